"""Sources and sinks on small trees of files, streams, and gray images."""

import json
import struct
import zlib

import numpy as np
import pytest

from framewright.operators import dedup, grouping, pixels
from framewright.sources import files
from framewright.streaming import unseen


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())


def png(pixels_rgb):
    h, w, _ = pixels_rgb.shape
    raw = b"".join(b"\0" + row.tobytes() for row in pixels_rgb)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("preset, want", [("caption", {"a.png", "b.JPG", "x y.webp"}), ("pair", {"a.png"}), ("small", {"a.png", "b.JPG"})])
def test_image_catalog(spark, tmp_path, preset, want):
    for name in ("a.png", "2_d/b.JPG", "2_d/e/x y.webp", "2_d/a.txt", "none"):
        put(tmp_path / name, "12345")
    rows = {r["filename"]: r for r in files.image_catalog(spark, str(tmp_path), preset).collect()}
    assert set(rows) == want
    assert (rows["a.png"]["rel_dir"], rows["a.png"]["stem"], rows["a.png"]["ext"], rows["a.png"]["size_bytes"]) == ("", "a", ".png", 5)
    if "x y.webp" in rows:
        assert (rows["x y.webp"]["rel_dir"], rows["x y.webp"]["stem"]) == ("2_d/e", "x y")


def test_sidecars(spark, tmp_path):
    put(tmp_path / "d/a.txt", "one\ntwo")
    put(tmp_path / "d/a_wd14.txt", "tag, tag")
    put(tmp_path / "b_blip.txt", "")
    put(tmp_path / "d/a.json", json.dumps({"pg_cap": "x", "n": "1"}))
    found = {tuple(r) for r in files.read_captions(spark, str(tmp_path)).collect()}
    assert found >= {("d", "a", "", "one\ntwo"), ("d", "a", "wd14", "tag, tag")}
    meta = files.read_caption_meta(spark, str(tmp_path)).collect()
    assert [(r["rel_dir"], r["stem"], r["meta"]) for r in meta] == [("d", "a", {"pg_cap": "x", "n": "1"})]


def test_tag_vocab_keeps_file_order(spark, tmp_path):
    put(tmp_path / "v.csv", "tag_id,name,category,count\n9,general,9,1\n3,a_b,0,2\n5,c_(d),4,3\n")
    rows = files.read_tag_vocab(spark, str(tmp_path / "v.csv")).orderBy("pos").collect()
    assert [r["name"] for r in rows] == ["general", "a_b", "c_(d)"]
    put(tmp_path / "w.csv", "name,tag_id,category\na,1,0\n")
    with pytest.raises(ValueError):
        files.read_tag_vocab(spark, str(tmp_path / "w.csv"))


def test_api_items(spark, tmp_path):
    put(tmp_path / "1.json", json.dumps({"page_no": 1, "items": [{"id": 7, "url": "u"}, {"id": 8, "url": "v"}]}))
    put(tmp_path / "2.json", json.dumps({"page_no": 2, "error": "none"}))
    rows = files.read_api_items(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r["page_no"], r["pos"], r["id"], r["url"]) for r in rows] == [(1, 0, 7, "u"), (1, 1, 8, "v")]


def test_streams_take_each_key_and_row_once(spark, tmp_path):
    def feed(n, rows):
        put(tmp_path / f"in/{n}.json", "\n".join(json.dumps({"url": u}) for u in rows))
        stream = spark.readStream.schema("url string").json(str(tmp_path / "in"))
        unseen.stream_pending(unseen.stream_unseen(stream, "url"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        return sorted(r["url"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert feed(1, ["a", "a", "b"]) == ["a", "b"]
    assert feed(2, ["b", "c"]) == ["a", "b", "c"]


def test_gray_images(spark, tmp_path):
    rgb = np.random.default_rng(3).integers(0, 256, (3, 5, 3), dtype=np.uint8)
    put(tmp_path / "a.png", png(rgb))
    put(tmp_path / "bad.png", "no image")
    rows = pixels.read_gray(spark, str(tmp_path))
    gray = np.rint(rgb.astype(float) @ np.array([0.299, 0.587, 0.114]))
    row = rows.collect()
    assert len(row) == 1 and (row[0]["width"], row[0]["height"]) == (5, 3)
    assert np.array_equal(np.array(row[0]["gray"]).reshape(3, 5), gray)
    at = lambda y, x: gray[abs(y) if y < 3 else 4 - y, abs(x) if x < 5 else 8 - x]
    lap = [at(y - 1, x) + at(y + 1, x) + at(y, x - 1) + at(y, x + 1) - 4 * at(y, x) for y in range(3) for x in range(5)]
    assert pixels.laplacian_variance(rows).first()["vol"] == pytest.approx(np.var(lap))
    sums = pixels.gray_row_sums(rows).orderBy("y").collect()
    assert [r["gray_sum"] for r in sums] == gray.sum(axis=1).tolist()


def test_empty_and_thin_images(spark):
    rows = spark.createDataFrame([(1, 1, 1, [5.0]), (2, 0, 0, []), (3, None, None, None), (4, 2, 1, [1.0, 3.0])], "id long, width int, height int, gray array<double>")
    vol = {r["id"]: r["vol"] for r in pixels.laplacian_variance(rows).collect()}
    assert vol == {1: 0.0, 2: None, 3: None, 4: pytest.approx(np.var([4.0, -4.0]))}
    assert {r["image_id"] for r in pixels.gray_row_sums(rows).collect()} == {1, 4}


def test_leaf_groups(spark):
    rows = spark.createDataFrame([(1, ""), (2, "a"), (3, "a/b"), (4, "c/d/e"), (5, "c/d/e/f"), (6, "c/g")], "id long, rel_dir string")
    assert {r["id"]: r["grp"] for r in dedup.leaf_groups(rows).collect()} == {1: None, 2: "a", 3: "a", 4: "c/d/e", 5: "c/d/e", 6: "c/g"}


@pytest.mark.parametrize("ids, n, want", [(3, 1000, 9), (3, 5, 5), (40, 100, 100), (0, 10, 0)])
def test_sample_unique_pairs(spark, ids, n, want):
    pairs = [tuple(r) for r in grouping.sample_unique_pairs(spark.range(ids), n, 1).collect()]
    assert len(pairs) == len(set(pairs)) == want
    assert set(pairs) == {tuple(r) for r in grouping.sample_unique_pairs(spark.range(ids), n, 1).collect()}


def test_vocabulary_options(spark):
    rows = [(0, "a_(b)_(c)", 4), (1, ">_<", 0), (2, "same_tag", 4), (3, "same_tag", 0), (4, "x;y_z", 9)]
    vocab = spark.createDataFrame(rows, "pos long, name string, category int")
    names = lambda **o: [r["name"] for r in grouping.vocab_normalise(vocab, **o).orderBy("pos").collect()]
    assert names(series_sep=", ", underscores=False) == ["a_(b), c", ">_<", "same_tag", "same_tag", "x;y_z"]
    assert names(replacements=r"same tag,one\,two;x\;y z,w") == ["a (b) (c)", ">_<", "same tag", "one,two", "w"]


def test_select_tags_options(spark):
    names, kinds = ["r1", "r2", "g1", "g2", "c1", "c2"], [9, 9, 0, 0, 4, 4]
    rows = spark.createDataFrame([([0.5, 0.5, 0.35, 0.2, 0.9, 0.8],)], "p array<double>")
    tags = lambda **o: rows.select(grouping.select_tags(rows["p"], names, kinds, **o).alias("t")).first()["t"]
    assert tags() == "r1, g1, c1, c2"
    assert tags(rating="last", characters_first=True, sep=",") == "c2,c1,g1,r1"
    assert tags(rating=None, always_first=["g1", "c2", "absent"], undesired=["c1 "]) == "c2, g1"


def test_page_order(spark):
    from framewright.sources.chains import page_order

    chain = [(f"a{i}", f"a{i + 1}" if i < 700 else None) for i in range(701)]
    lost = [("b0", "b1"), ("b2", "b3"), ("b3", "gone")]
    cycle = [(f"c{i}", f"c{(i + 1) % 5}") for i in range(5)] + [("d", "d")]
    merged = [("e0", "e1"), ("x", "e1"), ("e1", "e2"), ("e2", None)]
    rows = [*chain, *lost, *cycle, *merged, (None, "a0"), ("a3", "a4"), ("a3", None)]
    starts = spark.createDataFrame([("a0",), ("b0",), ("e0",), ("b0",)], "u string")
    got = {r["url"]: tuple(r)[1:] for r in page_order(spark.createDataFrame(rows, "url string, next string"), starts=starts).collect()}
    assert len(got) == len({u for u, _ in rows if u})
    assert all(got[f"a{i}"] == ("a0", i, "ok") for i in range(701))
    assert (got["b0"], got["b2"], got["b3"]) == (("b0", 0, "ok"), ("b2", 0, "broken"), ("b2", 1, "broken"))
    assert {got[u] for u in ("c0", "c1", "c2", "c3", "c4", "d")} == {(None, None, "cyclic")}
    assert (got["e0"], got["x"], got["e1"], got["e2"]) == (("e0", 0, "ok"), ("x", 0, "broken"), ("e1", 0, "merged"), ("e1", 1, "merged"))
    free = page_order(spark.createDataFrame(lost, "url string, next string"))
    assert {(r["url"], r["status"]) for r in free.collect()} == {("b0", "ok"), ("b2", "ok"), ("b3", "ok")}
    assert page_order(spark.createDataFrame([], "url string, next string")).count() == 0


def test_landed_pages_without_numbers(spark, tmp_path):
    def land(name, url, then, ids, **more):
        meta = {"metadata": {"nextPage": then}} if then else {}
        put(tmp_path / name, json.dumps({"url": url, "items": [{"id": i, "url": f"i{i % 4}"} for i in ids], **meta, **more}))

    # landed in no order; page 3 of the second source is lost
    land("z.json", "s/1", "s/2", [1, 2])
    land("b.json", "s/2", "s/3", [3])
    land("a.json", "s/3", None, [4, 5])
    land("q.json", "t/1", "t/2", [6])
    land("p.json", "t/3", None, [7])
    land("o.json", None, None, [8], page_no=4)
    land("n.json", None, None, [9])
    put(tmp_path / "m.json", json.dumps({"url": "u/1", "error": "none"}))
    starts = spark.createDataFrame([("s/1",), ("t/1",), ("u/1",)], "url string")
    items = files.read_api_items(spark, str(tmp_path), starts=starts)
    got = sorted((r["source"] or "", r["page_no"], r["pos"], r["id"]) for r in items.collect())
    assert got == [("", 4, 0, 8), ("s/1", 0, 0, 1), ("s/1", 0, 1, 2), ("s/1", 1, 0, 3), ("s/1", 2, 0, 4), ("s/1", 2, 1, 5), ("t/1", 0, 0, 6)]
    errors = {r["file"][-6:]: r["reason"] for r in files.read_api_errors(spark, str(tmp_path), starts=starts).collect()}
    assert errors == {"p.json": "broken", "n.json": "unnamed", "m.json": "no items"}
    # the order is what the cap and the stop rule need
    assert sorted(r["id"] for r in grouping.cap_per_source(items.filter("source is not null"), 3).collect()) == [1, 2, 3, 6]


def test_scratch_files_go(spark):
    from framewright.plans import session

    kept = session.staged(spark.range(5), "here")
    folder = session._scratches(spark)
    assert kept.count() == 5
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files_of = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert files_of.exists(path)
    session.drop_scratch(spark)
    assert not files_of.exists(path)
    assert session.staged(spark.range(5), "again").count() == 5 and spark.range(3).checkpoint().count() == 3
