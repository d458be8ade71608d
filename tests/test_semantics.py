"""Hand-computed cases: geometry, tags, names and file plans."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from framewright.functions import geometry as G
from framewright.functions import text as X
from framewright.operators import catalog as C
from framewright.operators import grouping as A
from framewright.sources import files as S


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("x")).first()["x"]
    return tuple(row) if hasattr(row, "asDict") else row


@pytest.mark.parametrize(
    ("box", "size", "want"),
    [
        ((0, 100, 100, 400), (1000, 1000), (0, 183, 100, 316)),  # 225 wide would pass the left edge: shrink to 133.3 high
        ((400, 100, 500, 400), (1000, 1000), (337, 100, 562, 400)),  # room on both sides: grow to 225 wide
        ((100, 0, 400, 100), (1000, 1000), (183, 0, 316, 100)),  # no room above: shrink to 133.3 wide
        ((10, 10, 110, 110), (200, 200), (10, 10, 110, 110)),
        ((10, 10, 60, 10), (200, 200), None),
    ],
)
def test_adjust_crop(spark, box, size, want):
    names = ("x1", "y1", "x2", "y2", "w", "h")
    got = one(spark, G.adjust_crop(*map(F.col, names)), **dict(zip(names, (*box, *size), strict=True)))
    assert got == want


def test_nearest_aspect(spark):
    wh = lambda w, h: one(spark, G.nearest_aspect(F.col("w"), F.col("h")), w=w, h=h)
    assert wh(640, 960) == ("640x960", 960) and wh(1500, 1000) == ("960x640", 1000) and wh(500, 500) == ("1024x1024", 500)
    assert wh(800, 600)[0] == "1024x768" and wh(700, 1000) == ("640x960", 1050) and wh(740, 1000)[0] == "768x1024"


def test_buckets(spark):
    wh = lambda w, h, **k: one(spark, G.select_bucket(F.col("w"), F.col("h"), **k), w=w, h=h)
    # 1254.1 x 836.1 at the largest area; by the height 832: 1248 wide
    assert wh(1500, 1000)[:4] == (1216, 832, 1248, 832) and wh(1500, 1000)[4] == pytest.approx(1216 / 832 - 1.5)
    assert wh(700, 500)[:4] == (640, 448, 700, 500)
    assert wh(500, 500, resos=G.SIZES_1024)[:4] == (1024, 1024, 1024, 1024)
    assert wh(896, 1152, resos=G.SIZES_1024) == (896, 1152, 896, 1152, 0.0)
    assert wh(600, 900, resos=G.SIZES_1024)[:4] == (896, 1152, 896, 1344)


def test_crop_ltrb(spark):
    at = lambda *v: one(spark, G.crop_ltrb(*map(F.col, "abcd")), **dict(zip("abcd", v, strict=True)))
    assert at(1024, 1024, 500, 1000) == (256.0, 0.0, 768.0, 1024.0)
    assert at(1024, 512, 1000, 1000) == (256.0, 0.0, 768.0, 512.0)
    assert at(512, 1024, 1000, 500) == (0.0, 384.0, 512.0, 640.0)


def test_center_windows(spark):
    names = ("x1", "y1", "x2", "y2")
    crop = lambda *v: one(spark, G.center_crop(*map(F.col, names), F.lit(448), F.lit(576)), **dict(zip(names, v, strict=True)))
    assert crop(100.9, 100.9, 500.9, 500.9) == (76, 12, 524, 588) and crop(0, 0, 249, 600) is None
    near = one(spark, G.center_crop_nearest(*map(F.col, names), sizes=((256, 256), (512, 512))), x1=100, y1=100, x2=400, y2=400)
    assert near == (122, 122, 378, 378)
    cut = lambda w, h: one(spark, G.center_cut_paste(F.col("w"), F.col("h")), w=w, h=h)
    assert cut(100, 50) == (2, 0, 98, 50, 0, 23) and cut(96, 96) == (0, 0, 96, 96, 0, 0) and cut(41, 201) == (0, 52, 41, 148, 27, 0)


def test_crop_plan(spark):
    rows = [(1, 0, 3, 0.9, 0.0, 0.0, 600.0, 600.0), (1, 1, 3, 0.9, 0.0, 0.0, 1100.0, 1100.0), (1, 2, 3, 0.1, 0.0, 0.0, 1100.0, 1100.0), (2, 0, 1, 0.9, 0.0, 0.0, 100.0, 100.0)]
    df = spark.createDataFrame(rows, "image_id long, det_idx long, class_id int, confidence double, x1 double, y1 double, x2 double, y2 double")
    images = spark.createDataFrame([(1, 2000, 2000), (2, 2000, 2000), (3, 400, 300)], "image_id long, img_w int, img_h int")
    df = df.join(images, "image_id")
    name = F.format_string("f%d.png", "image_id")
    got = lambda **k: sorted(tuple(r)[:4] + (r["name"],) for r in A.crop_plan(df, confidence=0.3, images=images, filename=name, **k).collect())
    frames = [(2, "xx", 0, 1024, "f2.png"), (3, "xx", 0, 1024, "f3.png")]
    assert got(upscaler=True) == [(1, "03", 0, 512, "f1.png"), (1, "03", 1, 1024, "f1_1.png"), *frames]
    assert got() == [(1, "03", 0, 1024, "f1.png"), *frames]
    assert got(mode="fixed") == [(1, "03", 0, 512, "f1.png"), (1, "03", 1, 1024, "f1_1.png"), *frames]


def test_flatten_tree(spark):
    names = ["n.png", "n.png", "n_1.png", "n.png", "m.png", "n_1.png", "n_2_1.png", "n_2.png", "m.jpg", "n_2.png", "k_1.png", "k_2.png"]
    rows = [(i, f"a/{i % 4}", x, x.rsplit(".", 1)[0]) for i, x in enumerate(names)] + [(50, "", "n.png", "n"), (51, "b", "n.png", "n")]
    df = spark.createDataFrame(rows, "id long, rel_dir string, filename string, stem string")
    caps = df.filter("id <> 3").select("rel_dir", "stem")
    taken, texts, want = set(), set(), {}
    for i, rel, name, stem in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        sub, ext = rel.split("/")[0] or ".", name[len(stem) :]

        def free(used, first, ext, sub=sub, stem=stem):
            for k in itertools.count():
                if (x := f"{sub}/{stem}_{k}{ext}" if k else f"{sub}/{first}") not in used:
                    used.add(x)
                    return x

        has = any(r[1] == rel and r[3] == stem and r[0] != 3 for r in rows)
        want[i] = (free(taken, name, ext), free(texts, f"{stem}.txt", ".txt") if has else None)
    got = {r["id"]: (r["dest"], r["caption_dest"]) for r in A.flatten_tree(df, caps).collect()}
    assert got == want and len({d for d, _ in got.values()}) == len(rows)


@pytest.mark.parametrize("seed", range(3))
def test_first_free_names_against_a_walk(spark, seed):
    r = random.Random(seed)
    stems = ["n", "n_1", "n_2", "n_3", "n_7", "n_1_1", "n_1_2", "n_1_1_1", "n_2_1", "n_01", "m", "m_2"]
    rows = [(i, f"a/{r.randint(0, 3)}", f"{r.choices(stems, [9, 4, 2, 2, 1, 3, 1, 1, 2, 2, 3, 2])[0]}{r.choice(['.png', '.png', '.jpg', ''])}") for i in range(150)]
    taken, want = set(), {}
    for i, rel, name in sorted(rows, key=lambda x: (x[1], x[2], x[0])):
        stem, dot, ext = name.partition(".")
        want[i] = next(x for k in itertools.count() if (x := f"{stem}_{k}{dot}{ext}" if k else name) not in taken)
        taken.add(want[i])
    df = spark.createDataFrame(rows, "id long, rel_dir string, filename string").repartition(4)
    assert {x["id"]: x["dest"][2:] for x in A.flatten_tree(df).collect()} == want


def test_frames_of_a_folder_are_no_single_task(spark):
    rows = spark.range(20_000).select("id", F.concat(F.lit("a/"), F.col("id") % 3).alias("rel_dir"), F.format_string("f_%08d.png", F.when(F.col("id") == 7, 8).otherwise(F.col("id"))).alias("filename"))
    df = A.flatten_tree(rows)
    assert "Pandas" not in df._jdf.queryExecution().toString()
    names = df.select("dest", F.spark_partition_id().alias("p")).collect()
    assert len({r["dest"] for r in names}) == 20_000 and "a/f_00000008_1.png" in {r["dest"] for r in names}


def test_tags(spark):
    probs = F.array(*(F.lit(x) for x in (0.9, 0.2, 0.8, 0.6)))
    pick = lambda **k: one(spark, A.select_tags(probs, ["safe", "bad", "cat", "ann"], [9, 9, 0, 4], **k))
    assert pick() == "safe, cat, ann" and pick(undesired=["safe"]) == "cat, ann" and pick(rating=None) == "cat, ann"
    assert pick(existing=F.lit("dog, cat,\n")) == "dog, cat, safe, ann" and pick(existing=F.lit(None).cast("string")) == "safe, cat, ann"
    clean = lambda t: one(spark, X.remove_substring_tags(F.col("t")), t=t)
    assert clean("cat, black cat, dog, dog, at") == "black cat, dog, dog" and clean("") == "" and clean(",,") == ", , " and clean("a,,aa") == "aa"
    assert one(spark, X.remove_phrases(F.col("t"), ["score_9"]), t="score_9, score_9 x, score_5_up,y") == "  x, y"


def test_links_and_images(spark):
    html = '<a href="/x/" tagindex="-1"> <b>X</b> y</a><a class="q" href="z.png">Z</a><a href="/">no</a>'
    links = lambda **k: [tuple(x) for x in one(spark, X.html_links(F.col("h"), **k), h=html)]
    assert links() == [("x", "X y"), ("z.png", "Z")] and links(attribute=("tagindex", "-1")) == [("x", "X y")] and links(ext=".png") == [("z.png", "Z")]
    html = '<article class="p"><img src="/1.png"><span class="sprite-id">#1.2</span></article><article class="p"><p>none</p></article><article class="q"><img src="/2.png"></article>'
    images = lambda **k: [tuple(x) for x in one(spark, X.html_images(F.col("h"), **k), h=html)]
    assert images() == [("/1.png", "1_2"), ("/2.png", "unknown")] and images(article_class="p") == [("/1.png", "1_2")]


def test_null_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(1, None, "s", " x "), (2, "a", "s", "y"), (3, None, "t", None)], "id long, rel_dir string, stem string, text string")
    got = sorted(tuple(r) for r in A.chunk_prompts(df, 2, F.coalesce("text", F.lit(""))).collect())
    assert [(i, f, n) for i, f, n, _ in got] == [(1, 1, 1), (2, 2, 1), (3, 1, 2)] and got[0][3] == '--prompt "x, " --negative_prompt ""'


def test_failures_by_source_and_batch(spark):
    rows = [(s, i, not (s == "a" and 3 <= i <= 5) and not (s == "b" and 4 <= i <= 7)) for s in ("a", "b") for i in range(12)]
    log = spark.createDataFrame(rows, "source string, seq long, ok boolean")
    left = lambda **k: {s: max(r["seq"] for r in A.cut_after_failures(log, limit=3, source="source", **k).collect() if r["source"] == s) for s in ("a", "b")}
    assert left(batch=500) == {"a": 5, "b": 6} and left(batch=5) == {"a": 11, "b": 7} and left(batch=4) == {"a": 11, "b": 6}


def test_score_batches(spark):
    df = spark.createDataFrame([(i, None if i == 7 else f"t{i}") for i in range(20)], "id long, text string").coalesce(1)

    def model(frame):
        assert len(frame) <= 6
        return frame[["id"]].assign(n=[len(x) for x in frame["text"]])

    done = spark.createDataFrame([(0,), (1,)], "id long")
    got = {r["id"]: (r["n"], r["error"]) for r in A.score_batches(df, model, "id long, n long", batch=6, done=done, report=True).collect()}
    assert set(got) == set(range(2, 20)) and got[7][0] is None and "TypeError" in got[7][1] and got[12] == (3, None)


def test_labels_and_grids(spark):
    df = spark.createDataFrame([(1, "4.png"), (2, "7a.png"), (3, "4_7.png"), (4, "x.png")], "id long, filename string").withColumn("text", F.lit("a (b) [c]"))
    names = spark.createDataFrame([("4", "Ann")], "id string, name string")
    assert {r["id"]: r["label"] for r in C.label_from_id(df, names, "text").collect()} == {1: "ann, a b c", 2: "7, a b c"}
    assert {r["id"]: r["label"] for r in C.label_from_ids(df, names, "text").collect()} == {3: "fusion 7_body in ann_style, a b c"}
    cells = spark.createDataFrame([("s.0.png",), ("s.3.png",), ("t.1.png",), ("s.x.png",)], "filename string")
    assert [r["blank"] for r in C.dense_grid(C.indexed(cells, "s"), 5, 2).orderBy("idx").collect()] == [False, True, True, False, True] and C.grid_rows(5, 2) == 3


def test_upsert_of_captions(spark):
    new = spark.createDataFrame([(1, 1, "k", "new"), (1, 0, "k", "older"), (2, 0, "j", "x")], "image_id long, turn int, key string, text string")
    old = spark.createDataFrame([(1, {"k": "old", "z": "kept"}), (3, {"q": "alone"})], "image_id long, meta map<string,string>")
    assert {r["image_id"]: r["meta"] for r in A.merge_caption_results(new, old).collect()} == {1: {"k": "new", "z": "kept"}, 2: {"j": "x"}, 3: {"q": "alone"}}


def test_api_pages(spark, tmp_path):
    item = '{"id": 1, "url": "u", "width": 700, "height": 700, "stats": {"heartCount": 9, "likeCount": 9, "laughCount": 1, "cryCount": 1}, "meta": {"prompt": "p"}}'
    (tmp_path / "1.json").write_text('{"page_no": 1, "items": [' + item + ', {"id": 2, "meta": null}]}')
    (tmp_path / "2.json").write_text('{"page_no": 2, "error": "no"}')
    (tmp_path / "3.json").write_text("{broken")
    items = S.read_api_items(spark, str(tmp_path))
    assert sorted((r["page_no"], r["pos"], r["id"]) for r in items.collect()) == [(1, 0, 1), (1, 1, 2)]
    assert [r["id"] for r in C.filter_api_quality(items).collect()] == [1]
    assert sorted((r["page_no"] or 0, r["file"][-6:]) for r in S.read_api_errors(spark, str(tmp_path)).collect()) == [(0, "3.json"), (2, "2.json")]


def test_odd_file_names(spark, tmp_path):
    folder = tmp_path / "1_a+b c"
    folder.mkdir()
    for name in ("100%.png", "a+b.png", "ü x.PNG"):
        (folder / name).write_bytes(b"x")
    (folder / "a+b%20.txt").write_text("t")
    got = {r["filename"]: (r["rel_dir"], r["folders"], r["stem"]) for r in S.image_catalog(spark, str(tmp_path)).collect()}
    assert got == {n: ("1_a+b c", ["1_a+b c"], n.rsplit(".", 1)[0]) for n in ("100%.png", "a+b.png", "ü x.PNG")}
    assert [(r["rel_dir"], r["stem"]) for r in S.read_captions(spark, str(tmp_path)).collect()] == [("1_a+b c", "a+b%20")]


def test_vocab_places_and_prompt_order(spark, tmp_path):
    (tmp_path / "tags.csv").write_text("tag_id,name,category,count\n" + "".join(f"{i},n{i},0,1\n" for i in range(50)))
    assert [r["pos"] for r in S.read_tag_vocab(spark, str(tmp_path / "tags.csv")).orderBy("pos").collect()] == list(range(50))
    df = spark.createDataFrame([(i, f"d{i % 3}", "s", f"line {i}") for i in range(30)], "id long, rel_dir string, stem string, text string")
    S.write_prompt_files(A.chunk_prompts(df, 10, F.col("text")), str(tmp_path / "out"))
    first = next((tmp_path / "out" / "file_no=1").glob("*.txt")).read_text().splitlines()
    assert [x.split('"')[1] for x in first] == [f"line {i}, " for i in range(0, 30, 3)]


def test_batches_from_a_start(spark):
    # numbers 3 to 14 in batches of 5: 3-7, 8-12, 13-14; failures from 5 on
    log = spark.createDataFrame([(i, i < 5) for i in range(3, 15)], "seq long, ok boolean")
    last = lambda **k: max(r["seq"] for r in A.cut_after_failures(log, batch=5, **k).collect())
    assert last(limit=4) == 11 and last(limit=4, start=0) == 8 and last(limit=3) == 7 and last(limit=6) == 14
    rows = {r["batch"]: (r["n_ok"], r["n"], r["stopped"]) for r in A.fetch_batch_summary(log, 5, 4).collect()}
    assert rows == {0: (2, 5, False), 1: (0, 4, True)}
    assert {r["batch"]: r["n"] for r in A.fetch_batch_summary(log, 5, 100, start=2).collect()} == {0: 4, 1: 5, 2: 3}


def test_batches_by_source_start_at_its_least_number(spark):
    rows = [(s, first + i, i < 2) for s, first in (("a", 7), ("b", 100), (None, 4)) for i in range(6)]
    log = spark.createDataFrame(rows, "source string, seq long, ok boolean")
    kept = A.cut_after_failures(log, batch=4, limit=2, source="source").collect()
    assert {s: max(r["seq"] for r in kept if r["source"] == s) for s in ("a", "b", None)} == {"a": 10, "b": 103, None: 7}


def test_sample_leaves_the_root_out(spark):
    rows = [(i, x, f"s{i}") for i, x in enumerate(["", "", "", "a", "a/b", "a/b", "c"])]
    df = spark.createDataFrame(rows, "id long, rel_dir string, stem string")
    got = A.sample_per_folder(df, 2, 1).collect()
    assert sorted({r["dir"] for r in got}) == ["a", "a/b"] and len(got) == 4
    assert {r["id"] for r in got if r["dir"] == "a/b"} == {4, 5}


def test_a_null_map_becomes_a_new_one(spark):
    df = spark.createDataFrame([(None, " t "), ({"k": "old", "z": "1"}, "t"), ({}, None)], "m map<string,string>, t string")
    assert [r["m"] for r in df.select(X.upsert_meta(F.col("m"), "k", F.col("t")).alias("m")).collect()] == [{"k": "t"}, {"z": "1", "k": "t"}, {"k": None}]


@pytest.mark.parametrize(("w", "h"), [(0, 10), (10, 0), (0, 0), (-3, 10), (None, 10)])
def test_images_without_a_size(spark, w, h):
    df = spark.createDataFrame([(w, h)], "w int, h int")
    w, h = F.col("w"), F.col("h")
    made = (G.select_bucket(w, h), G.select_bucket(w, h, resos=G.SIZES_1024), G.crop_ltrb(F.lit(64), F.lit(64), w, h), G.fit_letterbox(w, h))
    assert [tuple(df.select(x.alias("x")).collect()[0]) for x in made] == [(None,)] * 4


def test_videos_without_frames_or_rate(spark):
    df = spark.createDataFrame([(1, 0.0, 100), (2, 10.0, 0), (3, 10.0, 60), (4, 10.0, 45_000), (5, None, 9)], "video_idx long, fps double, frame_count long")
    for rows in (A.frame_plan(df).collect(), A.frame_plan(df, end=4500.0).collect(), A.frame_plan_legacy(df).collect()):
        assert {(r["video_idx"]) for r in rows} == {3, 4}
        of = lambda v: sorted(r["frame"] for r in rows if r["video_idx"] == v)  # noqa: B023, E731
        assert len(of(3)) == 4 and len(of(4)) == 3000 and of(4)[0] == 0 and of(4)[-1] >= 44_999
    assert [r["frame"] for r in A.frame_plan(df, per_min=10).filter("video_idx = 3").collect()] == [0]


def test_frequencies_are_ordered(spark):
    df = spark.createDataFrame([(["b", "a"],), (["b", "c"],), (["a", "d"],)], "tags array<string>")
    assert [tuple(r) for r in A.tag_frequency(df).collect()] == [("a", 2), ("b", 2), ("c", 1), ("d", 1)]


def test_logged_urls_lose_their_line_ends(spark):
    items = spark.createDataFrame([(1, 0, 0, "u"), (2, 0, 1, "v"), (3, 1, 0, "v"), (4, 1, 1, "w")], "id long, page_no int, pos int, url string")
    seen = spark.createDataFrame([("u\n",), (" w\r\n",), (None,)], "url string")
    assert [r["id"] for r in C.unseen_urls(items, seen).collect()] == [2]


def test_a_hot_key_ships_k_rows_a_task(spark):
    df = spark.range(40_000, numPartitions=20).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"), "id", F.xxhash64("id").alias("v"))
    rows = df.collect()
    want = {g: sorted((r["v"], r["id"]) for r in rows if r["g"] == g)[:3] for g in {r["g"] for r in rows}}
    got = A.top_k(df, ["g"], ["v", "id"], 3)
    assert sorted((r["g"], r["rank"], r["v"], r["id"]) for r in got.collect()) == sorted((g, k, *x) for g, own in want.items() for k, x in enumerate(own, 1))
    # ranked and cut before the first exchange, between the two, and after
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 3


def test_numbers_by_run_and_by_weight(spark):
    df = spark.range(500).select("id", (F.xxhash64("id") % 50).alias("v"))
    order = {r["id"]: k for k, r in enumerate(sorted(df.collect(), key=lambda r: (r["v"], r["id"])), 1)}
    assert {r["id"]: r["rn"] for r in A.numbered_by_run(df, F.floor(F.col("v") / 10), "v", "id").collect()} == order
    assert {r["id"]: r["rn"] for r in A.numbered(df, "v", "id").collect()} == order
    sums = {r["id"]: r["rn"] for r in A.numbered(df, "v", "id", weight=(F.col("id") % 3)).collect()}
    assert all(sums[i] == sum(j % 3 for j in order if order[j] <= order[i]) for i in order)


def test_pages_of_logged_urls_end_a_source(spark):
    rows = [("s", page, pos, f"u{page}{pos}", page < 4) for page in range(6) for pos in range(2)]
    items = spark.createDataFrame(rows, "source string, page_no int, pos int, url string, ok boolean")
    seen = spark.createDataFrame([("u10\n",), ("u20",), ("u21 ",)], "url string")
    take = lambda *a: sorted((r["page_no"], r["pos"]) for r in A.take_until_empty_page(items, F.col("ok"), *a).collect())
    assert take(100) == [(p, q) for p in range(4) for q in range(2)]
    assert take(100, seen) == [(0, 0), (0, 1), (1, 1)] and take(2, seen) == [(0, 0), (0, 1)]
