"""Hashed pairs, logs of keys, models in workers, long vocabularies, images as bytes."""

import json
import math
import os
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators import dedup, grouping, hooks, pixels
from framewright.sources import files
from framewright.streaming import unseen


def near_vectors(spark, n=3000, dims=48):
    r = np.random.default_rng(4)
    base = r.standard_normal((n // 3, dims))
    rows = np.concatenate([base, base + 0.15 * r.standard_normal(base.shape), r.standard_normal((n - 2 * (n // 3), dims))])
    made = [(i, i % 2 if i < 2 * len(base) and i % len(base) % 2 else 0, v.tolist()) for i, v in enumerate(rows)]
    return spark.createDataFrame([*made, (n, 0, [0.0] * dims), (n + 1, 0, None)], "id long, grp int, vec array<double>").repartition(8)


def test_pairs_by_hashes(spark):
    emb = near_vectors(spark).cache()
    exact = {(r["a"], r["b"]): r["sim"] for r in dedup.similar_pairs(emb.filter("vec is not null"), 0.92).collect()}
    found = {(r["a"], r["b"]): r["sim"] for r in dedup.similar_pairs_hashed(emb, 0.92, 0.95).collect()}
    assert len(exact) > 600 and set(found) <= set(exact) and len(found) >= 0.93 * len(exact)
    assert all(abs(found[p] - exact[p]) < 1e-9 for p in found)
    assert dedup.similar_pairs_hashed(emb, 0.92, 0.95).count() == len(found)  # the same whenever it is run
    with pytest.raises(ValueError):
        dedup.similar_pairs_hashed(emb, -0.1)


def test_hashes_compare_few_pairs(spark):
    """Rows shipped grow with the rows; pairs that meet by chance are a small share of all pairs."""
    bits, tables = dedup.hash_plan(0.95, 1_000_000, 0.95)
    same = 1 - np.arccos(0.95) / np.pi
    assert 1 - (1 - same**bits) ** tables >= 0.95 and tables <= 60 and tables / 2**bits < 1e-3
    assert dedup.hash_plan(0.95, 10, 0.95)[1] <= dedup.hash_plan(0.95, 10_000, 0.95)[1]


def test_few_copies_are_shipped():
    """At low thresholds too, where hashes tell little: a row goes to few tables, and its chance to meet holds."""
    for threshold in (0.0, 0.25, 0.5, 0.8):
        for n in (10, 12_000, 1_000_000):
            bits, tables = dedup.hash_plan(threshold, n, 0.95)
            assert tables <= 32 and 1 - (1 - (1 - np.arccos(threshold) / np.pi) ** bits) ** tables >= 0.95


def test_strips_have_each_pair_once(monkeypatch):
    r = np.random.default_rng(2)
    one, two = r.standard_normal((57, 4)), r.standard_normal((31, 4))
    monkeypatch.setattr(dedup, "STRIP", 200)
    for other, want in ((two, one @ two.T > 0.5), (one, np.triu(one @ one.T > 0.5, 1))):
        met = [(i, j, s) for x, y, sims in dedup._over(one, other, 0.5) for i, j, s in zip(x.tolist(), y.tolist(), sims, strict=True)]
        assert sorted((i, j) for i, j, _ in met) == list(map(tuple, np.argwhere(want).tolist()))
        assert all(abs(s - one[i] @ other[j]) < 1e-12 for i, j, s in met)


def test_pairs_and_recall_in_blocks(spark, monkeypatch):
    """Groups and buckets of many blocks, with rows that have no group: pairs as by brute force, found ones once, counted row by row."""
    monkeypatch.setattr(dedup, "BLOCK", 48 * 20)
    emb = near_vectors(spark, 300).withColumn("grp", F.expr("case when id % 10 = 7 then null else grp end")).cache()
    rows = [(x["id"], x["grp"], np.array(x["vec"])) for x in emb.filter("vec is not null and grp is not null and id < 300").collect()]
    cos = lambda v, w: v @ w / np.sqrt((v @ v) * (w @ w))
    want = {(a, b) for a, g, v in rows for b, h, w in rows if a < b and g == h and cos(v, w) > 0.25}
    exact = [(x["a"], x["b"]) for x in dedup.similar_pairs(emb, 0.25).collect()]
    found = [(x["a"], x["b"]) for x in dedup.similar_pairs_hashed(emb, 0.25, 0.8).collect()]
    assert len(want) > 500 and len(exact) == len(want) == len(set(exact)) and set(exact) == want
    assert len(found) == len(set(found)) and 0.8 * len(want) < len(found) < len(want) and set(found) < want
    each = dedup.recall_of_hashes(emb, 0.25, 0.8).agg(F.sum("pairs"), F.sum("found"), F.sum("wrong")).first()
    assert tuple(each) == (len(want), len(found), 0)


def test_near_duplicates_by_hashes(spark):
    from framewright.plans.session import with_checkpoints

    with_checkpoints(spark)
    emb = near_vectors(spark, 600).filter("vec is not null")
    status = {r["id"]: r["status"] for r in dedup.near_duplicates(emb, 0.9, recall=0.99).collect()}
    pairs = {(r["a"], r["b"]) for r in dedup.similar_pairs(emb, 0.9).collect()}
    kept = {i for i, s in status.items() if s == "keep"}
    assert len(status) == 601 and sum(a in kept and b in kept for a, b in pairs) <= 0.05 * len(pairs)
    assert all(any(b == i and a in kept for a, b in pairs) for i, s in status.items() if s == "delete")


def greedy(rows, threshold):
    """Status and has_duplicates by hand, of ``id, grp, vec``."""
    near = lambda v, w: v.any() and w.any() and v @ w / np.sqrt((v @ v) * (w @ w)) > threshold
    rows, kept = [(i, g, None if v is None else np.array(v)) for i, g, v in sorted(rows, key=lambda x: x[0])], []
    sound = [x for x in rows if x[1] is not None and x[2] is not None]
    for i, g, v in sound:
        if not any(g == h and near(v, w) for _, h, w in kept):
            kept.append((i, g, v))
    ids = {i for i, _, _ in kept}
    linked = {i for i, g, v in kept if any(g == h and i != j and near(v, w) for j, h, w in sound)}
    return {i: ("keep" if i in ids or g is None or v is None else "delete", i in linked) for i, g, v in rows}


def no_pairs(*args):
    raise AssertionError("pairs are listed")


def test_near_duplicates_by_leaf_in_rounds(spark, monkeypatch):
    """Groups of up to ten blocks; rows of the root have no group, one row has no vector, one is zero."""
    from framewright.plans.session import with_checkpoints

    with_checkpoints(spark)
    monkeypatch.setattr(dedup, "BLOCK", 48 * 20)
    monkeypatch.setattr(dedup, "similar_pairs", no_pairs)
    folder = F.expr("case when id % 10 = 7 then '' when id % 3 > 0 then concat('a', if(id % 4 = 0, '/s', '')) else concat('b/c', id % 2) end")
    emb = near_vectors(spark, 300).withColumn("rel_dir", folder).drop("grp").cache()
    top = lambda x: None if x == "" else x if x.startswith("b") else "a"
    rows = [(x["id"], top(x["rel_dir"]), x["vec"]) for x in emb.collect()]
    for threshold in (0.25, 0.9):
        got = {x["id"]: (x["status"], x["has_duplicates"]) for x in dedup.near_duplicates_by_leaf(emb, threshold).collect()}
        assert got == greedy(rows, threshold)


def test_near_duplicates_in_rounds(spark, monkeypatch):
    """Copies across blocks, kept rows whose only neighbours are deleted ones before them, rows without group or vector."""
    from framewright.plans.session import with_checkpoints

    with_checkpoints(spark)
    monkeypatch.setattr(dedup, "BLOCK", 2 * 30)
    monkeypatch.setattr(dedup, "similar_pairs", no_pairs)
    r = random.Random(6)
    turn = lambda d: [math.cos(math.radians(d)), math.sin(math.radians(d))]
    rows = [(i, r.choice([0, 0, 0, 1, None]), turn(r.randrange(720) / 2) if i % 9 else [0.0, 0.0]) for i in r.sample(range(10_000), 300)]
    rows += [(20_000 + i, 2, turn(x)) for i, x in enumerate([0, 20, 40] + [20] * 90 + [90, 70, 41])] + [(30_000, 2, None)]
    emb = spark.createDataFrame(rows, "id long, grp int, vec array<double>").repartition(6).cache()
    got = {x["id"]: (x["status"], x["has_duplicates"]) for x in dedup.near_duplicates(emb, math.cos(math.radians(25.25))).collect()}
    assert got == greedy(rows, math.cos(math.radians(25.25))) and got[20_002] == ("keep", True) and got[20_001] == ("delete", False)


def test_three_batches_of_a_stream(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")

    def feed(name, urls):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"in/{name}.json").write_text("\n".join(json.dumps({"url": u, "pos": i}) for i, u in enumerate(urls)))
        stream = spark.readStream.schema("url string, pos int").json(str(tmp_path / "in"))
        unseen.stream_unseen_logged(stream, "url", ["pos"], log, out, str(tmp_path / "state")).awaitTermination()
        return sorted((r["batch"], r["url"], r["pos"]) for r in spark.read.schema("url string, pos int, batch int").parquet(out).collect())

    one = feed("1", ["b", "a\n", "a", None, "b \r\n"])
    assert one == [(0, "a", 1), (0, "b", 0)]
    two = feed("2", ["c", "b", "\ta", "c"])
    assert two == [*one, (1, "c", 0)]
    # batch 1 once more, as after a failure between the two writes
    again = spark.createDataFrame([("c", 0), ("b", 1), ("a", 2), ("c", 3)], "url string, pos int")
    unseen.take_unseen(again, 1, "url", ["pos"], log, out)
    unseen.compact_log(spark, log, 2)
    assert feed("3", ["d", "c", "a", "b"]) == [*two, (2, "d", 0)]
    assert sorted(r["key"] for r in unseen.read_log(spark, log).collect()) == ["a", "b", "c", "d"]
    assert {r["batch"] for r in unseen.read_log(spark, log).collect()} == {-1, 2}
    # no state but the offsets and the log
    assert not [f for f in (tmp_path / "state").rglob("*") if f.parent.name == "state" and f.name == "state"]


def test_the_log_is_not_shuffled_for_a_small_batch(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    unseen.take_unseen(spark.range(5000).select(F.concat(F.lit("u"), "id").alias("url"), "id"), 0, "url", ["id"], log, out)
    unseen.take_unseen(spark.range(4990, 5010).select(F.concat(F.lit("u"), "id").alias("url"), "id"), 1, "url", ["id"], log, out)
    assert spark.read.parquet(f"{out}/batch=1").count() == 10
    assert sum(f.name.startswith("part=") for f in (tmp_path / "log/batch=1").iterdir()) <= 10


def test_one_setup_a_worker(spark, tmp_path):
    folder = str(tmp_path)

    def setup():
        open(f"{folder}/{os.getpid()}-{random.random()}", "w").close()
        return lambda f: f[["id"]].assign(pid=os.getpid())

    rows = hooks.score_with(spark.range(2000, numPartitions=40), setup, "id long, pid long", batch=10).collect()
    made = [name.split("-")[0] for name in os.listdir(folder)]
    assert len(rows) == 2000 and len(made) == len(set(made)) and {str(r["pid"]) for r in rows} == set(made)


def test_a_rerun_scores_only_the_rest(spark, tmp_path):
    out, seen = str(tmp_path / "out"), tmp_path / "seen"
    seen.mkdir()
    df = spark.range(200)

    def model(fails):
        def setup():
            def score(f):
                if fails is not None and (f["id"] == fails).any():
                    raise RuntimeError("out of memory")
                for i in f["id"]:
                    (seen / f"{i}-{random.random()}").touch()
                return f[["id"]].assign(n=f["id"] * 2)

            return score

        return setup

    chunk = {r["id"]: r["c"] for r in df.select("id", F.pmod(F.xxhash64("id"), F.lit(5)).alias("c")).collect()}
    bad = next(i for i in range(200) if chunk[i] == 3)
    with pytest.raises(Exception, match="out of memory"):
        hooks.score_resumable(df, model(bad), "id long, n long", out, chunks=5)
    before = {int(f.name.split("-")[0]) for f in seen.iterdir() if chunk[int(f.name.split("-")[0])] < 3}
    assert before == {i for i in range(200) if chunk[i] < 3}
    for f in seen.iterdir():
        f.unlink()
    rows = hooks.score_resumable(df, model(None), "id long, n long", out, chunks=5).collect()
    assert sorted((r["id"], r["n"]) for r in rows) == [(i, 2 * i) for i in range(200)]
    assert {int(f.name.split("-")[0]) for f in seen.iterdir()} == {i for i in range(200) if chunk[i] >= 3}
    later = hooks.score_resumable(spark.range(203), model(None), "id long, n long", out, chunks=5)
    assert later.count() == 203


def tagged(p, names, kinds, general=0.35, character=0.35, undesired=(), rating="first", characters_first=False, always_first=()):
    skipped = {u.strip() for u in undesired}
    tags = []
    for v, name, kind in zip(p, names, kinds, strict=False):
        if v is not None and name not in skipped and ((kind == 0 and v >= general) or (kind == 4 and v >= character)):
            tags.insert(0 if kind == 4 and characters_first else len(tags), name)
    best = max((i for i in range(min(len(p), len(names))) if kinds[i] == 9), key=lambda i: (p[i], -i), default=None)
    if rating and best is not None and names[best] not in skipped:
        tags.insert(0 if rating == "first" else len(tags), names[best])
    for x in always_first:
        if x in tags:
            tags.remove(x)
            tags.insert(0, x)
    return tags


def test_ten_thousand_slots(spark):
    r = np.random.default_rng(7)
    n = 10_000
    names, kinds = [f"t{i % 9990}" for i in range(n)], [9] * 4 + r.choice([0, 4], n - 4).tolist()
    rows = [(i, (r.random(n) * (r.random(n) < 0.01)).astype(np.float32).tolist()) for i in range(40)] + [(40, None), (41, [0.5, 0.5, 0.1, 0.0, 0.9, None, 0.7]), (42, [0.4] * (n + 3))]
    df = spark.createDataFrame(rows, "id long, p array<float>").repartition(4)
    own = [(i, p if p is None else [x if x is None else float(np.float32(x)) for x in p]) for i, p in rows]
    for options in ({}, {"rating": "last", "characters_first": True, "undesired": ["t1", " t7 ", "t9"], "always_first": ["t8", "t30", "t8000"]}, {"rating": None, "general": 0.8, "character": 0.2}):
        tags = grouping.select_tag_arrays(df, "p", names, kinds, **options)
        assert {x["id"]: x["tags"] for x in tags.collect()} == {i: p if p is None else tagged(p, names, kinds, **options) for i, p in own}
    assert grouping.tag_frequency(tags).count() > 100


def test_arrays_and_text_of_tags_agree(spark):
    names, kinds = [f"t{i}" for i in range(30)], [9] * 4 + [0] * 16 + [4] * 10
    df = spark.range(200).select("id", F.transform(F.sequence(F.lit(1), F.lit(30)), lambda k: F.abs(F.hash("id", k)) / 2147483648.0).alias("p"))
    for options in ({}, {"rating": "last", "characters_first": True, "undesired": ["t5 ", "t2"], "always_first": ["t8", "t25"]}):
        both = grouping.select_tag_arrays(df, "p", names, kinds, **options).select(F.array_join("tags", ", ").alias("a"), grouping.select_tags(F.col("p"), names, kinds, **options).alias("b")).collect()
        assert all(x["a"] == x["b"] for x in both)


def png(data, kind):
    h, w = data.shape[:2]
    raw = b"".join(b"\0" + row.tobytes() for row in data)
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_images_as_bytes(spark, tmp_path):
    r = np.random.default_rng(3)
    made = {"a": (r.choice([0, 9], (5, 7, 4)).astype(np.uint8), 6), "b": (r.choice([0, 200], (4, 3, 3)).astype(np.uint8), 2), "c": (r.choice([0, 5], (3, 4)).astype(np.uint8), 0), "d": (np.full((1, 1, 4), 7, np.uint8), 6)}
    made["e"] = (np.concatenate([np.zeros((2, 6, 3), np.uint8), np.full((3, 6, 3), 99, np.uint8), np.zeros((1, 6, 3), np.uint8)]), 2)
    pixel_rows, rgba_of = [], {}
    for name, (m, kind) in made.items():
        (tmp_path / f"{name}.png").write_bytes(png(m, kind))
        h, w = m.shape[:2]
        full = np.concatenate([np.repeat(m.reshape(h, w, 1), 3, 2), np.full((h, w, 1), 255, np.uint8)], 2) if m.ndim == 2 else m if m.shape[2] == 4 else np.concatenate([m, np.full((h, w, 1), 255, np.uint8)], 2)
        rgba_of[name] = full
        pixel_rows += [(name, x, y, full[y, x].tobytes().hex(), w, h) for y in range(h) for x in range(w)]
    (tmp_path / "broken.png").write_text("no image")
    raw = pixels.read_raw(spark, str(tmp_path)).withColumn("id", F.regexp_extract("id", r"(\w+)\.png$", 1))
    wanted = grouping.boundary_mode_color(spark.createDataFrame(pixel_rows, "image_id string, x int, y int, rgba string, w int, h int"))
    assert {x["id"]: x["rgba"] for x in pixels.edge_colors(raw).collect()} == {x["image_id"]: x["rgba"] for x in wanted.collect()}
    gray = pixels.read_gray(spark, str(tmp_path)).withColumn("id", F.regexp_extract("id", r"(\w+)\.png$", 1))
    for threshold in (20, 1000):
        bounds = grouping.letterbox_bounds(pixels.gray_row_sums(gray), threshold)
        assert {x["id"]: (x["top"], x["bottom"]) for x in pixels.row_bounds(raw, threshold).collect()} == {x["image_id"]: (x["top"], x["bottom"]) for x in bounds.collect()}
    empty = spark.createDataFrame([("n", 0, 0, 3, None), ("z", 0, 0, 3, bytearray())], "id string, width int, height int, channels int, data binary")
    assert [tuple(x) for x in pixels.edge_colors(empty).collect()] == [("n", None), ("z", None)]
    assert [tuple(x) for x in pixels.row_bounds(empty).collect()] == [("n", None, None), ("z", None, None)]


def test_sizes_by_header(spark, tmp_path):
    segment = lambda kind, body: b"\xff" + bytes([kind]) + struct.pack(">H", len(body) + 2) + body
    frame = lambda kind, w, h: segment(kind, b"\x08" + struct.pack(">HH", h, w) + b"\x03" + b"\0" * 9)
    tables = segment(0xE1, b"x" * 65_000) + segment(0xC4, b"\x08" + b"\0" * 20) + b"\xff"
    made = {
        "a.png": (png(np.zeros((3, 5, 3), np.uint8), 2), (5, 3)),
        "b.jpg": (b"\xff\xd8" + tables + frame(0xC0, 640, 480) + b"\xff\xda", (640, 480)),
        "c.jpeg": (b"\xff\xd8" + segment(0xE0, b"JFIF") + frame(0xC2, 70_000 % 65_536, 9), (4464, 9)),
        "d.gif": (b"GIF89a" + struct.pack("<HH", 300, 200) + b"\0" * 5, (300, 200)),
        "e.bmp": (b"BM" + b"\0" * 12 + struct.pack("<IiiHH", 40, 31, -17, 1, 24), (31, 17)),
        "f.bmp": (b"BM" + b"\0" * 12 + struct.pack("<IHHHH", 12, 8, 9, 1, 24), (8, 9)),
        "g.webp": (b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + (99).to_bytes(3, "little") + (49).to_bytes(3, "little"), (100, 50)),
        "h.webp": (b"RIFF\0\0\0\0WEBPVP8 " + b"\0" * 10 + struct.pack("<HH", 20, 10), (20, 10)),
        "i.webp": (b"RIFF\0\0\0\0WEBPVP8L" + b"\0" * 5 + struct.pack("<I", 11 | 21 << 14) + b"\0" * 5, (12, 22)),
        "j.png": (b"\x89PNG", (None, None)),
        "k.jpg": (b"\xff\xd8" + segment(0xE0, b"JFIF"), (None, None)),
    }
    for name, (data, _) in made.items():
        (tmp_path / name).write_bytes(data)
    rows = files.image_catalog(spark, str(tmp_path)).collect()
    assert {r["filename"]: (r["width"], r["height"]) for r in rows} == {name: size for name, (_, size) in made.items()}
    plan = files.image_catalog(spark, str(tmp_path)).select("path", "size_bytes")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "content" not in plan.split("ReadSchema")[-1]
