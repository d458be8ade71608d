"""Aggregations, rankings, plans and tag selection."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions.geometry import adjust_crop
from framewright.functions.text import frame_name, merge_tag_lists, py_strip, uniform
from framewright.plans.session import scratch, staged

#: Parts of a random order that are numbered in one task each.
RUNS = 4096


def tag_frequency(tagged: DataFrame, column: str = "tags") -> DataFrame:
    """``tag, n``, the most frequent first, equal ones by tag."""
    return tagged.select(F.explode(column).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int, rank: str = "rank", parts: int = 32) -> DataFrame:
    """The first ``k`` rows of each key in ``order``, with their ``rank``.

    Each task ranks what it reads and ships at most ``k`` rows a key to one of ``parts`` parts of the key; the parts' best are
    ranked again. So a key with most of the rows is no long task, and its last ranking sees ``parts * k`` rows.
    """
    own = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(parts)))
    first = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    best = own.withColumn(rank, first).filter(F.col(rank) <= k).drop("_part")
    return best.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)


def folder_repeats(images: DataFrame, per_epoch: int = 160) -> DataFrame:
    """Repeats that bring a folder to about ``per_epoch`` images, 1 to 4, and its new name."""
    clean = F.regexp_replace(F.element_at(F.split("rel_dir", "/"), -1), r"^\d+_", "")
    counted = images.groupBy("rel_dir").agg(F.count(F.lit(1)).alias("n")).withColumn("clean", clean)
    times = F.greatest(F.lit(1), F.least(F.lit(4), F.bround(F.lit(float(per_epoch)) / F.col("n"), 0).cast("int")))
    counted = counted.withColumn("repeats", F.when(F.col("clean").isin("other", "0other"), 1).otherwise(times))
    return counted.select("rel_dir", "n", "repeats", F.concat_ws("_", F.col("repeats").cast("string"), "clean").alias("new_name"))


def dedup_summary(dedup: DataFrame) -> DataFrame:
    kept = F.count_if(F.col("status") == "keep")
    return dedup.groupBy("grp").agg(F.count(F.lit(1)).alias("initial"), kept.alias("retained"), (F.count(F.lit(1)) - kept).alias("deleted"))


def bucket_histogram(bucketed: DataFrame) -> DataFrame:
    """Images of each bucket; ids rank the (few) buckets by width, then height."""
    return bucketed.groupBy("w", "h").agg(F.count(F.lit(1)).alias("n")).withColumn("bucket_id", F.dense_rank().over(Window.orderBy("w", "h")) - 1)


def shard_summary(sharded: DataFrame) -> DataFrame:
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


def merge_caption_results(results: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """A map of key to text for each image; of repeated keys the last turn wins, of its texts the greatest.

    ``existing`` (``image_id, meta``) keeps its other keys and its images without results.
    """
    last = results.groupBy("image_id", "key").agg(F.max(F.struct("turn", "text")).alias("t"))
    new = last.groupBy("image_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "t.text")))).alias("meta"))
    if existing is None:
        return new
    both = existing.select("image_id", F.col("meta").alias("old")).join(new, "image_id", "full_outer")
    kept = F.map_filter("old", lambda k, _: ~F.array_contains(F.map_keys("meta"), k))
    merged = F.when(F.col("old").isNull(), F.col("meta")).when(F.col("meta").isNull(), F.col("old")).otherwise(F.map_concat(kept, "meta"))
    return both.select("image_id", merged.alias("meta"))


def fetch_batch_summary(log: DataFrame, batch: int = 500, limit: int = 100, start: int | None = None) -> DataFrame:
    """``batch, n_ok, n, stopped`` of each batch of the kept log; batches count from 0 at ``start``, else at the least number."""
    log = _batched(log, batch, start, []).withColumnRenamed("_batch", "batch")
    kept = cut_after_failures(log, batch, limit, start=start)
    done = kept.groupBy("batch").agg(F.count_if("ok").alias("n_ok"), F.count(F.lit(1)).alias("n"))
    sizes = log.groupBy("batch").agg(F.count(F.lit(1)).alias("of"))
    return done.join(sizes, "batch").select("batch", "n_ok", "n", (F.col("n") < F.col("of")).alias("stopped"))


def boundary_mode_color(pixels: DataFrame) -> DataFrame:
    """The most frequent colour of each image's four edges, corners twice; the smallest of equals."""
    edges = (F.col("x") == 0).cast("int") + (F.col("x") == F.col("w") - 1).cast("int") + (F.col("y") == 0).cast("int") + (F.col("y") == F.col("h") - 1).cast("int")
    counts = pixels.withColumn("k", edges).filter("k > 0").groupBy("image_id", "rgba").agg(F.sum("k").alias("n"))
    return counts.groupBy("image_id").agg(F.min_by("rgba", F.struct(-F.col("n"), "rgba")).alias("rgba"))


def letterbox_bounds(sums: DataFrame, threshold: float = 20) -> DataFrame:
    """First and last rows over the threshold; the whole image where there's none."""
    lit = F.when(F.col("gray_sum") > threshold, F.col("y"))
    return sums.groupBy("image_id").agg(F.coalesce(F.min(lit), F.min("y")).alias("top"), F.coalesce(F.max(lit), F.max("y")).alias("bottom"))


def keep_largest(images: DataFrame, n: int) -> DataFrame:
    """The ``n`` PNGs of each folder whose shorter sides are longest; of equal ones the last by name."""
    side = F.least("width", "height")
    return top_k(images.filter(F.col("filename").endswith(".png")), ["rel_dir"], [side.desc(), F.col("filename").desc()], n, "_k").drop("_k")


def select_sharpest(scores: DataFrame, n: int = 100) -> DataFrame:
    """Top n of each folder by scaled variance plus one minus scaled similarity; constant columns add nothing."""
    spans = scores.groupBy(F.col("grp").alias("_g")).agg(*(f(c).alias(f"_{c}_{n}") for c in ("vol", "ssim") for n, f in (("lo", F.min), ("hi", F.max))))
    norm = lambda c: F.try_divide(F.col(c) - F.col(f"_{c}_lo"), F.col(f"_{c}_hi") - F.col(f"_{c}_lo"))
    score = F.coalesce(norm("vol"), F.lit(0.0)) + F.coalesce(1 - norm("ssim"), F.lit(0.0))
    scored = scores.join(spans, F.col("grp").eqNullSafe(F.col("_g"))).select(*scores.columns, score.alias("score"))
    return top_k(scored, ["grp"], [F.col("score").desc(), F.col("path")], n)


def sample_per_folder(captions: DataFrame, k: int = 2, seed: int = 0) -> DataFrame:
    """k files of each folder below the root, drawn from all below it; smaller folders are left out."""
    parts = F.split("rel_dir", "/")
    above = captions.select("*", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))).alias("dir")).filter("dir <> ''")
    path = F.concat_ws("/", "rel_dir", "stem")
    ranked = top_k(above, ["dir"], [uniform(seed, F.col("dir"), path), F.col("rel_dir"), F.col("stem"), F.col("id")], k)
    enough = above.groupBy("dir").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") >= k).select("dir")
    return ranked.join(enough, "dir", "left_semi")


def numbered(df: DataFrame, *order: str, weight: Column | None = None) -> DataFrame:
    """Adds ``rn``, the row's place in the whole order from 1, nulls first.

    The order is dealt to tasks in ranges, which are written once in the shared folder, so that they don't change; a row's place is
    that in its range after the rows of the ranges before. So neither all rows nor a large folder is one task. With ``weight`` (a
    whole number a row, at least 0) ``rn`` is the sum of the weights up to the row.
    """
    path = scratch(df.sparkSession, "numbered")
    own = df.withColumn("_w", F.lit(1) if weight is None else weight)
    ranged = own.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    return _ranked(df.sparkSession.read.schema(ranged.schema).parquet(path), order).select(*df.columns, "rn")


def numbered_by_run(df: DataFrame, run: Column, *order: str) -> DataFrame:
    """As ``numbered``, by an order in which ``run`` never falls: each run is a task's work, and nothing is written."""
    return _ranked(df.withColumn("_w", F.lit(1)).withColumn("_range", run), order).select(*df.columns, "rn")


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    # a row for each range
    sums = rows.groupBy("_range").agg(F.sum("_w").alias("n"))
    before = sums.select("_range", F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    until = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_r", F.sum("_w").over(until)).join(F.broadcast(before), "_range").withColumn("rn", F.col("_before") + F.col("_r"))


def chunk_prompts(lines: DataFrame, max_lines: int, line: Column, prefix: str = "", suffix: str = "", negative: str = "", order: Sequence[str] = ("rel_dir", "stem", "id")) -> DataFrame:
    """Prompt lines, stripped, with the file of at most ``max_lines`` that each goes to and its place there from 1."""
    text = F.concat(F.lit(f'--prompt "{prefix}'), py_strip(line), F.lit(f', {suffix}" --negative_prompt "{negative}"'))
    at = F.col("rn") - 1
    return numbered(lines, *order).select("id", (F.floor(at / max_lines) + 1).alias("file_no"), (F.pmod(at, F.lit(max_lines)) + 1).alias("line_no"), text.alias("line"))


def assign_shards(pairs: DataFrame, n: int = 5, seed: int = 0) -> DataFrame:
    """Even shards of a random order; the first (count mod n) have one row more."""
    ranked = numbered_by_run(pairs.withColumn("_u", uniform(seed, F.col("id"))), F.floor(F.col("_u") * RUNS), "_u", "id")
    total = pairs.agg(F.count(F.lit(1)).alias("_n"))
    small, more = F.floor(F.col("_n") / n), F.col("_n") % n
    i = F.col("rn") - 1
    shard = F.when(i < more * (small + 1), F.floor(i / (small + 1))).otherwise(more + F.floor(F.try_divide(i - more * (small + 1), small)))
    return ranked.join(F.broadcast(total)).withColumn("shard", (shard + 1).cast("int")).drop("_u", "_n", "rn")


def _batched(log: DataFrame, batch: int, start: int | None, keys: Sequence[str]) -> DataFrame:
    """Adds ``_batch``, counted from 0 at ``start``, else at the least number of the log, or of its source."""
    if start is not None:
        return log.withColumn("_batch", F.floor((F.col("seq") - start) / batch))
    least = log.groupBy(*(F.col(k).alias("_of") for k in keys)).agg(F.min("seq").alias("_start"))
    own = log.join(least, F.col(keys[0]).eqNullSafe(F.col("_of"))) if keys else log.join(F.broadcast(least))
    return own.select(*log.columns, F.floor((F.col("seq") - F.col("_start")) / batch).alias("_batch"))


def cut_after_failures(log: DataFrame, batch: int = 500, limit: int = 100, source: str | None = None, start: int | None = None) -> DataFrame:
    """The log up to the row that makes a run of ``limit`` failures within ``batch`` numbers; all after it goes.

    Batches count from ``start``, else from the least number, and runs start anew with each. With ``source`` each value of that column is a log of its own.
    """
    keys = [source] if source else []
    numbers = _batched(log, batch, start, keys)
    own = Window.partitionBy(*keys, "_batch")
    until = own.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    run = F.col("seq") - F.coalesce(F.max(F.when(F.col("ok"), F.col("seq"))).over(until), F.min("seq").over(own) - 1)
    hit = numbers.withColumn("_run", run).filter(F.col("_run") >= limit).groupBy(*keys).agg(F.min("seq").alias("_cut"))
    if source:
        cut = log.join(hit.withColumnRenamed(source, "_of"), F.col(source).eqNullSafe(F.col("_of")), "left")
    else:
        cut = log.join(F.broadcast(hit), how="left")
    return cut.filter(F.col("_cut").isNull() | (F.col("seq") <= F.col("_cut"))).select(*log.columns)


def take_until_empty_page(items: DataFrame, passing: Column, max_images: int, seen: DataFrame | None = None) -> DataFrame:
    """Passing items in page order up to the first page that has none, at most ``max_images`` a source.

    With ``seen`` (``url``, white space at its ends aside) logged urls don't pass, so a page of such alone ends its source.
    """
    if seen is not None:
        logged = seen.select(py_strip(F.col("url")).alias("url")).distinct().withColumn("_logged", F.lit(True))
        items = items.join(logged, "url", "left").select(*items.columns, (passing & F.col("_logged").isNull()).alias("_passes"))
        return take_until_empty_page(items, F.col("_passes"), max_images).drop("_passes")
    pages = items.groupBy("source", "page_no").agg(F.bool_or(passing).alias("any"))
    stop = pages.filter(~F.col("any")).groupBy("source").agg(F.min("page_no").alias("stop"))
    rows = items.filter(passing).join(stop, "source", "left").filter(F.col("stop").isNull() | (F.col("page_no") < F.col("stop"))).drop("stop")
    return cap_per_source(rows, max_images)


def cap_per_source(df: DataFrame, n: int = 250, order: Sequence[str] = ("page_no", "pos")) -> DataFrame:
    return top_k(df, ["source"], order, n, "_k").drop("_k")


def crop_plan(
    detections: DataFrame, upscaler: bool = False, t: float = 1.0, mode: str = "scaled", confidence: float = 0.0, images: DataFrame | None = None, filename: Column | None = None
) -> DataFrame:
    """A row for each crop that is kept, and a whole-frame row for each image without one.

    ``scaled`` leaves out crops whose longer side is under 512 ``t``, makes those over 1024 ``t`` 1024 long and the rest
    512 if there's an upscaler; ``fixed`` leaves out those with a side under 250 and makes those over 768 long
    1024, the rest 512. Detections under ``confidence`` give no crop. ``images`` (``image_id, img_w, img_h``) names
    images that may have no detection at all. With ``filename`` each row has ``name``, numbered from the second crop on.
    """
    if images is not None:
        detections = images.select("image_id", "img_w", "img_h").join(detections.drop("img_w", "img_h"), "image_id", "left")
    boxes = detections.withColumn("box", adjust_crop(*(F.col(c) for c in ("x1", "y1", "x2", "y2", "img_w", "img_h"))))
    bw, bh = F.col("box.x2") - F.col("box.x1"), F.col("box.y2") - F.col("box.y1")
    most = F.greatest(bw, bh)
    if mode == "fixed":
        target = F.when(F.least(F.abs(bw), F.abs(bh)) < 250, F.lit(None)).when(most > 768, 1024).otherwise(512)
    else:
        target = F.when(most < 512 * t, F.lit(None)).when(most > 1024 * t, 1024).otherwise(F.lit(512) if upscaler else F.lit(None))
    sure = F.coalesce(F.col("confidence") >= confidence, F.lit(False)) if "confidence" in detections.columns else F.col("det_idx").isNotNull()
    boxes = boxes.withColumn("target", F.when(sure & F.col("box").isNotNull(), target).cast("int"))
    own = Window.partitionBy("image_id")
    kept = F.col("target").isNotNull()
    # crops in order of detection, then the rest; the first row of an image without a crop stands for its frame
    boxes = boxes.withColumn("crop_idx", F.row_number().over(own.orderBy(F.col("target").isNull(), "det_idx")) - 1).withColumn("_first", F.max(kept).over(own))
    rows = boxes.filter(kept | (~F.col("_first") & (F.col("crop_idx") == 0)))
    whole = adjust_crop(F.lit(0), F.lit(0), F.col("img_w"), F.col("img_h"), F.col("img_w"), F.col("img_h"))
    rows = rows.withColumn("box", F.when(kept, F.col("box")).otherwise(whole))
    folder = F.when(kept, F.format_string("%02d", "class_id")).otherwise("xx")
    columns = [F.col("image_id"), folder.alias("subfolder"), "crop_idx", F.coalesce("target", F.lit(1024)).alias("target"), "box.x1", "box.y1", "box.x2", "box.y2"]
    if filename is not None:
        numbered_name = F.concat(F.expr("substr(_name, 1, length(_name) - 4)"), F.lit("_"), F.col("crop_idx").cast("string"), F.lit("."), F.expr("right(_name, 3)"))
        rows = rows.withColumn("_name", filename)
        columns.append(F.when(F.col("crop_idx") > 0, numbered_name).otherwise(F.col("_name")).alias("name"))
    return rows.select(*columns)


def _running(df: DataFrame, keys: Sequence[str], at: str, sums: dict[str, Column], run: int = 65_536) -> DataFrame:
    """Adds running sums before each row, by keys in the order of ``at`` (whole numbers), summed in runs of ``run`` so that no key is one task."""
    own = df.withColumn("_run", F.floor(F.col(at) / run))
    totals = own.groupBy(*keys, "_run").agg(*(F.sum(v).alias(f"_{n}") for n, v in sums.items()))
    before = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "_run", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums))
    until = Window.partitionBy(*keys, "_run").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    rows = own.join(totals, [*keys, "_run"])
    return rows.select(*df.columns, *((F.coalesce(F.sum(v).over(until), F.lit(0)) + F.col(f"_{n}")).alias(n) for n, v in sums.items()))


def _passed_over(taken: DataFrame) -> DataFrame:
    """The numbers of ``taken`` (``g, k, before, need``) that their group passes over, with ``v``, the group's row that would have come to them.

    Group ``g`` numbers ``need`` rows in order, each with its first free number. Number k is a name of its own, first used after ``before`` of
    the group's rows. A row comes to k if k less the numbers passed over below it is that row's place; it passes over k if k was used
    before. Whether it does depends on the smaller numbers of the group, so bounds on how many of those are passed over are narrowed in rounds,
    until they decide every number. A round decides at least the first open number of each group, and nearly always all.
    """
    # k is passed over if fewer than ``limit`` below it are
    now = taken.select("g", "k", "need", (F.col("k") - F.col("before")).alias("limit"), F.lit(None).cast("int").alias("over"))
    open_ = True
    while open_:
        bounds = _running(now, ["g"], "k", {"least": F.coalesce("over", F.lit(0)), "most": F.coalesce("over", F.lit(1))})
        over = F.when(F.col("most") < F.col("limit"), 1).when(F.col("least") >= F.col("limit"), 0)
        now = staged(bounds.select("g", "k", "need", "limit", over.alias("over")), "passed-over")
        open_ = not now.filter("over is null").isEmpty()
    below = _running(now, ["g"], "k", {"below": F.col("over")})
    return below.select("g", "k", "need", "over", (F.col("k") - F.col("below")).alias("v"))


def _first_free(rows: DataFrame, name: str, order: Sequence[str], out: str) -> DataFrame:
    """Adds ``out``: for each row in order, the first of ``name``, ``name_1`` and on that no row before it in ``sub`` has taken.

    A group is the rows of one name in a ``sub``. Its i-th row that needs a number gets the i-th number that is free. Only rows named ``name_k``
    themselves can take a number from it, and it can take the name from them; so groups are settled in the order of their nesting
    (``n``, ``n_1``, ``n_1_1``), a level at a time, from a row for each such pair of names. Rows are numbered by ranges of the order and meet
    the passed-over numbers as rows between them, so neither a folder, nor a name that many rows have, is one task.
    """
    split = r"^(.*?)(\.[^.]*)?$"
    stem, ext = F.regexp_extract("_n", split, 1), F.regexp_extract("_n", r"(\.[^.]*)$", 1)
    rows = rows.withColumn("_n", F.col(name)).withColumn("g", F.struct("sub", "_n"))
    columns = [c for c in rows.columns if c not in ("_n", "g")]
    first = F.min(F.struct(*order)).alias("first")
    groups = staged(rows.groupBy("g").agg(F.count(F.lit(1)).alias("c"), first), "names")
    # names that are another name's numbered form, with that name's group and the number
    numbered_form = r"^(.*)_([1-9][0-9]{0,17})$"
    stem_of, ext_of = F.regexp_extract("g._n", split, 1), F.regexp_extract("g._n", r"(\.[^.]*)$", 1)
    forms = groups.withColumn("_s", stem_of).filter(F.col("_s").rlike(numbered_form)).withColumn("k", F.regexp_extract("_s", numbered_form, 2).cast("long"))
    forms = forms.withColumn("base", F.struct(F.col("g.sub").alias("sub"), F.concat(F.regexp_extract("_s", numbered_form, 1), ext_of).alias("_n")))
    pairs = forms.join(groups.select(F.col("g").alias("base"), F.col("c").alias("base_c")), "base").select("base", "g", "k", "c", "base_c", "first")
    pairs = staged(pairs, "numbered-names")
    if pairs.isEmpty():
        # no name can take another's number
        at = numbered(rows, "sub", "_n", *order)
        start = at.groupBy("g").agg(F.min("rn").alias("start"))
        i = F.col("rn") - F.col("start")
        return at.join(start, "g").withColumn(out, F.when(i == 0, F.col("_n")).otherwise(F.concat(stem, F.lit("_"), i.cast("string"), ext))).select(*columns, out)
    # marks stand in a group's order where a name that is one of its numbered forms is first used; they weigh nothing
    marks = pairs.select(F.col("base.sub").alias("sub"), F.col("base._n").alias("_n"), *(F.col(f"first.{c}").alias(c) for c in order), F.lit(0).alias("_real"), F.col("g").alias("_form"))
    both = rows.withColumn("_real", F.lit(1)).drop("g").unionByName(marks, allowMissingColumns=True)
    at = numbered(both, "sub", "_n", *order, "_real", weight=F.col("_real"))
    at = at.withColumn("g", F.struct("sub", "_n"))
    start = at.groupBy("g").agg((F.min("rn") - F.min_by("_real", F.struct("rn", -F.col("_real")))).alias("start"))
    at = staged(at.join(start, "g").withColumn("i", F.col("rn") - F.col("start")).drop("start", "rn"), "places")
    used = at.filter("_real = 0").select(F.col("_form").alias("g"), F.col("i").alias("seen"))
    pairs = staged(pairs.drop("first").join(used, "g"), "numbered-names")
    # a level at a time: groups whose name is nobody's numbered form keep their first row's name
    free = pairs.select(F.col("base").alias("g")).distinct().join(pairs.select("g"), "g", "left_anti").withColumn("own", F.lit(1))
    free, settled, over = staged(free, "settled"), None, None
    while not free.isEmpty():
        settled = free if settled is None else settled.unionByName(free)
        # of the rows seen before a form's first use, the first may have kept its name
        taken = pairs.join(free.withColumnRenamed("g", "base"), "base")
        taken = taken.select(F.col("base").alias("g"), "k", F.greatest(F.col("seen") - F.col("own"), F.lit(0)).alias("before"), (F.col("base_c") - F.col("own")).alias("need"))
        found = _passed_over(taken)
        found_over = found.filter("over = 1 and v <= need").select("g", "v")
        over = found_over if over is None else over.unionByName(found_over)
        forms_now = pairs.select("g", "base", "k").join(found.select(F.col("g").alias("base"), "k", "over", "v", "need"), ["base", "k"])
        free = staged(forms_now.select("g", F.when((F.col("over") == 0) & (F.col("v") <= F.col("need")), 0).otherwise(1).alias("own")), "settled")
    # the row that comes to a passed-over number, and all after it, get one more
    real = at.filter("_real = 1").join(settled, "g", "left").withColumn("v", F.col("i") - F.coalesce("own", F.lit(1)))
    steps = over.groupBy("g", "v").agg(F.count(F.lit(1)).alias("_more"))
    jump = _running_at(real.join(over.select("g").distinct(), "g", "left_semi").select("g", "v"), steps)
    real = real.join(jump, ["g", "v"], "left").withColumn("_no", F.col("v") + F.coalesce("_jump", F.lit(0)))
    return real.withColumn(out, F.when(F.col("v") == 0, F.col("_n")).otherwise(F.concat(stem, F.lit("_"), F.col("_no").cast("string"), ext))).select(*columns, out)


def _running_at(places: DataFrame, steps: DataFrame) -> DataFrame:
    """``g, v, _jump``: for each of ``places`` (``g, v``) the sum of ``_more`` over the group's ``steps`` at ``v`` or before."""
    both = places.select("g", "v", F.lit(0).alias("_more"), F.lit(1).alias("_place")).unionByName(steps.select("g", "v", "_more", F.lit(0).alias("_place")))
    # steps at a place come before it
    rows = _running(both.withColumn("_at", F.col("v") * 2 + F.col("_place")), ["g"], "_at", {"_jump": F.col("_more")})
    return rows.filter("_place = 1").select("g", "v", "_jump")


def flatten_tree(images: DataFrame, captions: DataFrame | None = None) -> DataFrame:
    """Adds ``dest``, the image's path in a tree of first folders only; with ``captions`` also ``caption_dest``.

    In order of folder, name and id, an image whose name is taken gets the first free ``_1``, ``_2`` and on. The caption of its
    folder and stem, if there's one, is copied as well, under the first free name by a count of its own.
    """
    sub = F.element_at(F.split("rel_dir", "/"), 1)
    rows = images.withColumn("sub", F.when(F.col("rel_dir") == "", ".").otherwise(sub))
    rows = _first_free(rows, "filename", ("rel_dir", "filename", "id"), "_name").withColumn("dest", F.concat_ws("/", "sub", "_name")).drop("_name")
    if captions is None:
        return rows
    has = captions.select("rel_dir", "stem").distinct()
    own = rows.join(has, ["rel_dir", "stem"], "left_semi").select("sub", "rel_dir", "filename", "id", F.concat("stem", F.lit(".txt")).alias("txt"))
    named = _first_free(own, "txt", ("rel_dir", "filename", "id"), "_name").select("id", F.concat_ws("/", "sub", "_name").alias("caption_dest"))
    return rows.join(named, "id", "left")


def unique_dest_names(df: DataFrame) -> DataFrame:
    """The k-th collision on ``dest`` gets the k-th letter before its extension; past ``j`` the name is null."""
    k = F.row_number().over(Window.partitionBy("dest").orderBy("id")) - 1
    stem, ext = F.regexp_extract("dest", r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract("dest", r"(\.[^.]*)$", 1)
    named = F.when(F.col("k") == 0, F.col("dest")).when(F.col("k") <= 10, F.concat(stem, F.substr(F.lit("abcdefghij"), F.col("k"), F.lit(1)), ext))
    return df.withColumn("k", k.cast("int")).withColumn("unique_dest", named).drop("k")


def ordered_catalog(df: DataFrame, column: str = "path") -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def _to_front(tags: Column, tag: str) -> Column:
    """The first occurrence of the tag, if any, moved to the front."""
    at = F.array_position(tags, tag)
    return F.when(at > 0, F.concat(F.array(F.lit(tag)), F.filter(tags, lambda x, i: i != at - 1))).otherwise(tags)


def select_tags(
    probs: Column,
    names: Sequence[str],
    categories: Sequence[int],
    general: float = 0.35,
    character: float = 0.35,
    undesired: Sequence[str] = (),
    sep: str = ", ",
    rating: str | None = "first",
    characters_first: bool = False,
    always_first: Sequence[str] = (),
    existing: Column | None = None,
) -> Column:
    """Tag text of a score vector, for a vocabulary in the vector's order.

    Categories are 9 (ratings), 0 (general) and 4 (characters). General and character tags count
    at or over their thresholds; ``characters_first`` puts the characters in front, the last one
    first. The best rating (the first of equals) stands ``first``, ``last`` or nowhere (None), unless it is undesired.
    Each tag of ``always_first`` that is there then moves to the front. With ``existing`` caption
    text, its tags come first and only new ones follow; where it is null, as without it. Null scores give null.
    """
    # one literal: the optimizer folds it to an array, however long the vocabulary
    table = F.from_json(F.lit(json.dumps([{"n": n, "c": c} for n, c in zip(names, categories, strict=True)])), "array<struct<n:string,c:int>>")
    scored = F.zip_with(probs, table, lambda p, t: F.struct(p.cast("double").alias("p"), t.n.alias("n"), t.c.alias("c")))
    skipped = [u.strip() for u in undesired]
    wanted = lambda x: ~x.n.isin(skipped) if skipped else F.lit(True)
    plain = lambda x: (x.c == 0) & (x.p >= general) & wanted(x)
    person = lambda x: (x.c == 4) & (x.p >= character) & wanted(x)
    of = lambda keep: F.transform(F.filter(scored, keep), lambda x: x.n)
    tags = F.concat(F.reverse(of(person)), of(plain)) if characters_first else of(lambda x: plain(x) | person(x))
    if rating:
        ratings = F.filter(scored, lambda x: x.c == 9)
        best = F.array(F.array_max(F.transform(ratings, lambda x, i: F.struct(x.p.alias("p"), (-i).alias("i"), x.n.alias("n")))))
        best = F.transform(F.filter(best, lambda x: x.isNotNull() & wanted(x)), lambda x: x.n)
        tags = F.concat(best, tags) if rating == "first" else F.concat(tags, best)
    for first in always_first:
        tags = _to_front(tags, first)
    if existing is None:
        return F.array_join(tags, sep)
    before = F.regexp_replace(existing, r"^\n+|\n+$", "")
    return F.when(existing.isNull(), F.array_join(tags, sep)).otherwise(merge_tag_lists(before, tags, sep))


def select_tag_arrays(
    df: DataFrame,
    probs: str,
    names: Sequence[str],
    categories: Sequence[int],
    general: float = 0.35,
    character: float = 0.35,
    undesired: Sequence[str] = (),
    rating: str | None = "first",
    characters_first: bool = False,
    always_first: Sequence[str] = (),
    out: str = "tags",
) -> DataFrame:
    """Adds ``out``, the array of tags that ``select_tags`` joins; for vocabularies of thousands of slots, and for ``tag_frequency``.

    The vocabulary is broadcast once (it is as long as a score vector). A batch of vectors is one matrix that is compared with the
    slots' thresholds at once; only what passes becomes Python values.
    """
    kinds = np.array(categories)
    skipped = {u.strip() for u in undesired}
    known = np.array([n not in skipped for n in names], dtype=bool)
    least = np.where(kinds == 0, general, np.where(kinds == 4, character, np.inf))
    least[~known] = np.inf
    shared = df.sparkSession.sparkContext.broadcast((np.array(names, dtype=object), kinds == 4, np.flatnonzero(kinds == 9), least, known))

    def pick(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names, person, ratings, least, known = shared.value
        for vectors in batches:
            tags: list = [None if v is None else [] for v in vectors]
            at = [i for i, v in enumerate(vectors) if v is not None]
            scores = np.full((len(at), len(names)), -np.inf)
            for row, i in enumerate(at):
                own = np.asarray(vectors.iloc[i], dtype=np.float64)[: len(names)]
                scores[row, : len(own)] = np.where(np.isnan(own), -np.inf, own)
            over = scores >= least
            best = ratings[scores[:, ratings].argmax(axis=1)] if len(ratings) and len(at) else []
            for row, i in enumerate(at):
                slots = np.flatnonzero(over[row])
                if characters_first:
                    slots = np.concatenate([slots[person[slots]][::-1], slots[~person[slots]]])
                found = names[slots].tolist()
                if rating and len(ratings) and known[best[row]]:
                    found = [names[best[row]], *found] if rating == "first" else [*found, names[best[row]]]
                for tag in always_first:
                    if tag in found:
                        found.remove(tag)
                        found.insert(0, tag)
                tags[i] = found
            yield pd.Series(tags)

    pick.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(out, F.pandas_udf(pick, "array<string>")(F.col(probs).cast("array<double>")))


def vocab_normalise(vocab: DataFrame, series_sep: str | None = None, underscores: bool = True, replacements: str = "") -> DataFrame:
    """The names of a vocabulary (``pos, name, category``) as captions show them.

    ``series_sep`` parts a character's trailing ``(series)`` from it; ``underscores`` become spaces
    in names of over three characters; ``replacements`` are ``source,target`` pairs between
    semicolons (both marks escaped by a backslash), each for the first match only: general tags
    before characters before ratings. The table is small: the windows run over one name's rows.
    """
    name = F.col("name")
    if series_sep is not None:
        parts = F.split(name, r"\(")
        head = F.regexp_replace(F.array_join(F.slice(parts, 1, F.size(parts) - 1), "("), "_$", "")
        series = F.concat(head, F.lit(series_sep), F.replace(F.element_at(parts, -1), F.lit(")"), F.lit("")))
        name = F.when((F.col("category") == 4) & name.endswith(")") & name.contains("("), series).otherwise(name)
    if underscores:
        name = F.when(F.length(name) > 3, F.replace(name, F.lit("_"), F.lit(" "))).otherwise(name)
    out = vocab.withColumn("name", name)
    kind = F.when(F.col("category") == 0, 0).when(F.col("category") == 4, 1).otherwise(2)
    for pair in filter(None, re.split(r"(?<!\\);", replacements)):
        source, target = (re.sub(r"\\([,;])", r"\1", x) for x in re.split(r"(?<!\\),", pair))
        first = F.row_number().over(Window.partitionBy("name").orderBy(kind, "pos")) == 1
        out = out.withColumn("_first", first).withColumn("name", F.when(F.col("_first") & (F.col("name") == source), target).otherwise(F.col("name"))).drop("_first")
    return out


#: Frames that one task lists.
FRAMES = 1000


def _each_frame(videos: DataFrame) -> DataFrame:
    """A row with ``i`` from 0 for each of a video's ``n`` frames. Runs of frames are dealt to tasks before they are listed, so a long video is many tasks."""
    runs = videos.filter("n > 0").withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / FRAMES)))).repartition("video_idx", "_run")
    return runs.withColumn("i", F.explode(F.sequence(F.col("_run") * FRAMES, F.least(F.col("n"), (F.col("_run") + 1) * FRAMES) - 1))).drop("_run")


def _frame_rows(rows: DataFrame, frame: Column) -> DataFrame:
    return rows.select("video_idx", F.floor(frame).cast("long").alias("frame")).withColumn("name", frame_name(F.col("video_idx"), F.col("frame")))


def frame_plan(videos: DataFrame, per_min: int = 40, start: float = 0.0, end: float | None = None) -> DataFrame:
    """Frames spread evenly over each video; one frame asked for gives the first. A video without frames or rate has none."""
    videos = videos.filter("fps > 0 and frame_count > 0")
    length = F.try_divide(F.col("frame_count"), F.col("fps"))
    stop = F.least(length, F.lit(end)) if end is not None else length
    first, last = F.floor(F.try_divide(F.lit(start) * F.col("frame_count"), length)), F.floor(F.try_divide(stop * F.col("frame_count"), length))
    n = F.floor((stop - start) * per_min / 60).cast("int")
    rows = _each_frame(videos.withColumn("first", first).withColumn("last", last).withColumn("n", n))
    return _frame_rows(rows, F.col("first") + F.coalesce(F.try_divide(F.col("i") * (F.col("last") - F.col("first")), F.col("n") - 1), F.lit(0)))


def frame_plan_legacy(videos: DataFrame, per_min: int = 40) -> DataFrame:
    """Frames spread evenly from the first to the last; one frame asked for gives the first. A video without frames or rate has none."""
    videos = videos.filter("fps > 0 and frame_count > 0")
    rows = _each_frame(videos.withColumn("n", F.floor(F.try_divide(F.col("frame_count"), F.col("fps")) * per_min / 60).cast("int")))
    return _frame_rows(rows, F.coalesce(F.try_divide(F.col("i") * (F.col("frame_count") - 1), F.col("n") - 1), F.lit(0)))


def fetch_plan(feeds: DataFrame, template: str, batch: int = 500) -> DataFrame:
    """Numbers, urls and batch folders of each feed's run of ``total`` items from ``start``.

    ``template`` has ``{}`` where the number goes. A feed without items gives no rows.
    """
    at = F.explode(F.sequence(F.lit(0), F.col("total") - 1))
    head, tail = template.split("{}")
    rows = feeds.filter("total > 0").select("feed", "start", at.alias("i")).withColumn("seq", (F.col("start") + F.col("i")).cast("long"))
    folder = F.format_string("batch_%02d", F.floor(F.col("i") / batch))
    return rows.select("feed", "seq", F.concat(F.lit(head), F.col("seq").cast("string"), F.lit(tail)).alias("url"), folder.alias("folder"))


def prompt_lines_for_ids(names: DataFrame, lo: int, hi: int) -> DataFrame:
    """A prompt line for each id from ``lo`` to ``hi`` - 1; ids without a name stand for themselves."""
    ids = names.sparkSession.range(lo, hi).select(F.col("id").cast("string").alias("id"))
    return ids.join(names.select("id", "name"), "id", "left").select("id", F.format_string('--prompt "fusion %s_body" ', F.coalesce("name", "id")).alias("line"))


def sample_unique_pairs(ids: DataFrame, n: int = 1000, seed: int = 0) -> DataFrame:
    """``n`` different ordered pairs of ids (one id twice is a pair), the same for the same seed; all pairs if there are fewer.

    Pairs are drawn, not listed: twice as many numbered draws as needed, of which the first of
    each pair counts. Only where ``n`` is over a quarter of the pairs are all listed, at most 4 n.
    """
    placed = numbered_by_run(ids.select("id"), F.floor(uniform(seed, F.col("id")) * RUNS), "id").select("id", "rn")
    m = placed.count()
    spark = ids.sparkSession
    if m * m < 4 * n:
        pairs = spark.range(m * m).select((F.floor(F.col("id") / m) + 1).alias("i"), (F.col("id") % m + 1).alias("j"), F.col("id").alias("k"))
        pairs = pairs.select("i", "j", uniform(seed, F.col("k")).alias("k"))
    else:
        place = lambda side: F.floor(uniform(seed, F.lit(side), F.col("id")) * m) + 1
        pairs = spark.range(2 * n + 64).select(place("a").alias("i"), place("b").alias("j"), F.col("id").alias("k")).groupBy("i", "j").agg(F.min("k").alias("k"))
    chosen = pairs.orderBy("k", "i", "j").limit(n)
    return chosen.join(placed.toDF("a", "i"), "i").join(placed.toDF("b", "j"), "j").select("a", "b")


def file_chunks(files: DataFrame, chunk: int = 100 * 1024 * 1024) -> DataFrame:
    rows = files.withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / chunk) - 1, F.lit(0)).cast("int"))))
    offset = F.col("part").cast("long") * chunk
    return rows.select("id", F.format_string(".part%03d", "part").alias("part"), offset.alias("offset"), F.least(F.lit(chunk), F.col("size") - offset).alias("length"))


def score_batches(df: DataFrame, fn: Callable, schema: str, batch: int = 250, done: DataFrame | None = None, key: str = "id", report: bool = False) -> DataFrame:
    """Runs a model's batch function (pandas frame in and out, at most ``batch`` rows) over the rows whose key isn't ``done``.

    With ``report``, a batch that fails is tried row by row; a row that fails gives its key and the ``error``, and other
    rows have a null ``error``. Without, a failure ends the job.
    """
    if done is not None:
        df = df.join(done.select(key), key, "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch].reset_index(drop=True)
                if not report:
                    yield fn(part)
                    continue
                try:
                    yield fn(part).assign(error=None)
                except Exception:
                    yield from one_by_one(part)

    def one_by_one(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for at in range(len(part)):
            row = part.iloc[at : at + 1].reset_index(drop=True)
            try:
                yield fn(row).assign(error=None)
            except Exception as e:
                yield pd.DataFrame({c: [row[key].iloc[0] if c == key else None] for c in names}).assign(error=f"{type(e).__name__}: {e}")

    names = [x.split()[0] for x in schema.split(",")]
    return df.mapInPandas(run, f"{schema}, error string" if report else schema)


def score_prompts(df: DataFrame, prompts: Sequence[tuple[str, str]], fn: Callable, schema: str, batch: int = 250) -> DataFrame:
    """Every row with every (prompt, key), run through a model's batch function."""
    each = F.explode(F.array(*(F.struct(F.lit(p).alias("prompt"), F.lit(k).alias("key")) for p, k in prompts)))
    return score_batches(df.withColumn("_p", each).select(*df.columns, "_p.prompt", "_p.key"), fn, schema, batch)
