"""Filters, joins and set operations on image and caption manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions.text import caption_kind_name, py_strip, remove_brackets


def filter_api_quality(df: DataFrame, min_w: int = 600, min_h: int = 600) -> DataFrame:
    """Items that are liked, large enough and have a prompt.

    Counts and prompt are flat (``heart, likes, laugh, cry, prompt``), or in ``stats`` and ``meta`` as ``read_api_items`` gives them.
    """
    if "stats" in df.columns:
        heart, likes, laugh, cry = (F.col(f"stats.{x}Count") for x in ("heart", "like", "laugh", "cry"))
        prompt = F.try_element_at("meta", F.lit("prompt"))
    else:
        heart, likes, laugh, cry, prompt = (F.col(x) for x in ("heart", "likes", "laugh", "cry", "prompt"))
    liked = (heart > 5) & ((heart + likes) / 2 > laugh + cry)
    return df.filter(liked & prompt.isNotNull() & (F.col("width") >= min_w) & (F.col("height") >= min_h))


def filter_expected_size(df: DataFrame, w: int, h: int) -> DataFrame:
    return df.filter((F.col("width") == w) & (F.col("height") == h))


def filter_size_of(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Rows of the size of the reference's one row; none if it has no row."""
    size = reference.select(F.col("width").alias("_w"), F.col("height").alias("_h")).limit(1)
    return df.join(F.broadcast(size), (F.col("width") == F.col("_w")) & (F.col("height") == F.col("_h"))).drop("_w", "_h")


def filter_small(df: DataFrame, size_threshold: int = 576) -> DataFrame:
    return df.filter(F.greatest("width", "height") <= size_threshold)


def filter_by_prefixes(df: DataFrame, prefixes: Sequence[str], ext: str = ".png") -> DataFrame:
    any_of = F.lit(False)
    for p in prefixes:
        any_of = any_of | F.col("filename").startswith(p)
    return df.filter(any_of & F.col("filename").endswith(ext))


def drop_by_suffix(df: DataFrame, suffix: str, column: str = "filename") -> DataFrame:
    return df.filter(~F.col(column).endswith(suffix))


def filter_valid_ids(df: DataFrame, valid: DataFrame) -> DataFrame:
    """Rows named ``a.b.png`` whose first number is among ``valid.id``."""
    first = F.regexp_extract("filename", r"^(\d+)\.(\d+)[a-zA-Z]?\.png$", 1)
    return df.withColumn("first_id", first).join(valid.select(F.col("id").alias("first_id")), "first_id", "left_semi")


def drop_banned_tags(text: Column, banned: Sequence[str]) -> Column:
    """Comma-separated pieces without those that hold a banned string."""
    def clean(x):
        ok = F.lit(True)
        for b in banned:
            ok = ok & ~x.contains(b)
        return ok

    return F.array_join(F.transform(F.filter(F.split(text, ","), clean), py_strip), ", ")


def filter_detections(df: DataFrame, confidence: float) -> DataFrame:
    return df.filter(F.col("confidence") >= confidence)


def quarantine_phrases(df: DataFrame, phrases: Sequence[str], column: str = "text") -> DataFrame:
    """Adds ``quarantined``: whether the caption holds any of the phrases."""
    hit = F.lit(False)
    for p in phrases:
        hit = hit | F.coalesce(F.col(column).contains(p), F.lit(False))
    return df.withColumn("quarantined", hit)


def pair_images_captions(images: DataFrame, captions: DataFrame) -> DataFrame:
    """Captions with an image of the same stem in the same folder, once each."""
    return captions.join(images.select("rel_dir", "stem"), ["rel_dir", "stem"], "left_semi")


def orphan_captions(captions: DataFrame, images: DataFrame, ext: str = ".png") -> DataFrame:
    return captions.join(images.filter(F.col("filename").endswith(ext)).select("rel_dir", "stem"), ["rel_dir", "stem"], "left_anti")


def pending_images(images: DataFrame, done: DataFrame, overwrite: bool = False) -> DataFrame:
    return images if overwrite else images.join(done.select("rel_dir", "stem"), ["rel_dir", "stem"], "left_anti")


def unseen_urls(items: DataFrame, seen: DataFrame) -> DataFrame:
    """Items whose url isn't logged, the first by page and position of each url.

    A logged url counts without white space at its ends, such as the line's end that a log file keeps.
    """
    first = F.row_number().over(Window.partitionBy("url").orderBy("page_no", "pos", "id"))
    return items.join(seen.select(py_strip(F.col("url")).alias("url")), "url", "left_anti").withColumn("_k", first).filter("_k = 1").drop("_k")


def common_files(a: DataFrame, b: DataFrame) -> DataFrame:
    own = lambda x: x.filter(F.col("filename").endswith(".png")).select(F.lower("filename").alias("filename"))
    return own(a).intersect(own(b))


def combine_caption_kinds(captions: DataFrame, kinds: Sequence[str] = ("blip", "wd14")) -> DataFrame:
    """One caption for each stem that has any of the kinds: their texts in that order, joined."""
    flat = F.regexp_replace(F.col("text"), "\n", " ")
    parts = [F.max(F.when(F.col("kind") == k, flat)) for k in kinds]
    return captions.filter(F.col("kind").isin(list(kinds))).groupBy("rel_dir", "stem").agg(F.concat_ws(", ", *parts).alias("text"))


def _captioned(label: Column, content: str | None) -> Column:
    return F.concat(label, F.lit(", "), remove_brackets(F.col(content))) if content else label


def label_from_id(df: DataFrame, names: DataFrame, content: str | None = None) -> DataFrame:
    """Adds ``style_id`` of ``a.png`` files and ``label``, its name or else the id; other files drop out.

    With ``content`` the label stands before that column's text, brackets removed.
    """
    ids = df.withColumn("style_id", F.regexp_extract("filename", r"^(\d+)[a-zA-Z]?\.png$", 1)).filter("style_id <> ''")
    named = ids.join(names.toDF("style_id", "style_name"), "style_id", "left")
    return named.withColumn("label", _captioned(F.lower(F.coalesce("style_name", "style_id")), content)).drop("style_name")


def label_from_ids(df: DataFrame, names: DataFrame, content: str | None = None) -> DataFrame:
    """Adds style and body ids of ``a.b.png`` or ``a_b.png`` files and ``label``, made of their names or else the ids.

    Other files drop out. With ``content`` the label stands before that column's text, brackets removed.
    """
    pattern = r"^(\d+)[._](\d+)[a-zA-Z]?\.png$"
    df = df.filter(F.col("filename").rlike(pattern))
    ids = df.withColumn("style_id", F.regexp_extract("filename", pattern, 1)).withColumn("body_id", F.regexp_extract("filename", pattern, 2))
    style, body = names.toDF("style_id", "style_name"), names.toDF("body_id", "body_name")
    named = ids.join(style, "style_id", "left").join(body, "body_id", "left")
    s, b = F.lower(F.coalesce("style_name", "style_id")), F.lower(F.coalesce("body_name", "body_id"))
    label = F.concat(F.lit("fusion "), b, F.lit("_body in "), s, F.lit("_style"))
    return named.withColumn("label", _captioned(label, content)).drop("style_name", "body_name")


def dest_name_from_prompt(df: DataFrame, names: DataFrame) -> DataFrame:
    """``dest`` from the names in the info text of a row; null where there's no such text.

    The text is ``Parameters``, else ``Comment``, else the first value that holds ``fusion``.
    """
    info = F.coalesce(F.try_element_at("info", F.lit("Parameters")), F.try_element_at("info", F.lit("Comment")), F.get(F.filter(F.map_values("info"), lambda v: v.contains("fusion")), 0))
    pattern = r"fusion (\S+)_body in (\S+)_style"
    found = df.withColumn("_t", F.lower(info)).withColumn("_b", F.regexp_extract("_t", pattern, 1)).withColumn("_s", F.regexp_extract("_t", pattern, 2))
    low = invert_map(names.select("id", F.lower("name").alias("name"))).select("id", "name")
    found = found.join(low.toDF("_bid", "_b"), "_b", "left").join(low.toDF("_sid", "_s"), "_s", "left")
    both = F.col("_bid").isNotNull() & F.col("_sid").isNotNull()
    dest = F.when(F.coalesce(F.col("_b"), F.lit("")) == "", F.lit(None)).when(both, F.concat_ws(".", "_sid", "_bid", F.lit("png"))).otherwise(F.col("filename"))
    return found.withColumn("dest", dest).drop("_t", "_b", "_s", "_bid", "_sid")


def id_pair_urls(ids: DataFrame, base: str) -> DataFrame:
    """A url for every ordered pair of ids. The result has as many rows as pairs: that is what is asked for."""
    return ids.select(F.col("id").alias("a")).crossJoin(ids.select(F.col("id").alias("b"))).select("a", "b", F.concat(F.lit(base), "a", F.lit("."), "b").alias("url"))


def dense_grid(images: DataFrame, n: int = 502, cols: int = 20, cell: int = 96) -> DataFrame:
    """Cells 0 to n - 1 of a sheet with their places; ``blank`` where no image has the index ``idx``.

    The sheet has ``grid_rows(n, cols)`` rows. ``indexed`` takes the indexes from file names.
    """
    cells = images.sparkSession.range(n).withColumnRenamed("id", "idx")
    at = cells.join(images.select("idx").distinct().withColumn("has", F.lit(True)), "idx", "left")
    return at.select("idx", F.col("has").isNull().alias("blank"), ((F.col("idx") % cols) * cell).alias("x"), (F.floor(F.col("idx") / cols) * cell).alias("y"))


def grid_rows(n: int, cols: int = 20) -> int:
    return -(-n // cols)


def indexed(images: DataFrame, base: str) -> DataFrame:
    """The images named ``{base}.{i}.png``, with ``idx``."""
    head, tail = f"{base}.", F.expr(f"substr(filename, {len(base) + 2}, length(filename) - {len(base) + 5})")
    own = images.filter(F.col("filename").startswith(head) & F.col("filename").endswith(".png") & tail.rlike("^[0-9]{1,18}$"))
    return own.withColumn("idx", tail.cast("long"))


def rename_captions(captions: DataFrame, images: DataFrame, suffix: str = "_wd14") -> DataFrame:
    """Captions (``rel_dir, filename``) after those paired with an image have got the suffix.

    Captions that have it, and those without an image of their stem in the folder, stay. A renamed caption replaces
    one that has the new name; of several the last by ``id`` wins.
    """
    stem = F.regexp_replace("filename", r"\.txt$", "")
    has = images.filter(F.col("filename").rlike(r"\.(png|jpg|jpeg|gif|bmp)$")).select("rel_dir", F.regexp_replace("filename", r"\.[^.]*$", "").alias("_stem")).distinct().withColumn("_has", F.lit(True))
    named = captions.withColumn("_stem", stem).join(has, ["rel_dir", "_stem"], "left")
    moves = F.col("_has").isNotNull() & F.col("filename").endswith(".txt") & ~F.col("filename").endswith(f"{suffix}.txt")
    named = named.withColumn("_moved", F.coalesce(moves, F.lit(False)).cast("int")).withColumn("filename", F.when(F.col("_moved") == 1, caption_kind_name(F.col("_stem"), suffix)).otherwise(F.col("filename")))
    last = F.row_number().over(Window.partitionBy("rel_dir", "filename").orderBy(F.desc("_moved"), F.desc("id")))
    return named.withColumn("_k", last).filter("_k = 1").select(*captions.columns)


def recode_ids(df: DataFrame, mapping: DataFrame, column: str = "id") -> DataFrame:
    """``name`` for each id; ids without one as text."""
    return df.join(mapping.select(F.col("id").alias(column), "name"), column, "left").withColumn("name", F.coalesce("name", F.col(column).cast("string")))


def compare_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each distinct key with ``side``: ``a``, ``b`` or ``both``."""
    tagged = a.select("key", F.lit(1).alias("s")).unionByName(b.select("key", F.lit(2).alias("s"))).groupBy("key").agg(F.bit_or("s").alias("s"))
    return tagged.select("key", F.when(F.col("s") == 1, "a").when(F.col("s") == 2, "b").otherwise("both").alias("side"))


def fill_missing_keys(a: DataFrame, b: DataFrame, key: str = "key") -> DataFrame:
    return b.unionByName(a.join(b.select(key), key, "left_anti"))


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in frames.items():
        own = df.withColumn("source", F.lit(name))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def invert_map(df: DataFrame) -> DataFrame:
    """name -> id; the last id of a repeated name wins."""
    return df.groupBy("name").agg(F.max("id").alias("id"))
