"""Sources and sinks: image listings, sidecars, vocabularies, landed pages, manifests."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.functions.text import extension
from framewright.sources.chains import page_order, placed

#: Extensions of each kind of job.
PRESETS = {
    "caption": r"(?i)\.(png|jpg|jpeg|gif|bmp|tiff|webp)$",
    "pair": r"\.(png|jpg|jpeg|gif|bmp)$",
    "count": r"(?i)\.(png|jpg|jpeg|gif|bmp|tiff)$",
    "tagger": r"\.(png|jpg|jpeg|webp|bmp|PNG|JPG|JPEG|WEBP|BMP)$",
    "small": r"(?i)\.(png|jpg|jpeg|bmp)$",
    "crop": r"(?i)\.(png|jpg|jpeg|bmp|gif|webp)$",
    "encode": r"(?i)(png|jpg|jpeg)$",
}


#: A landed page, as far as jobs use it: the url it was asked for, the number if the job that fetched it knows it, and the answer.
API_SCHEMA = (
    "url string, page_no int, items array<struct<id:bigint,url:string,width:int,height:int,"
    "stats:struct<heartCount:int,likeCount:int,laughCount:int,cryCount:int>,meta:map<string,string>>>,"
    "metadata struct<nextPage:string>"
)


def _parts(path: Column, root: str) -> tuple[Column, Column, Column]:
    """Plain path, folder below the root and file name."""
    plain, top = F.regexp_replace(path, "^file:/*", "/"), re.sub("^file:/*", "/", root).rstrip("/") + "/"
    rel = F.when(plain.startswith(top), F.substring(plain, len(top) + 1, 1 << 30)).otherwise(plain)
    rel = F.regexp_replace(rel, "^/", "")
    return plain, F.regexp_replace(rel, "/?[^/]*$", ""), F.element_at(F.split(rel, "/"), -1)


def _number(head: bytes, at: int, n: int, order: str) -> int:
    return int.from_bytes(head[at : at + n], order)


def header_size(data: bytes) -> tuple[int, int] | None:
    """Width and height by the header of a PNG, GIF, BMP, JPEG or WebP file; null for other files and broken headers."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return _number(data, 16, 4, "big"), _number(data, 20, 4, "big")
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return _number(data, 6, 2, "little"), _number(data, 8, 2, "little")
    if data[:2] == b"BM" and len(data) >= 26:
        wide = 4 if _number(data, 14, 4, "little") >= 40 else 2
        height = int.from_bytes(data[18 + wide : 18 + 2 * wide], "little", signed=wide == 4)
        return _number(data, 18, wide, "little"), abs(height)  # rows from the top have a negative height
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP" and len(data) >= 30:
        if data[12:16] == b"VP8X":
            return 1 + _number(data, 24, 3, "little"), 1 + _number(data, 27, 3, "little")
        if data[12:16] == b"VP8L":
            bits = _number(data, 21, 4, "little")
            return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
        if data[12:16] == b"VP8 ":
            return _number(data, 26, 2, "little") & 0x3FFF, _number(data, 28, 2, "little") & 0x3FFF
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data) and data[at] == 0xFF:
            kind = data[at + 1]
            if kind == 0xFF or kind == 0x01 or 0xD0 <= kind <= 0xD8:  # fill bytes and marks without a length
                at += 1 if kind == 0xFF else 2
            elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                return _number(data, at + 7, 2, "big"), _number(data, at + 5, 2, "big")
            else:
                at += 2 + _number(data, at + 2, 2, "big")
    return None


def sized(files: DataFrame, content: str = "content") -> DataFrame:
    """Adds ``width`` and ``height`` by the files' headers, without decoding; only a JPEG goes to Python with more than its first bytes."""

    def sizes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for heads in batches:
            found = [header_size(x) or (None, None) if x is not None else (None, None) for x in heads]
            yield pd.DataFrame({"width": pd.array([w for w, _ in found], dtype="Int32"), "height": pd.array([h for _, h in found], dtype="Int32")})

    sizes.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    data = F.col(content)
    head = F.when(F.hex(F.substring(data, 1, 2)) == "FFD8", data).otherwise(F.substring(data, 1, 32))
    size = F.pandas_udf(sizes, "width int, height int")(head)
    return files.withColumn("_size", size).withColumns({c: F.col(f"_size.{c}") for c in ("width", "height")}).drop("_size")


def image_catalog(spark: SparkSession, root: str, preset: str = "caption") -> DataFrame:
    """``path, rel_dir, folders, filename, stem, ext, width, height, size_bytes`` of the image files below the root.

    Sizes in pixels are read from the headers only where they are asked for; they are null for files that aren't what their names say.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("size_bytes"), "content")
    path, rel, name = _parts(F.col("path"), root)
    rows = files.select(path.alias("path"), rel.alias("rel_dir"), name.alias("filename"), "size_bytes", "content").filter(F.col("filename").rlike(PRESETS[preset]))
    rows = sized(rows).drop("content")
    rows = rows.withColumn("folders", F.filter(F.split("rel_dir", "/"), lambda x: x != ""))
    ext = extension(F.col("filename"))
    return rows.withColumn("ext", ext).withColumn("stem", F.expr("substr(filename, 1, length(filename) - length(ext))"))


def _whole(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    # this path is encoded as a URL; a plus sign in it stands for itself
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    text = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{suffix}").select("value", F.url_decode(encoded).alias("p"))
    _, rel, name = _parts(F.col("p"), root)
    return text.select(rel.alias("rel_dir"), F.regexp_replace(name, suffix.replace(".", r"\.") + "$", "").alias("stem"), "value")


def read_captions(spark: SparkSession, root: str) -> DataFrame:
    rows = _whole(spark, root, ".txt")
    kind = F.regexp_extract("stem", "_(wd14|blip)$", 1)
    return rows.select("rel_dir", F.regexp_replace("stem", "_(wd14|blip)$", "").alias("stem"), kind.alias("kind"), F.col("value").alias("text"))


def read_caption_meta(spark: SparkSession, root: str, suffix: str = ".json") -> DataFrame:
    return _whole(spark, root, suffix).select("rel_dir", "stem", F.from_json("value", "map<string,string>").alias("meta"))


def read_tag_vocab(spark: SparkSession, path: str) -> DataFrame:
    """A tagger's vocabulary with ``pos``, its places from 0. It is a small table, so one task numbers it."""
    rows = spark.read.csv(path, header=True)
    if rows.columns[:3] != ["tag_id", "name", "category"]:
        raise ValueError("a vocabulary starts with tag_id, name, category")
    return rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("pos", F.row_number().over(Window.orderBy("_at")) - 1).drop("_at")


def _pages(spark: SparkSession, path: str, schema: str, starts: DataFrame | None) -> DataFrame:
    """Landed pages with their file, source and place; ``reason`` says why a page has no place or no items."""
    pages = spark.read.schema(f"{schema}, _corrupt_record string").json(path, multiLine=True).withColumn("file", F.col("_metadata.file_path"))
    if "url" not in pages.columns or "metadata" not in pages.columns:
        return pages.withColumn("reason", F.when(F.col("items").isNull(), "no items"))
    chain = page_order(pages.select("url", F.col("metadata.nextPage").alias("next")), starts=starts)
    rows = placed(pages, chain, F.col("page_no"))
    return rows.withColumn("reason", F.when(F.col("items").isNull(), "no items").when(F.col("status") != "ok", F.col("status"))).drop("status")


def read_api_items(spark: SparkSession, path: str, schema: str = API_SCHEMA, starts: DataFrame | None = None) -> DataFrame:
    """``source, page_no, pos`` and the fields of each item of the landed pages, read once.

    A page without ``page_no`` has the place that the chain of next pages gives it (``page_order``), and its items the chain's first url as ``source``.
    ``starts`` (one column of urls) are the pages that chains may begin with. Pages without a place or items are in ``read_api_errors``.
    """
    pages = _pages(spark, path, schema, starts).filter("reason is null")
    head = [c for c in ("source", "page_no") if c in pages.columns]
    return pages.select(*head, F.posexplode("items").alias("pos", "item")).select(*head, "pos", "item.*")


def read_api_errors(spark: SparkSession, path: str, schema: str = API_SCHEMA, starts: DataFrame | None = None) -> DataFrame:
    """``page_no, file, record, reason`` of the other pages; ``record`` where the page could not be read.

    ``reason`` is ``no items``, or ``broken``, ``merged``, ``cyclic`` or ``unnamed`` for a page with neither number nor place.
    """
    return _pages(spark, path, schema, starts).filter("reason is not null").select("page_no", "file", F.col("_corrupt_record").alias("record"), "reason")


def write_training_set(df: DataFrame, out: str) -> None:
    df.write.partitionBy("folder").parquet(out)


def write_prompt_files(df: DataFrame, out: str) -> None:
    """One text file a ``file_no``, in folders of that name, its lines in the order of ``line_no``."""
    df.repartition("file_no").sortWithinPartitions("file_no", "line_no").select("file_no", "line").write.partitionBy("file_no").text(out)


def json_values_to_lines(values: DataFrame, column: str = "value") -> DataFrame:
    """The values of JSON objects, a line each; of a repeated key the last value counts."""
    return values.select(F.explode(F.map_values(F.from_json(column, "map<string,string>"))).alias("line"))
