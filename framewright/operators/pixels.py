"""Measures of gray images, and the reader that makes them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Weights of blue, green and red.
BGR = np.array([0.114, 0.587, 0.299])


#: Columns of images with their bytes, row by row, each pixel blue, green, red and maybe alpha, or gray alone.
RAW = ("id", "width", "height", "channels", "data")


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """``RAW`` of the images below a root, ``id`` their path; unreadable files are left out."""
    images = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(root)
    return images.select("image.origin", "image.width", "image.height", "image.nChannels", "image.data").toDF(*RAW)


def _grays(data: bytes, channels: int) -> np.ndarray:
    m = np.frombuffer(data, np.uint8).reshape(-1, channels).astype(float)
    return np.rint(m[:, :3] @ BGR) if channels >= 3 else m[:, 0]


def edge_colors(images: DataFrame) -> DataFrame:
    """``id, rgba`` from ``RAW`` columns: the most frequent colour of each image's four edges, corners twice, as eight hex digits; the first of equals.

    As ``boundary_mode_color`` on a table of pixels, but no pixel becomes a row. Images without alpha are opaque; null without pixels.
    """

    def modes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = []
            for w, h, c, data in zip(f["width"], f["height"], f["channels"], f["data"], strict=True):
                if data is None or not len(data):
                    found.append(None)
                    continue
                m = np.frombuffer(data, np.uint8).reshape(int(h), int(w), int(c))
                edge = np.concatenate([m[0], m[-1], m[:, 0], m[:, -1]]).astype(np.uint32)
                red, green, blue = (edge[:, k] for k in ((2, 1, 0) if c >= 3 else (0, 0, 0)))
                codes, n = np.unique((red << 24) | (green << 16) | (blue << 8) | (edge[:, 3] if c == 4 else 255), return_counts=True)
                found.append(f"{codes[n.argmax()]:08x}")
            yield pd.DataFrame({"id": f["id"], "rgba": pd.Series(found, index=f.index, dtype=object)})

    return images.select(*RAW).mapInPandas(modes, f"id {dict(images.dtypes)['id']}, rgba string")


def row_bounds(images: DataFrame, threshold: float = 20) -> DataFrame:
    """``id, top, bottom`` from ``RAW`` columns: the first and last row of pixels whose gray values sum to over the threshold; the whole image where there's none.

    As ``letterbox_bounds`` of ``gray_row_sums``, but a row an image; null without pixels.
    """

    def bounds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            top, bottom = [], []
            for w, h, c, data in zip(f["width"], f["height"], f["channels"], f["data"], strict=True):
                if data is None or not len(data):
                    top.append(None)
                    bottom.append(None)
                    continue
                lit = np.flatnonzero(_grays(data, int(c)).reshape(int(h), int(w)).sum(axis=1) > threshold)
                top.append(int(lit[0]) if len(lit) else 0)
                bottom.append(int(lit[-1]) if len(lit) else int(h) - 1)
            yield pd.DataFrame({"id": f["id"], "top": pd.array(top, dtype="Int32"), "bottom": pd.array(bottom, dtype="Int32")}, index=f.index)

    return images.select(*RAW).mapInPandas(bounds, f"id {dict(images.dtypes)['id']}, top int, bottom int")


def read_gray(spark: SparkSession, root: str) -> DataFrame:
    """``id`` (path), ``width``, ``height`` and ``gray``, the rows one after the other; unreadable files are left out."""
    def gray(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f[["id", "width", "height"]].assign(gray=[_grays(d, c) for d, c in zip(f["data"], f["channels"], strict=True)])

    return read_raw(spark, root).mapInPandas(gray, "id string, width int, height int, gray array<double>")


def laplacian_variance(images: DataFrame) -> DataFrame:
    """``id, vol``: variance of the four-neighbour Laplacian, mirrored about the border pixels; null without pixels."""

    def variance(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            vol = []
            for g, h, w in zip(f["gray"], f["height"], f["width"], strict=True):
                if g is None or not len(g):
                    vol.append(None)
                    continue
                m = np.asarray(g, dtype=float).reshape(h, w)
                p = np.pad(m, [(1, 1) if n > 1 else (0, 0) for n in (h, w)], "reflect")
                p = np.pad(p, [(0, 0) if n > 1 else (1, 1) for n in (h, w)], "edge")
                vol.append(float(np.var(p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * m)))
            yield pd.DataFrame({"id": f["id"], "vol": pd.Series(vol, index=f.index, dtype=float)})

    rows = images.select("id", "width", "height", "gray")
    return rows.mapInPandas(variance, f"id {dict(images.dtypes)['id']}, vol double")


def gray_row_sums(images: DataFrame) -> DataFrame:
    """``image_id, y, gray_sum`` for every row of pixels."""
    row = lambda y: F.aggregate(F.slice("gray", y * F.col("width") + 1, F.col("width")), F.lit(0.0), lambda s, v: s + v)
    sums = F.transform(F.sequence(F.lit(0), F.col("height") - 1), row)
    return images.filter("height > 0 and width > 0").select(F.col("id").alias("image_id"), F.posexplode(sums).alias("y", "gray_sum"))
