"""Column functions on sizes, boxes and vectors. None of them shuffles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Target sizes, in the order that breaks ties.
SIZES_512 = ((512, 512), (448, 576), (576, 448))
SIZES_1024 = ((1024, 1024), (896, 1152), (1152, 896))
#: Target sizes and their aspect ratios, in the order that breaks ties.
ASPECTS = (("640x960", 2, 3), ("768x1024", 3, 4), ("960x640", 3, 2), ("1024x1024", 1, 1), ("1024x768", 4, 3))


#: Fixed values: (width step, height step, first, last) of each family of resolutions, upright and lying.
RESOLUTION_FAMILIES = ((32, 32, 8, 32), (32, 64, 12, 24), (64, 96, 5, 12), (96, 128, 3, 9))
RESOLUTIONS = tuple(dict.fromkeys(size for a, b, lo, hi in RESOLUTION_FAMILIES for n in range(lo, hi + 1) for size in ((a * n, b * n), (b * n, a * n))))


def _nearest(distance: Sequence[Column], values: Sequence[Column]) -> Column:
    """The value of the least distance, the first of equals."""
    return F.array_min(F.array(*(F.struct(d.alias("d"), F.lit(i).alias("i"), v.alias("v")) for i, (d, v) in enumerate(zip(distance, values, strict=True))))).v


def _let(then: Callable[[Column], Column], **values: Column) -> Column:
    """``then`` of a struct of the values, each computed once; written out in every place, they outgrow generated code."""
    return F.get(F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), then), 0)


def _positive(side: Column) -> Column:
    return F.when(side > 0, side)


def _both(w: Column, h: Column, then: Column) -> Column:
    """``then`` where there is a width and a height, else null."""
    return F.when(w.isNotNull() & h.isNotNull(), then)


def nearest_size(w: Column, h: Column, sizes: Sequence[tuple[int, int]] = SIZES_512) -> Column:
    """The size with the nearest aspect ratio, as a struct (w, h)."""
    ratio = F.try_divide(w.cast("double"), h)
    return _nearest([F.abs(F.lit(a / b) - ratio) for a, b in sizes], [F.struct(F.lit(a).alias("w"), F.lit(b).alias("h")) for a, b in sizes])


def nearest_resolution(w: Column, h: Column, sizes: Sequence[tuple[int, int]] = RESOLUTIONS) -> Column:
    """Least difference of ratio plus a thousandth of the difference of area."""
    ratio, area = F.try_divide(w.cast("double"), h), w.cast("double") * h
    return _nearest([F.abs(F.lit(a / b) - ratio) + F.abs(F.lit(float(a * b)) - area) / 1000 for a, b in sizes], [F.struct(F.lit(a).alias("w"), F.lit(b).alias("h")) for a, b in sizes])


def nearest_aspect(w: Column, h: Column) -> Column:
    """The target of the nearest ratio and the height that a crop of full width has at that ratio."""
    ratio = F.try_divide(w.cast("double"), h)
    return _nearest([F.abs(F.lit(a / b) - ratio) for _, a, b in ASPECTS], [F.struct(F.lit(n).alias("name"), F.floor(w / F.lit(a / b)).cast("int").alias("crop_h")) for n, a, b in ASPECTS])


def adjust_crop(x1: Column, y1: Column, x2: Column, y2: Column, w: Column, h: Column) -> Column:
    """The box at the nearest of the ratios 1, 3/4 and 4/3 about its centre, as a struct.

    It grows if the grown window about the centre lies inside the image, else it shrinks; then it is
    clamped and truncated. A box without height gives null.
    """
    ratios = (1.0, 0.75, 4 / 3)

    def shaped(b: Column) -> Column:
        bw, bh = b["x2"] - b["x1"], b["y2"] - b["y1"]
        target = lambda s: _nearest([F.abs(F.lit(r) - s["ratio"]) for r in ratios], [F.lit(r) for r in ratios])
        return _let(lambda s: _let(lambda t: sized(b, s, t["target"]), target=target(s)), bw=bw, bh=bh, ratio=F.try_divide(bw, bh))

    def sized(b: Column, s: Column, target: Column) -> Column:
        narrow, by_w, by_h = target > s["ratio"], s["bw"] / target, s["bh"] * target
        grow_w, grow_h = F.when(narrow, by_h).otherwise(s["bw"]), F.when(narrow, s["bh"]).otherwise(by_w)
        inside = lambda low, high, side, most: ((low + high) / 2 - side / 2 >= 0) & ((low + high) / 2 + side / 2 <= most)
        fits = inside(b["x1"], b["x2"], grow_w, b["w"]) & inside(b["y1"], b["y2"], grow_h, b["h"])
        nw = F.when(fits, grow_w).when(narrow, s["bw"]).otherwise(by_h)
        nh = F.when(fits, grow_h).when(narrow, by_w).otherwise(s["bh"])
        return F.when(s["bh"] != 0, _let(lambda n: clamped(b, n), nw=nw, nh=nh))

    def clamped(b: Column, n: Column) -> Column:
        left = F.greatest((b["x1"] + b["x2"]) / 2 - n["nw"] / 2, F.lit(0.0))
        top = F.greatest((b["y1"] + b["y2"]) / 2 - n["nh"] / 2, F.lit(0.0))
        sides = (("x1", left), ("y1", top), ("x2", F.least(b["w"], left + n["nw"])), ("y2", F.least(b["h"], top + n["nh"])))
        return F.struct(*(c.cast("int").alias(k) for k, c in sides))

    corners = {k: c.cast("int").cast("double") for k, c in (("x1", x1), ("y1", y1), ("x2", x2), ("y2", y2))}
    return _let(shaped, **corners, w=w.cast("double"), h=h.cast("double"))


def center_crop(x1: Column, y1: Column, x2: Column, y2: Column, w: Column, h: Column) -> Column:
    """A window of ``w`` by ``h`` about the truncated box's centre, at 0 or above; null for boxes with a side under 250."""
    x1, y1, x2, y2 = (c.cast("int") for c in (x1, y1, x2, y2))
    left, top = F.greatest(F.floor((x1 + x2) / 2 - w / 2), F.lit(0)), F.greatest(F.floor((y1 + y2) / 2 - h / 2), F.lit(0))
    box = F.struct(left.cast("int").alias("x1"), top.cast("int").alias("y1"), (left + w).cast("int").alias("x2"), (top + h).cast("int").alias("y2"))
    return F.when((x2 - x1 >= 250) & (y2 - y1 >= 250), box)


def center_crop_nearest(x1: Column, y1: Column, x2: Column, y2: Column, sizes: Sequence[tuple[int, int]] = RESOLUTIONS) -> Column:
    """``center_crop`` to the resolution nearest to the truncated box's size."""
    bw, bh = x2.cast("int") - x1.cast("int"), y2.cast("int") - y1.cast("int")
    return _let(lambda s: center_crop(x1, y1, x2, y2, s["size"]["w"], s["size"]["h"]), size=nearest_resolution(bw, bh, sizes))


def select_bucket(w: Column, h: Column, max_area: int = 1024 * 1024, step: int = 64, resos: Sequence[tuple[int, int]] | None = None) -> Column:
    """Bucket, resized size and error of the ratio, as a struct (w, h, resized_w, resized_h, ar_error).

    Without ``resos`` images only shrink: to ``max_area``, with one side at a multiple of ``step``; the
    bucket is what multiples of ``step`` the resized image covers. With ``resos`` images shrink or grow to cover
    the bucket among them that equals their size, else has the nearest ratio. An image without width or height has none: null.
    """
    w, h = _positive(w), _positive(h)
    ratio = F.try_divide(w.cast("double"), h)
    whole = lambda c: F.floor(c + 0.5).cast("long")

    def out(bw: Column, bh: Column, rw: Column, rh: Column) -> Column:
        return F.struct(bw.cast("long").alias("w"), bh.cast("long").alias("h"), rw.alias("resized_w"), rh.alias("resized_h"), (F.try_divide(bw.cast("double"), bh) - ratio).alias("ar_error"))

    if resos:
        own = F.lit(False)
        for a, b in resos:
            own = own | ((w == a) & (h == b))

        def covered(s: Column) -> Column:
            scale = F.when(ratio > s["size"]["w"] / s["size"]["h"], s["size"]["h"] / h).otherwise(s["size"]["w"] / w)
            return _let(lambda k: out(s["size"]["w"], s["size"]["h"], whole(w * k["scale"]), whole(h * k["scale"])), scale=scale)

        return _both(w, h, _let(covered, size=F.when(own, F.struct(w.cast("int").alias("w"), h.cast("int").alias("h"))).otherwise(nearest_size(w, h, resos))))

    to = lambda c: whole(c) - F.pmod(whole(c), F.lit(step))

    def rounded(s: Column) -> Column:
        by_w = F.abs(F.try_divide(s["rw"].cast("double"), to(s["rw"] / ratio)) - ratio)
        by_h = F.abs(F.try_divide(to(s["rh"] * ratio).cast("double"), s["rh"]) - ratio)
        large, first = w.cast("long") * h > max_area, by_w < by_h
        sw = F.when(~large, w.cast("long")).when(first, s["rw"]).otherwise(whole(s["rh"] * ratio))
        sh = F.when(~large, h.cast("long")).when(first, whole(s["rw"] / ratio)).otherwise(s["rh"])
        return _let(lambda r: out(r["w"] - F.pmod(r["w"], F.lit(step)), r["h"] - F.pmod(r["h"], F.lit(step)), r["w"], r["h"]), w=sw, h=sh)

    rw = F.sqrt(F.lit(float(max_area)) * ratio)
    return _both(w, h, _let(rounded, rw=to(rw), rh=to(F.lit(float(max_area)) / rw)))


def crop_ltrb(bucket_w: Column, bucket_h: Column, w: Column, h: Column) -> Column:
    """Where an image of ``w`` by ``h``, resized to fit inside its bucket, lies in it, as doubles; null without a size."""
    w, h = _positive(w), _positive(h)
    bw, bh = bucket_w.cast("double"), bucket_h.cast("double")
    ratio = F.try_divide(w.cast("double"), h)
    wide = F.try_divide(bw, bh) > ratio
    rw, rh = F.when(wide, bh * ratio).otherwise(bw), F.when(wide, bh).otherwise(bw / ratio)
    left, top = (F.floor((a - b) / 2).cast("double") for a, b in ((bw, rw), (bh, rh)))
    return _both(w, h, F.struct(left.alias("left"), top.alias("top"), (left + rw).alias("right"), (top + rh).alias("bottom")))


def fit_letterbox(w: Column, h: Column, side: int = 1024) -> Column:
    """The largest size of the image's ratio inside a square, and its offset there; null without a size."""
    w, h = _positive(w), _positive(h)
    ratio = F.least(F.lit(float(side)) / w, F.lit(float(side)) / h)
    nw, nh = F.floor(w * ratio).cast("int"), F.floor(h * ratio).cast("int")
    return _both(w, h, F.struct(nw.alias("w"), nh.alias("h"), F.floor((side - nw) / 2).cast("int").alias("x"), F.floor((side - nh) / 2).cast("int").alias("y")))


def center_paste(w: Column, h: Column, side: int = 96) -> Column:
    """(action, x, y): pad where either side is short, else resize; the offset of a longer side is negative."""
    pad = (w < side) | (h < side)
    at = lambda c: F.when(pad, F.floor((F.lit(side) - c) / 2)).otherwise(0).cast("int")
    return F.struct(F.when(pad, "pad").otherwise("resize").alias("action"), at(w).alias("x"), at(h).alias("y"))


def center_cut_paste(w: Column, h: Column, side_w: int = 96, side_h: int = 96) -> Column:
    """Without resizing: the box (x1, y1, x2, y2) of the image that the canvas can hold, and where it is pasted (x, y)."""
    def along(c: Column, side: int):
        low = F.greatest(F.floor((c - side) / 2), F.lit(0)).cast("int")
        return low, F.least(c, low + side).cast("int"), F.greatest(F.floor((F.lit(side) - F.least(c, F.lit(side))) / 2), F.lit(0)).cast("int")

    (x1, x2, x), (y1, y2, y) = along(w, side_w), along(h, side_h)
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), x.alias("x"), y.alias("y"))


def trim_top_bottom(h: Column, px: int) -> Column:
    return F.when(h - 2 * px > 0, h - 2 * px)


def trim_and_resize_meta(w: Column, h: Column, target_w: int, target_h: int) -> Column:
    """The size before the resize and the crop box after it: all of the target."""
    box = F.struct(F.lit(0).alias("x1"), F.lit(0).alias("y1"), F.lit(target_w).alias("x2"), F.lit(target_h).alias("y2"))
    return F.struct(w.alias("original_w"), h.alias("original_h"), box.alias("crop"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision; 0 where a vector is all zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))
