"""Image cleaning on rasters held as lines.

A raster table is ``(image_id, y, v)`` with one row per line of an image; ``v`` holds the line's values from 0 to 255, and a
pixel's ``x`` is its place in it. :func:`to_lines` and :func:`to_pixels` lead from and to one row per pixel.

Box filters work on tiles: each task gets a square of pixels with as much of its surroundings as the kernels reach, runs
all passes on it in memory, and gives back the square. So a chain of filters takes one shuffle of tiles and one that puts
lines together again, a single image may be any share of the data, and no task holds more than a tile. A pass costs
the same for any kernel: least and greatest values run up and down inside blocks of the kernel's size. Kernels are
anchored at ``k // 2`` and clipped at the border.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.fixed import GROW_KERNEL, NOISE_KERNEL, SHRINK_KERNEL, THRESHOLD, WHITE

# Pixels along a side of a tile, without its surroundings. Results do not depend on it.
_TILE = 1024
# Pixel and mask in one number: the pixel, plus this where the mask is set.
_SET = 256


def to_lines(px: DataFrame, *values: str) -> DataFrame:
    """One row per pixel ``(image_id, y, x, v)`` to lines; with ``values`` these columns in place of ``v``."""
    names = values or ("v",)
    line = F.array_sort(F.collect_list(F.struct("x", *names)))
    return px.groupBy("image_id", "y").agg(line.alias("line")).select(
        "image_id", "y", *[F.col(f"line.{n}").alias(n) for n in names]
    )


def to_pixels(lines: DataFrame) -> DataFrame:
    """Lines to one row per pixel ``(image_id, y, x, v)``."""
    return lines.select("image_id", "y", F.posexplode("v").alias("x", "v"))


def to_gray(lines: DataFrame) -> DataFrame:
    """``r, g, b`` to one gray value: 0.299, 0.587 and 0.114, rounded half up, in whole numbers."""
    gray = F.transform(
        F.arrays_zip("r", "g", "b"),
        lambda p: F.floor((p["r"] * 299 + p["g"] * 587 + p["b"] * 114 + 500) / 1000).cast("int"),
    )
    return lines.select("image_id", "y", gray.alias("v"))


def binarize_inv(lines: DataFrame, t: int = THRESHOLD) -> DataFrame:
    """Ink (at most ``t``) becomes 255, paper 0."""
    return lines.withColumn("v", F.transform("v", lambda p: F.when(p > t, F.lit(0)).otherwise(F.lit(WHITE))))


def _slide(a: np.ndarray, k: int, axis: int, pick: np.ufunc, neutral: int) -> np.ndarray:
    """``pick`` over windows of ``k`` along an axis: a running value up to the window's end and one down from its start."""
    a = np.moveaxis(a, axis, -1)
    n = a.shape[-1]
    whole = -(-(n + k - 1) // k) * k
    padded = np.full((*a.shape[:-1], whole), neutral, a.dtype)
    padded[..., k // 2 : k // 2 + n] = a
    blocks = padded.reshape(*a.shape[:-1], whole // k, k)
    up = pick.accumulate(blocks, axis=-1).reshape(padded.shape)
    down = pick.accumulate(blocks[..., ::-1], axis=-1)[..., ::-1].reshape(padded.shape)
    return np.moveaxis(pick(down[..., :n], up[..., k - 1 : k - 1 + n]), -1, axis)


def _least(a: np.ndarray, k: int) -> np.ndarray:
    return _slide(_slide(a, k, 1, np.minimum, WHITE), k, 0, np.minimum, WHITE)


def _greatest(a: np.ndarray, k: int) -> np.ndarray:
    return _slide(_slide(a, k, 1, np.maximum, 0), k, 0, np.maximum, 0)


def _tiled(lines: DataFrame, reach: int, work: Callable[[np.ndarray], np.ndarray], tile: int | None = None) -> DataFrame:
    """``work`` on tiles of the image with ``reach`` pixels around them, as far as the image goes."""
    side = tile or _TILE
    known = lines.where(F.col("image_id").isNotNull() & F.col("y").isNotNull() & F.col("v").isNotNull())
    tiles = F.sequence(F.lit(0), F.floor(F.greatest(F.lit(0), F.size("v") - 1) / F.lit(side)).cast("int"))

    def start(t: Column) -> Column:
        return F.greatest(F.lit(0), t * side - reach)

    cut = F.transform(
        tiles, lambda t: F.struct(t.alias("tx"), F.slice("v", start(t) + 1, (t + 1) * side + reach - start(t)).alias("part"))
    )
    rows = F.sequence(
        F.floor(F.greatest(F.lit(0), F.col("y") - reach) / F.lit(side)).cast("int"),
        F.floor((F.col("y") + reach) / F.lit(side)).cast("int"),
    )
    dealt = known.select("image_id", "y", F.explode(cut).alias("c")).select(
        "image_id", "y", "c.tx", "c.part", F.explode(rows).alias("ty")
    )

    def of_tiles(frame: pd.DataFrame, starts: list[int]) -> pd.DataFrame:
        ys, parts, chosen, results = frame["y"].to_numpy(), frame["part"].to_list(), [], []
        for first, last in zip(starts, [*starts[1:], len(frame)]):
            tx, ty = frame["tx"].iat[first], frame["ty"].iat[first]
            own = np.flatnonzero(ys[first:last] // side == ty)
            if len(own):
                left = tx * side - max(0, tx * side - reach)
                result = work(np.stack(parts[first:last]).astype(np.int16))[own, left : left + side]
                chosen.append(own + first)
                results += list(result.astype(np.int32))
        if not chosen:
            return frame.iloc[:0][["image_id", "y", "tx", "part"]]
        rows = np.concatenate(chosen)
        return frame.iloc[rows][["image_id", "y", "tx"]].assign(part=results)

    def filtered(batches):
        held = None
        for batch in batches:
            frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
            keys = frame[["image_id", "tx", "ty"]]
            starts = np.flatnonzero((keys != keys.shift()).any(axis=1)).tolist()
            if len(starts) > 1:
                yield of_tiles(frame.iloc[: starts[-1]], starts[:-1])
            held = frame.iloc[starts[-1] :] if starts else None
        if held is not None and len(held):
            yield of_tiles(held, [0])

    kind = lines.schema["image_id"].dataType.simpleString()
    keys = ("image_id", "tx", "ty")
    parts = (
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys, "y")
        .mapInPandas(filtered, f"image_id {kind}, y int, tx int, part array<int>")
    )
    # Said here for all who use the result, for whom Spark would otherwise say it one by one, and then share no shuffle.
    parts = parts.where(F.col("image_id").isNotNull() & F.col("y").isNotNull())
    whole = F.array_sort(F.collect_list(F.struct("tx", "part")))
    return parts.groupBy("image_id", "y").agg(whole.alias("parts")).select(
        "image_id", "y", F.flatten("parts.part").alias("v")
    )


def erode(lines: DataFrame, k: int = NOISE_KERNEL) -> DataFrame:
    """Least value in a k x k box."""
    least = _least
    return _tiled(lines, k, lambda a: least(a, k))


def dilate(lines: DataFrame, k: int = GROW_KERNEL) -> DataFrame:
    """Greatest value in a k x k box."""
    greatest = _greatest
    return _tiled(lines, k, lambda a: greatest(a, k))


def erode_mask(lines: DataFrame, k: int = NOISE_KERNEL) -> DataFrame:
    """:func:`erode` of a mask of 0 and 255."""
    return erode(lines, k)


def dilate_mask(lines: DataFrame, k: int = GROW_KERNEL) -> DataFrame:
    """:func:`dilate` of a mask of 0 and 255."""
    return dilate(lines, k)


def nonzero(lines: DataFrame) -> DataFrame:
    """``(image_id, y, x)`` of the pixels that are set."""
    return to_pixels(lines).where(F.col("v") != 0).select("image_id", "y", "x")


def apply_mask(lines: DataFrame, mask: DataFrame) -> DataFrame:
    """The pixel where the mask is set, white elsewhere."""
    m = mask.select("image_id", "y", F.col("v").alias("m"))
    kept = F.zip_with("v", "m", lambda p, on: F.when(on != 0, p).otherwise(F.lit(WHITE)))
    return lines.join(m, ["image_id", "y"]).select("image_id", "y", kept.alias("v"))


def _set_places(lines: DataFrame, is_set: Callable[[Column], Column]) -> DataFrame:
    """``(image_id, y, xs)``: the places of the pixels that are set, for lines that have any."""
    places = F.filter(F.transform("v", lambda p, x: F.when(is_set(p), x)), lambda x: x.isNotNull())
    return lines.select("image_id", "y", places.alias("xs")).where(F.size("xs") > 0)


def nonzero_ends(mask: DataFrame) -> DataFrame:
    """``(image_id, y, low, high)``: the first and last pixel that is set, for lines that have any."""
    return _set_places(mask, lambda p: p != 0).select(
        "image_id", "y", F.array_min("xs").alias("low"), F.array_max("xs").alias("high")
    )


def _boxes(lines: DataFrame, is_set: Callable[[Column], Column]) -> DataFrame:
    return (
        _set_places(lines, is_set)
        .groupBy("image_id")
        .agg(
            F.min(F.array_min("xs")).alias("bx"),
            F.min("y").alias("by"),
            (F.max(F.array_max("xs")) - F.min(F.array_min("xs")) + 1).alias("bw"),
            (F.max("y") - F.min("y") + 1).alias("bh"),
        )
    )


def bounding_box(mask: DataFrame) -> DataFrame:
    """``(image_id, bx, by, bw, bh)`` around the pixels that are set; no row for an empty mask."""
    return _boxes(mask, lambda p: p != 0)


def _cut(lines: DataFrame, box: DataFrame) -> DataFrame:
    """``(image_id, y, v, h)``: the part inside the box, and the box's height.

    The box is listed once per line, so the join is on ``(image_id, y)`` and a large image is spread over its lines.
    """
    listed = box.withColumn("y", F.explode(F.sequence(F.col("by"), F.col("by") + F.col("bh") - 1)))
    return lines.join(listed, ["image_id", "y"]).select(
        "image_id",
        (F.col("y") - F.col("by")).alias("y"),
        F.slice("v", F.col("bx") + 1, F.col("bw")).alias("v"),
        F.col("bh").alias("h"),
    )


def crop(lines: DataFrame, box: DataFrame) -> DataFrame:
    """Pixels inside the image's box, counted from its corner."""
    return _cut(lines, box).drop("h")


def _half_line(v: np.ndarray) -> np.ndarray:
    """Overlap-weighted sums onto half as many places: a place is ``n`` long where a pixel is ``n // 2`` long."""
    n, half = len(v), len(v) // 2
    line = np.concatenate([[0], np.cumsum(v, dtype=np.int64)]) * half
    ends = np.arange(half + 1, dtype=np.int64) * n
    pixel = ends // half
    upto = line[pixel] + np.append(v, 0)[pixel] * (ends % half)
    return np.diff(upto)


def _halved(lines: DataFrame) -> DataFrame:
    """Half the width and height of lines that know the height ``h`` of their image."""
    half_line = _half_line

    @F.pandas_udf("array<bigint>")
    def across(v: pd.Series) -> pd.Series:
        return v.map(half_line)

    @F.pandas_udf("array<int>")
    def averaged(sums: pd.Series, weights: pd.Series, area: pd.Series) -> pd.Series:
        totals = [
            sum(s.astype(np.int64) * w for s, w in zip(rows, by, strict=True)) for rows, by in zip(sums, weights, strict=True)
        ]
        return pd.Series([((2 * t + a) // (2 * a)).astype(np.int32) for t, a in zip(totals, area, strict=True)], dtype=object)

    rows = (
        lines.where((F.size("v") > 1) & (F.col("h") > 1))
        .withColumn("h", F.col("h").cast("bigint"))
        .withColumn("y", F.col("y").cast("bigint"))
        .select("image_id", "y", "h", (F.size("v") * F.col("h")).alias("area"), across("v").alias("s"))
    )
    near, far = F.expr("y * (h div 2) div h"), F.expr("((y + 1) * (h div 2) - 1) div h")
    weight = F.expr("least((y + 1) * (h div 2), (place + 1) * h) - greatest(y * (h div 2), place * h)")
    return (
        rows.withColumn("place", F.explode(F.sequence(near, far)))
        .withColumn("weight", weight)
        .groupBy("image_id", F.col("place").cast("int").alias("y"), "area")
        .agg(F.collect_list(F.struct("s", "weight")).alias("rows"))
        .select("image_id", "y", averaged(F.col("rows.s"), F.col("rows.weight"), "area").alias("v"))
    )


def half_size(lines: DataFrame) -> DataFrame:
    """Area average to half the width and height, rounded half up; exact for odd sizes too.

    The heights of the images are counted first, so the lines are read twice.
    """
    heights = lines.groupBy("image_id").agg((F.max("y") + 1).alias("h"))
    return _halved(lines.join(heights, "image_id").select("image_id", "y", "v", "h"))


def _packed_mask(lines: DataFrame, t: int, noise: int, grow: int, shrink: int) -> DataFrame:
    """Lines of pixels that carry the mask of the inked areas: binarize, erode, dilate, erode in one pass over tiles."""
    least, greatest, white, is_set = _least, _greatest, WHITE, _SET

    def packed(a: np.ndarray) -> np.ndarray:
        ink = np.where(a > t, 0, white).astype(np.int16)
        return a + is_set * (least(greatest(least(ink, noise), grow), shrink) != 0)

    return _tiled(lines, noise + grow + shrink, packed)


def clean_mask(
    lines: DataFrame,
    t: int = THRESHOLD,
    noise: int = NOISE_KERNEL,
    grow: int = GROW_KERNEL,
    shrink: int = SHRINK_KERNEL,
) -> DataFrame:
    """``(image_id, y, v, m)``: the lines with ``m``, the mask of the inked areas."""
    mask = F.transform("v", lambda p: F.when(p >= _SET, F.lit(WHITE)).otherwise(F.lit(0)))
    return _packed_mask(lines, t, noise, grow, shrink).select(
        "image_id", "y", F.transform("v", lambda p: p % _SET).alias("v"), mask.alias("m")
    )


def clean_image(
    lines: DataFrame,
    t: int = THRESHOLD,
    noise: int = NOISE_KERNEL,
    grow: int = GROW_KERNEL,
    shrink: int = SHRINK_KERNEL,
) -> DataFrame:
    """The inked part of each image on white, cut out and halved. An image without ink has no rows."""
    packed = _packed_mask(lines, t, noise, grow, shrink)
    kept = F.transform("v", lambda p: F.when(p >= _SET, p - _SET).otherwise(F.lit(WHITE)))
    return _halved(_cut(packed, _boxes(packed, lambda p: p >= _SET)).withColumn("v", kept))


def sparse_images(px: DataFrame) -> DataFrame:
    """Images whose pixels do not fill a rectangle that starts at (0, 0); :func:`to_lines` expects none."""
    full = (F.max("x") + 1).cast("long") * (F.max("y") + 1)
    return (
        px.groupBy("image_id")
        .agg(F.count(F.lit(1)).alias("n_pixels"), full.alias("n_expected"))
        .where(F.col("n_pixels") != F.col("n_expected"))
    )
