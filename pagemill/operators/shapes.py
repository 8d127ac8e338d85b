"""Regions and rotation of rasters held as lines (see :mod:`pagemill.operators.raster`).

Connected regions are labelled on tiles. A tile also sees the last line and column of its neighbours above and to the left, so
each 2 x 2 square of pixels lies in some tile, and a pixel that several tiles see ties their labels together. These ties, at most the
rim of each tile, are a graph whose components are the regions. So one image, or one region, may be any share of the data.

The skew of an image is that of the smallest rectangle around its ink. Only the ends of each line can be on the convex hull;
hulls of spans of lines are merged to that of the image, and the rectangle lies along one of its edges. Turning cuts the image into tiles,
sends each to the tiles of the result that it can reach, at most a few, and makes each tile of the result from those it got.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.fixed import WHITE
from pagemill.functions.frames import group_blocks
from pagemill.functions.graph import component_roots
from pagemill.functions.spans import numbered, stored
from pagemill.operators.raster import nonzero_ends

# Pixels along a side of a tile, lines whose hull one task finds, and lines whose regions are numbered together. Results do not
# depend on them.
_TILE = 1024
_SPAN = 4096
#: Pixels of tiles that are turned together; a tile of more is turned alone.
_PIXELS = 1 << 20


def _merged(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes is tied to by the edges ``a``, ``b``."""
    root = np.arange(n)
    while len(a):
        of_a, of_b = root[a], root[b]
        apart = of_a != of_b
        if not apart.any():
            break
        a, b, of_a, of_b = a[apart], b[apart], of_a[apart], of_b[apart]
        np.minimum.at(root, np.maximum(of_a, of_b), np.minimum(of_a, of_b))
        while True:
            onward = root[root]
            if (onward == root).all():
                break
            root = onward
    return root


def _runs(lines: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the runs of set pixels of ``parts``: line, first and last place, and the run that stands for each run's region.

    ``lines`` are numbers of the parts, ascending; parts of numbers one apart lie below each other. Pixels that touch at a corner are tied.
    """
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    begin = np.cumsum(sizes + 2) - sizes - 1  # a clear pixel before and behind each part
    edged = np.zeros(sizes.sum() + 2 * len(parts), np.int8)
    inside = np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
    edged[inside] = np.concatenate([*parts, np.zeros(0, np.int32)]) != 0
    steps = np.diff(edged)
    up, down = np.flatnonzero(steps == 1) + 1, np.flatnonzero(steps == -1)
    at = np.searchsorted(begin, up, side="right") - 1
    first, last, row = up - begin[at], down - begin[at], lines[at]
    width = int(sizes.max(initial=0)) + 4
    # in the line below, runs that end behind the place before this run and begin before the place behind it
    low = np.searchsorted(row * width + last + 2, (row + 1) * width + first + 1, side="left")
    high = np.searchsorted(row * width + first + 2, (row + 1) * width + last + 3, side="right")
    n = np.maximum(0, high - low)
    a = np.repeat(np.arange(len(row)), n)
    b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    return at, first, last, _merged(len(row), a, b)


def label_runs(rows: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last place of the runs of set pixels, and the run that stands for each run's region.

    ``rows`` are the numbers of the lines of ``mask``, ascending. Pixels that touch at a corner are tied.
    """
    at, first, last, of = _runs(rows.astype(np.int64), list(mask))
    return rows.astype(np.int64)[at], first, last, of


_LABELS = "node long, pixel long, x0 int, y0 int, x1 int, y1 int, n_pixels long"


def _labelled(mask: DataFrame, tile: int) -> DataFrame:
    """Boxes of the labels of each tile (``pixel`` is null), and the labels of pixels that other tiles see, too."""
    side = tile
    known = mask.where(F.col("image_id").isNotNull() & F.col("y").isNotNull() & F.exists("v", lambda p: p != 0))
    tiles = F.sequence(F.lit(0), F.floor((F.size("v") - 1) / F.lit(side)).cast("int"))

    def part(t: Column) -> Column:
        begin = F.greatest(F.lit(0), t * side - 1)
        return F.struct(t.alias("tx"), F.slice("v", begin + 1, (t + 1) * side - begin).alias("part"))

    cut = F.filter(F.transform(tiles, part), lambda c: F.exists(c["part"], lambda p: p != 0))
    own = F.floor(F.col("y") / F.lit(side)).cast("int")
    rows = F.when(F.pmod(F.col("y"), F.lit(side)) == side - 1, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = known.select("image_id", "y", F.explode(cut).alias("c")).select(
        "image_id", "y", "c.tx", "c.part", F.explode(rows).alias("ty")
    )
    kind = mask.schema["image_id"].dataType.simpleString()
    keys, blocks, runs = ["image_id", "tx", "ty"], group_blocks, _runs

    def sections(frame, starts):
        """Tiles that are labelled together: all, but for those that have a line twice, which are alone."""
        y = frame["y"].to_numpy(np.int64)
        step = np.diff(y, prepend=y[0])
        step[step > 1] = 2  # lines below each other have numbers one apart, those of different tiles do not
        step[starts] = 2
        ends = np.append(starts[1:], len(frame))
        twice = np.unique(np.searchsorted(starts, np.flatnonzero(step == 0), side="right") - 1)
        cuts = np.unique(np.concatenate([[0, len(frame)], starts[twice], ends[twice]])).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield frame.iloc[a:b], np.cumsum(step[a:b])

    def label(batches):
        for frame, lines in (part for block in blocks(batches, keys) for part in sections(*block)):
            y, image = frame["y"].to_numpy(np.int64), frame["image_id"].to_numpy()
            at, first, last, of = runs(lines, frame["part"].to_list())
            row, tx, ty = y[at], frame["tx"].to_numpy(np.int64)[at], frame["ty"].to_numpy(np.int64)[at]
            begin = np.maximum(0, tx * side - 1)
            first, last = first + begin, last + begin
            nodes = (row << 32 | first)[of]  # a region's first pixel here: its first run's
            # boxes of what is the tile's own
            own_first, own = np.maximum(first, tx * side), (row >= ty * side) & (last >= tx * side)
            names, which = np.unique(of[own], return_inverse=True)
            if len(names):
                low, high = np.full((len(names), 2), np.iinfo(np.int64).max), np.full((len(names), 2), -1)
                np.minimum.at(low, which, np.stack([own_first[own], row[own]], 1))
                np.maximum.at(high, which, np.stack([last[own], row[own]], 1))
                sizes = np.bincount(which, (last - own_first + 1)[own], len(names)).astype(np.int64)
                yield pd.DataFrame(
                    {"image_id": image[at[names]], "node": nodes[names], "pixel": None, "x0": low[:, 0], "y0": low[:, 1]}
                    | {"x1": high[:, 0], "y1": high[:, 1], "n_pixels": sizes}
                )
            # pixels in the first or last line or column of the tile or beside it; of a run there, all its pixels in these lines
            pixels, of_run = [], []
            for line in (ty * side - 1, (ty + 1) * side - 1):
                on = np.flatnonzero(row == line)
                size = last[on] - first[on] + 1
                pixels.append(np.repeat((row[on] << 32) + first[on] - (np.cumsum(size) - size), size) + np.arange(size.sum()))
                of_run.append(np.repeat(on, size))
            for x in (tx * side - 1, (tx + 1) * side - 1):
                on = np.flatnonzero((first <= x) & (x <= last))
                pixels.append((row[on] << 32) + x[on])
                of_run.append(on)
            pixel, run = np.concatenate(pixels), np.concatenate(of_run)
            if len(pixel):
                yield pd.DataFrame({"image_id": image[at[run]], "node": nodes[run], "pixel": pixel}).assign(
                    x0=None, y0=None, x1=None, y1=None, n_pixels=None
                )

    return dealt.repartition(*keys).sortWithinPartitions(*keys, "y").mapInPandas(label, f"image_id {kind}, {_LABELS}")


def raster_regions(mask: DataFrame, tile: int | None = None) -> DataFrame:
    """``(image_id, region_no, box, n_pixels)`` of the connected regions of set pixels, corners included.

    Regions are numbered from 0 by the top and then the left side of their boxes. ``mask`` is lines ``(image_id, y, v)``, 0
    where nothing is set: of :func:`binarize_inv` for letters, of :func:`clean_mask`, whose ``m`` is to be taken, for blocks. Lines without an image
    or number do not count. Labels and ties are stored below ``spark.checkpoint.dir``.
    """
    made = stored(_labelled(mask, tile or _TILE), "region-labels")
    ties = made.where("pixel is not null").select("image_id", F.col("node").alias("a"), F.col("pixel").alias("b"))
    roots = component_roots(ties, "image_id")
    boxes = made.where("pixel is null").join(roots, ["image_id", "node"], "left").withColumn("root", F.coalesce("root", "node"))
    whole = boxes.groupBy("image_id", "root").agg(
        F.min("x0").alias("x"),
        F.min("y0").alias("y"),
        F.max("x1").alias("right"),
        F.max("y1").alias("bottom"),
        F.sum("n_pixels").alias("n_pixels"),
    )
    span = F.floor(F.col("y") / F.lit(_SPAN)).cast("int")
    inside = Window.partitionBy("image_id", "span").orderBy("y", "x", "root")
    counted = whole.withColumn("span", span).withColumn("inside", F.row_number().over(inside))
    in_order = numbered(counted, ["image_id"], "inside", "region-spans")
    box = F.struct(
        "x", "y", (F.col("right") - F.col("x") + 1).alias("w"), (F.col("bottom") - F.col("y") + 1).alias("h")
    )
    return in_order.select("image_id", (F.col("number") - 1).cast("int").alias("region_no"), box.alias("box"), "n_pixels")


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of points ``(x, y)``, in order, without those on its edges."""
    points = np.unique(points.astype(np.int64), axis=0)
    if len(points) < 3:
        return points

    def half(ordered):
        out = []
        for p in ordered:
            while len(out) > 1:
                (ax, ay), (bx, by) = out[-2], out[-1]
                if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0:
                    break
                out.pop()
            out.append(p)
        return out

    rows = points.tolist()
    return np.array(half(rows)[:-1] + half(rows[::-1])[:-1], np.int64)


def least_rectangle(corners: np.ndarray) -> tuple[int, int]:
    """Direction ``(dx, dy)`` of a side of the smallest rectangle around a convex hull, within 45 degrees of a line.

    The rectangle has a side along an edge of the hull, so each edge is tried. Of equal areas the direction of least slope is
    taken, falling ones first. A hull without an edge is level.
    """
    found = None
    for (ax, ay), (bx, by) in zip(corners.tolist(), np.roll(corners, -1, axis=0).tolist(), strict=True):
        dx, dy = bx - ax, by - ay
        size = int(np.gcd(dx, dy))
        if not size:
            continue
        dx, dy = dx // size, dy // size
        for _ in range(4):  # a quarter turn of a rectangle is the same rectangle
            if dx > 0 and -dx < dy <= dx:
                break
            dx, dy = -dy, dx
        along, across = corners @ [dx, dy], corners @ [-dy, dx]
        area = int(along.max() - along.min()) * int(across.max() - across.min()) / (dx * dx + dy * dy)
        key = (area, dy / dx)
        if found is None or key < found[0]:
            found = (key, (dx, dy))
    return found[1] if found else (1, 0)


def skew(mask: DataFrame) -> DataFrame:
    """``(image_id, dx, dy)``: the direction of the smallest rectangle around the set pixels of each image, in whole numbers.

    ``dx`` pixels to the right go with ``dy`` downwards, at most 45 degrees. Images without a set pixel have no row.
    """
    kind = mask.schema["image_id"].dataType.simpleString()
    of_points, of_hull = hull, least_rectangle
    ends = nonzero_ends(mask)
    points = ends.select("image_id", "y", F.explode(F.array("low", "high")).alias("x")).withColumn(
        "span", F.floor(F.col("y") / F.lit(_SPAN)).cast("int")
    )

    def of_span(group: pd.DataFrame) -> pd.DataFrame:
        corners = of_points(group[["x", "y"]].to_numpy())
        return pd.DataFrame({"image_id": group["image_id"].iat[0], "x": corners[:, 0], "y": corners[:, 1]})

    def of_image(group: pd.DataFrame) -> pd.DataFrame:
        dx, dy = of_hull(of_points(group[["x", "y"]].to_numpy()))
        return pd.DataFrame({"image_id": [group["image_id"].iat[0]], "dx": [dx], "dy": [dy]})

    corners = points.groupBy("image_id", "span").applyInPandas(of_span, f"image_id {kind}, x long, y long")
    return corners.groupBy("image_id").applyInPandas(of_image, f"image_id {kind}, dx long, dy long")


def turn(lines: DataFrame, directions: DataFrame, tile: int | None = None) -> DataFrame:
    """Images turned about their middle so that ``(dx, dy)`` of ``directions`` ``(image_id, dx, dy)`` becomes level.

    The size stays; what comes from outside of the image is white. A pixel is the one that its middle lies in. Images without a
    direction stay as they are. The sizes of the images are counted first, so the lines are read twice.
    """
    side = tile or _TILE
    sizes = lines.groupBy("image_id").agg((F.max("y") + 1).alias("h"), F.max(F.size("v")).alias("w"))
    known = sizes.join(directions.select("image_id", "dx", "dy"), "image_id", "left").na.fill({"dx": 1, "dy": 0})
    tiles = F.sequence(F.lit(0), F.floor((F.size("v") - 1) / F.lit(side)).cast("int"))
    cut = F.transform(tiles, lambda t: F.struct(t.alias("sx"), F.slice("v", t * side + 1, F.lit(side)).alias("part")))
    parts = lines.where(F.size("v") > 0).select("image_id", "y", F.explode(cut).alias("c")).select("image_id", "y", "c.sx", "c.part")
    sy = F.floor(F.col("y") / F.lit(side)).cast("int")
    # where the corners of a tile of the image come to lie, with a pixel to spare
    length = F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))
    c, s = F.col("dx") / length, F.col("dy") / length
    mx, my = (F.col("w") - 1) / 2, (F.col("h") - 1) / 2
    corners = [(x, y) for x in (F.col("sx") * side, (F.col("sx") + 1) * side) for y in (F.col("sy") * side, (F.col("sy") + 1) * side)]
    xs = [mx + (x - mx) * c + (y - my) * s for x, y in corners]
    ys = [my - (x - mx) * s + (y - my) * c for x, y in corners]

    def reached(places: list[Column], size: str) -> Column:
        low = F.greatest(F.lit(0), F.floor((F.least(*places) - 1) / side).cast("int"))
        high = F.least(F.floor((F.col(size) - 1) / side).cast("int"), F.floor((F.greatest(*places) + 1) / side).cast("int"))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    table = known.withColumn("sx", F.explode(F.sequence(F.lit(0), F.floor((F.col("w") - 1) / side).cast("int")))).withColumn(
        "sy", F.explode(F.sequence(F.lit(0), F.floor((F.col("h") - 1) / side).cast("int")))
    )
    goals = table.withColumn("tx", F.explode(reached(xs, "w"))).withColumn("ty", F.explode(reached(ys, "h")))
    dealt = parts.withColumn("sy", sy).join(goals, ["image_id", "sx", "sy"])
    # every tile of the result is made, also of nothing
    empty = table.select(
        "image_id", F.lit(None).cast("int").alias("y"), F.col("sx").alias("tx"), F.col("sy").alias("ty"), "sx",
        F.lit(None).cast("array<int>").alias("part"), "w", "h", "dx", "dy",
    )
    kind = lines.schema["image_id"].dataType.simpleString()
    keys, blocks, white, most = ["image_id", "tx", "ty"], group_blocks, WHITE, _PIXELS

    def made(batches):
        for frame, starts in blocks(batches, keys):
            w, h, dx, dy, tx, ty = (frame[k].to_numpy(np.int64)[starts] for k in ("w", "h", "dx", "dy", "tx", "ty"))
            nx, ny = np.minimum(w, (tx + 1) * side) - tx * side, np.minimum(h, (ty + 1) * side) - ty * side
            upto = np.cumsum(nx * ny)
            image, ends, low = frame["image_id"].to_numpy()[starts], np.append(starts[1:], len(frame)), 0
            while low < len(starts):  # tiles of a bounded number of pixels together
                high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + most, side="right")))
                # a row per line of a tile, then a place per pixel
                t = np.repeat(np.arange(low, high), ny[low:high])
                y = np.arange(len(t)) - np.repeat(np.cumsum(ny[low:high]) - ny[low:high], ny[low:high]) + ty[t] * side
                line = np.repeat(np.arange(len(t)), nx[t])
                of, first = t[line], np.cumsum(nx[t]) - nx[t]
                x, down = np.arange(len(line)) - first[line] + (tx * side)[of], y[line]
                size = np.sqrt((dx * dx + dy * dy).astype(np.float64))
                c, s, mx, my = (dx / size)[of], (dy / size)[of], ((w - 1) / 2)[of], ((h - 1) / 2)[of]
                from_x = np.floor(mx + (x - mx) * c - ((down - my) * s) + 0.5).astype(np.int64)
                from_y = np.floor(my + (x - mx) * s + ((down - my) * c) + 0.5).astype(np.int64)
                out = np.full(len(line), white, np.int32)
                part = frame.iloc[starts[low] : ends[high - 1]]
                of_part = np.repeat(np.arange(low, high), ends[low:high] - starts[low:high])
                known = part["part"].notna().to_numpy()
                part, of_part = part[known], of_part[known]
                if len(part):
                    # lines by tile, number and place across; of equal ones the last counts
                    place = (of_part - low) * (int(h.max()) + 1) + part["y"].to_numpy(np.int64)
                    key = place * (int(w.max()) // side + 1) + part["sx"].to_numpy(np.int64)
                    order = np.argsort(key, kind="stable")
                    parts = part["part"].to_numpy()[order].tolist()
                    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
                    begin, flat = np.cumsum(sizes) - sizes, np.concatenate(parts)
                    inside = np.flatnonzero((from_x >= 0) & (from_x < w[of]) & (from_y >= 0) & (from_y < h[of]))
                    from_x, from_y, of = from_x[inside], from_y[inside], of[inside]
                    wanted = ((of - low) * (int(h.max()) + 1) + from_y) * (int(w.max()) // side + 1) + from_x // side
                    found = np.searchsorted(key[order], wanted, side="right") - 1
                    hit = (found >= 0) & (key[order][found] == wanted) & (from_x % side < sizes[found])
                    out[inside[hit]] = flat[begin[found[hit]] + from_x[hit] % side]
                yield pd.DataFrame({"image_id": image[t], "y": y, "tx": tx[t], "part": np.split(out, first[1:])})
                low = high

    columns = ["image_id", "y", "tx", "ty", "sx", "part", "w", "h", "dx", "dy"]
    gathered = dealt.select(*columns).unionByName(empty)
    turned = gathered.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(made, f"image_id {kind}, y int, tx int, part array<int>")
    whole = F.array_sort(F.collect_list(F.struct("tx", "part")))
    return turned.groupBy("image_id", "y").agg(whole.alias("parts")).select("image_id", "y", F.flatten("parts.part").alias("v"))


def deskew(lines: DataFrame, mask: DataFrame, tile: int | None = None) -> DataFrame:
    """``lines`` turned level by the skew of ``mask``."""
    return turn(lines, skew(mask), tile)
