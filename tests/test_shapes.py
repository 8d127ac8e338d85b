"""Regions, skew and rotation against brute force on small images, on tiles of several sizes."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import pagemill as pm
from pagemill.functions.frames import group_blocks
from pagemill.operators import shapes


def lines_of(spark, images):
    rows = [(k, y, [int(p) for p in line]) for k, image in images.items() for y, line in enumerate(image)]
    return spark.createDataFrame(rows, "image_id long, y int, v array<int>").repartition(3)


def image_of(df, key):
    return np.array([r.v for r in df.where(F.col("image_id") == key).orderBy("y").collect()])


def brute_regions(image):
    left, out = {(int(y), int(x)) for y, x in zip(*np.nonzero(image), strict=True)}, []
    while left:
        todo, found = [left.pop()], []
        while todo:
            y, x = todo.pop()
            found.append((y, x))
            around = {(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & left
            left -= around
            todo += around
        ys, xs = zip(*found, strict=True)
        out.append((min(ys), min(xs), min(found), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, len(found)))
    return [(k, x, y, w, h, n) for k, (y, x, _, w, h, n) in enumerate(sorted(out))]


def spiral(n):
    image = np.zeros((n, n), int)
    y = x = 0
    dy, dx = 0, 1
    image[0, 0] = 1
    for _ in range(n * n):
        ahead = (y + 2 * dy, x + 2 * dx)
        step = (y + dy, x + dx)
        if not (0 <= step[0] < n and 0 <= step[1] < n) or (0 <= ahead[0] < n and 0 <= ahead[1] < n and image[ahead]):
            dy, dx = dx, -dy
            step = (y + dy, x + dx)
            if not (0 <= step[0] < n and 0 <= step[1] < n) or image[step]:
                break
        y, x = step
        image[y, x] = 1
    return image


@pytest.mark.parametrize("tile", [3, 8, 1024])
def test_regions_match_brute_force(spark, monkeypatch, tile):
    """Regions that span tiles, touch at corners of tiles, wind about one another, or fill the image."""
    monkeypatch.setattr(shapes, "_SPAN", 5)
    random = np.random.default_rng(9)
    images = {k: random.random((random.integers(1, 22), random.integers(1, 22))) < share for k, share in enumerate([0.1, 0.3, 0.4, 0.5, 0.7])}
    images |= {10: np.eye(19), 11: np.eye(16)[::-1], 12: np.ones((9, 17)), 13: np.zeros((5, 5)), 14: spiral(21), 15: np.ones((1, 1))}
    mask = lines_of(spark, {k: (np.asarray(i) > 0) * 255 for k, i in images.items()})
    got = {}
    for r in pm.raster_regions(mask, tile).collect():
        got.setdefault(r.image_id, []).append((r.region_no, *r.box, r.n_pixels))
    assert {k: sorted(v) for k, v in got.items()} == {k: w for k, i in images.items() if (w := brute_regions(i))}


def test_regions_of_nothing(spark):
    empty = lines_of(spark, {1: np.zeros((2, 2))})
    assert pm.raster_regions(empty).count() == 0 and pm.raster_regions(empty.limit(0)).count() == 0
    assert pm.skew(empty).count() == 0
    assert image_of(pm.deskew(empty, empty), 1).tolist() == [[0, 0], [0, 0]]
    broken = spark.createDataFrame([(None, 1, [1]), (1, None, [1]), (1, 1, None), (2, 0, [1])], "image_id long, y int, v array<int>")
    assert [tuple(r)[:2] for r in pm.raster_regions(broken).collect()] == [(2, 0)]


def inked(angle, w=400, h=240):
    """A page of lines of text, 300 by 120, turned by an angle."""
    y, x = np.mgrid[0:h, 0:w]
    c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))
    u, v = (x - w / 2) * c + (y - h / 2) * s, -(x - w / 2) * s + (y - h / 2) * c
    return (abs(u) <= 150) & (abs(v) <= 60) & (np.floor(v / 8) % 2 == 0)


def test_known_angles_are_found(spark, monkeypatch):
    monkeypatch.setattr(shapes, "_SPAN", 50)
    angles = {0: 0.0, 1: 3.0, 2: -7.5, 3: 12.25, 4: 30.0, 5: -0.75, 6: 44.0}
    mask = lines_of(spark, {k: inked(a, 520, 520) * 255 for k, a in angles.items()})
    got = {r.image_id: math.degrees(math.atan2(r.dy, r.dx)) for r in pm.skew(mask).collect()}
    # a border of 300 pixels shows an angle to the tangent of a pixel or so
    assert got.keys() == angles.keys() and all(abs(got[k] - a) < 0.35 for k, a in angles.items())
    fine = lines_of(spark, {k: sharp(a) * 255 for k, a in {1: 3.0, 2: -7.5, 3: 20.0}.items()})
    got = {r.image_id: math.degrees(math.atan2(r.dy, r.dx)) for r in pm.skew(fine).collect()}
    assert all(abs(got[k] - a) < 0.1 for k, a in {1: 3.0, 2: -7.5, 3: 20.0}.items())


def sharp(angle):
    """A rectangle of 1,400 by 500 pixels."""
    y, x = np.mgrid[0:1500, 0:1500]
    c, s = math.cos(math.radians(angle)), math.sin(math.radians(angle))
    u, v = (x - 750) * c + (y - 750) * s, -(x - 750) * s + (y - 750) * c
    return (abs(u) <= 700) & (abs(v) <= 250)


def brute_turn(image, dx, dy):
    h, w = image.shape
    size = math.sqrt(dx * dx + dy * dy)
    c, s, mx, my = dx / size, dy / size, (w - 1) / 2, (h - 1) / 2
    out = np.full((h, w), 255)
    for y in range(h):
        for x in range(w):
            u, v = math.floor(mx + (x - mx) * c - (y - my) * s + 0.5), math.floor(my + (x - mx) * s + (y - my) * c + 0.5)
            if 0 <= u < w and 0 <= v < h:
                out[y, x] = image[v, u]
    return out


@pytest.mark.parametrize("tile", [4, 1024])
def test_turning_matches_brute_force(spark, tile):
    random = np.random.default_rng(2)
    sizes = {1: (9, 14, 1, 0), 2: (16, 5, 3, 1), 3: (12, 12, 1, 1), 4: (11, 20, 5, -2), 5: (1, 9, 7, 3), 6: (8, 8, 9, 9)}
    images = {k: random.integers(0, 256, s[:2]) for k, s in sizes.items()} | {7: random.integers(0, 256, (6, 6))}
    directions = spark.createDataFrame([(k, s[2], s[3]) for k, s in sizes.items()], "image_id long, dx long, dy long")
    turned = pm.turn(lines_of(spark, images), directions, tile)
    for k, (_, _, dx, dy) in sizes.items():
        assert (image_of(turned, k) == brute_turn(images[k], dx, dy)).all(), k
    assert (image_of(turned, 7) == images[7]).all()


def test_deskewed_lines_are_level(spark):
    page = np.where(inked(6.0, 520, 520), 0, 255)
    lines = lines_of(spark, {1: page})
    level = image_of(pm.deskew(lines, pm.binarize_inv(lines), 128), 1)
    ink = (level < 100).sum(axis=1)
    full, none = (ink > 280).sum(), (ink == 0).sum()
    before = (page < 100).sum(axis=1)
    assert full >= 50 and (before > 280).sum() == 0 and none >= 380


def test_small_tiles_are_worked_on_together():
    """Groups that end in a batch are one frame; what of a group is still to come is held back."""
    frame = pd.DataFrame({"a": [1, 1, 2, 3, 3, 3, 3, 4], "b": [0, 0, 0, 0, 0, 0, 1, 1]})
    for size in (1, 2, 3, 5, 8):
        blocks = list(group_blocks((frame.iloc[k : k + size] for k in range(0, 8, size)), ["a", "b"]))
        assert pd.concat([f for f, _ in blocks], ignore_index=True).equals(frame)
        groups = [n for f, starts in blocks for n in np.diff([*starts, len(f)]).tolist()]
        assert groups == [2, 1, 3, 1, 1]
    assert [len(starts) for _, starts in group_blocks(iter([frame]), ["a", "b"])] == [4, 1]
    assert [len(f) for f, _ in group_blocks(iter([frame.iloc[:0], frame]), ["a", "b"])] == [7, 1]
