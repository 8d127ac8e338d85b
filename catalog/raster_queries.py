"""Queries over raster tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import pagemill as pm
from catalog import fixtures as fx

# Kernels that fit images of 8 x 8, and of 64 x 250.
SMALL = {"t": 100, "noise": 2, "grow": 4, "shrink": 2}
TALL = {"t": 128, "noise": 3, "grow": 9, "shrink": 5}
FULL = {"t": 128, "noise": 3, "grow": 100, "shrink": 50}


def _pixels(query):
    """The query's lines as pixels, at the last step only."""

    def run(spark, sf):
        return pm.to_pixels(query(spark, sf))

    return run


def to_gray(spark, sf):
    """Three channels of one image from three embedding values each."""
    values = fx.gray_values()

    def shifted(by):
        return F.concat(F.slice(values, by + 1, 64 - by), F.slice(values, 1, by)) if by else values

    channels = F.arrays_zip(values.alias("r"), shifted(1).alias("g"), shifted(2).alias("b"))
    rgb = fx.table(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), fx.square(channels, "y", "c"))
    return pm.to_gray(rgb.select("image_id", "y", "c.r", "c.g", "c.b"))


def binarize_inv(spark, sf):
    return pm.binarize_inv(fx.raster(spark, sf))


def erode_3(spark, sf):
    return pm.erode(fx.tall_raster(spark, sf), 3)


def dilate_100(spark, sf):
    return pm.dilate(fx.tall_raster(spark, sf), 100)


def erode_50(spark, sf):
    return pm.erode(fx.tall_raster(spark, sf), 50)


def _mask(spark, sf):
    return pm.binarize_inv(fx.tall_raster(spark, sf), 128)


def erode_mask(spark, sf):
    return pm.erode_mask(_mask(spark, sf), 3)


def dilate_mask(spark, sf):
    return pm.dilate_mask(pm.erode_mask(_mask(spark, sf), 3), 10)


def nonzero(spark, sf):
    return pm.nonzero(pm.binarize_inv(fx.raster(spark, sf)))


def apply_mask(spark, sf):
    px = fx.raster(spark, sf)
    return pm.apply_mask(px, pm.binarize_inv(px))


def _small_boxes(spark, sf):
    return pm.bounding_box(pm.erode_mask(pm.binarize_inv(fx.raster(spark, sf)), 2))


def bounding_box(spark, sf):
    return _small_boxes(spark, sf)


def crop(spark, sf):
    return pm.crop(fx.raster(spark, sf), _small_boxes(spark, sf))


def half_size(spark, sf):
    return pm.half_size(fx.tall_raster(spark, sf))


def half_size_cropped(spark, sf):
    """Odd and even sizes, and images that get too small to be halved."""
    return pm.half_size(pm.crop(fx.raster(spark, sf), _small_boxes(spark, sf)))


def clean_image(spark, sf):
    return pm.clean_image(fx.raster(spark, sf), **SMALL)


def clean_image_tall(spark, sf):
    return pm.clean_image(fx.tall_raster(spark, sf), **TALL)


def clean_image_full_kernels(spark, sf):
    return pm.clean_image(fx.tall_raster(spark, sf), **FULL)


def sparse_images(spark, sf):
    """Dropping the white pixels leaves images that no longer fill their rectangle."""
    return pm.sparse_images(pm.to_pixels(fx.raster(spark, sf)).where(F.col("v") < 255))


def raster_regions(spark, sf):
    """Connected regions of the ink, found on tiles of three pixels."""
    return fx.flat_boxes(pm.raster_regions(pm.binarize_inv(fx.raster(spark, sf)), tile=3))


def skew(spark, sf):
    return pm.skew(pm.binarize_inv(fx.raster(spark, sf)))


def deskew(spark, sf):
    lines = fx.raster(spark, sf)
    return pm.deskew(lines, pm.binarize_inv(lines), tile=3)


QUERIES = {
    "to_gray": _pixels(to_gray),
    "binarize_inv": _pixels(binarize_inv),
    "erode_3": _pixels(erode_3),
    "dilate_100": _pixels(dilate_100),
    "erode_50": _pixels(erode_50),
    "erode_mask": _pixels(erode_mask),
    "dilate_mask": _pixels(dilate_mask),
    "nonzero": nonzero,
    "apply_mask": _pixels(apply_mask),
    "bounding_box": bounding_box,
    "crop": _pixels(crop),
    "half_size": _pixels(half_size),
    "half_size_cropped": _pixels(half_size_cropped),
    "clean_image": _pixels(clean_image),
    "clean_image_tall": _pixels(clean_image_tall),
    "clean_image_full_kernels": _pixels(clean_image_full_kernels),
    "sparse_images": sparse_images,
    "raster_regions": raster_regions,
    "skew": skew,
    "deskew": _pixels(deskew),
}


def _filter(source: str, k: int, pick: str, out: str) -> str:
    frame = f"ROWS BETWEEN {k // 2} PRECEDING AND {k - 1 - k // 2} FOLLOWING"
    return f"""{out}_rows AS (
  SELECT image_id, y, x, {pick}(v) OVER (PARTITION BY image_id, y ORDER BY x {frame}) AS v FROM {source}),
{out} AS (
  SELECT image_id, y, x, {pick}(v) OVER (PARTITION BY image_id, x ORDER BY y {frame}) AS v FROM {out}_rows)"""


def _ink(t: int) -> str:
    return f"ink AS (SELECT image_id, y, x, CASE WHEN v > {t} THEN 0 ELSE 255 END::INTEGER AS v FROM px)"


def _boxes(source: str) -> str:
    return f"""boxes AS (
  SELECT image_id, min(x) AS bx, min(y) AS "by", max(x) - min(x) + 1 AS bw, max(y) - min(y) + 1 AS bh
  FROM {source} WHERE v <> 0 GROUP BY image_id)"""


def _cut(source: str) -> str:
    return f"""cut AS (
  SELECT image_id, y - "by" AS y, x - bx AS x, v FROM {source} JOIN boxes USING (image_id)
  WHERE x >= bx AND x < bx + bw AND y >= "by" AND y < "by" + bh)"""


def _half(source: str) -> str:
    return f"""sizes AS (SELECT image_id, max(x) + 1 AS w, max(y) + 1 AS h FROM {source} GROUP BY image_id),
sized AS (
  SELECT *, w // 2 AS ow, h // 2 AS oh FROM {source} JOIN sizes USING (image_id) WHERE w >= 2 AND h >= 2),
in_x AS (
  SELECT *, unnest(range(x * ow // w, ((x + 1) * ow - 1) // w + 1)) AS j FROM sized),
in_xy AS (
  SELECT *, unnest(range(y * oh // h, ((y + 1) * oh - 1) // h + 1)) AS i FROM in_x),
weighted AS (
  SELECT *, least((x + 1) * ow, (j + 1) * w) - greatest(x * ow, j * w) AS wx,
         least((y + 1) * oh, (i + 1) * h) - greatest(y * oh, i * h) AS wy FROM in_xy)
SELECT image_id, i::INTEGER AS y, j::INTEGER AS x,
       ((2 * sum(v::BIGINT * wx * wy) + w::BIGINT * h) // (2 * w::BIGINT * h))::INTEGER AS v
FROM weighted GROUP BY image_id, w, h, i, j"""


def _clean(raster: str, t: int, noise: int, grow: int, shrink: int) -> str:
    return f"""WITH {raster}, {_ink(t)},
{_filter("ink", noise, "min", "thin")},
{_filter("thin", grow, "max", "fat")},
{_filter("fat", shrink, "min", "mask")},
whitened AS (
  SELECT px.image_id, px.y, px.x, CASE WHEN mask.v <> 0 THEN px.v ELSE 255 END AS v
  FROM px JOIN mask ON px.image_id = mask.image_id AND px.y = mask.y AND px.x = mask.x),
{_boxes("mask")}, {_cut("whitened")}, {_half("cut")}"""


def _components(source: str) -> str:
    """Regions of ``source`` ``(image_id, y, x)``: each pixel's least pixel that can be reached."""
    return f"""reached AS (
  SELECT image_id, y, x, y AS ry, x AS rx FROM {source}
  UNION
  SELECT r.image_id, s.y, s.x, r.ry, r.rx FROM reached r JOIN {source} s
    ON s.image_id = r.image_id AND s.y BETWEEN r.y - 1 AND r.y + 1 AND s.x BETWEEN r.x - 1 AND r.x + 1),
rooted AS (SELECT image_id, y, x, min(ry::BIGINT * 100000 + rx) AS root FROM reached GROUP BY image_id, y, x),
regions AS (
  SELECT image_id, root, min(x) AS x, min(y) AS y, (max(x) - min(x) + 1)::INTEGER AS w, (max(y) - min(y) + 1)::INTEGER AS h,
         count(*) AS n_pixels FROM rooted GROUP BY image_id, root)
SELECT image_id, (row_number() OVER (PARTITION BY image_id ORDER BY y, x, root) - 1)::INTEGER AS region_no, x, y, w, h, n_pixels
FROM regions"""


_SKEW = """pts AS (
  SELECT image_id, y::BIGINT AS y, unnest([min(x), max(x)])::BIGINT AS x FROM ink WHERE v <> 0 GROUP BY image_id, y),
sides AS (
  SELECT a.image_id, b.x - a.x AS dx, b.y - a.y AS dy
  FROM pts a JOIN pts b ON a.image_id = b.image_id AND (a.x <> b.x OR a.y <> b.y) JOIN pts c ON c.image_id = a.image_id
  GROUP BY a.image_id, a.x, a.y, b.x, b.y HAVING min((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x)) >= 0),
turned AS (
  SELECT DISTINCT image_id, t.dx // gcd(t.dx, t.dy) AS dx, t.dy // gcd(t.dx, t.dy) AS dy
  FROM (SELECT image_id, unnest([{'dx': dx, 'dy': dy}, {'dx': -dy, 'dy': dx}, {'dx': -dx, 'dy': -dy}, {'dx': dy, 'dy': -dx}]) AS t FROM sides)
  WHERE t.dx > 0 AND t.dy > -t.dx AND t.dy <= t.dx),
areas AS (
  SELECT image_id, dx, dy,
         ((max(x * dx + y * dy) - min(x * dx + y * dy)) * (max(y * dx - x * dy) - min(y * dx - x * dy)))::DOUBLE
           / (dx * dx + dy * dy)::DOUBLE AS area
  FROM turned JOIN pts USING (image_id) GROUP BY image_id, dx, dy),
least AS (
  SELECT image_id, dx, dy FROM areas
  QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY area, dy::DOUBLE / dx::DOUBLE) = 1),
skew AS (
  SELECT image_id, coalesce(dx, 1)::BIGINT AS dx, coalesce(dy, 0)::BIGINT AS dy
  FROM (SELECT DISTINCT image_id FROM pts) LEFT JOIN least USING (image_id))"""

_SELECT = "SELECT image_id, y, x, v FROM "
_SMALL_BOXES = f"{fx.RASTER}, {_ink(100)}, {_filter('ink', 2, 'min', 'thin')}, {_boxes('thin')}"
_VALUE = "least(255, greatest(0, floor(128 + embedding[{} + 1]::DOUBLE * 500)))::INTEGER"

ORACLE = {
    "to_gray": f"""WITH rgb AS (
  SELECT vec_id AS image_id, k // 8 AS y, k % 8 AS x, {_VALUE.format("k")} AS r,
         {_VALUE.format("(k + 1) % 64")} AS g, {_VALUE.format("(k + 2) % 64")} AS b
  FROM (SELECT *, unnest(range(len(embedding))) AS k FROM embeddings))
SELECT image_id, y::INTEGER AS y, x::INTEGER AS x, ((299 * r + 587 * g + 114 * b + 500) // 1000)::INTEGER AS v FROM rgb""",
    "binarize_inv": f"WITH {fx.RASTER}, {_ink(100)} {_SELECT} ink",
    "erode_3": f"WITH {fx.TALL}, {_filter('px', 3, 'min', 'o')} {_SELECT} o",
    "dilate_100": f"WITH {fx.TALL}, {_filter('px', 100, 'max', 'o')} {_SELECT} o",
    "erode_50": f"WITH {fx.TALL}, {_filter('px', 50, 'min', 'o')} {_SELECT} o",
    "erode_mask": f"WITH {fx.TALL}, {_ink(128)}, {_filter('ink', 3, 'min', 'o')} {_SELECT} o",
    "dilate_mask": f"""WITH {fx.TALL}, {_ink(128)}, {_filter('ink', 3, 'min', 'm')}, {_filter('m', 10, 'max', 'o')}
{_SELECT} o""",
    "nonzero": f"WITH {fx.RASTER}, {_ink(100)} SELECT image_id, y, x FROM ink WHERE v <> 0",
    "apply_mask": f"WITH {fx.RASTER} SELECT image_id, y, x, CASE WHEN v > 100 THEN 255 ELSE v END AS v FROM px",
    "bounding_box": f'WITH {_SMALL_BOXES} SELECT image_id, bx, "by", bw, bh FROM boxes',
    "crop": f"WITH {_SMALL_BOXES}, {_cut('px')} {_SELECT} cut",
    "half_size": f"WITH {fx.TALL}, {_half('px')}",
    "half_size_cropped": f"WITH {_SMALL_BOXES}, {_cut('px')}, {_half('cut')}",
    "clean_image": _clean(fx.RASTER, **SMALL),
    "clean_image_tall": _clean(fx.TALL, **TALL),
    "clean_image_full_kernels": _clean(fx.TALL, **FULL),
    "sparse_images": f"""WITH {fx.RASTER}
SELECT image_id, count(*) AS n_pixels, ((max(x) + 1) * (max(y) + 1))::BIGINT AS n_expected
FROM px WHERE v < 255 GROUP BY image_id HAVING count(*) <> (max(x) + 1) * (max(y) + 1)""",
    "raster_regions": f"WITH RECURSIVE {fx.RASTER}, {_ink(100)}, inked AS (SELECT image_id, y, x FROM ink WHERE v <> 0), {_components('inked')}",
    "skew": f"WITH {fx.RASTER}, {_ink(100)}, {_SKEW} SELECT * FROM skew",
    "deskew": f"""WITH {fx.RASTER}, {_ink(100)}, {_SKEW},
angles AS (
  SELECT image_id, dx / sqrt((dx * dx + dy * dy)::DOUBLE) AS c, dy / sqrt((dx * dx + dy * dy)::DOUBLE) AS s
  FROM (SELECT image_id, coalesce(dx, 1) AS dx, coalesce(dy, 0) AS dy FROM (SELECT DISTINCT image_id FROM px) LEFT JOIN skew USING (image_id))),
from_where AS (
  SELECT image_id, y, x, floor(3.5::DOUBLE + (x - 3.5::DOUBLE) * c - (y - 3.5::DOUBLE) * s + 0.5::DOUBLE)::INTEGER AS u,
         floor(3.5::DOUBLE + (x - 3.5::DOUBLE) * s + (y - 3.5::DOUBLE) * c + 0.5::DOUBLE)::INTEGER AS t
  FROM px JOIN angles USING (image_id))
SELECT f.image_id, f.y, f.x, coalesce(px.v, 255)::INTEGER AS v
FROM from_where f LEFT JOIN px ON px.image_id = f.image_id AND px.y = f.t AND px.x = f.u""",
}
