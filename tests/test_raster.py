"""Raster operators against straightforward numpy, with odd shapes and the default kernels."""

import numpy as np
import pytest

import pagemill as pm


def to_df(spark, images):
    rows = [
        (image_id, y, x, int(v))
        for image_id, image in images.items()
        for (y, x), v in np.ndenumerate(image)
    ]
    return pm.to_lines(spark.createDataFrame(rows, "image_id long, y int, x int, v int"))


def from_df(df):
    images = {}
    for r in pm.to_pixels(df).collect():
        images.setdefault(r.image_id, {})[(r.y, r.x)] = r.v
    out = {}
    for image_id, cells in images.items():
        h, w = (max(c[i] for c in cells) + 1 for i in (0, 1))
        assert len(cells) == h * w
        out[image_id] = np.array([[cells[(y, x)] for x in range(w)] for y in range(h)])
    return out


def box_filter(image, k, pick):
    low, high = k // 2, k - 1 - k // 2
    h, w = image.shape
    return np.array(
        [
            [
                pick(image[max(0, y - low) : y + high + 1, max(0, x - low) : x + high + 1])
                for x in range(w)
            ]
            for y in range(h)
        ]
    )


def halve(image):
    h, w = image.shape
    if h < 2 or w < 2:
        return None
    oh, ow = h // 2, w // 2

    def weights(n, o):
        return np.array(
            [[max(0, min((x + 1) * o, (j + 1) * n) - max(x * o, j * n)) for x in range(n)] for j in range(o)]
        )

    wy, wx = weights(h, oh), weights(w, ow)
    assert (wy.sum(axis=1) == h).all() and (wx.sum(axis=1) == w).all()
    return (2 * (wy @ image @ wx.T) + w * h) // (2 * w * h)


def clean(image, t, noise, grow, shrink):
    mask = np.where(image > t, 0, 255)
    mask = box_filter(mask, noise, np.min)
    mask = box_filter(mask, grow, np.max)
    mask = box_filter(mask, shrink, np.min)
    if not mask.any():
        return None
    ys, xs = np.nonzero(mask)
    white = np.where(mask != 0, image, 255)
    return halve(white[ys.min() : ys.max() + 1, xs.min() : xs.max() + 1])


@pytest.fixture(scope="module")
def images():
    rng = np.random.default_rng(5)
    page = np.full((70, 61), 250)
    page[20:40, 10:33] = rng.integers(0, 90, (20, 23))
    page[60:62, 50:52] = 0
    return {
        1: rng.integers(0, 256, (9, 13)),
        2: rng.integers(0, 120, (12, 7)),
        3: page,
        4: np.full((6, 6), 255),
        5: np.array([[0, 10, 20]]),
    }


@pytest.mark.parametrize("k", [1, 2, 3, 4, 7, 50, 100])
def test_erode_and_dilate(spark, images, k):
    df = to_df(spark, images)
    eroded, dilated = from_df(pm.erode(df, k)), from_df(pm.dilate(df, k))
    for i, image in images.items():
        assert (eroded[i] == box_filter(image, k, np.min)).all()
        assert (dilated[i] == box_filter(image, k, np.max)).all()
        assert (eroded[i] <= image).all() and (dilated[i] >= image).all()


@pytest.mark.parametrize("k", [1, 2, 3, 4, 7, 50, 100])
def test_masks_give_the_same_as_any_raster(spark, images, k):
    mask = pm.binarize_inv(to_df(spark, images), 60)
    for fast, plain in ((pm.erode_mask, pm.erode), (pm.dilate_mask, pm.dilate)):
        a, b = from_df(fast(mask, k)), from_df(plain(mask, k))
        assert all((a[i] == b[i]).all() for i in images)


def test_half_size(spark, images):
    got = from_df(pm.half_size(to_df(spark, images)))
    want = {i: halve(image) for i, image in images.items()}
    assert set(got) == {i for i, image in want.items() if image is not None} == {1, 2, 3, 4}
    assert all((got[i] == want[i]).all() for i in got)


@pytest.mark.parametrize("kernels", [(100, 3, 100, 50), (100, 3, 9, 5), (60, 2, 4, 2), (100, 1, 1, 1)])
def test_clean_image(spark, images, kernels):
    got = from_df(pm.clean_image(to_df(spark, images), *kernels))
    want = {i: clean(image, *kernels) for i, image in images.items()}
    want = {i: image for i, image in want.items() if image is not None}
    assert got and set(got) == set(want)
    assert all((got[i] == want[i]).all() for i in got)


def test_steps_make_the_chain(spark, images):
    df = to_df(spark, images)
    mask = pm.erode(pm.dilate(pm.erode(pm.binarize_inv(df, 100), 3), 9), 5)
    steps = pm.half_size(pm.crop(pm.apply_mask(df, mask), pm.bounding_box(mask)))
    a, b = from_df(steps), from_df(pm.clean_image(df, 100, 3, 9, 5))
    assert a and set(a) == set(b)
    assert all((a[i] == b[i]).all() for i in a)


def test_gray_is_weighted_and_rounded(spark):
    rows = [(1, 0, 0, 255, 255, 255), (1, 0, 1, 0, 0, 0), (1, 0, 2, 255, 0, 0), (1, 0, 3, 0, 255, 0), (1, 0, 4, 0, 0, 255)]
    df = spark.createDataFrame(rows, "image_id long, y int, x int, r int, g int, b int")
    assert [r.v for r in pm.to_gray(pm.to_lines(df, "r", "g", "b")).collect()] == [[255, 0, 76, 150, 29]]


def test_nonzero_and_box(spark, images):
    df = to_df(spark, {4: images[4] * 0, 1: np.array([[0, 0, 0, 0], [0, 9, 0, 9], [0, 9, 0, 0]])})
    assert sorted((r.y, r.x) for r in pm.nonzero(df).collect()) == [(1, 1), (1, 3), (2, 1)]
    assert [tuple(r) for r in pm.bounding_box(df).collect()] == [(1, 1, 1, 3, 2)]


def test_sparse_images_are_found(spark, images):
    df = pm.to_pixels(to_df(spark, images))
    assert pm.sparse_images(df).count() == 0
    assert [r.image_id for r in pm.sparse_images(df.where("NOT (image_id = 3 AND x = 5 AND y = 7)")).collect()] == [3]


def test_tiles_meet_without_a_seam(spark, images, monkeypatch):
    from pagemill.operators import raster

    want = from_df(pm.clean_image(to_df(spark, images), 100, 3, 9, 5))
    monkeypatch.setattr(raster, "_TILE", 7)
    got = from_df(pm.clean_image(to_df(spark, images), 100, 3, 9, 5))
    assert got.keys() == want.keys() and all((got[i] == want[i]).all() for i in want)
    dilated = from_df(pm.dilate(to_df(spark, images), 10))
    assert all((dilated[i] == box_filter(image, 10, np.max)).all() for i, image in images.items())


def test_long_sides(spark):
    line = [int(v) for v in np.random.default_rng(1).integers(0, 256, 70_000)]
    df = spark.createDataFrame([(1, 0, line), (1, 1, line)], "image_id long, y int, v array<int>")
    (row,) = pm.half_size(df).collect()
    pairs = np.array(line).reshape(-1, 2).sum(axis=1)
    assert row.v == ((2 * pairs + 2) // 4).tolist()
    turned = spark.createDataFrame([(1, y, [v, v]) for y, v in enumerate(line)], "image_id long, y int, v array<int>")
    assert [r.v for r in pm.half_size(turned).orderBy("y").collect()] == [[v] for v in row.v]


def test_pages_to_rasters_and_back(spark):
    class Engine:
        def page_count(self, file):
            return 2

        def render(self, file, first, last):
            for _ in range(first, last + 1):
                yield file.read(4)

        def raster(self, image):
            if image == b"bad!":
                raise ValueError("no pixels")
            return [[image[0], image[1]], [image[2], image[3]]]

        def image(self, lines):
            return bytes(int(v) for line in lines for v in line)

        def recognize(self, image, lang, rect):
            return image.decode()

    df = spark.createDataFrame(
        [("p", bytearray(b"abcdbad!"), 1, 2)], "path string, content binary, first_page int, last_page int"
    )
    lines = pm.render_rasters(df, Engine)
    got = sorted(((r.page_no, r.y, r.v, r.ok) for r in lines.collect()), key=str)
    assert got == [(1, 0, [97, 98], True), (1, 1, [99, 100], True), (2, None, None, False)]
    pages = pm.recognize_rasters(lines, Engine).collect()
    assert [(r.page_no, r.page_text, r.ok) for r in pages] == [(1, "abcd", True)]
