"""Image operations on pixel tables against plain numpy versions of them."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from histoweave.operators import raster
import plain_images as plain
import plain_kernels as kernels

W, H, BY = 9, 7, ["img", "layer"]


@pytest.fixture(scope="module")
def images():
    rng = np.random.default_rng(17)
    return {(i, k): rng.integers(-300, 300, (H, W)) * (rng.random((H, W)) < 0.6) for i in range(3) for k in range(2)}


@pytest.fixture(scope="module")
def pixels(spark, images):
    rows = [(i, k, x, y, int(a[y, x])) for (i, k), a in images.items() for y in range(H) for x in range(W)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["img", "layer", "x", "y", "v"])).cache()


def arrays(df, column="v", missing=0.0):
    out = {}
    for r in df.collect():
        out.setdefault((r["img"], r["layer"]), np.full((H, W), missing))[r["y"], r["x"]] = r[column]
    return out


def test_smoothing_blur_shift_and_warp(spark, images, pixels):
    smooth, blur = arrays(raster.smooth(pixels, BY, W, H, 1.7)), arrays(raster.blur_score(pixels, BY, W, H))
    moved, warped = arrays(raster.fourier_shift(pixels, BY, W, H, 0.3, -1.25)), arrays(raster.remap(pixels, BY, W, H, *raster.radial_places(W, H, 0.07)))
    for key, a in images.items():
        assert np.allclose(smooth[key], plain.smooth(a, 1.7)) and np.allclose(blur[key], plain.blur_score(a))
        assert np.allclose(moved[key], kernels.fourier_shift(a.astype(float), 0.3, -1.25))
        assert np.allclose(warped[key], kernels.remap(a.astype(float), *plain.radial_warp(a.shape, 0.07)))


def test_regions_boxes_tails_and_masks(spark, images, pixels):
    on = pixels.where("v > 0")
    for diagonal in (True, False):
        found = arrays(raster.regions(on, BY, W, H, diagonal), "region")
        for key, a in images.items():
            assert (found[key] == kernels.label(a > 0, diagonal)).all()
    boxes = {(r.img, r.layer, r.region): (r.x, r.y, r.w, r.h, r.area) for r in raster.boxes(raster.regions(on, BY, W, H), BY).collect()}
    for (i, k), a in images.items():
        lab = kernels.label(a > 0)
        for n in range(1, lab.max() + 1):
            y, x = np.nonzero(lab == n)
            assert boxes.pop((i, k, n)) == (x.min(), y.min(), np.ptp(x) + 1, np.ptp(y) + 1, len(x))
    assert not boxes
    trimmed = arrays(raster.trim_tails(on, BY).withColumn("v", F.lit(1)))
    closed = arrays(raster.open_close(pixels.withColumn("v", (F.col("v") != 0).cast("int")), BY, W, H))
    for key, a in images.items():
        assert (trimmed.get(key, np.zeros((H, W))) > 0).tolist() == plain.trim_tails(a > 0).tolist()
        assert (closed[key] > 0).tolist() == plain.close_mask(a != 0).tolist()


def test_thresholds_intercepts_circles_and_lines(spark, images, pixels):
    rows = pixels.withColumn("at", F.col("y") * W + F.col("x"))
    cut = {(r.img, r.layer): r.threshold for r in raster.otsu_by_skew(pixels, BY).collect()}
    start = {(r.img, r.layer): r.intercept for r in raster.robust_intercept(rows, BY, "at", 2.0).collect()}
    angle = 2 * np.pi * F.col("at") / (W * H)
    ring = rows.select(*BY, ((1000 + F.col("v")) * F.cos(angle) + 50).alias("x"), ((1000 + F.col("v")) * F.sin(angle) - 7).alias("y"))
    circle = {(r.img, r.layer): (r.cx, r.cy, r.radius) for r in raster.fit_circle(ring, BY).collect()}
    line = raster.simplify(rows.select(*BY, "at", F.col("at").cast("double").alias("x"), F.col("v").cast("double").alias("y")), BY, "at", 120.0).collect()
    for key, a in images.items():
        assert cut[key] == plain.otsu_by_skew(a.ravel()) and np.isclose(start[key], plain.robust_intercept(a.ravel().astype(float), 2.0))
        t, r = 2 * np.pi * np.arange(a.size) / a.size, 1000 + a.ravel()
        assert np.allclose(circle[key], plain.fit_circle(r * np.cos(t) + 50, r * np.sin(t) - 7))
        got = sorted((p.x, p.y) for p in line if (p.img, p.layer) == key)
        assert got == [tuple(map(float, p)) for p in plain.simplify(list(enumerate(a.ravel().tolist())), 120.0)]


def test_few_and_equal_values(spark):
    flat = spark.createDataFrame([(1, 1, x, 0, 5) for x in range(4)] + [(2, 1, 0, 0, 3), (2, 1, 1, 0, 9)], "img int, layer int, x int, y int, v long")
    assert {r.img: r.threshold for r in raster.otsu_by_skew(flat, BY).collect()} == {1: 0.0, 2: 0.0}
    assert {r.img: r.intercept for r in raster.robust_intercept(flat, BY, "x", 2.0).collect()} == {1: 5.0, 2: 6.0}
    none = flat.where("v > 99")
    assert raster.regions(none, BY, 4, 1).count() == raster.trim_tails(none, BY).count() == raster.simplify(none.withColumn("k", F.col("x")), BY, "k", 1.0).count() == 0
