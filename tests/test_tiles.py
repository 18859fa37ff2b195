"""Regions found in tiles of 8 x 7 pixels and linked beyond them."""

import numpy as np
import pandas as pd
import pytest

import plain_kernels as kernels
from histoweave.operators import raster


def frame(spark, masks):
    rows = [(i, x, y, int(m[y, x])) for i, m in masks.items() for y in range(m.shape[0]) for x in range(m.shape[1])]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["i", "x", "y", "v"]))


def snake(h, w):
    m = np.zeros((h, w), bool)
    m[::2] = True
    m[1::4, -1] = m[3::4, 0] = True
    return m


@pytest.mark.parametrize("h, w, diagonal", [(7, 8, True), (7, 8, False), (15, 17, True), (15, 17, False)])
def test_regions_and_sizes_of_images_of_one_and_of_many_tiles(spark, h, w, diagonal):
    rng = np.random.default_rng(h * w)
    masks = {3: rng.random((h, w)) < 0.5, 5: np.ones((h, w), bool), 8: snake(h, w), 9: np.zeros((h, w), bool), 11: rng.random((h, w)) < 0.35}
    df = frame(spark, masks)
    got = {(r.i, r.y, r.x): r.region for r in raster.regions(df.where("v = 1"), ["i"], w, h, diagonal).collect()}
    want = {}
    for i, m in masks.items():
        lab = kernels.label(m, diagonal)
        want |= {(i, int(y), int(x)): int(lab[y, x]) for y, x in np.argwhere(m)}
    assert got == want
    for i, m in masks.items():
        for value in (True, False):
            lab = kernels.label(m == value, diagonal)
            for k in range(1, int(lab.max()) + 1):
                if (lab == k).sum() < 5:
                    m = np.where(lab == k, not value, m)
        masks[i] = m
    rows = raster.size_filter(df, ["i"], w, h, 5, diagonal=diagonal).collect()
    assert len(rows) == len(masks) * h * w and all(r.v == masks[r.i][r.y, r.x] for r in rows)


def test_a_mask_of_one_tile_is_filtered_in_one_grouping(spark):
    df = frame(spark, {1: np.eye(4, dtype=bool), None: np.eye(4, dtype=bool)}).selectExpr("CAST(IF(isnan(i), NULL, i) AS LONG) AS i", "x", "y", "IF(x = 3 AND y = 3, NULL, v) AS v")
    done = raster.size_filter(df, ["i"], 4, 4, 4)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    v = {(r.i, r.x, r.y): r.v for r in done.collect()}
    assert len(v) == 32 and v[1, 0, 0] == 0 and v[1, 3, 3] is None and v[None, 0, 0] == 1 and v[None, 3, 3] is None
