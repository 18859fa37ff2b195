"""Outlines of masks against the plain walk around each region."""

import numpy as np
import pytest

import plain_kernels as kernels
from histoweave.operators import outlines

SPIRAL = [[1, 1, 1, 1, 1, 1, 1], [1, 0, 0, 0, 0, 0, 1], [1, 0, 1, 1, 1, 0, 1], [1, 0, 1, 0, 1, 0, 1], [1, 0, 1, 1, 1, 0, 1], [1, 0, 0, 0, 0, 0, 1], [1, 1, 1, 1, 1, 1, 1]]


def frame(spark, masks):
    rows = [(i, 1, int(x), int(y)) for i, m in masks.items() for y, x in zip(*np.nonzero(m))]
    return spark.createDataFrame(rows, "img int, layer int, x int, y int")


def collected(spark, masks, repeat=1):
    df = frame(spark, masks)
    for _ in range(repeat - 1):
        df = df.unionByName(frame(spark, masks))
    rings, corners = outlines.contours(df, ["img", "layer"])
    points = {}
    for c in sorted(corners.collect(), key=lambda c: c.vid):
        points.setdefault((c.img, c.ring), []).append((c.x, c.y))
    return {(r.img, r.ring): (r.depth, r.parent, points[r.img, r.ring]) for r in rings.collect()}, rings


@pytest.mark.parametrize("repeat", [1, 2])
def test_contours_match_a_walk(spark, repeat):
    rng = np.random.default_rng(3)
    masks = {i: rng.random((9, 11)) < p for i, p in enumerate((0.3, 0.5, 0.6, 0.7, 0.8))} | {7: np.array(SPIRAL), 8: np.ones((1, 1)), 9: np.eye(5), 10: 1 - np.eye(5)}
    got, rings = collected(spark, masks, repeat)
    want = {(i, k): (d, p, [(int(x), int(y)) for x, y in points]) for i, m in masks.items() for k, d, p, points in kernels.contours(np.asarray(m) > 0)}
    assert got == want
    net = {}
    for r in rings.collect():
        net[r.img] = net.get(r.img, 0) + (-r.area if r.hole else r.area)
    assert net == {i: int(np.count_nonzero(m)) for i, m in masks.items()}


def test_a_large_image_of_nested_squares(spark):
    n = 120
    d = np.minimum.outer(np.minimum(np.arange(n), n - 1 - np.arange(n)), np.minimum(np.arange(n), n - 1 - np.arange(n)))
    got, rings = collected(spark, {1: d % 4 < 2})
    assert len(got) == n // 4 and {(r.depth, r.area) for r in rings.collect()} == {(k, (n - 4 * k) ** 2) for k in range(n // 4)}
    assert all(len(v[2]) == 4 for v in got.values())


def test_many_dots_beside_each_other_have_no_parent(spark):
    m = np.zeros((64, 3))
    m[::2, 1] = 1
    got, _ = collected(spark, {1: m})
    assert {v[:2] for v in got.values()} == {(0, 0)} and len(got) == 32


def test_no_pixels(spark):
    got, _ = collected(spark, {1: np.zeros((2, 2))})
    assert got == {}
