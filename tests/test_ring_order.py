"""Rings are ordered within batches of edges, and only what goes on beyond a batch in rounds."""

import random

import numpy as np

import plain_kernels as kernels
from histoweave.operators import outlines, rings

SIZES = [[1, 2, 3], [64], [100, 1, 33], [7] * 20]


def permutation(spark):
    rng, steps, want = random.Random(4), [], {}
    for i, sizes in enumerate(SIZES):
        names = list(range(sum(sizes)))
        rng.shuffle(names)
        for n in sizes:
            cycle, names = names[:n], names[n:]
            at = cycle.index(min(cycle))
            for k, e in enumerate(cycle):
                steps.append((i, e, cycle[(k + 1) % n]))
                want[i, e] = (min(cycle), (k - at) % n)
    return spark.createDataFrame(steps, "id int, e int, next int"), want


def ordered(out):
    return {(r.id, r.e): (r.ring, r.place) for r in out.collect()}


def test_rings_within_a_batch_are_written_once(spark, monkeypatch):
    steps, want = permutation(spark)
    written, cut = [], rings.cut
    monkeypatch.setattr(rings, "cut", lambda df, *by: written.append(df) or cut(df, *by))
    by_image = rings.C("e") * 0
    assert ordered(rings.ring_order(steps, ["id"], (by_image,))) == want and len(written) == 1


def test_rings_across_batches(spark):
    steps, want = permutation(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for most in (1, 3, 7, 50):
        spark.conf.set(name, most)
        try:
            assert ordered(rings.ring_order(steps, ["id"])) == want
        finally:
            spark.conf.unset(name)


def test_outlines_across_batches_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(outlines, "TILE", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 9)
    try:
        masks = {i: np.random.default_rng(i).random((13, 17)) < p for i, p in enumerate((0.4, 0.6, 0.7))}
        df = spark.createDataFrame([(i, int(x), int(y)) for i, m in masks.items() for y, x in zip(*np.nonzero(m))], "img int, x int, y int")
        found, corners = outlines.contours(df, ["img"])
        points = {}
        for c in sorted(corners.collect(), key=lambda c: c.vid):
            points.setdefault((c.img, c.ring), []).append((c.x, c.y))
        got = {(r.img, r.ring): (r.depth, r.parent, points[r.img, r.ring]) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(i, k): (d, p, [(int(x), int(y)) for x, y in ps]) for i, m in masks.items() for k, d, p, ps in kernels.contours(m)}


def test_valid_polygons_take_no_rounds_for_long_rings(spark, monkeypatch):
    written, cut = [], rings.cut
    monkeypatch.setattr(rings, "cut", lambda df, *by: written.append(df) or cut(df, *by))
    counts = []
    for n in (1, 40):  # a box, and a comb of many teeth over hundreds of units
        comb = [(0, 0), (10 * n, 0), *((10 * k - j, 20 if j < 6 else 5) for k in range(n, 0, -1) for j in (0, 5, 6, 9)), (0, 5)]
        df = spark.createDataFrame([(1, 0, v, float(x), float(y)) for v, (x, y) in enumerate(comb)], "id long, ring int, vid int, x double, y double")
        got = rings.make_valid(df, ["id"], 4).select("polygon", "area").distinct().collect()
        twice = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(comb, comb[1:] + comb[:1]))
        counts.append(len(written))
        written.clear()
        assert [(r.polygon, r.area) for r in got] == [(1, abs(twice) / 2)]
    assert counts[0] == counts[1]
