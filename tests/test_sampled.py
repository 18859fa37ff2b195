"""Bilinear samples meet each image's pixels once, whatever the number of places asked for."""

import numpy as np
from pyspark.sql import functions as F

from histoweave.operators import raster


def test_samples_match_plain_ones_and_take_one_join(spark):
    a = np.random.default_rng(1).normal(size=(5, 7))
    a[2, 3] = np.nan  # missing
    rows = [(1, x, y, float(a[y, x])) for y in range(5) for x in range(7) if not np.isnan(a[y, x])]
    df = spark.createDataFrame(rows, "i int, x int, y int, v double")
    out = raster.remap(df, ["i"], 7, 5, F.col("x") + 0.25, F.col("y") * 0.5 - 0.125)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning(i") == 2 and "BroadcastExchange" not in plan
    got = {(r.x, r.y): r.v for r in out.collect()}
    for _, x, y, _ in rows:
        mx, my = min(max(x + 0.25, 0), 6), min(max(y * 0.5 - 0.125, 0), 4)
        sx, sy = min(int(mx), 5), min(int(my), 3)
        want = sum(np.nan_to_num(a[sy + j, sx + i]) * abs(1 - i - (mx - sx)) * abs(1 - j - (my - sy)) for i in (0, 1) for j in (0, 1))
        assert abs(got[x, y] - want) < 1e-12
    assert len(got) == len(rows)
