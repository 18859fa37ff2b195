"""Pairs of images are merged, pixel by pixel, and so is what is looked up for each of them."""

from pyspark.sql import functions as F

from histoweave.operators import registration
from histoweave.plans.kernels import _pairs
from histoweave.plans.registry import Tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_nothing_is_broadcast_for_pairs_and_moves(spark):
    pairs = _pairs(Tables(spark, "/root/testdata/sf0.001"))
    moves = pairs.select("vec_id", "layer").distinct().select("*", F.lit(0.5).alias("dx_a"), F.lit(0.25).alias("dy_a"))
    moved = registration.cubic_shift(pairs, ["vec_id", "layer"], 4, 4, moves, ("a",))
    assert "BroadcastExchange" not in plan(pairs) and "BroadcastExchange" not in plan(moved)
