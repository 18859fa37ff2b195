"""Joins of tables that grow with the input are merges: nothing that grows is sent through the driver."""

from histoweave.operators import graph, relational, spatial
from histoweave.plans.registry import Tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def broadcasts(df) -> int:
    return plan(df).count("BroadcastExchange")


def test_only_slide_sizes_are_broadcast_for_overlaps(spark):
    t = Tables(spark, SF)
    assert broadcasts(t.overlap) == 2  # a row a slide, on both sides
    assert plan(spatial.degrees(t.rect, t.overlap)).count("SortMergeJoin") == 2
    assert plan(graph.propagate_flags(t.rect.selectExpr("slide_id", "n", "CAST(n % 3 = 0 AS INT) AS flag"), t.overlap)).count("SortMergeJoin") == 3


def test_merged_sides_are_not_broadcast(spark):
    a, b = spark.range(10).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert "SortMergeJoin" in plan(a.join(relational.merged(b), "k", how))
    assert "SortMergeJoin" in plan(relational.inner_merge(a, b, on="k"))
