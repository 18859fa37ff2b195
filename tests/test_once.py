"""Polygons are computed once in an expression, and dealt to all tasks where that outweighs reading them."""

import math

from pyspark.sql import functions as F

from histoweave.functions import polygons as P
from histoweave.operators.relational import dealt


def test_a_polygon_occurs_once_in_its_plan(spark):
    df = spark.createDataFrame([(3.0, 1.0)], "x double, y double")
    box = P.box(F.col("x"), F.col("y"), F.lit(2.0), F.lit(5.0))
    text = df.select(P.normalised(P.shifted(P.shifted(box))).alias("p"), P.signed_area(box).alias("a"))._jdf.queryExecution().analyzed().toString()
    assert text.count("array(") < 30


def test_areas_of_few_points(spark):
    rows = [([],), ([(1.0, 2.0)],), ([(0.0, 0.0), (2.0, 0.0), (0.0, 3.0)],), ([(0.0, 0.0), (0.0, 3.0), (2.0, 0.0)],), ([(0.0, None), (2.0, 0.0), (0.0, 3.0)],), (None,)]
    df = spark.createDataFrame(rows, "p array<struct<x:double,y:double>>")
    assert [r[0] for r in df.select(P.signed_area(F.col("p"))).collect()] == [0.0, 0.0, 3.0, -3.0, None, None]


def test_circle_has_its_area(spark):
    df = spark.createDataFrame([(3.0, 1.0, 2.0)], "x double, y double, r double")
    found = df.select(P.signed_area(P.circle(F.col("x"), F.col("y"), F.col("r"), 64))).first()[0]
    assert math.isclose(found, 32 * 4 * math.sin(2 * math.pi / 64), rel_tol=1e-12)


def test_dealt_rows_are_in_all_tasks(spark):
    assert dealt(spark.range(1000).coalesce(1), "id").rdd.getNumPartitions() == 32
