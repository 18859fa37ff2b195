"""Pixels of polygons are counted along lines: as many as a test of each centre finds, and no row a pixel."""

import math
import random
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from histoweave.functions import polygons as P
from histoweave.plans import ORACLE_SQL, QUERIES

RINGS = "i long, outer array<struct<x:double,y:double>>, hole array<struct<x:double,y:double>>"


def inside(ring, x, y):
    hit = lambda a, b: (a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0]
    return sum(hit(a, b) for a, b in zip(ring, ring[1:] + ring[:1])) % 2 == 1


def test_pixels_are_those_whose_centres_are_inside(spark):
    rng = random.Random(9)
    number = lambda kind: rng.choice((rng.randrange(-7, 8), rng.randrange(-14, 15) / 2, rng.uniform(-7, 7))) if kind else float(rng.randrange(-14, 15)) / 2
    ring = lambda kind: [(float(number(kind)), float(number(kind))) for _ in range(rng.randrange(0, 9))]
    made = [(i, ring(i % 2), ring(i % 2)) for i in range(300)]
    got = {r.i: r.n for r in spark.createDataFrame(made, RINGS).select("i", P.pixels(F.col("outer"), F.col("hole")).alias("n")).collect()}
    centres = [(x + 0.5, y + 0.5) for x in range(-8, 8) for y in range(-8, 8)]
    want = {i: sum(inside(o, x, y) and not inside(h, x, y) for x, y in centres) for i, o, h in made}
    assert got == want and max(want.values()) > 20


def test_a_pixel_begins_exactly_at_its_centre(spark):
    values = [v for c in (0.5, -0.5, 1.5, 3.0, 2.0**40 + 0.5, -(2.0**40) - 0.5) for v in (math.nextafter(c, -math.inf), c, math.nextafter(c, math.inf))] + [0.0, 1e-300, -1e-300]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").coalesce(1).select(P._first(F.col("v"))).collect()]
    assert got == [math.ceil(Fraction(v) - Fraction(1, 2)) for v in values]


def test_pixels_of_nothing_and_of_the_unknown(spark):
    box = [(0.0, 0.0), (3.0, 0.0), (3.0, 2.0), (0.0, 2.0)]
    rows = [(0, [], []), (1, [(1.0, 2.0)], []), (2, box, []), (3, box, None), (4, None, box), (5, box, [(None, 1.0)]), (6, [*box[:3], (0.0, None)], []), (7, box, box)]
    got = spark.createDataFrame(rows, RINGS).select("i", P.pixels(F.col("outer"), F.col("hole")).alias("n")).collect()
    assert {r.i: r.n for r in got} == {0: 0, 1: 0, 2: 6, 3: None, 4: None, 5: None, 6: None, 7: 0}


def test_a_holed_box_of_the_reference(spark):
    text = "POLYGON((1.0001 1.0001, 1.0001 8.9999, 8.9999 8.9999, 8.9999 1.0001, 1.0001 1.0001), (4.0001 5.9999, 7.9999 5.9999, 7.9999 4.0001, 4.0001 4.0001))"
    rings = P.from_wkt(F.col("t"))
    row = spark.createDataFrame([(text,)], "t string").select(P.pixels(rings[0], rings[1]).alias("n"), P.nested_area(rings).alias("area")).first()
    assert row.n == 56 and math.isclose(row.area, 56, rel_tol=1e-3)


@pytest.mark.parametrize("key", ["sp-09", "sp-09-all"])
def test_rows_are_the_sqls_where_keys_repeat_and_sizes_are_null(spark, key, tmp_path):
    parts = "SELECT * FROM '/root/testdata/sf0.001/part.parquet'"
    duckdb.sql(f"COPY ({parts} UNION ALL ({parts} WHERE p_partkey % 3 = 0) UNION ALL ({parts.replace('*', '* REPLACE (CAST(NULL AS INT) AS p_size)')} WHERE p_partkey < 5)) TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    got = [tuple(r) for r in QUERIES[key](spark, str(tmp_path)).select("id", "pixels").collect()]
    c = duckdb.connect()
    c.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    want = c.sql(f"SELECT id, pixels FROM ({ORACLE_SQL[key]}) q").fetchall()
    order = lambda r: (r[0], r[1] is None, r[1] or 0)
    assert sorted(got, key=order) == sorted(want, key=order) and sum(n is None for _, n in got) == 5


@pytest.mark.parametrize("key", ["sp-09", "sp-09-all"])
def test_no_row_is_made_for_a_pixel(spark, key):
    plan = QUERIES[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan


def test_both_queries_deal_polygons_to_all_tasks(spark):
    assert [QUERIES[key](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() for key in ("sp-09", "sp-09-all")] == [32, 32]
