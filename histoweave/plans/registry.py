"""Registration of queries, and the fixtures that give the driver tables the shapes of slides, cells, logs and pixels."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: DuckDB text of each fixture; those used in a query are put before it.
FIXTURES: dict[str, str] = {
    "rect": """SELECT * FROM (SELECT CAST(floor(p_partkey/100e0) AS BIGINT) AS slide_id, CAST(p_partkey%100+1 AS BIGINT) AS n, CAST((p_partkey%10)*535 AS BIGINT) AS cx,
        CAST(floor((p_partkey%100)/10e0) AS BIGINT)*400 AS cy, CAST(669 AS BIGINT) AS w, CAST(500 AS BIGINT) AS h, CAST((p_partkey*7919)%100003 AS BIGINT) AS t, p_name AS file FROM part) x
        WHERE NOT (slide_id%2=1 AND (cx=5*535 OR cx=6*535))""",
    "overlap": """SELECT a.slide_id, a.n AS p1, b.n AS p2, a.cx AS x1, a.cy AS y1, b.cx AS x2, b.cy AS y2, CAST(sign(a.cx-b.cx)+3*sign(a.cy-b.cy)+5 AS INT) AS tag
        FROM rect a JOIN rect b ON a.slide_id=b.slide_id AND a.n<>b.n AND abs(a.cx-b.cx)<a.w AND abs(a.cy-b.cy)<a.h""",
    "measured": """SELECT slide_id, p1, p2, tag, CAST((p1*7+p2*13)%11-5 AS DOUBLE) AS dx, CAST((p1*3+p2*5)%7-3 AS DOUBLE) AS dy, 0.5+(p1+p2)%3 AS covxx, 0.4+(p1*p2)%2 AS covyy, 0.1 AS covxy,
        CAST(CASE WHEN (p1*p2)%17=0 THEN 1 ELSE 0 END AS INT) AS exit, CAST((669-abs(x1-x2))*(500-abs(y1-y2)) AS BIGINT) AS npix, 1.0+(p1*p2)%13 AS mse FROM overlap""",
    "pixels": """SELECT vec_id, label, CAST(k-1 AS INT) AS k, CAST((k-1)%4 AS INT) AS layer, CAST(floor((k-1)/4e0) AS INT) AS pixel, CAST(floor(CAST(embedding[k] AS DOUBLE)*1000) AS BIGINT) AS v
        FROM (SELECT vec_id, label, embedding, unnest(generate_series(1, len(embedding))) AS k FROM embeddings) e""",
    "img": "SELECT vec_id, layer, pixel%4 AS x, CAST(floor(pixel/4e0) AS INT) AS y, v FROM pixels",
    "cell": """SELECT CAST(l_orderkey AS BIGINT) AS slide_id, CAST(l_partkey%100+1 AS BIGINT) AS field, CASE WHEN l_linestatus='F' THEN 0 ELSE 2 END AS ctype, l_linenumber AS n,
        CAST((l_partkey*37)%669 AS BIGINT) AS x, CAST((l_suppkey*53)%500 AS BIGINT) AS y, CAST(1+max(l_quantity)%20 AS BIGINT) AS w, CAST(1+max(l_suppkey)%15 AS BIGINT) AS h
        FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus""",
    "runlog": """SELECT CAST(user_id AS BIGINT) AS slide_id, CASE WHEN event_id%2=0 THEN 'align' ELSE 'warp' END AS module, event_id AS pos, ts,
        CASE WHEN event_type IN ('signup','view') THEN 'START' WHEN event_type='purchase' THEN 'FINISH' WHEN event_type='error' THEN 'ERROR' ELSE 'INFO' END AS message FROM events""",
    "sampledef": """SELECT c_custkey AS slide_id, CAST(c_nationkey AS BIGINT) AS batch, CAST(c_nationkey%5 AS BIGINT) AS cohort, CAST(CASE WHEN c_acctbal>0 THEN 1 ELSE 0 END AS INT) AS isgood, c_name AS name, c_mktsegment AS project FROM customer""",
    "queue_main": "SELECT o_orderkey AS task, o_custkey AS slide_id, o_orderpriority AS antibody, o_orderstatus AS status FROM orders WHERE o_orderkey%3<>0",
    "queue_local": "SELECT o_orderkey AS task, o_custkey AS slide_id, o_orderpriority AS antibody, o_orderstatus AS status FROM orders WHERE o_orderkey%3<>1",
    "poly": """SELECT p_partkey AS id, CAST(p_partkey%50 AS DOUBLE) AS x0, CAST(p_partkey%70 AS DOUBLE) AS y0, CAST(8+p_size AS DOUBLE) AS wd, CAST(6+p_size%9 AS DOUBLE) AS ht FROM part""",
}


def with_fixtures(text: str) -> str:
    """The query with the fixtures it names, in their order of dependence, as common tables."""
    need: list[str] = []

    def add(body: str) -> None:
        for name in FIXTURES:
            if re.search(rf"\b{name}\b", body) and name not in need:
                add(FIXTURES[name])
                need.append(name)

    add(text)
    head = ", ".join(f"{n} AS ({FIXTURES[n]})" for n in need)
    text = text.strip()
    if not head:
        return text
    if text.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head}, {text[len('WITH RECURSIVE') :]}"
    return f"WITH {head}, {text[4:]}" if text.upper().startswith("WITH") else f"WITH {head} {text}"


class Tables:
    """The tables of a folder and the fixtures on them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def rect(self) -> DataFrame:
        k = F.col("p_partkey")
        r = self.part.select(F.floor(k / 100).alias("slide_id"), (k % 100 + 1).alias("n"), (k % 10 * 535).alias("cx"), (F.floor(k % 100 / 10) * 400).alias("cy"), F.lit(669).cast("long").alias("w"), F.lit(500).cast("long").alias("h"), (k * 7919 % 100003).alias("t"), F.col("p_name").alias("file"))
        return r.where(~((F.col("slide_id") % 2 == 1) & F.col("cx").isin(5 * 535, 6 * 535)))

    @property
    def overlap(self) -> DataFrame:
        from histoweave.operators.spatial import box_overlaps

        return box_overlaps(self.rect)

    @property
    def measured(self) -> DataFrame:
        p1, p2 = F.col("p1"), F.col("p2")
        return self.overlap.select(
            "slide_id", "p1", "p2", "tag", ((p1 * 7 + p2 * 13) % 11 - 5).cast("double").alias("dx"), ((p1 * 3 + p2 * 5) % 7 - 3).cast("double").alias("dy"),
            (F.lit(0.5) + (p1 + p2) % 3).alias("covxx"), (F.lit(0.4) + p1 * p2 % 2).alias("covyy"), F.lit(0.1).alias("covxy"), F.when(p1 * p2 % 17 == 0, 1).otherwise(0).alias("exit"),
            ((669 - F.abs(F.col("x1") - F.col("x2"))) * (500 - F.abs(F.col("y1") - F.col("y2")))).alias("npix"), (F.lit(1.0) + p1 * p2 % 13).alias("mse"),
        )

    @property
    def pixels(self) -> DataFrame:
        e = self.embeddings.select("vec_id", "label", F.posexplode("embedding").alias("k", "e"))
        return e.select("vec_id", "label", "k", (F.col("k") % 4).alias("layer"), F.floor(F.col("k") / 4).cast("int").alias("pixel"), F.floor(F.col("e").cast("double") * 1000).alias("v"))

    @property
    def img(self) -> DataFrame:
        return self.pixels.select("vec_id", "layer", (F.col("pixel") % 4).alias("x"), F.floor(F.col("pixel") / 4).cast("int").alias("y"), "v")

    @property
    def cell(self) -> DataFrame:
        g = self.lineitem.groupBy("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus").agg(F.max("l_quantity").alias("q"))
        return g.select(
            F.col("l_orderkey").alias("slide_id"), (F.col("l_partkey") % 100 + 1).alias("field"), F.when(F.col("l_linestatus") == "F", 0).otherwise(2).alias("ctype"), F.col("l_linenumber").alias("n"),
            (F.col("l_partkey") * 37 % 669).alias("x"), (F.col("l_suppkey") * 53 % 500).alias("y"), (1 + F.col("q") % 20).cast("long").alias("w"), (1 + F.col("l_suppkey") % 15).alias("h"),
        )

    @property
    def runlog(self) -> DataFrame:
        kind = F.col("event_type")
        message = F.when(kind.isin("signup", "view"), "START").when(kind == "purchase", "FINISH").when(kind == "error", "ERROR").otherwise("INFO")
        return self.events.select(F.col("user_id").alias("slide_id"), F.when(F.col("event_id") % 2 == 0, "align").otherwise("warp").alias("module"), F.col("event_id").alias("pos"), "ts", message.alias("message"))

    @property
    def sampledef(self) -> DataFrame:
        return self.customer.select(F.col("c_custkey").alias("slide_id"), F.col("c_nationkey").cast("long").alias("batch"), (F.col("c_nationkey") % 5).cast("long").alias("cohort"), (F.col("c_acctbal") > 0).cast("int").alias("isgood"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("project"))

    def _queue(self, but: int) -> DataFrame:
        return self.orders.where(F.col("o_orderkey") % 3 != but).select(F.col("o_orderkey").alias("task"), F.col("o_custkey").alias("slide_id"), F.col("o_orderpriority").alias("antibody"), F.col("o_orderstatus").alias("status"))

    @property
    def queue_main(self) -> DataFrame:
        return self._queue(0)

    @property
    def queue_local(self) -> DataFrame:
        return self._queue(1)

    @property
    def poly(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.part.select(k.alias("id"), (k % 50).cast("double").alias("x0"), (k % 70).cast("double").alias("y0"), (8 + F.col("p_size")).cast("double").alias("wd"), (6 + F.col("p_size") % 9).cast("double").alias("ht"))


def query(key: str, sql: str | None = None):
    """Register a function of Tables under a key, with the DuckDB text for it if there is one."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE_SQL[key] = with_fixtures(sql)
        return f

    return add
