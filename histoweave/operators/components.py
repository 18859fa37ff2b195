"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from histoweave.operators.relational import merged
from histoweave.sources.written import cut, discard

#: A node with more edges than this, and than this share of them, is looked up in a broadcast; so that has at most 1 / SHARE rows.
DEGREE, SHARE = 1_000, 1e-5


def _round(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The distinct edges, written, and their number and hash sum, which are taken while they are written."""
    seen = Observation()
    out = cut(edges.distinct().observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")))
    return out, (seen.get["n"], seen.get["s"])


def _looked_up(edges: DataFrame, key: str, least: DataFrame, n: int) -> DataFrame:
    """The edges with the value m of least(node, m) for the node in column `key`, null where there is none.

    Rows of nodes with very many edges meet theirs by a broadcast, all others by a
    shuffle, so no task gets the edges of a hub.
    """
    most = max(DEGREE, int(n * SHARE))
    hubs = edges.groupBy(F.col(key).alias("node")).agg(F.count("*").alias("d")).where(F.col("d") > most).select("node")
    found = [(r["node"], r["m"]) for r in hubs.join(merged(least), "node", "left").collect()]  # at most 1 / SHARE rows
    least = least.withColumnRenamed("node", key)
    if not found:
        return edges.join(merged(least), key, "left")
    of_hubs = F.broadcast(edges.sparkSession.createDataFrame(found, "node long, hub_m long").withColumnRenamed("node", key))
    far = edges.join(of_hubs.select(key), key, "left_anti").join(merged(least), key, "left")
    return far.unionByName(edges.join(of_hubs, key).withColumnRenamed("hub_m", "m"))


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """(node, component) for every node of an edge, component being its smallest reachable node.

    Only minima are aggregated by node, with partial aggregation, and hubs are
    looked up apart, so a node with any number of neighbours is no hot group. Self
    loops name a node without linking it. Null ends are ignored. The number of
    rounds grows with the logarithm of the number of nodes.
    """
    # an edge goes from its larger end u to its smaller end v
    pairs = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    now, mark = _round(pairs)
    for _ in range(most):
        # large star: every larger neighbour of a node goes to the node's smallest one, as the node does
        least = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
        large = _looked_up(now, "v", least, mark[0]).select("u", F.coalesce("m", "v").alias("v"))
        large, n = _round(large)
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
        small = _looked_up(large, "u", least, n[0]).select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = small.unionByName(least.select(F.col("node").alias("u"), F.col("m").alias("v")))
        last, before = now, mark
        now, mark = _round(small)
        discard(last)
        discard(large)
        if before == mark:
            return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    raise RuntimeError(f"components did not settle in {most} rounds")
