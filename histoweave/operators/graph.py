"""Islands, neighbours and closures on overlap graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histoweave.operators.components import components
from histoweave.operators.relational import merged


def _node(slide: str, n: str, most: int) -> Column:
    return F.col(slide) * most + F.col(n)


def islands(rects: DataFrame, overlaps: DataFrame, most: int = 1_000_000) -> DataFrame:
    """(slide_id, n, island): islands are named by their smallest field; fields without overlaps are islands of one.

    Overlaps come in both directions, so strongly connected components are the
    connected ones. Field numbers have to be below `most`.
    """
    edges = overlaps.select(_node("slide_id", "p1", most).alias("a"), _node("slide_id", "p2", most).alias("b"))
    alone = rects.select(_node("slide_id", "n", most).alias("a"), _node("slide_id", "n", most).alias("b"))
    found = components(edges.unionByName(alone))
    return found.select(F.floor(F.col("node") / most).alias("slide_id"), (F.col("node") % most).alias("n"), (F.col("component") % most).alias("island"))


def island_sizes(found: DataFrame) -> DataFrame:
    return found.groupBy("slide_id", "island").agg(F.count("*").alias("members"))


def sized_islands(found: DataFrame, least: int, fallback: int) -> DataFrame:
    """Islands of at least `least` members; on slides without one, of at least `fallback`; else all."""
    sizes = island_sizes(found)
    best = sizes.groupBy("slide_id").agg(F.max("members").alias("m"))
    cut = F.when(F.col("m") >= least, least).when(F.col("m") >= fallback, fallback).otherwise(1)
    return sizes.join(merged(best), "slide_id").where(F.col("members") >= cut).select("slide_id", "island", "members")


def neighbours_by_tag(overlaps: DataFrame) -> DataFrame:
    """Each field's incoming neighbour for each direction."""
    return overlaps.select("slide_id", F.col("p2").alias("n"), "tag", F.col("p1").alias("neighbour"))


def propagate_flags(flagged: DataFrame, edges: DataFrame, share: float = 0.5) -> DataFrame:
    """One step: a field is flagged if it was, or if over `share` of its neighbours are; flagged(slide_id, n, flag)."""
    near = edges.select("slide_id", F.col("p1").alias("n"), F.col("p2").alias("m")).join(merged(flagged.select("slide_id", F.col("n").alias("m"), F.col("flag").alias("f"))), ["slide_id", "m"])
    part = near.groupBy("slide_id", "n").agg(F.avg("f").alias("share"))
    return flagged.join(merged(part), ["slide_id", "n"], "left").select("slide_id", "n", F.when((F.col("flag") == 1) | (F.coalesce("share", F.lit(0.0)) > share), 1).otherwise(0).alias("flag"))


def flag_closure(flagged: DataFrame, edges: DataFrame, share: float = 0.5, most: int = 100) -> DataFrame:
    """Steps until the number of flags stays the same."""
    from histoweave.sources.written import cut

    now, before = cut(flagged), -1
    for _ in range(most):
        n = now.agg(F.sum("flag")).first()[0]
        if n == before:
            return now
        before, now = n, cut(propagate_flags(now, edges, share))
    return now
