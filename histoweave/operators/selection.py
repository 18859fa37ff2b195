"""Exact medians of columns with any number of distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histoweave.sources.written import cut, discard

#: Distinct values of a group that are ordered in one task; parts into which more are divided in a round.
FEW, PARTS = 10_000, 64
C = F.col


def medians(df: DataFrame, by: list[str], value: str, name: str = "median") -> DataFrame:
    """(by, name) of each group of df(by, value): the middle value, or the mean of the two middle ones.

    Values are counted first, so copies are one row. Where a group has more than FEW
    distinct values, approximate quantiles of these divide it into parts, whose
    counts tell in which the middle lies; the others go, and so on, so no task
    holds or sorts a group. Nulls are ignored, and a group without values has a null.
    """
    keyed = df.select(F.struct(*by).alias("g") if by else F.lit(0).alias("g"), C(value).cast("double").alias("v"))
    counted = cut(keyed.groupBy("g", "v").agg(F.count("v").alias("n")))
    total = counted.groupBy("g").agg(F.sum("n").alias("total"))
    now = counted.where("v is not null").join(total, "g")
    now = now.select("g", "v", "n", F.floor((C("total") + 1) / 2).alias("first"), (F.floor(C("total") / 2) + 1).alias("last"))
    most = counted.where("v is not null").groupBy("g").count().agg(F.max("count")).first()[0] or 0
    now = cut(now) if most > FEW else now
    while most > FEW:
        large = cut(now.groupBy("g").agg(F.count("*").alias("k"), F.percentile_approx("v", [i / PARTS for i in range(1, PARTS)], 1000).alias("at")).where(C("k") > FEW))
        if large.isEmpty():
            discard(large)
            break
        part = F.size(F.filter("at", lambda p: p < C("v")))
        placed = now.join(large.select("g", "at"), "g", "left").withColumn("part", F.when(C("at").isNull(), 0).otherwise(part)).drop("at")
        sizes = placed.groupBy("g", "part").agg(F.sum("n").alias("m"))
        upto = Window.partitionBy("g").orderBy("part")  # PARTS rows a group
        sizes = sizes.withColumn("before", F.sum("m").over(upto) - C("m"))
        kept = placed.join(sizes, ["g", "part"]).where((C("before") + C("m") >= C("first")) & (C("before") < C("last")))
        ends = sizes.join(now.select("g", "first", "last").distinct(), "g").where((C("before") + C("m") >= C("first")) & (C("before") < C("last"))).groupBy("g").agg(F.min("before").alias("base"))
        new = cut(kept.join(ends, "g").select("g", "v", "n", (C("first") - C("base")).alias("first"), (C("last") - C("base")).alias("last")))
        discard(large)
        discard(now)
        now = new
    running = F.sum("n").over(Window.partitionBy("g").orderBy("v"))
    ranked = now.withColumn("upto", running)
    holds = lambda r: (C("upto") >= C(r)) & (C("upto") - C("n") < C(r))
    found = ranked.groupBy("g").agg(((F.max(F.when(holds("first"), C("v"))) + F.max(F.when(holds("last"), C("v")))) / 2).alias(name))
    out = counted.select("g").distinct().join(found, "g", "left")
    return out.select(*([F.col("g.*")] if by else []), name)
