"""Filters with reasons, renames, queue differences and numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merged(df: DataFrame) -> DataFrame:
    """The table as a side of a join that grows with the input: it is sorted and merged, never broadcast.

    Sizes are planned from compressed files and before rows are repeated, so a table
    that is planned at a few MB can fill the driver.
    """
    return df.hint("merge")


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt to four tasks a core, where work on a row outweighs reading it: a small file is read by few tasks."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *by)


def filter_chain(df: DataFrame, checks: list[tuple[str, Column]], every: bool = False) -> DataFrame:
    """Adds `reason`: the first check that fails, or all of them, comma-separated; empty if none does. Null counts as failed."""
    failed = [(name, ~F.coalesce(ok, F.lit(False))) for name, ok in checks]
    if every:
        return df.withColumn("reason", F.array_join(F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in failed])), ","))
    reason = F.lit("")
    for name, bad in reversed(failed):
        reason = F.when(bad, F.lit(name)).otherwise(reason)
    return df.withColumn("reason", reason)


def fill_from(left: DataFrame, right: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Left rows with null columns filled from the matching right row."""
    other = right.select(*on, *[F.col(c).alias(f"_{c}") for c in columns])
    out = left.join(merged(other), on, "left")
    return out.select(*[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) if c in columns else F.col(c) for c in left.columns])


def inner_merge(*tables: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in all tables; a key that one lacks goes."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(merged(t), on)
    return out


def side_indicator(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in only one of two tables of the same columns, with `side` => for added and <= for removed ones."""
    return b.exceptAll(a).withColumn("side", F.lit("=>")).unionByName(a.exceptAll(b).withColumn("side", F.lit("<=")))


def coalesce_queues(main: DataFrame, local: DataFrame, on: list[str]) -> DataFrame:
    """Main rows, then local rows that main lacks, each with its origin."""
    new = local.join(merged(main.select(*on)), on, "left_anti")
    return main.withColumn("origin", F.lit("main")).unionByName(new.withColumn("origin", F.lit("local")))


def latest(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """The value of each key's last row."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def renumber_duplicates(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of a number keeps it; further ones get numbers above the largest, in order.

    The numbers above are given within hash parts by a prefix sum over the parts'
    counts, so no task sees all rows.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    marked = df.withColumn("_rank", rank)
    again = number_rows(marked.where("_rank > 1"), [order], "_more")
    top = df.agg(F.coalesce(F.max(key), F.lit(0)).alias("_top"))
    moved = again.crossJoin(F.broadcast(top)).withColumn(key, F.col("_top") + F.col("_more"))  # one row
    return marked.where("_rank = 1").select(*df.columns).unionByName(moved.select(*df.columns))


#: Rows of a range that is numbered by itself.
RANGE_ROWS = 1_000_000


def number_rows(df: DataFrame, order: list[str], name: str = "number", by: tuple[str, ...] = (), parts: int | None = None) -> DataFrame:
    """Numbers rows from 1 in a total order, each group of `by` by itself, by ranges: each is sorted by itself and starts after the ones before.

    Ranges are in order of the groups, so only a range's first group can have begun
    before; the driver gets the counts of the first and the last group of each.
    """
    from histoweave.sources.written import cut

    parts = parts or max(8, -(-df.count() // RANGE_ROWS))
    ranged = cut(df.repartitionByRange(parts, *by, *order).withColumn("_part", F.spark_partition_id()))
    group = F.struct(*by) if by else F.lit(0)
    sizes = ranged.groupBy("_part", group.alias("g")).agg(F.count("*").alias("n"))
    borders = sizes.groupBy("_part").agg(F.min(F.struct("g", "n")).alias("first"), F.max(F.struct("g", "n")).alias("last")).collect()  # one row a range
    offsets, before = [], (None, 0)
    for r in sorted(borders, key=lambda r: r["_part"]):
        start = before[1] if r["first"]["g"] == before[0] else 0
        offsets += [F.lit(r["_part"]), F.lit(start)]
        before = (r["last"]["g"], r["last"]["n"] + (start if r["first"]["g"] == r["last"]["g"] else 0))
    inside = F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order))
    if not offsets:
        return ranged.withColumn(name, inside.cast("long")).drop("_part")
    first = F.dense_rank().over(Window.partitionBy("_part").orderBy(*by)) == 1 if by else F.lit(True)
    base = F.when(first, F.create_map(*offsets)[F.col("_part")]).otherwise(0)
    return ranged.withColumn(name, (base + inside).cast("long")).drop("_part")
