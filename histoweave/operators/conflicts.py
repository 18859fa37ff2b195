"""Conflicts between the primary regions of a slide's islands, resolved by moving the borders that overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoweave.operators.relational import merged
from histoweave.sources.written import cut, discard

#: Overlap, as a share of the distance between fields, up to which a border is moved; islands of at most two fields allow more.
NEAR, NEAR_SMALL = 0.1, 0.25
#: An overlap counts from this share of the first island's left border on.
TOLERANCE = 1e-5
#: Of two overlaps that are both too large, only the other one is cut if one is so many times as large.
RATIO = 1.5
C = F.col


def region_overlaps(regions: DataFrame, by: str = "slide_id") -> DataFrame:
    """Pairs a, b of regions(by, island, n, mx1, mx2, my1, my2, orphan) that share area, of different islands, the smaller island first.

    Regions are dealt to cells as large as the slide's largest one, so each is in
    four at most; a pair counts in the cell of its common part's first corner.
    """
    size = regions.groupBy(by).agg(F.max(C("mx2") - C("mx1")).alias("cw"), F.max(C("my2") - C("my1")).alias("ch"))
    island = regions.groupBy(by, "island").agg(F.count("*").alias("fields"), F.min("mx1").alias("left"))
    r = regions.where(~C("orphan") & (C("mx2") > C("mx1")) & (C("my2") > C("my1"))).join(size, by).join(merged(island), [by, "island"])
    cells = lambda low, high, size: F.explode(F.sequence(F.floor(C(low) / C(size)), F.floor(C(high) / C(size))))
    r = r.withColumn("gx", cells("mx1", "mx2", "cw")).withColumn("gy", cells("my1", "my2", "ch"))
    row = F.struct("island", "n", "mx1", "mx2", "my1", "my2", "fields", "left")
    a, b = r.select(by, "gx", "gy", "cw", "ch", row.alias("a")), r.select(by, "gx", "gy", row.alias("b"))
    first = lambda c, size: F.floor(F.greatest(C(f"a.{c}1"), C(f"b.{c}1")) / C(size))
    shared = lambda c: F.least(C(f"a.{c}2"), C(f"b.{c}2")) - F.greatest(C(f"a.{c}1"), C(f"b.{c}1")) > TOLERANCE * F.abs("a.left")
    pairs = a.join(merged(b), [by, "gx", "gy"]).where((C("a.island") < C("b.island")) & shared("mx") & shared("my"))
    return pairs.where((C("gx") == first("mx", "cw")) & (C("gy") == first("my", "ch"))).select(by, "a", "b")


def _closest(axis: str) -> Column:
    """The two borders of an overlap that lie closest: the later region's lower one, `one`, the earlier one's upper one, `two`, and whose they are."""
    lo, hi = f"m{axis}1", f"m{axis}2"
    side = lambda p, q: F.struct(C(f"{p}.{lo}").alias("one"), C(f"{q}.{hi}").alias("two"), C(f"{p}.n").alias("lower"), C(f"{q}.n").alias("upper"))
    return F.when(F.abs(C(f"a.{hi}") - C(f"b.{lo}")) <= F.abs(C(f"a.{lo}") - C(f"b.{hi}")), side("b", "a")).otherwise(side("a", "b"))


def _moves(pairs: DataFrame, by: str) -> DataFrame:
    """(by, n, border, at): the borders to move for pairs(by, a, b, offset_x, offset_y).

    The overlap of two fields is cut along x, along y, or it is a corner that could
    be cut along both. A corner is cut along the borders that other pairs of its
    islands have cut, or that two corners share; one that shares none along one.
    """
    near = F.when((C("a.fields") <= 2) | (C("b.fields") <= 2), NEAR_SMALL).otherwise(NEAR)
    p = pairs.withColumn("x", _closest("x")).withColumn("y", _closest("y"))
    p = p.withColumn("fx", F.abs(C("x.one") - C("x.two")) / C("offset_x")).withColumn("fy", F.abs(C("y.one") - C("y.two")) / C("offset_y"))
    small_x, small_y = C("fx") <= near, C("fy") <= near
    neither = ~small_x & ~small_y
    p = p.withColumn("by_x", small_x | (neither & (C("fx") <= RATIO * C("fy")))).withColumn("by_y", small_y | (neither & (C("fy") <= RATIO * C("fx"))))
    p = p.withColumn("corner", C("by_x") & C("by_y"))
    islands = (by, C("a.island"), C("b.island"))
    for axis, other in (("x", "y"), ("y", "x")):
        border = Window.partitionBy(*islands, C(f"{axis}.one"), C(f"{axis}.two"))
        across = F.when(C("corner"), F.struct(C(f"{other}.one"), C(f"{other}.two")))
        p = p.withColumn(f"in_{axis}", F.max(C(f"by_{axis}") & ~C("corner")).over(border) | F.coalesce(F.min(across).over(border) != F.max(across).over(border), F.lit(False)))
    alone = C("corner") & ~C("in_x") & ~C("in_y")
    deeper = (C("x.one") - C("x.two")) < (C("y.one") - C("y.two"))
    along_x = F.when(C("corner"), C("in_x") | (alone & deeper)).otherwise(C("by_x"))
    along_y = F.when(C("corner"), C("in_y") | (alone & ~deeper)).otherwise(C("by_y"))
    move = lambda use, axis: [F.when(use, F.struct(C(f"{axis}.{n}").alias("n"), F.lit(f"m{axis}{k}").alias("border"), ((C(f"{axis}.one") + C(f"{axis}.two")) / 2).alias("at"))) for n, k in (("lower", 1), ("upper", 2))]
    found = p.select(by, F.explode(F.array_compact(F.array(*move(along_x, "x"), *move(along_y, "y")))).alias("m"))
    return found.select(by, "m.*")


def resolve(regions: DataFrame, by: str = "slide_id", most: int = 100) -> DataFrame:
    """regions(by, island, n, mx1, mx2, my1, my2, orphan, offset_x, offset_y) with no area in two islands.

    Islands that share area are taken in pairs, in order of their numbers; pairs
    without a common island in one round. Borders move to the middle of the overlap;
    if pairs of one round move a border differently, the innermost place stays, and
    what would end before it begins becomes empty. Regions only shrink, so a
    resolved pair stays resolved, and there are as many rounds as the longest chain
    of pairs at most. Orphans are left alone. Nulls in a border take a region out.
    """
    now = cut(regions)
    sides = ("mx1", "mx2", "my1", "my2")
    for _ in range(most):
        pairs = cut(region_overlaps(now, by))
        if pairs.isEmpty():
            discard(pairs)
            return now
        key = F.struct(C("a.island").alias("i"), C("b.island").alias("j"))
        both = pairs.select(by, key.alias("p")).distinct()
        first = both.select(by, "p", F.explode(F.array("p.i", "p.j")).alias("island")).groupBy(by, "island").agg(F.min("p").alias("p"))
        chosen = first.groupBy(by, "p").agg(F.count("*").alias("k")).where("k = 2").select(by, "p")
        offsets = now.groupBy(by).agg(F.max("offset_x").alias("offset_x"), F.max("offset_y").alias("offset_y"))
        turn = pairs.withColumn("p", key).join(merged(chosen), [by, "p"], "left_semi").join(offsets, by)
        to = _moves(turn, by).groupBy(by, "n").agg(*(F.max(F.when(C("border") == s, C("at"))).alias(f"_{s}") if s[-1] == "1" else F.min(F.when(C("border") == s, C("at"))).alias(f"_{s}") for s in sides))
        moved = now.join(merged(to), [by, "n"], "left").withColumns({s: F.coalesce(f"_{s}", s) for s in sides})
        moved = moved.withColumns({f"m{a}2": F.greatest(f"m{a}1", f"m{a}2") for a in "xy"})
        new = cut(moved.select(*now.columns))
        discard(pairs)
        discard(now)
        now = new
    raise RuntimeError(f"regions of islands still overlap after {most} rounds")
