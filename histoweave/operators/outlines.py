"""Outlines of masks, with their hierarchy, from border edges as rows.

A mask is the set pixels (by, x, y) of an image, y downwards. Each side between a
set pixel and one that isn't is an edge with the set pixel to its right, so rings
around regions go clockwise and rings around holes the other way. Where two set
pixels touch by a corner the outline turns left and joins them: regions are
8-connected, holes 4-connected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoweave.operators.relational import merged, number_rows
from histoweave.operators.rings import ring_order
from histoweave.sources.written import cut, discard

C = F.col
EDGE = ("y0", "x0", "y1", "x1")
#: Side of the tiles, in pixels, by which edges are dealt.
TILE = 64
#: The pixels around a corner: a bit each, and where the corner lies from the pixel.
AROUND = ((1, 1, 1), (2, 1, 0), (4, 0, 1), (8, 0, 0))  # upper left, upper right, lower left, lower right; (bit, y, x)
#: The sides that meet at a corner: where they end (y, x), the bit of the pixel that makes them come in, and the bit of the one that makes them go out.
MEETING = (((0, 1), 2, 8), ((0, -1), 4, 1), ((-1, 0), 1, 2), ((1, 0), 8, 4))


def _turns(around: int) -> list[tuple[int, int, int, int]]:
    """(y, x, y, x) of each side that comes in at a corner with these pixels around it, and of the one that goes on from there, to the left where there are two."""
    comes = [at for at, i, o in MEETING if around & i and not around & o]
    goes = [at for at, i, o in MEETING if around & o and not around & i]
    return [(y, x, *min(goes, key=lambda g, y=y, x=x: y * g[1] - x * g[0])) for y, x in comes]


def border_steps(mask: DataFrame, by: list[str]) -> DataFrame:
    """(by, e, next): each side of a set pixel that no other set pixel has too, and the one that goes on from its end.

    A pixel marks its four corners; what meets at a corner follows from its marks, so
    one grouping with partial sums makes all steps.
    """
    places = F.array(*(F.struct(F.lit(bit).alias("bit"), F.lit(j).alias("j"), F.lit(i).alias("i")) for bit, j, i in AROUND))
    sent = mask.select(*by, C("x").cast("long").alias("x"), C("y").cast("long").alias("y"), F.explode(places).alias("p"))
    corners = sent.groupBy(*by, (C("y") + C("p.j")).alias("y"), (C("x") + C("p.i")).alias("x")).agg(F.bit_or("p.bit").alias("m")).where("m < 15")
    turns = F.array(*(F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(("fy", "fx", "ty", "tx"), t))) for t in _turns(m))) for m in range(1, 15)))
    met = corners.select(*by, "y", "x", F.explode(F.element_at(turns, C("m"))).alias("t"))
    start, end = (C("y") + C("t.fy"), C("x") + C("t.fx")), (C("y") + C("t.ty"), C("x") + C("t.tx"))
    edge = lambda *ends: F.struct(*(c.alias(n) for n, c in zip(EDGE, ends)))
    return met.select(*by, edge(*start, C("y"), C("x")).alias("e"), edge(C("y"), C("x"), *end).alias("next"))


def _parents(rings: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """(by, ring, depth, parent) of rings(by, ring, hole), from the edge over each ring's first pixel.

    What lies next above the first pixel's upper side is another ring's edge: of a
    ring of the same kind, which has the same parent, or of the other kind, which is
    the parent. Chains of the first are followed by pointer doubling.
    """
    flat = edges.where(C("e.y0") == C("e.y1")).select(*by, "ring", F.least("e.x0", "e.x1").alias("x"), C("e.y0").alias("y"))
    column = Window.partitionBy(*by, "x").orderBy("y")
    over = flat.withColumn("link", F.lag("ring").over(column)).where((C("x") == C("ring.x0")) & (C("y") == C("ring.y0"))).select(*by, "ring", "link")
    kind = rings.select(*by, C("ring").alias("link"), C("hole").alias("hole2"))
    first = rings.join(merged(over), [*by, "ring"], "left").join(merged(kind), [*by, "link"], "left")
    other = C("hole") != C("hole2")
    state = cut(first.select(*by, "ring", C("link").alias("to"), F.coalesce(other, F.lit(False)).cast("long").alias("depth"), F.when(other, C("link")).alias("parent")))
    while not state.where("to is not null").isEmpty():
        ahead = state.select(*by, C("ring").alias("to"), C("to").alias("to2"), C("depth").alias("depth2"), C("parent").alias("parent2"))
        new = cut(state.join(merged(ahead), [*by, "to"], "left").select(*by, "ring", C("to2").alias("to"), (C("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"), F.coalesce("parent", "parent2").alias("parent")))
        discard(state)
        state = new
    return state.drop("to")


def contours(mask: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rings (by, ring, hole, depth, parent, area, perimeter) and their corners (by, ring, vid, x, y) of mask(by, x, y).

    Rings are numbered from 1 in each image, regions first and then holes, in order
    of their first pixel. A region has an even depth and the hole it lies in as
    parent, a hole an odd one and the region around it; 0 is none. `area` counts all
    pixels within the ring. Corners go clockwise from the first pixel's upper left
    one. Repeated pixels count once; nulls in x or y drop a pixel.
    """
    tile = (F.floor(C("e.y0") / TILE), F.floor(C("e.x0") / TILE))
    walked = ring_order(border_steps(mask.where("x is not null and y is not null"), by), by, tile)
    twice = F.sum(C("e.x0") * C("e.y1") - C("e.x1") * C("e.y0"))
    rings = cut(walked.groupBy(*by, "ring").agg((twice / 2).cast("long").alias("signed"), F.count("*").alias("perimeter")).withColumn("hole", C("signed") < 0))
    tree = _parents(rings, walked.select(*by, "ring", "e"), by)
    named = number_rows(rings.select(*by, "ring", "hole", C("ring.y0").alias("y"), C("ring.x0").alias("x")), ["hole", "y", "x"], "number", tuple(by)).select(*by, "ring", "number")
    above = named.select(*by, C("ring").alias("parent"), C("number").alias("parent_number"))
    out = rings.join(merged(tree), [*by, "ring"]).join(merged(named), [*by, "ring"]).join(merged(above), [*by, "parent"], "left")
    out = cut(out.select(*by, "ring", "number", "hole", "depth", F.coalesce("parent_number", F.lit(0).cast("long")).alias("parent"), F.abs("signed").alias("area"), "perimeter"))
    straight = (C("e.x1") - C("e.x0") == C("next.x1") - C("next.x0")) & (C("e.y1") - C("e.y0") == C("next.y1") - C("next.y0"))
    place: Column = (C("place") + 1) % C("perimeter")
    corners = walked.where(~straight).join(merged(out.select(*by, "ring", "number", "hole", "perimeter")), [*by, "ring"])
    corners = corners.select(*by, "number", F.when(C("hole"), (C("perimeter") - place) % C("perimeter")).otherwise(place).alias("at"), C("next.x0").alias("x"), C("next.y0").alias("y"))
    vid = F.row_number().over(Window.partitionBy(*by, "number").orderBy("at")) - 1
    discard(rings)
    return out.drop("ring").withColumnRenamed("number", "ring"), corners.select(*by, C("number").alias("ring"), vid.alias("vid"), "x", "y")
