"""Rings and polygons as rows of vertices and edges: ordering, validity, nesting and outlines of masks.

Coordinates are whole numbers here, units of a grid, so that all tests of side and
crossing are exact; they must stay below 2^30. A polygon is the rows of one
combination of the key columns, and no step holds one as a whole: edges meet in
buckets of a grid over the polygon, and rings are ordered batch by batch, then by
pointer doubling of what goes on beyond a batch.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histoweave.operators.relational import merged
from histoweave.sources.written import cut, discard

#: Rounds of cutting edges at their crossings; a cut edge bends by rounding and can cross another one anew.
ROUNDS = 12
#: Side of the tiles, in units of the vertices, by which the edges of rings are dealt; a ring within one needs no rounds.
TILE = 4096
ENDS = ("x0", "y0", "x1", "y1")
C = F.col


def edges_of(vertices: DataFrame, by: list[str]) -> DataFrame:
    """(by, ring, x0, y0, x1, y1) of vertices(by, ring, vid, x, y): each to the next and the last to the first; edges without length go."""
    along = Window.partitionBy(*by, "ring").orderBy("vid")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = [F.coalesce(F.lead(c).over(along), F.first(c).over(whole)).alias(f"{c}1") for c in ("x", "y")]
    return vertices.select(*by, "ring", C("x").alias("x0"), C("y").alias("y0"), *ends).where("x0 <> x1 or y0 <> y1")


def odd_edges(edges: DataFrame, by: list[str]) -> DataFrame:
    """Edges that occur an odd number of times in either direction, once and from the smaller end; others bound nothing."""
    turned = (C("x0") > C("x1")) | ((C("x0") == C("x1")) & (C("y0") > C("y1")))
    pairs = (("x0", "x1"), ("y0", "y1"), ("x1", "x0"), ("y1", "y0"))
    one_way = edges.select(*by, *(F.when(turned, C(b)).otherwise(C(a)).alias(a) for a, b in pairs))
    return one_way.groupBy(*by, *ENDS).agg(F.count("*").alias("n")).where("n % 2 = 1").drop("n")


def _celled(edges: DataFrame, by: list[str]) -> DataFrame:
    """Edges with the side `cell` of their polygon's buckets: its extent over the root of its number of edges."""
    extent = F.greatest(F.max(F.greatest("x0", "x1")) - F.min(F.least("x0", "x1")), F.max(F.greatest("y0", "y1")) - F.min(F.least("y0", "y1")))
    cells = edges.groupBy(*by).agg(F.greatest(F.lit(1), F.ceil(extent / F.sqrt(F.count("*")))).cast("long").alias("cell"))
    return edges.join(merged(cells), by)


def _columns(edges: DataFrame) -> DataFrame:
    """One row for each bucket column that an edge touches."""
    return edges.withColumn("cx", F.explode(F.sequence(F.floor(F.least("x0", "x1") / C("cell")), F.floor(F.greatest("x0", "x1") / C("cell")))))


def _bucketed(edges: DataFrame) -> DataFrame:
    """One row for each bucket that an edge touches, from its height in each column with a unit to spare."""
    left, right = F.least("x0", "x1"), F.greatest("x0", "x1")
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    slope = (C("y1") - C("y0")) / (C("x1") - C("x0"))
    at = lambda x: F.when(C("x0") == C("x1"), C("y0")).otherwise(C("y0") + (x - C("x0")) * slope)
    a, b = at(F.greatest(left, C("cx") * C("cell"))), at(F.least(right, (C("cx") + 1) * C("cell")))
    steep = C("x0") == C("x1")
    lo = F.when(steep, low).otherwise(F.greatest(low, F.floor(F.least(a, b)) - 1))
    hi = F.when(steep, high).otherwise(F.least(high, F.ceil(F.greatest(a, b)) + 1))
    return _columns(edges).withColumn("cy", F.explode(F.sequence(F.floor(lo / C("cell")), F.floor(hi / C("cell")))))


def _side(a: str, b: str, end: int) -> Column:
    """Sign of the side of edge `a` on which an end of edge `b` lies; 0 is on its line."""
    x, y = C(f"{b}.x{end}"), C(f"{b}.y{end}")
    return F.sign((C(f"{a}.x1") - C(f"{a}.x0")) * (y - C(f"{a}.y0")) - (C(f"{a}.y1") - C(f"{a}.y0")) * (x - C(f"{a}.x0")))


def _met(edges: DataFrame, by: list[str]) -> DataFrame:
    """(by, edge, px, py): points at which edges have to be cut, ends of others on them and crossings, which are rounded."""
    placed = _bucketed(_celled(edges, by))
    key = lambda t: F.struct(*(C(f"{t}.{c}") for c in ENDS))
    both = functools.reduce(lambda p, c: p & (C(f"a.{c}") == C(f"b.{c}")), [*by, "cx", "cy"], key("a") < key("b"))
    pairs = placed.alias("a").join(merged(placed.alias("b")), both)
    within = lambda t, x, y: ((x - C(f"{t}.x0")) * (x - C(f"{t}.x1")) + (y - C(f"{t}.y0")) * (y - C(f"{t}.y1"))) < 0
    cuts = []
    for t, o in (("a", "b"), ("b", "a")):
        for end in (0, 1):
            x, y = C(f"{o}.x{end}"), C(f"{o}.y{end}")
            cuts.append(F.when((_side(t, o, end) == 0) & within(t, x, y), F.struct(key(t).alias("e"), x.alias("px"), y.alias("py"))))
    crossing = (_side("a", "b", 0) * _side("a", "b", 1) < 0) & (_side("b", "a", 0) * _side("b", "a", 1) < 0)
    ax, ay, bx, by_ = (C(f"{t}.{c}1") - C(f"{t}.{c}0") for t in "ab" for c in "xy")
    part = ((C("b.x0") - C("a.x0")) * by_ - (C("b.y0") - C("a.y0")) * bx) / (ax * by_ - ay * bx)
    px, py = (F.round(C(f"a.{c}0") + part * d).cast("long") for c, d in (("x", ax), ("y", ay)))
    for t in ("a", "b"):
        new = ~((px == C(f"{t}.x0")) & (py == C(f"{t}.y0"))) & ~((px == C(f"{t}.x1")) & (py == C(f"{t}.y1")))
        cuts.append(F.when(crossing, F.when(new, F.struct(key(t).alias("e"), px.alias("px"), py.alias("py")))))
    found = pairs.select(*(C(f"a.{c}").alias(c) for c in by), F.explode(F.array_compact(F.array(*cuts))).alias("c"))
    return found.select(*by, "c.e.*", "c.px", "c.py").distinct()


def noded(edges: DataFrame, by: list[str]) -> DataFrame:
    """The odd edges of `edges`, cut wherever they meet, until they meet at ends alone."""
    now = cut(odd_edges(edges, by))
    for _ in range(ROUNDS):
        points = cut(_met(now, by))
        if points.isEmpty():
            discard(points)
            return now
        ends = now.select(*by, *ENDS, F.explode(F.array(F.struct(C("x0").alias("px"), C("y0").alias("py")), F.struct(C("x1").alias("px"), C("y1").alias("py")))).alias("p")).select(*by, *ENDS, "p.*")
        far = (C("px") - C("x0")) * (C("x1") - C("x0")) + (C("py") - C("y0")) * (C("y1") - C("y0"))
        along = Window.partitionBy(*by, *ENDS).orderBy(far, "px", "py")
        pieces = ends.unionByName(points).select(*by, C("px"), C("py"), F.lead("px").over(along).alias("qx"), F.lead("py").over(along).alias("qy")).where("qx is not null and (px <> qx or py <> qy)")
        new = cut(odd_edges(pieces.select(*by, C("px").alias("x0"), C("py").alias("y0"), C("qx").alias("x1"), C("qy").alias("y1")), by))
        discard(now)
        discard(points)
        now = new
    raise ValueError(f"edges still cross after {ROUNDS} rounds of cutting them; take a finer grid")


def _linked(keys: np.ndarray, onto: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows whose keys are `keys` (rows by fields), in groups that begin where `fresh` is: the row whose key is `onto`, -1 if none is, and the rank of each key."""
    n, group = len(keys), np.cumsum(fresh)
    both = np.concatenate([np.column_stack([group, keys]), np.column_stack([group, onto])])
    asks = np.repeat([0, 1], n)
    order = np.lexsort((asks, *both.T[::-1]))
    same = (both[order[1:]] == both[order[:-1]]).all(axis=1) & (asks[order[1:]] == 1) & (asks[order[:-1]] == 0)
    link = np.full(n, -1)
    link[order[1:][same] - n] = order[:-1][same]
    rank = np.empty(2 * n, np.int64)
    rank[order] = np.arange(2 * n)
    return link, rank[:n]


def _walked(link: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """(head, first, place, span) of each row of the cycles and open chains that `link` makes.

    On a cycle `head` is -1, `first` its row of the smallest rank and `place` counts from
    that. On a chain `head` is its first row, `first` its row of the smallest rank and
    `place` counts from the head; `span` is the number of rows of either.
    """
    n = len(link)
    rows, ends = np.arange(n), link < 0
    back = rows.copy()
    back[link[~ends]] = rows[~ends]
    started = back == rows
    started[rows[~ends & (link == rows)]] = False  # a cycle of one
    place, low, ahead, far = (back != rows).astype(np.int64), rows.copy(), np.where(ends, rows, link), np.zeros(n, np.int64)
    size = 1
    while size < 2 * n:
        place, back = place + place[back], back[back]
        nearer = rank[low[ahead]] < rank[low]
        low, far = np.where(nearer, low[ahead], low), np.where(nearer, far[ahead] + size, far)
        ahead, size = ahead[ahead], 2 * size
    opened = started[back]
    head = np.where(opened, back, -1)
    cycle = np.bincount(low[~opened], minlength=n)
    chain = np.bincount(back[opened], minlength=n)
    span = np.where(opened, chain[back], cycle[low])
    first = np.where(opened, low[back], low)
    return head, first, np.where(opened, place, -far % np.maximum(span, 1)), span


def _chained(by: list[str], k: int):
    """Arrow batches of (by, e0.., n0..), in order of `by`, with the cycles and chains within each batch; see `ring_order`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            fresh = np.zeros(n, bool)
            for c in by:
                v = batch.column(c)
                fresh[1:] |= pc.not_equal(v.slice(1), v.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            keys, onto = (np.column_stack([batch.column(f"{p}{i}").to_numpy() for i in range(k)]) for p in "en")
            head, first, place, span = _walked(*_linked(keys, onto, fresh))
            opened, heads = head >= 0, head == np.arange(n)
            last = np.zeros(n, np.int64)
            ending = opened & (place == span - 1)
            last[head[ending]] = np.flatnonzero(ending)
            known = ~opened | heads
            out = [pa.array(keys[first, i], mask=~known) for i in range(k)]
            out += [pa.array(keys[head, i], mask=~opened) for i in range(k)]
            out += [pa.array(onto[last, i], mask=~heads) for i in range(k)]
            out += [pa.array(place), pa.array(place[first], mask=~heads), pa.array(span, mask=~heads)]
            names = [f"{p}{i}" for p in "rho" for i in range(k)] + ["place", "far", "span"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, *names])

    return run


def ring_order(steps: DataFrame, by: list[str], near: tuple[Column, ...] = ()) -> DataFrame:
    """(by, e, next, ring, place), written, of steps(by, e, next), a permutation of the e: `ring` is the cycle's smallest e, `place` counts from it.

    Steps are dealt by `near`, expressions of e, and sorted; within each Arrow batch
    they become cycles, which are done, and chains. Only chains then go on, a row
    each, by pointer doubling: after k rounds each knows the smallest e of the 2^k next
    ones and how far it is, so the rounds follow the logarithm of the most chains in a
    cycle. e is a number or a struct of numbers; nulls drop a step.
    """
    kind = steps.schema["e"].dataType
    fields = [(f".{f.name}", f.name, f.dataType) for f in kind.fields] if isinstance(kind, T.StructType) else [("", "e", kind)]
    k = len(fields)
    flat = steps.dropna(subset=[*by, "e", "next"]).repartition(*by, *(near or [C("e")])).sortWithinPartitions(*by, *near, "e")
    flat = flat.select(*by, *(C(f"{c}{at}").cast("long").alias(f"{c[0]}{i}") for c in ("e", "next") for i, (at, _, _) in enumerate(fields)))
    more = [f"{p}{i}" for p in "rho" for i in range(k)] + ["place", "far", "span"]
    found = flat.mapInArrow(_chained(by, k), T.StructType([*flat.schema.fields, *(T.StructField(c, T.LongType()) for c in more)]))

    def whole(p: str) -> Column:
        parts = [C(f"{p}{i}").cast(t).alias(name) for i, (_, name, t) in enumerate(fields)]
        return F.when(C(f"{p}0").isNotNull(), F.struct(*parts)) if isinstance(kind, T.StructType) else parts[0]

    done = cut(found.select(*by, whole("e").alias("e"), whole("n").alias("next"), whole("r").alias("ring"), "place", whole("h").alias("head"), whole("o").alias("to"), "far", "span"))
    closed = done.where("head is null").select(*by, "e", "next", "ring", "place")
    if done.where("head is not null").isEmpty():
        closed._written = done._written
        return closed
    state = cut(done.where("head is not null and span is not null").select(*by, "head", "to", "ring", "far", "span", C("span").alias("own")))
    while True:
        other = state.select(*by, C("head").alias("to"), C("to").alias("to2"), C("ring").alias("ring2"), C("far").alias("far2"), C("span").alias("span2"))
        nearer = C("ring2") < C("ring")
        new = state.join(merged(other), [*by, "to"])
        new = cut(new.select(*by, "head", C("to2").alias("to"), F.when(nearer, C("ring2")).otherwise(C("ring")).alias("ring"), F.when(nearer, C("far2") + C("span")).otherwise(C("far")).alias("far"), (C("span") + C("span2")).alias("span"), "own", nearer.alias("moved")))
        discard(state)
        state = new
        if new.where("moved").isEmpty():
            break
    n = F.sum("own").over(Window.partitionBy(*by, "ring"))
    chains = state.select(*by, "head", "ring", C("far").alias("off"), n.alias("n"))
    rest = done.where("head is not null").select(*by, "e", "next", "head", "place").join(merged(chains), [*by, "head"])
    out = cut(closed.unionByName(rest.select(*by, "e", "next", "ring", F.pmod(C("place") - C("off"), "n").alias("place"))))
    discard(done)
    discard(state)
    return out


def _turning(edges: DataFrame, by: list[str]) -> DataFrame:
    """(by, e, next) of both directions of noded edges, such that cycles go around faces with the face to the left."""
    both = edges.select(*by, F.explode(F.array(F.struct(*(C(c) for c in ENDS)), F.struct(C("x1").alias("x0"), C("y1").alias("y0"), C("x0").alias("x1"), C("y0").alias("y1")))).alias("o"))
    both = both.select(*by, "o.*")
    around = Window.partitionBy(*by, "x0", "y0").orderBy(F.atan2(C("y1") - C("y0"), C("x1") - C("x0")))
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    target = F.struct("x1", "y1")
    clockwise = F.coalesce(F.lag(target).over(around), F.last(target).over(whole))
    turned = both.withColumn("t", clockwise)
    back = F.struct(C("x1").alias("x0"), C("y1").alias("y0"), C("x0").alias("x1"), C("y0").alias("y1"))
    return turned.select(*by, back.alias("e"), F.struct("x0", "y0", C("t.x1").alias("x1"), C("t.y1").alias("y1")).alias("next"))


def twice_area(e: str = "e") -> Column:
    """Sum of the cross products of a ring's edges: twice its area, negative if it goes clockwise."""
    return F.sum(C(f"{e}.x0") * C(f"{e}.y1") - C(f"{e}.x1") * C(f"{e}.y0"))


def _above(points: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """(by, point, ring, n): how many edges(by, ring, e) of each ring lie above points(by, point, e), the middle of an edge that isn't vertical."""
    flat = _celled(edges.select(*by, "ring", "e.*"), by)
    sides = flat.select(*by, "cell").distinct()
    placed = points.select(*by, "point", (C("e.x0") + C("e.x1")).alias("mx"), (C("e.y0") + C("e.y1")).alias("my")).join(merged(sides), by).withColumn("cx", F.floor(C("mx") / 2 / C("cell"))).drop("cell")
    low, high = F.least("x0", "x1"), F.greatest("x0", "x1")
    met = placed.join(merged(_columns(flat.where("x0 <> x1"))), [*by, "cx"]).where((2 * low <= C("mx")) & (C("mx") < 2 * high))
    below = ((C("x1") - C("x0")) * (C("my") - 2 * C("y0")) - (C("y1") - C("y0")) * (C("mx") - 2 * C("x0"))) * F.when(C("x0") < C("x1"), 1).otherwise(-1) < 0
    return met.where(below).groupBy(*by, "point", "ring").agg(F.count("*").alias("n"))


def _flat_edge() -> Column:
    """The smallest edge of a group that isn't vertical."""
    return F.min(F.when(C("e.x0") != C("e.x1"), C("e")))


def make_valid(vertices: DataFrame, by: list[str], scale: int = 256) -> DataFrame:
    """(by, polygon, ring, vid, x, y, area) of the valid polygons that cover what vertices(by, ring, vid, x, y) cover an odd number of times.

    Coordinates are rounded to 1 / `scale`. Edges are cut where they meet; pieces
    that occur an even number of times (spikes, repeated rings) bound nothing and go,
    so what has no area gives no row. Each connected face is a polygon, numbered
    from 1 by descending area (of the polygon, without its holes); its outer ring is
    ring 0 and counterclockwise, its holes are clockwise, and rings touch themselves
    nowhere. Rings start at their smallest vertex; cuts stay as vertices. Null
    coordinates drop a vertex.
    """
    whole = vertices.select(*by, "ring", "vid", *(F.round(C(c) * scale).cast("long").alias(c) for c in ("x", "y"))).where("x is not null and y is not null")
    edges = noded(edges_of(whole, by), by)
    tile = [F.floor(C(f"e.{c}") / (TILE * scale)) for c in ("x0", "y0")]
    cycles = ring_order(_turning(edges, by), by, tuple(tile))
    about = cut(cycles.groupBy(*by, "ring").agg(twice_area().alias("area2"), _flat_edge().alias("e")))
    over = cut(_above(about.select(*by, C("ring").alias("point"), "e"), cycles.select(*by, "ring", "e"), by))
    crossed = over.groupBy(*by, "point").agg((F.sum("n") / 2).cast("long").alias("all"))  # each edge is in two cycles
    rightwards = C("e.x0") < C("e.x1")
    faces = about.join(merged(crossed.withColumnRenamed("point", "ring")), [*by, "ring"], "left").withColumn("all", F.coalesce("all", F.lit(0)))
    faces = cut(faces.where(F.when(rightwards, C("all") % 2 == 1).otherwise(C("all") % 2 == 0)).select(*by, "ring", "area2"))
    outer = faces.where("area2 > 0").select(*by, C("ring").alias("face"), C("area2").alias("size"))
    apart = faces.where("area2 < 0").select(*by, C("ring").alias("point"))
    holds = over.where("n % 2 = 1").withColumnRenamed("ring", "face").join(merged(apart), [*by, "point"]).join(merged(outer), [*by, "face"])
    holder = holds.groupBy(*by, "point").agg(F.min(F.struct("size", "face"))["face"].alias("face")).withColumnRenamed("point", "ring")
    member = outer.select(*by, C("face").alias("ring"), "face").unionByName(holder)
    inner = cycles.join(merged(member), [*by, "ring"])
    visits = Window.partitionBy(*by, "ring", C("next.x0"), C("next.y0"))
    n = F.count("*").over(Window.partitionBy(*by, "ring"))
    along = visits.orderBy((C("place") + 1) % n)
    before = F.coalesce(F.lag("next").over(along), F.last("next").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    inner = inner.select("*", n.alias("size")).select(*by, "face", "e", "ring", "place", before.alias("next"), F.count("*").over(visits).alias("met"))
    inner = cut(inner.select("*", F.max("met").over(Window.partitionBy(*by, "ring")).alias("most")).drop("met"))
    simple = inner.where("most = 1").select(*by, "face", "e", "ring", "place")
    split = inner.where("most > 1").select(*by, "face", "e", "next")
    if not split.isEmpty():  # the same vertex again: each part between two visits is a ring of its own
        parts = ring_order(split.select(*by, "e", "next"), by, tuple(tile))
        simple = simple.unionByName(split.select(*by, "face", "e").join(merged(parts.select(*by, "e", "ring", "place")), [*by, "e"]))
    simple = cut(simple)
    rings = simple.groupBy(*by, "face", "ring").agg(twice_area().alias("area2"))
    sized = rings.select(*by, "face", "ring", "area2", F.sum("area2").over(Window.partitionBy(*by, "face")).alias("total"))
    number = F.dense_rank().over(Window.partitionBy(*by).orderBy(F.desc("total"), "face"))
    place = F.row_number().over(Window.partitionBy(*by, "face").orderBy(C("area2") < 0, "ring")) - 1
    numbered = sized.select(*by, "ring", number.alias("polygon"), place.alias("number"), (C("total") / (2 * scale * scale)).alias("area"))
    out = simple.join(merged(numbered), [*by, "ring"]).select(*by, "polygon", C("number").alias("ring"), (C("place") + 1).cast("int").alias("vid"), (C("e.x0") / scale).alias("x"), (C("e.y0") / scale).alias("y"), "area")
    for t in (edges, cycles, about, over, faces):
        discard(t)
    return out


def nesting(vertices: DataFrame, by: list[str]) -> DataFrame:
    """(by, ring, depth, parent, polygon, kind) of rings, as vertices(by, ring, vid, x, y), of any number that don't cross or share edges.

    `depth` is the number of rings around a ring and `parent` the closest of them. A
    ring of even depth bounds a polygon of its own, one of odd depth is a hole of its
    parent's, so islands in holes become polygons beside the one around them. Rings
    without area go.
    """
    whole = vertices.select(*by, "ring", "vid", C("x").cast("long").alias("x"), C("y").cast("long").alias("y"))
    edges = edges_of(whole, by).select(*by, "ring", F.struct(*ENDS).alias("e"))
    rings = edges.groupBy(*by, "ring").agg(F.abs(twice_area()).alias("area2"), _flat_edge().alias("e")).where("area2 > 0")
    edges = edges.join(merged(rings.select(*by, "ring")), [*by, "ring"], "left_semi")
    around = _above(rings.select(*by, C("ring").alias("point"), "e"), edges, by).where("n % 2 = 1 and ring <> point")
    sized = around.join(merged(rings.select(*by, "ring", "area2")), [*by, "ring"])
    held = sized.groupBy(*by, "point").agg(F.count("*").alias("depth"), F.min(F.struct("area2", "ring"))["ring"].alias("parent")).withColumnRenamed("point", "ring")
    out = rings.select(*by, "ring").join(merged(held), [*by, "ring"], "left").withColumn("depth", F.coalesce("depth", F.lit(0).cast("long")))
    even = C("depth") % 2 == 0
    return out.select(*by, "ring", "depth", "parent", F.when(even, C("ring")).otherwise(C("parent")).alias("polygon"), F.when(even, "outer").otherwise("hole").alias("kind"))
