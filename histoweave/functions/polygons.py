"""Polygons as arrays of points, in built-in expressions only. Rings aren't closed: the last point links to the first."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, not wherever f names it."""
    return F.transform(F.array(value), f)[0]


def ring(*points: tuple[Column, Column]) -> Column:
    return F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in points])


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    """Counter-clockwise rectangle."""
    return ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))


def shifted(points: Column) -> Column:
    """Each point's successor."""
    return _once(points, lambda p: F.concat(F.slice(p, F.lit(2), F.size(p)), F.slice(p, 1, 1)))


def signed_area(points: Column) -> Column:
    """Shoelace sum; positive for counter-clockwise rings."""
    cross = lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]

    def along(p: Column) -> Column:
        """The last point and the sum so far; the way back to the first one ends it."""
        first = F.get(p, F.lit(0))
        start = F.struct(first["x"].alias("x"), first["y"].alias("y"), F.lit(0.0).alias("s"))
        step = lambda a, b: F.struct(b["x"].alias("x"), b["y"].alias("y"), (a["s"] + cross(a, b)).alias("s"))
        return F.aggregate(p, start, step, lambda a: a["s"] + F.coalesce(cross(a, first), F.lit(0.0)))

    return _once(points, along) / 2


def perimeter(points: Column) -> Column:
    side = lambda a, b: F.sqrt((a["x"] - b["x"]) ** 2 + (a["y"] - b["y"]) ** 2)
    return _once(points, lambda p: F.aggregate(F.zip_with(p, shifted(p), side), F.lit(0.0), lambda s, v: s + v))


def nested_area(rings: Column) -> Column:
    """Area of rings ordered from the outside in, each inside the one before: holes count as negative."""
    return F.aggregate(F.transform(rings, lambda r, i: F.abs(signed_area(r)) * F.when(i % 2 == 0, 1).otherwise(-1)), F.lit(0.0), lambda s, v: s + v)


def nested_perimeter(rings: Column) -> Column:
    return F.aggregate(F.transform(rings, perimeter), F.lit(0.0), lambda s, v: s + v)


def counter_clockwise(points: Column) -> Column:
    return _once(points, lambda p: F.when(signed_area(p) < 0, F.reverse(p)).otherwise(p))


def normalised(points: Column) -> Column:
    """Counter-clockwise, from the point with the smallest y and of these the smallest x."""
    place = lambda p: _once(F.transform(p, lambda a: F.struct(a["y"].alias("y"), a["x"].alias("x"))), lambda q: F.array_position(q, F.array_min(q)).cast("int"))
    turned = lambda p: _once(place(p), lambda at: F.concat(F.slice(p, at, F.size(p)), F.slice(p, F.lit(1), at - 1)))
    return _once(counter_clockwise(points), turned)


def to_wkt(rings: Column) -> Column:
    """POLYGON text with closed rings and whole-number coordinates where they are whole."""
    number = lambda v: F.when(v == F.floor(v), F.floor(v).cast("string")).otherwise(v.cast("string"))
    point = lambda a: F.concat_ws(" ", number(a["x"]), number(a["y"]))
    one = lambda r: F.concat(F.lit("("), F.array_join(F.transform(F.concat(r, F.slice(r, 1, 1)), point), ","), F.lit(")"))
    return F.concat(F.lit("POLYGON ("), F.array_join(F.transform(rings, one), ","), F.lit(")"))


def from_wkt(text: Column) -> Column:
    """Rings of POLYGON text, without their closing points; null for `poly` and other text."""
    rings = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1))
    point = lambda p: F.struct(F.split(F.trim(p), " +")[0].cast("double").alias("x"), F.split(F.trim(p), " +")[1].cast("double").alias("y"))
    opened = F.transform(rings, lambda r: F.transform(F.split(r, ","), point))
    opened = F.transform(opened, lambda r: F.when((F.size(r) > 1) & (r[0] == r[F.size(r) - 1]), F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r))
    return F.when(text.startswith("POLYGON"), opened)


def contains(points: Column, x: Column, y: Column) -> Column:
    """Crossing-number test for a point that is on no edge."""
    hit = lambda a, b: ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"])
    crossings = _once(points, lambda p: F.aggregate(F.zip_with(p, shifted(p), lambda a, b: F.coalesce(hit(a, b), F.lit(False)).cast("int")), F.lit(0), lambda s, v: s + v))
    return crossings % 2 == 1


def _first(v: Column) -> Column:
    """The first pixel, or line of pixels, whose centre v isn't beyond: v - 1/2 rounded up, without the rounding of a difference."""
    return F.shiftright(F.ceil(v * 2), 1)


def crossings(points: Column, mark: int) -> Column:
    """(y, x, mark) where the ring's edges cross the centres of lines of pixels: line y, and its first pixel that isn't to the left of the crossing.

    A line through a vertex crosses the edges that go on from it to larger y, as in `contains`.
    """

    def along(a: Column, b: Column) -> Column:
        low, high = _first(F.least(a["y"], b["y"])), _first(F.greatest(a["y"], b["y"]))
        x = lambda y: (b["x"] - a["x"]) * (y + 0.5 - a["y"]) / (b["y"] - a["y"]) + a["x"]
        at = lambda y: F.struct(y.alias("y"), _first(x(y)).alias("x"), F.lit(mark).alias("mark"))
        return F.transform(F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<long>")), at)

    return _once(points, lambda p: F.flatten(F.zip_with(p, shifted(p), along)))


def pixels(outer: Column, hole: Column) -> Column:
    """How many pixels have their centre in a ring and not in its hole: those that `contains` has in the one and not in the other.

    Runs between crossings are counted line by line, so the work follows the edges'
    heights and no pixel is a value of its own. Null where a coordinate is.
    """
    known = lambda r: F.forall(r, lambda a: (a["x"] + a["y"]).isNotNull())
    start = F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).alias("within"), F.lit(0).cast("long").alias("n"))
    run = lambda s, e: F.struct(e["x"].alias("x"), s["within"].bitwiseXOR(e["mark"]).alias("within"), (s["n"] + F.when(s["within"] == 1, e["x"] - s["x"]).otherwise(0)).alias("n"))
    count = lambda o, h: F.aggregate(F.sort_array(F.concat(crossings(o, 1), crossings(h, 2))), start, run, lambda s: s["n"])
    return _once(outer, lambda o: _once(hole, lambda h: F.when(known(o) & known(h), count(o, h))))


def round_to_grid(points: Column, pixel: float, eps: float = 1e-10) -> Column:
    snap = lambda v: F.floor((v + eps) / pixel) * pixel
    return F.transform(points, lambda a: F.struct(snap(a["x"]).cast("double").alias("x"), snap(a["y"]).cast("double").alias("y")))


def circle(x: Column, y: Column, radius: Column, angles: int) -> Column:
    turns = [2 * math.pi * i / angles for i in range(angles)]
    unit = F.array(*(F.struct(F.lit(math.cos(t)).alias("x"), F.lit(math.sin(t)).alias("y")) for t in turns))
    return F.transform(unit, lambda u: F.struct((x + radius * u["x"]).alias("x"), (y + radius * u["y"]).alias("y")))


def edge_lengths(points: Column) -> Column:
    return _once(points, lambda p: F.zip_with(p, shifted(p), lambda a, b: F.sqrt((a["x"] - b["x"]) ** 2 + (a["y"] - b["y"]) ** 2)))
