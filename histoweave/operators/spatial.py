"""Rectangles, their overlaps, neighbours and primary regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoweave.operators.relational import merged


def box_overlaps(rects: DataFrame, by: str = "slide_id") -> DataFrame:
    """Ordered pairs of different rectangles of a slide whose corners differ by less than the first one's size.

    Rectangles are dealt to grid cells as large as the slide's largest one; one
    side is repeated in the 3 x 3 cells around its own, so the join is an equi
    join on (slide, cell) whatever the number of rectangles, and a merge. `tag` is the
    direction of the first as seen from the second, 1 for up-left to 9, 5 for the
    same corner.
    """
    size = rects.groupBy(by).agg(F.max("w").alias("cw"), F.max("h").alias("ch"))
    r = rects.join(size, by)
    gx, gy = F.floor(F.col("cx") / F.col("cw")), F.floor(F.col("cy") / F.col("ch"))
    one = r.select(by, F.col("n").alias("p1"), F.col("cx").alias("x1"), F.col("cy").alias("y1"), "w", "h", gx.alias("gx"), gy.alias("gy"))
    near = F.sequence(F.lit(-1), F.lit(1))
    two = r.select(by, F.col("n").alias("p2"), F.col("cx").alias("x2"), F.col("cy").alias("y2"), gx.alias("ox"), gy.alias("oy"))
    two = two.withColumn("i", F.explode(near)).withColumn("j", F.explode(near)).select(by, "p2", "x2", "y2", (F.col("ox") + F.col("i")).alias("gx"), (F.col("oy") + F.col("j")).alias("gy"))
    dx, dy = F.col("x1") - F.col("x2"), F.col("y1") - F.col("y2")
    pairs = one.join(merged(two), [by, "gx", "gy"]).where((F.col("p1") != F.col("p2")) & (F.abs(dx) < F.col("w")) & (F.abs(dy) < F.col("h")))
    return pairs.select(by, "p1", "p2", "x1", "y1", "x2", "y2", (F.sign(dx) + 3 * F.sign(dy) + 5).cast("int").alias("tag"))


def degrees(rects: DataFrame, overlaps: DataFrame) -> DataFrame:
    """Every rectangle with its number of outgoing overlaps, 0 included."""
    out = overlaps.groupBy("slide_id", F.col("p1").alias("n")).agg(F.count("*").alias("degree"))
    return rects.join(merged(out), ["slide_id", "n"], "left").withColumn("degree", F.coalesce("degree", F.lit(0)).cast("long"))


def edge_and_bulk(rects: DataFrame, overlaps: DataFrame) -> DataFrame:
    """Fields with all eight neighbours are bulk, others are edge."""
    return degrees(rects, overlaps).select("slide_id", "n", "degree", F.when(F.col("degree") == 8, "bulk").when(F.col("degree") < 8, "edge").otherwise("other").alias("kind"))


def hpf_offset(rects: DataFrame, axis: str) -> DataFrame:
    """The commonest smallest gap to the next field of the same row or column; of equally common ones the smallest."""
    other = {"cx": "cy", "cy": "cx"}[axis]
    places = rects.select("slide_id", other, axis)
    nexts = places.distinct().withColumn("gap", F.lead(axis).over(Window.partitionBy("slide_id", other).orderBy(axis)) - F.col(axis)).where("gap is not null")
    gaps = places.join(merged(nexts), ["slide_id", other, axis]).groupBy("slide_id", "gap").agg(F.count("*").alias("c"))
    return gaps.groupBy("slide_id").agg(F.max(F.struct("c", (-F.col("gap")).alias("g"))).alias("m")).select("slide_id", (-F.col("m.g")).alias("gap"), F.col("m.c").alias("times"))


def grid_index(rects: DataFrame, axis: str, tolerance: float) -> DataFrame:
    """Numbers the distinct coordinates of a slide, those within `tolerance` of the one before as one."""
    at = rects.select("slide_id", axis).distinct()
    w = Window.partitionBy("slide_id").orderBy(axis)
    new = F.when(F.col(axis) - F.lag(axis).over(w) > tolerance, 1).otherwise(0)
    return at.withColumn("new", new).select("slide_id", axis, (F.sum("new").over(w) + 1).cast("long").alias("g"))


def region_boundaries(rects: DataFrame, axis: str, size: str, tolerance: float) -> DataFrame:
    """Middle between the mean end of a grid line's fields and the mean start of the next line's."""
    means = rects.join(merged(grid_index(rects, axis, tolerance)), ["slide_id", axis]).groupBy("slide_id", "g").agg(F.avg(axis).alias("start"), F.avg(F.col(axis) + F.col(size)).alias("stop"))
    return means.select("slide_id", "g", "start", ((F.lead("start").over(Window.partitionBy("slide_id").orderBy("g")) + F.col("stop")) / 2).alias("boundary"))


def axis_regions(fields: DataFrame, by: list[str], place: str, at: str, size: str, offset: str, jump: float = 100.0, tolerance: float = 0.0) -> DataFrame:
    """(by, n, g, last, low, high): on one axis, each field's grid line of all lines of its group, and the borders of its primary region.

    Lines are the distinct nominal coordinates in `place`, those within `tolerance`
    of the one before being one line; a field further than that from its line's
    first one is an error. `at` is where fields really lie. Between two lines the border is the middle of the mean end and the
    mean start. The outer borders come from a line through the inner ones: its
    slope is the mean of their differences within one deviation of the mean, its
    intercept at each end that of the borders before the first one that lies more
    than `jump` standard errors off. With one inner border the outer ones are
    `offset` away, without any half of it to both sides of the fields' middle.
    """
    lines = Window.partitionBy(*by).orderBy(place, "n")
    new = F.coalesce((F.col(place) - F.lag(place).over(lines) > tolerance).cast("long"), F.lit(0))
    f = fields.withColumn("_new", new).withColumn("g", F.sum("_new").over(lines.rowsBetween(Window.unboundedPreceding, 0)) + 1).drop("_new")
    off = F.col(place) - F.min(place).over(Window.partitionBy(*by, "g"))
    f = f.withColumn("g", F.when(off > tolerance, F.raise_error(F.concat(F.lit(f"fields lie off the grid by more than {tolerance} in {place}: "), off.cast("string"))).cast("long")).otherwise(F.col("g")))
    mean = f.groupBy(*by, "g").agg(F.avg(at).alias("a"), F.max(size).alias("size"), F.max(offset).alias("offset"))
    full, w = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("g")
    b = (F.col("a") + F.col("size") + F.lead("a").over(w)) / 2
    mean = mean.withColumn("last", F.max("g").over(full)).withColumn("b", b).withColumn("d", F.lead("b").over(w) - F.col("b"))
    near = F.abs(F.col("d") - F.avg("d").over(full)) <= F.stddev_pop("d").over(full)
    mean = mean.withColumn("near", near).withColumn("m", F.avg(F.when(F.col("near"), F.col("d"))).over(full)).withColumn("r", F.col("b") - F.col("m") * F.col("g"))
    for name, order in (("up", F.col("g")), ("down", F.desc("g"))):
        before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        n, error = F.count("r").over(before), F.stddev_pop("r").over(before)
        off = F.abs(F.col("r") - F.avg("r").over(before))
        mean = mean.withColumn(name, F.col("b").isNotNull() & (n >= 2) & (off * F.sqrt(n) > jump * error))
    first = F.min(F.when(F.col("up"), F.col("g"))).over(full)
    end = F.max(F.when(F.col("down"), F.col("g"))).over(full)
    mean = mean.withColumn("from", F.coalesce(first, F.col("last"))).withColumn("to", F.coalesce(end, F.lit(0)))
    left = F.avg(F.when(F.col("g") < F.col("from"), F.col("r"))).over(full)
    right = F.avg(F.when(F.col("g") > F.col("to"), F.col("r"))).over(full)
    only = F.max("b").over(full)
    middle = F.col("a") + F.col("size") / 2
    low = F.when(F.col("last") > 2, left).when(F.col("last") == 2, only - F.col("offset")).otherwise(middle - F.col("offset") / 2)
    high = F.when(F.col("last") > 2, right + F.col("m") * F.col("last")).when(F.col("last") == 2, only + F.col("offset")).otherwise(middle + F.col("offset") / 2)
    mean = mean.withColumn("outer_low", low).withColumn("outer_high", high)
    borders = mean.select(*by, "g", "last", F.coalesce(F.lag("b").over(w), "outer_low").alias("low"), F.coalesce("b", "outer_high").alias("high"))
    return f.select(*by, "n", "g").join(merged(borders), [*by, "g"])


def primary_regions(fields: DataFrame, overlaps: DataFrame, by: list[str], tolerance: float = 0.0) -> DataFrame:
    """(by, n, mx1, mx2, my1, my2) of fields(by, n, cx, cy, px, py, w, h, offset_x, offset_y).

    Where a field has no neighbour on a side its own border counts, and so it does
    at a group's outermost line if the region would go beyond it. overlaps(by, p2,
    tag) names each field's neighbours by direction; `tolerance` is that of grid lines.
    """
    tags = overlaps.groupBy(*by, F.col("p2").alias("n")).agg(F.collect_set("tag").alias("tags"))
    x = axis_regions(fields, by, "cx", "px", "w", "offset_x", tolerance=tolerance).withColumnsRenamed({"g": "gx", "last": "lx", "low": "mx1", "high": "mx2"})
    y = axis_regions(fields, by, "cy", "py", "h", "offset_y", tolerance=tolerance).withColumnsRenamed({"g": "gy", "last": "ly", "low": "my1", "high": "my2"})
    r = fields.join(merged(x), [*by, "n"]).join(merged(y), [*by, "n"]).join(merged(tags), [*by, "n"], "left").withColumn("tags", F.coalesce("tags", F.array().cast("array<int>")))

    def side(border: str, own: Column, outermost: Column, beyond: Column, *near: int) -> Column:
        alone = ~F.arrays_overlap("tags", F.array(*[F.lit(t) for t in near]))
        return F.when(alone | (outermost & beyond), own).otherwise(F.col(border)).alias(border)

    right, bottom = F.col("px") + F.col("w"), F.col("py") + F.col("h")
    return r.select(
        *by, "n",
        side("mx1", F.col("px"), F.col("gx") == 1, F.col("mx1") < F.col("px"), 1, 4, 7), side("mx2", right, F.col("gx") == F.col("lx"), F.col("mx2") > right, 3, 6, 9),
        side("my1", F.col("py"), F.col("gy") == 1, F.col("my1") < F.col("py"), 1, 2, 3), side("my2", bottom, F.col("gy") == F.col("ly"), F.col("my2") > bottom, 7, 8, 9),
    )


def common_area(dx: Column, dy: Column, w: Column, h: Column, clip: int = 8) -> Column:
    """Pixels that two fields share, without `clip` pixels at each border; 0 if nothing is left."""
    side = lambda size, d: F.greatest(F.lit(0), F.floor(size - F.abs(d)) - 2 * clip)
    return side(w, dx) * side(h, dy)


def tiles_covered(rects: DataFrame, tile: int) -> DataFrame:
    """One row per rectangle and tile of a square grid that it touches, with the clipped overlap."""
    x, y = F.col("cx"), F.col("cy")
    t = rects.withColumn("tx", F.explode(F.sequence(F.floor(x / tile), F.floor((x + F.col("w") - 1) / tile)))).withColumn("ty", F.explode(F.sequence(F.floor(y / tile), F.floor((y + F.col("h") - 1) / tile))))
    wide = F.least(x + F.col("w"), (F.col("tx") + 1) * tile) - F.greatest(x, F.col("tx") * tile)
    high = F.least(y + F.col("h"), (F.col("ty") + 1) * tile) - F.greatest(y, F.col("ty") * tile)
    return t.select("slide_id", "n", "tx", "ty", wide.alias("wide"), high.alias("high"))
