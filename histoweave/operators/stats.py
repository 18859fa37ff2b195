"""Image stacks, histograms, thresholds and weighted statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoweave.operators.relational import merged


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.sum(weight)


def image_stack(pixels: DataFrame, mask: Column) -> DataFrame:
    """Per pixel and layer: sum, sum of squares and number of the images whose mask is set there."""
    m = mask.cast("long")
    return pixels.groupBy("pixel", "layer").agg(F.sum(F.col("v") * m).alias("s"), F.sum(F.col("v") * F.col("v") * m).alias("s2"), F.sum(m).alias("n"))


def mean_image(stack: DataFrame) -> DataFrame:
    """Mean and standard error of a stack; a layer's pixels that no image covers count its smallest number of images."""
    least = stack.where("n > 0").groupBy("layer").agg(F.min("n").alias("least"))
    n = F.when(F.col("n") > 0, F.col("n")).otherwise(F.coalesce("least", F.lit(1)))
    mean = F.col("s") / n
    return stack.join(F.broadcast(least), "layer", "left").select("pixel", "layer", mean.alias("mean"), F.sqrt(F.abs(F.col("s2") / n - mean * mean) / n).alias("se"))  # one row a layer


def flatfield(means: DataFrame) -> DataFrame:
    """Mean image over its layer's mean, weighted by inverse squared errors."""
    w = F.when(F.col("se") > 0, 1 / (F.col("se") * F.col("se"))).otherwise(0.0)
    layer = means.groupBy("layer").agg(weighted_mean(F.col("mean"), w).alias("level"))
    return means.join(F.broadcast(layer), "layer").select("pixel", "layer", (F.col("mean") / F.col("level")).alias("flat"))  # one row a layer


def histogram(pixels: DataFrame, *by: str) -> DataFrame:
    return pixels.groupBy(*by, "v").agg(F.count("*").alias("n"))


def otsu(hist: DataFrame, *by: str) -> DataFrame:
    """The bin at which the two classes' weighted variance is least; the smallest of equals.

    Classes are the bins below and from the bin on; each has its share of the
    counts up to and with the bin, or above.
    """
    w = Window.partitionBy(*by).orderBy("v")
    full = Window.partitionBy(*by)
    x, p = F.col("v").cast("double"), F.col("n") / F.sum("n").over(full)
    h = hist.withColumn("p", p).withColumn("q1", F.sum("p").over(w)).withColumn("q2", F.sum("p").over(full) - F.col("q1"))
    below = w.rowsBetween(Window.unboundedPreceding, -1)
    for name, value in (("m", F.col("p") * x), ("k", F.col("p") * x * x)):
        h = h.withColumn(f"{name}1", F.coalesce(F.sum(value).over(below), F.lit(0.0))).withColumn(f"{name}2", F.sum(value).over(full) - F.col(f"{name}1"))
    ok = (F.col("q1") > 1e-9) & (F.col("q2") > 1e-9)
    var = lambda i: F.col(f"k{i}") / F.col(f"q{i}") - (F.col(f"m{i}") / F.col(f"q{i}")) ** 2
    h = h.where(ok).withColumn("cost", F.round(F.col("q1") * var(1) + F.col("q2") * var(2), 6))
    return h.groupBy(*by).agg(F.min(F.struct("cost", "v")).alias("m")).select(*by, F.col("m.v").alias("threshold"))


def moment(hist: DataFrame, order: int, *by: str) -> DataFrame:
    """Standardised central moment of a histogram."""
    mean = hist.groupBy(*by).agg(weighted_mean(F.col("v"), F.col("n")).alias("mu"))
    d = F.col("v") - F.col("mu")
    both = hist.join(mean, list(by))
    return both.groupBy(*by).agg((F.sum(d**order * F.col("n")) / F.sum("n") / F.sqrt(F.sum(d * d * F.col("n")) / F.sum("n")) ** order).alias("moment"))


def index_quantiles(df: DataFrame, value: str, by: str, low: float, high: float) -> DataFrame:
    """(by, low, high): the values at places floor(q n) of the sorted values, from running sums of a histogram."""
    w = Window.partitionBy(by)
    hist = df.groupBy(by, value).agg(F.count("*").alias("times"))
    run = hist.select(by, value, F.sum("times").over(w.orderBy(value)).alias("upto"), F.sum("times").over(w).alias("n"))
    at = lambda q: F.min(F.when(F.col("upto") > F.floor(F.col("n") * q), F.col(value)))
    return run.groupBy(by).agg(at(low).alias("low"), at(high).alias("high"))


def spreads(pixels: DataFrame, central: Column, by: str) -> DataFrame:
    """5 to 95 % spread and deviation over the mean of the whole image, of all of it and of its central part."""
    whole = pixels.groupBy(by).agg(F.avg("v").alias("level"), F.stddev_pop("v").alias("std"), F.stddev_pop(F.when(central, F.col("v"))).alias("central_std"))
    q = index_quantiles(pixels, "v", by, 0.05, 0.95).withColumnsRenamed({"low": "a", "high": "b"})
    c = index_quantiles(pixels.where(central), "v", by, 0.05, 0.95).withColumnsRenamed({"low": "ca", "high": "cb"})
    over = lambda x: F.try_divide(x, F.col("level"))
    return whole.join(q, by).join(c, by, "left").select(by, over(F.col("b") - F.col("a")).alias("spread"), over(F.col("std")).alias("std"), over(F.col("cb") - F.col("ca")).alias("central_spread"), over(F.col("central_std")).alias("central_std"))


def extents(weights: DataFrame, by: str, place: str, weight: str, tail: float = 0.005) -> DataFrame:
    """(by, centre, low, high): rounded centroid, and how far it is to the last place before which less than the tail lies, and to the first up to which more than all but the tail does."""
    sums = weights.groupBy(by, place).agg(F.sum(weight).cast("double").alias("w"))
    full = Window.partitionBy(by)
    run = sums.select(by, place, F.sum("w").over(full.orderBy(place)).alias("upto"), F.sum("w").over(full).alias("total"), F.sum(F.col("w") * F.col(place)).over(full).alias("moment"))
    edge = run.groupBy(by).agg(F.first("total").alias("total"), F.first("moment").alias("moment"), F.max(F.when(F.col("upto") < tail * F.col("total"), F.col(place))).alias("a"), F.min(F.when(F.col("upto") > (1 - tail) * F.col("total"), F.col(place))).alias("b"))
    centre = F.rint(F.try_divide(F.col("moment"), F.col("total"))).cast("long")
    return edge.select(by, centre.alias("centre"), (centre - F.col("a")).alias("low"), (F.col("b") - centre).alias("high"))


def regression(df: DataFrame, by: str, y: str, x1: str, x2: str, weight: Column) -> DataFrame:
    """Weighted least squares of y on two columns and a constant, from sums alone (Cramer's rule)."""
    c = {"a": F.lit(1.0), "b": F.col(x1).cast("double"), "c": F.col(x2).cast("double")}
    sums = [F.sum(weight * c[i] * c[j]).alias(i + j) for i, j in ("aa", "ab", "ac", "bb", "bc", "cc")] + [F.sum(weight * c[i] * F.col(y)).alias(i + "y") for i in "abc"]
    s = df.groupBy(by).agg(*sums)

    def det(m: list[list[str]]) -> Column:
        (a, b, c), (d, e, f), (g, h, i) = [[F.col(x) for x in row] for row in m]
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    rows = [["aa", "ab", "ac"], ["ab", "bb", "bc"], ["ac", "bc", "cc"]]
    right = ["ay", "by", "cy"]
    part = lambda k: det([[right[r] if j == k else rows[r][j] for j in range(3)] for r in range(3)])
    whole = det(rows)
    return s.select(by, *[F.when(F.abs(whole) > 1e-9, part(k) / whole).alias(name) for k, name in enumerate(("constant", "slope1", "slope2"))])


def correct_exposure(value: Column, exposure: Column, median: Column, offset: Column, top: int = 65535) -> Column:
    """Counts at the median exposure; values up to the offset stay."""
    scaled = F.greatest(F.lit(0.0), F.least(F.lit(float(top)), F.rint(offset + median / exposure * (value - offset))))
    return F.when(value > offset, scaled).otherwise(value.cast("double"))


def covariance(pixels: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """Sums for a covariance of pixel columns over keys: (i, j, sum of products, count).

    A key's values are one array in order of the columns, of which the pairs with
    i <= j are made in place and summed in part in each task.
    """
    row = F.sort_array(F.collect_list(F.struct(F.col(column).alias("c"), F.col(value).alias("x"))))
    rows = pixels.groupBy(key).agg(row.alias("r")).select(F.posexplode("r").alias("p", "a"), "r")
    pairs = rows.select(F.col("a.c").alias("i"), F.col("a.x").alias("a"), F.explode(F.slice("r", F.col("p") + 1, F.size("r"))).alias("b"))
    return pairs.groupBy("i", F.col("b.c").alias("j")).agg(F.sum(F.col("a") * F.col("b.x")).alias("product"), F.sum("a").alias("si"), F.sum("b.x").alias("sj"), F.count("*").alias("n"))


def pyramid(pixels: DataFrame, by: list[str], levels: int) -> DataFrame:
    """Mean of the pixels that fall together at each zoom level, by halves in both directions."""
    zoomed = pixels.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    half = lambda c: F.floor(F.col(c) / F.expr("shiftleft(1, level)")).alias(c)
    return zoomed.groupBy(*by, "level", half("x"), half("y")).agg(F.avg("v").alias("v"))


def tiles(zoomed: DataFrame, by: list[str], side: int) -> DataFrame:
    """Tiles of a pyramid that have a pixel over 0, with the number of their pixels and of those that pad them to the full side."""
    at = lambda c: F.floor(F.col(c) / side).alias(f"t{c}")
    found = zoomed.groupBy(*by, "level", at("x"), at("y")).agg(F.max("v").alias("top"), F.count("*").alias("filled"))
    return found.where("top > 0").select(*by, "level", "tx", "ty", "filled", (side * side - F.col("filled")).alias("padded"))


def cut_regression(df: DataFrame, by: str, y: str, x1: str, x2: str, weight: Column, most: float) -> DataFrame:
    """The regression of the rows whose residual in a first one of all rows is at most `most`, with their number."""
    first = regression(df, by, y, x1, x2, weight)
    fitted = F.col("constant") + F.col("slope1") * F.col(x1) + F.col("slope2") * F.col(x2)
    kept = df.join(merged(first), by).where(F.abs(F.col(y) - fitted) <= most)
    return regression(kept, by, y, x1, x2, weight).join(merged(kept.groupBy(by).agg(F.count("*").alias("rows"))), by)
