"""Image operations on pixel tables (keys, x, y, value): neighbourhoods, convolutions, regions, warps and fits as joins and sums.

An image is the rows of one combination of the key columns, of `width` x `height`
pixels. A pixel sends what its neighbours need from it, and one grouping by pixel
gathers that, with partial sums, so no image has to fit a task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histoweave.operators.components import components
from histoweave.operators.relational import merged, number_rows
from histoweave.sources.written import cut, discard

NEAR = tuple((i, j) for j in (-1, 0, 1) for i in (-1, 0, 1))


def _offsets(pairs: tuple[tuple[int, int], ...]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in pairs]))


def neighbourhood(pixels: DataFrame, by: list[str], width: int, height: int, result: Column, offsets: tuple[tuple[int, int], ...] = NEAR) -> DataFrame:
    """(by, x, y, v): `result`, an aggregate of v, over the pixels at the offsets that lie in the image and are in the table."""
    sent = pixels.select(*by, "x", "y", "v", _offsets(offsets).alias("o")).select(*by, (F.col("x") - F.col("o.i")).alias("x"), (F.col("y") - F.col("o.j")).alias("y"), "v")
    inside = F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1)
    return sent.where(inside).groupBy(*by, "x", "y").agg(result.alias("v"))


def dilate(mask: DataFrame, by: list[str], width: int, height: int) -> DataFrame:
    """A mask of 0 and 1 grown by a 3 x 3 square."""
    return neighbourhood(mask, by, width, height, F.max("v"))


def erode(mask: DataFrame, by: list[str], width: int, height: int) -> DataFrame:
    """A mask shrunk by a 3 x 3 square; the image's border doesn't count as unset."""
    return neighbourhood(mask, by, width, height, F.min("v"))


def open_close(mask: DataFrame, by: list[str], width: int, height: int) -> DataFrame:
    for step in (erode, dilate, dilate, erode):
        mask = step(mask, by, width, height)
    return mask


def gaussian(sigma: float, reach: float = 4.0) -> dict[int, float]:
    r = max(1, int(reach * sigma + 0.5))
    k = {o: math.exp(-0.5 * (o / sigma) ** 2) for o in range(-r, r + 1)}
    return {o: w / sum(k.values()) for o, w in k.items()}


def _dealt_taps(axis: str, size: int, taps: dict[int, float]) -> Column:
    """Array of (o, w): how far along an axis a pixel is sent, and with which whole weight; the image goes on mirrored at its borders.

    Only the pixels within the kernel's reach of a border differ from those between.
    """
    reach, s = max(abs(o) for o in taps), F.col(axis).cast("int")
    few = size <= 2 * reach + 1
    rows = []
    for place in range(size) if few else [*range(reach + 1), *range(size - reach, size)]:
        whole: dict[int, float] = {}
        for goal in range(max(0, place - reach), min(size, place + reach + 1)):
            for o, w in taps.items():
                m = (goal + o) % (2 * size)
                if (m if m < size else 2 * size - 1 - m) == place:
                    whole[goal - place] = whole.get(goal - place, 0.0) + w
        rows.append(F.array(*(F.struct(F.lit(o).alias("o"), F.lit(w).alias("w")) for o, w in whole.items())))
    row = s if few else F.least(s, F.lit(reach)) + F.greatest(s - (size - 1 - reach), F.lit(0))
    return F.element_at(F.array(*rows), row + 1)


def convolve(pixels: DataFrame, by: list[str], axis: str, size: int, taps: dict[int, float], *values: str) -> DataFrame:
    """One pass along an axis over value columns, of v by default; the image goes on mirrored at its borders, the edge pixel counting twice.

    Pixels are dealt by lines, so that they move as they are and not once for each tap.
    """
    other, values = "y" if axis == "x" else "x", values or ("v",)
    lines = pixels.select(*by, axis, other, *values).repartition(*by, other)
    sent = lines.select(*by, other, *values, F.col(axis).cast("int").alias("_s"), F.explode(_dealt_taps(axis, size, taps)).alias("g"))
    return sent.groupBy(*by, (F.col("_s") + F.col("g.o")).alias(axis), other).agg(*(F.sum(F.col(v) * F.col("g.w")).alias(v) for v in values))


def smooth(pixels: DataFrame, by: list[str], width: int, height: int, sigma: float, *values: str) -> DataFrame:
    """Separable Gaussian."""
    taps = gaussian(sigma)
    return convolve(convolve(pixels, by, "y", height, taps, *values), by, "x", width, taps, *values)


def laplacian(pixels: DataFrame, by: list[str], width: int, height: int) -> DataFrame:
    """Sum of the four neighbours less four times the pixel, edge pixels standing for what lies outside."""
    second = {-1: 1.0, 0: -2.0, 1: 1.0}
    both = convolve(pixels, by, "x", width, second).unionByName(convolve(pixels, by, "y", height, second))
    return both.groupBy(*by, "x", "y").agg(F.sum("v").alias("v"))


def blur_score(pixels: DataFrame, by: list[str], width: int, height: int, sigma: float = 1.0) -> DataFrame:
    """Local variance of the Laplacian over the local mean."""
    at = [*by, "x", "y"]
    scale = smooth(pixels, by, width, height, sigma).withColumnRenamed("v", "s")
    n = laplacian(pixels, by, width, height).join(merged(scale), at).select(*at, (F.col("v") / (F.abs("s") + 1e-9)).alias("m"))
    both = smooth(n.withColumn("q", F.col("m") * F.col("m")), by, width, height, sigma, "m", "q")
    return both.select(*at, F.greatest(F.lit(0.0), F.col("q") - F.col("m") * F.col("m")).alias("v"))


#: Columns and rows of a tile; its pixels are bits of a long, row by row, without the sign.
WIDE, HIGH = 8, 7


@F.pandas_udf(T.ArrayType(T.LongType()))
def _parts(masks: pd.Series, diagonal: pd.Series) -> pd.Series:
    """The connected regions of each tile, as bits, in order of their first pixel."""
    m, rows = masks.to_numpy("<i8"), np.arange(len(masks))
    on = np.unpackbits(m.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(-1, 8, 8).astype(bool)
    first = np.where(on, np.arange(64, dtype=np.uint8).reshape(8, 8), 64).astype(np.uint8)
    near = [(i, j) for i, j in NEAR if len(m) == 0 or diagonal.iloc[0] or not i or not j]
    while True:
        wide = np.pad(first, ((0, 0), (1, 1), (1, 1)), constant_values=64)
        low = np.where(on, np.min([wide[:, 1 + j : 9 + j, 1 + i : 9 + i] for i, j in near], axis=0), 64).astype(np.uint8)
        if (low == first).all():
            break
        first = low
    row, y, x = np.nonzero(on)
    key = row * 64 + first[row, y, x]
    order = np.argsort(key, kind="stable")
    keys, starts = np.unique(key[order], return_index=True)
    bits = np.bitwise_or.reduceat((np.int64(1) << (y * 8 + x).astype(np.int64))[order], starts) if len(keys) else np.zeros(0, np.int64)
    return pd.Series(np.split(bits, np.searchsorted(keys // 64, rows[1:])) if len(m) else [], index=masks.index, dtype=object)


def _bit(x: str = "x", y: str = "y") -> Column:
    """The bit of a pixel in its tile."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (F.pmod(F.col(y), F.lit(HIGH)) * WIDE + F.pmod(F.col(x), F.lit(WIDE))).cast("int"))


def _tile() -> list[Column]:
    return [F.floor(F.col("x") / WIDE).alias("tx"), F.floor(F.col("y") / HIGH).alias("ty")]


def _pixels(tiles: DataFrame, bits: str, width: int, height: int, like: DataFrame, *keep: str, frame: bool = False) -> DataFrame:
    """A row for each pixel in a column of bits, with x, y of the types of `like`, its `bit` and some columns; of those at a tile's border only, if asked."""
    inner = lambda i, j: 0 < i < WIDE - 1 and 0 < j < HIGH - 1
    places = [(i, j) for j in range(min(HIGH, height)) for i in range(min(WIDE, width)) if not (frame and inner(i, j))]
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(1 << (j * WIDE + i)).cast("long").alias("bit")) for i, j in places]))
    found = tiles.withColumn("_o", each).where(F.col(bits).bitwiseAND(F.col("_o.bit")) != 0)
    x, y = F.col("tx") * WIDE + F.col("_o.i"), F.col("ty") * HIGH + F.col("_o.j")
    return found.select(*keep, x.cast(like.schema["x"].dataType).alias("x"), y.cast(like.schema["y"].dataType).alias("y"), F.col("_o.bit").alias("bit"))


def _pieces(tiles: DataFrame, by: list[str], width: int, height: int, diagonal: bool, like: DataFrame) -> DataFrame:
    """(by, tx, ty, r, first): the parts r of regions in tiles(by, tx, ty, m), each with the place of its whole region's first pixel.

    Only pixels at the borders of tiles are linked by components; an image of one tile has none.
    """
    parts = tiles.where(F.col("m") != 0).dropna(subset=by).select(*by, "tx", "ty", F.explode(_parts("m", F.lit(diagonal))).alias("r"))
    place = F.bit_count(F.col("r").bitwiseAND(-F.col("r")) - 1)
    first = (F.col("ty") * HIGH + F.floor(place / WIDE)) * width + F.col("tx") * WIDE + place % WIDE
    parts = parts.withColumn("first", first)
    if width <= WIDE and height <= HIGH:
        return parts
    parts = cut(parts)
    images = number_rows(parts.select(*by).distinct(), list(by), "_image")
    on = cut(parts.join(merged(images), by).withColumn("id", F.col("_image") * (width * height) + F.col("first")).drop("_image"))
    frame = _pixels(on, "r", width, height, like, *by, "tx", "ty", "id", frame=True)
    steps = ((1, 0), (0, 1), (1, 1), (-1, 1)) if diagonal else ((1, 0), (0, 1))
    sent = frame.select(*by, "tx", "ty", F.col("id").alias("a"), "x", "y", _offsets(steps).alias("o")).withColumns({"x": F.col("x") + F.col("o.i"), "y": F.col("y") + F.col("o.j")})
    tx, ty = _tile()
    sent = sent.where((tx != F.col("tx")) | (ty != F.col("ty"))).select(*by, "x", "y", "a")
    pairs = sent.join(merged(frame.select(*by, "x", "y", F.col("id").alias("b"))), [*by, "x", "y"]).select("a", "b").distinct()
    found = components(pairs).withColumnRenamed("node", "id")
    whole = on.join(merged(found), "id", "left").withColumn("first", F.coalesce("component", "id") % (width * height))
    return whole.select(*by, "tx", "ty", "r", "first")


def regions(mask: DataFrame, by: list[str], width: int, height: int, diagonal: bool = True) -> DataFrame:
    """(by, x, y, region): connected regions of the rows of a mask, numbered from 1 in each image in order of their first pixel.

    They are found in tiles of 8 x 7 pixels, and those that go on beyond a tile are linked.
    """
    tiles = mask.groupBy(*by, *_tile()).agg(F.bit_or(_bit()).alias("m"))
    found = _pieces(tiles, by, width, height, diagonal, mask)
    heads = found.select(*by, "first").distinct()
    number = F.row_number().over(Window.partitionBy(*by).orderBy("first")).alias("region")
    named = found.join(merged(heads.select(*by, "first", number)), [*by, "first"])
    return _pixels(named, "r", width, height, mask, *by, "region").select(*by, "x", "y", "region")


def boxes(labelled: DataFrame, by: list[str]) -> DataFrame:
    """Bounding box and area of each region."""
    size = lambda c: (F.max(c) - F.min(c) + 1).alias("w" if c == "x" else "h")
    return labelled.groupBy(*by, "region").agg(F.min("x").alias("x"), F.min("y").alias("y"), size("x"), size("y"), F.count("*").alias("area"))


def trim_tails(mask: DataFrame, by: list[str], most: int = 1_000) -> DataFrame:
    """The rows of a mask without pixels of fewer than two neighbours, taken away until none is left."""
    now = cut(mask.select(*by, "x", "y").dropna())
    places = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(1 << k).alias("bit")) for k, (i, j) in enumerate(NEAR)]))
    own = 1 << NEAR.index((0, 0))
    for _ in range(most):
        # a pixel marks itself and its neighbours, each by a bit of its own
        sent = now.select(*by, "x", "y", places.alias("o")).select(*by, (F.col("x") + F.col("o.i")).alias("x"), (F.col("y") + F.col("o.j")).alias("y"), "o.bit")
        marks = sent.groupBy(*by, "x", "y").agg(F.bit_or("bit").alias("m"))
        before, now = now, cut(marks.where((F.col("m").bitwiseAND(own) != 0) & (F.bit_count("m") >= 3)).drop("m"))
        done = before.count() == now.count()
        discard(before)
        if done:
            return now
    raise RuntimeError(f"tails did not end in {most} rounds")


def fourier_shift(pixels: DataFrame, by: list[str], width: int, height: int, dx: float, dy: float) -> DataFrame:
    """Images moved by a part of a pixel, periodic at their borders: the inverse transform of the turned transform, as two passes of its kernel."""

    def kernel(n: int, d: float) -> list[tuple[float, float]]:
        """Real and imaginary part by the distance of target and source, modulo n."""
        turns = [(k if k < (n + 1) // 2 else k - n) / n for k in range(n)]
        return [(sum(math.cos(2 * math.pi * f * (i - d)) for f in turns) / n, sum(math.sin(2 * math.pi * f * (i - d)) for f in turns) / n) for i in range(n)]

    def sent(df: DataFrame, axis: str, n: int, d: float, *values: str) -> DataFrame:
        taps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(re).alias("re"), F.lit(im).alias("im")) for i, (re, im) in enumerate(kernel(n, d))])
        return df.withColumn("k", F.explode(taps)).withColumn(axis, F.pmod(F.col(axis) + F.col("k.i"), F.lit(n)))

    one = sent(pixels, "x", width, dx).groupBy(*by, "x", "y").agg(F.sum(F.col("v") * F.col("k.re")).alias("re"), F.sum(F.col("v") * F.col("k.im")).alias("im"))
    return sent(one, "y", height, dy).groupBy(*by, "x", "y").agg(F.sum(F.col("re") * F.col("k.re") - F.col("im") * F.col("k.im")).alias("v"))


QUAD = ((0, 0), (1, 0), (0, 1), (1, 1))


def quads(pixels: DataFrame, by: list[str], value: str = "v") -> DataFrame:
    """(by, sx, sy, v00, v10, v01, v11): the values at (sx, sy) and to the right, below and right below of it, null where there is none."""
    sent = pixels.select(*by, "x", "y", value, _offsets(QUAD).alias("o")).select(*by, (F.col("x").cast("long") - F.col("o.i")).alias("sx"), (F.col("y").cast("long") - F.col("o.j")).alias("sy"), value, "o")
    corner = lambda i, j: F.sum(F.when((F.col("o.i") == i) & (F.col("o.j") == j), F.col(value))).alias(f"v{i}{j}")
    return sent.groupBy(*by, "sx", "sy").agg(*(corner(i, j) for i, j in QUAD))


def sampled(goals: DataFrame, corners: DataFrame, by: list[str], width: int, height: int, mx: Column, my: Column) -> DataFrame:
    """`goals` with v, the bilinear sample at the places (mx, my), expressions of their columns, clamped to the borders, of the images of `quads`; goals without a pixel there go."""
    c = lambda m, n: F.least(F.greatest(m, F.lit(0.0)), F.lit(n - 1.0))
    at = goals.withColumns({"mx": c(mx, width), "my": c(my, height)})
    at = at.withColumns({"sx": F.least(F.floor("mx"), F.lit(width - 2)), "sy": F.least(F.floor("my"), F.lit(height - 2))})
    u, v = F.col("mx") - F.col("sx"), F.col("my") - F.col("sy")
    parts = [F.coalesce(F.col(f"v{i}{j}") * ((u if i else 1 - u) * (v if j else 1 - v)), F.lit(0.0)) for i, j in QUAD]
    return at.join(merged(corners), [*by, "sx", "sy"]).select(*(F.col(k) for k in goals.columns), sum(parts[1:], parts[0]).alias("v"))


def remap(pixels: DataFrame, by: list[str], width: int, height: int, mx: Column, my: Column) -> DataFrame:
    """Bilinear samples of images at the places (mx, my), expressions of x and y, clamped to the borders."""
    return sampled(pixels.select(*by, "x", "y"), quads(pixels, by), by, width, height, mx, my)


def radial_places(width: int, height: int, k: float) -> tuple[Column, Column]:
    """Where a pixel of a radially corrected image comes from."""
    cx, cy, unit = (width - 1) / 2, (height - 1) / 2, max(width, height) / 2
    x, y = F.col("x") - cx, F.col("y") - cy
    r2 = (x * x + y * y) / unit**2
    return cx + x * (1 + k * r2), cy + y * (1 + k * r2)


def otsu_by_skew(pixels: DataFrame, by: list[str], most: int = 5) -> DataFrame:
    """(by, threshold): Otsu thresholds of what lies below the last one; the one after which the skew of the rest drops most.

    From sums of a histogram's whole counts, so equal costs are equal. 0 without a threshold.
    """
    hist = pixels.groupBy(*by, "v").agg(F.count("*").cast("double").alias("n"))
    full, upto = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    v = F.col("v").cast("double")
    powers = {f"s{i}": F.col("n") * v**i if i else F.col("n") for i in range(4)}
    now = hist.withColumn("limit", F.lit(None).cast("long")).withColumn("found", F.array().cast("array<struct<at:long,skew:double>>"))
    for _ in range(most):
        here = F.col("limit").isNull() | (F.col("v") < F.col("limit"))
        sums = {name: F.sum(F.when(here, value).otherwise(0.0)) for name, value in powers.items()}
        now = now.withColumns({name: s.over(full) for name, s in sums.items()} | {f"b{i}": F.coalesce(sums[f"s{i}"].over(upto), F.lit(0.0)) for i in range(3)})
        low = F.col("b2") - F.try_divide(F.col("b1") * F.col("b1"), F.col("b0"))
        rest = [F.col(f"s{i}") - F.col(f"b{i}") for i in range(3)]
        cost = F.when(here & (F.col("b0") > 0), low + (rest[2] - F.try_divide(rest[1] * rest[1], rest[0])))
        share = lambda x: F.try_divide(x, F.col("s0"))
        mean = share(F.col("s1"))
        var = share(F.col("s2")) - mean * mean
        skew = F.try_divide(share(F.col("s3")) - share(3 * mean * F.col("s2")) + 2 * mean * mean * mean, var * F.sqrt(var))
        going = (F.col("s0") >= 3) & (F.col("s0") * F.col("s2") > F.col("s1") * F.col("s1")) & (F.col("limit").isNull() | (F.size("found") > 0))
        best = F.min(F.when(cost.isNotNull(), F.struct(cost.alias("c"), F.col("v").alias("at")))).over(full)["at"]
        now = now.withColumn("best", F.when(going, best)).withColumn("skew", skew)
        now = now.withColumn("found", F.when(F.col("best").isNotNull(), F.concat("found", F.array(F.struct(F.col("best").alias("at"), F.col("skew").alias("skew"))))).otherwise(F.col("found")))
        # where nothing was found the limit is below all values, which ends the search
        now = now.withColumn("limit", F.coalesce("best", F.lit(-(2**62)))).select(*by, "v", "n", "limit", "found")
    found = now.groupBy(*by).agg(F.first("found").alias("f"))
    drops = F.transform(F.sequence(F.lit(1), F.size("f") - 1), lambda i: F.struct((F.element_at("f", i)["skew"] - F.element_at("f", i + 1)["skew"]).alias("drop"), (-i).alias("order"), F.element_at("f", i + 1)["at"].alias("at")))
    pick = F.when(F.size("f") == 0, F.lit(0).cast("long")).when(F.size("f") == 1, F.col("f")[0]["at"]).otherwise(F.array_max(drops)["at"])
    return found.select(*by, pick.cast("double").alias("threshold"))


def robust_intercept(pixels: DataFrame, by: list[str], order: str, sigmas: float) -> DataFrame:
    """(by, intercept): mean of the values before the first that lies over `sigmas` running deviations from the running mean, of three at least; else of all."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    v = F.col("v").cast("double")
    n, s, q = F.count("v").over(w), F.sum(v).over(w), F.sum(v * v).over(w)
    run = pixels.select(*by, order, v.alias("v"), n.alias("n"), F.try_divide(F.sqrt(F.greatest(n * q - s * s, F.lit(0.0))), n).alias("deviation"), F.try_divide(s, n).alias("mean"))
    jump = (F.col("n") >= 3) & (F.abs(F.col("v") - F.col("mean")) > sigmas * F.greatest("deviation", F.lit(1e-6)))
    first = F.min(F.when(jump, F.struct(F.col(order), F.col("mean"))))["mean"]
    return run.groupBy(*by).agg(F.coalesce(first, F.avg("v")).alias("intercept"))


def fit_circle(points: DataFrame, by: list[str]) -> DataFrame:
    """(by, cx, cy, radius): the algebraic least-squares circle of points (x, y), from centred sums alone; null where they lie on a line."""
    mean = points.groupBy(*by).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"))
    p = points.join(merged(mean), by).select(*by, "mx", "my", (F.col("x") - F.col("mx")).alias("u"), (F.col("y") - F.col("my")).alias("v"))
    u, v = F.col("u"), F.col("v")
    z = u * u + v * v
    s = p.groupBy(*by).agg(*[F.sum(e).alias(n) for n, e in (("uu", u * u), ("uv", u * v), ("vv", v * v), ("uz", u * z), ("vz", v * z), ("z", z))], F.count("*").alias("n"), F.first("mx").alias("mx"), F.first("my").alias("my"))
    det = 2 * (F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv"))
    cu = F.try_divide(F.col("uz") * F.col("vv") - F.col("vz") * F.col("uv"), det)
    cv = F.try_divide(F.col("vz") * F.col("uu") - F.col("uz") * F.col("uv"), det)
    return s.select(*by, (F.col("mx") + cu).alias("cx"), (F.col("my") + cv).alias("cy"), F.sqrt(F.col("z") / F.col("n") + cu * cu + cv * cv).alias("radius"))


def simplify(lines: DataFrame, by: list[str], order: str, tolerance: float, most: int = 64) -> DataFrame:
    """(by, x, y, order): Ramer-Douglas-Peucker; ends stay, and in each round the point furthest from its chord if it is over the tolerance.

    All chords of a round are dealt with together; of equally far points the first one stays.
    """
    ends = lines.groupBy(*by).agg(F.min(order).alias("lo"), F.max(order).alias("hi"))
    now = cut(lines.select(*by, order, "x", "y").join(merged(ends), by))
    for _ in range(most):
        end = lambda c: now.where(F.col(order) == F.col(c)).select(*by, F.col("lo").alias("l"), F.col("hi").alias("h"), F.col("x").alias(f"x{c}"), F.col("y").alias(f"y{c}"))  # noqa: B023, E731
        inner = now.where((F.col(order) > F.col("lo")) & (F.col(order) < F.col("hi")))
        # an end that two chords share is a row of each of them
        chord = end("lo").join(merged(end("hi")), [*by, "l", "h"])
        far = inner.join(merged(chord.withColumnsRenamed({"l": "lo", "h": "hi"})), [*by, "lo", "hi"])
        dx, dy, qx, qy = F.col("xhi") - F.col("xlo"), F.col("yhi") - F.col("ylo"), F.col("x") - F.col("xlo"), F.col("y") - F.col("ylo")
        length = F.sqrt(dx * dx + dy * dy)
        distance = F.coalesce(F.try_divide(F.abs(dx * qy - dy * qx), length), F.sqrt(qx * qx + qy * qy))
        split = far.groupBy(*by, "lo", "hi").agg(F.max(F.struct(distance.alias("d"), (-F.col(order)).alias("at"))).alias("m")).where(F.col("m.d") > tolerance).select(*by, "lo", "hi", (-F.col("m.at")).alias("split_at"))
        split = cut(split)
        if split.isEmpty():
            break
        both = now.join(merged(split), [*by, "lo", "hi"], "left")
        left = both.select(*by, order, "x", "y", "lo", F.coalesce("split_at", "hi").alias("hi"), F.col("split_at").alias("cut")).where(F.col("cut").isNull() | (F.col(order) <= F.col("cut")))
        right = both.where("split_at is not null").select(*by, order, "x", "y", F.col("split_at").alias("lo"), "hi", F.col("split_at").alias("cut")).where(F.col(order) >= F.col("cut"))
        now = cut(left.unionByName(right).drop("cut"))
    kept = now.where((F.col(order) == F.col("lo")) | (F.col(order) == F.col("hi")))
    return kept.select(*by, order, "x", "y").distinct()


def smooth_errors(pixels: DataFrame, by: list[str], width: int, height: int, sigma: float) -> DataFrame:
    """(by, x, y, v, error) of pixels(by, x, y, v, error): Gaussian smoothing, and the error of the sum if the pixels' errors are independent."""
    taps, at = gaussian(sigma), [*by, "x", "y"]
    squares = _squared(_squared(pixels.withColumn("v", F.col("error") * F.col("error")), by, "y", height, taps), by, "x", width, taps)
    return smooth(pixels, by, width, height, sigma).join(merged(squares.select(*at, F.sqrt("v").alias("error"))), at)


def _squared(squares: DataFrame, by: list[str], axis: str, size: int, taps: dict[int, float]) -> DataFrame:
    """One pass of squared errors; a pixel that comes in several times, by mirroring, comes in with the square of its whole weight."""
    other, whole = "y" if axis == "x" else "x", [dict[int, float]() for _ in range(size)]
    for goal in range(size):
        for o, w in taps.items():
            m = (goal + o) % (2 * size)
            source = m if m < size else 2 * size - 1 - m
            whole[source][goal] = whole[source].get(goal, 0.0) + w
    rows = F.array(*(F.array(*(F.struct(F.lit(g).alias("at"), F.lit(w * w).alias("w")) for g, w in sorted(goals.items()))) for goals in whole))
    sent = squares.select(*by, other, "v", F.explode(F.element_at(rows, F.col(axis).cast("int") + 1)).alias("g"))
    return sent.groupBy(*by, F.col("g.at").alias(axis), other).agg(F.sum(F.col("v") * F.col("g.w")).alias("v"))


def size_filter(mask: DataFrame, by: list[str], width: int, height: int, least: int, values: tuple[int, ...] = (1, 0), diagonal: bool = True) -> DataFrame:
    """A mask of 0 and 1, every pixel a row, without the connected regions of fewer than `least` pixels, first those of ones and then those of zeros; they take the other value."""
    at, one_tile = [*by, "tx", "ty"], width <= WIDE and height <= HIGH
    bits = lambda test: F.coalesce(F.bit_or(F.when(test, _bit())), F.lit(0).cast("long"))
    tiles = mask.groupBy(*by, *_tile()).agg(F.bit_or(_bit()).alias("all"), bits(F.col("v") == 1).alias("b1"), bits(F.col("v") == 0).alias("b0"))
    tiles = tiles if one_tile else cut(tiles)
    for value in values:
        own, other = F.col(f"b{value}"), F.col(f"b{1 - value}")
        if one_tile:
            small = F.aggregate(F.filter("_parts", lambda r: F.bit_count(r) < least), F.lit(0).cast("long"), lambda a, r: a.bitwiseOR(r))
            tiles = tiles.withColumn("_parts", _parts(own, F.lit(diagonal))).withColumn("small", small).drop("_parts")
            for c in by:  # what has no image has no regions
                tiles = tiles.withColumn("small", F.when(F.col(c).isNotNull(), F.col("small")).otherwise(F.lit(0)))
        else:
            found = cut(_pieces(tiles.select(*at, own.alias("m")), by, width, height, diagonal, mask))
            sizes = found.groupBy(*by, "first").agg(F.sum(F.bit_count("r")).alias("n")).where(F.col("n") < least)
            turned = found.join(merged(sizes), [*by, "first"], "left_semi").groupBy(*at).agg(F.bit_or("r").alias("small"))
            tiles = tiles.join(merged(turned), at, "left").withColumn("small", F.coalesce("small", F.lit(0).cast("long")))
        tiles = tiles.withColumns({f"b{value}": own.bitwiseAND(F.bitwise_not("small")), f"b{1 - value}": other.bitwiseOR(F.col("small"))}).drop("small")
        tiles = tiles if one_tile else cut(tiles)
    rows = _pixels(tiles, "all", width, height, mask, *by, "b1", "b0")
    has = lambda c: F.col(c).bitwiseAND(F.col("bit")) != 0
    return rows.select(*by, "x", "y", F.when(has("b1"), 1).when(has("b0"), 0).alias("v"))


def group_votes(layers: DataFrame, by: list[str], groups: dict[str, tuple[int, int]], nuclear: str, share: float = 0.6) -> DataFrame:
    """(by, x, y, v): the tissue mask that layer masks (by, layer, x, y, v of 0 and 1) agree on, by groups of layers from a first to a last one.

    A group sees tissue where all its layers but one at most are set, and background where
    fewer than half are. What the nuclear group and another one see counts; elsewhere
    a pixel is tissue if over `share` of all layers are set.
    """
    count = sum(b - a + 1 for a, b in groups.values())
    sums = {name: F.sum(F.when(F.col("layer").between(a, b), F.col("v")).otherwise(0)) for name, (a, b) in groups.items()}
    votes = layers.groupBy(*by, "x", "y").agg(*(s.alias(f"g{k}") for k, s in enumerate(sums.values())))
    weigh = lambda test: sum((F.when(test(F.col(f"g{k}"), b - a + 1), 10 if name == nuclear else 1).otherwise(0) for k, (name, (a, b)) in enumerate(groups.items())), F.lit(0))
    tissue, background = weigh(lambda g, n: g > n - 2) > 10, weigh(lambda g, n: g < n / 2) > 10
    total = sum((F.col(f"g{k}") for k in range(len(groups))), F.lit(0))
    return votes.select(*by, "x", "y", F.when(background, 0).when(tissue, 1).otherwise((total > share * count).cast("int")).alias("v"))
