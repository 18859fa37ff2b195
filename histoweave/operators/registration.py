"""Shifts and turns between images as passes over pixel tables.

Images are pairs (by, x, y, a, b) of `width` x `height` pixels; those that are missing
are 0. Transforms run row by row and column by column: a row of an image is one
array, the largest thing that a task holds, and between passes rows become columns
by a shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoweave.operators.raster import quads, sampled
from histoweave.operators.relational import merged
from histoweave.sources.written import cut, discard

C = F.col
#: Pixels to each side of the correlation's peak that the fit covers, and the degree of the fitted polynomial in x and y.
REACH, DEGREE = 10, 3
STEPS = 40
#: Scale of a shift's error.
ERROR_FACTOR = 0.25
#: The cubic convolution's free parameter.
CUBIC = -0.75


def _placed(at: pd.Series, values: pd.Series, size: int) -> np.ndarray:
    out = np.zeros((len(at), size))
    for i, (k, v) in enumerate(zip(at, values)):
        out[i, np.asarray(k, np.int64)] = v
    return out


def _lists(**columns: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({k: list(v) for k, v in columns.items()})


def correlation(pairs: DataFrame, by: list[str], width: int, height: int) -> DataFrame:
    """(by, sx, sy, z): the circular cross correlation, z = sum of a(x + sx, y + sy) b(x, y)."""
    four, two = "ra array<double>, ia array<double>, rb array<double>, ib array<double>", "re array<double>, im array<double>"

    @F.pandas_udf(four)
    def along_x(x: pd.Series, a: pd.Series, b: pd.Series) -> pd.DataFrame:
        fa, fb = (np.fft.rfft(_placed(x, v, width), axis=1) for v in (a, b))
        return _lists(ra=fa.real, ia=fa.imag, rb=fb.real, ib=fb.imag)

    @F.pandas_udf(two)
    def along_y(y: pd.Series, ra: pd.Series, ia: pd.Series, rb: pd.Series, ib: pd.Series) -> pd.DataFrame:
        fa, fb = (np.fft.fft(_placed(y, r, height) + 1j * _placed(y, i, height), axis=1) for r, i in ((ra, ia), (rb, ib)))
        z = np.fft.ifft(fa * np.conj(fb), axis=1)
        return _lists(re=z.real, im=z.imag)

    @F.pandas_udf("array<double>")
    def back(k: pd.Series, re: pd.Series, im: pd.Series) -> pd.Series:
        half = width // 2 + 1
        return pd.Series(list(np.fft.irfft(_placed(k, re, half) + 1j * _placed(k, im, half), n=width, axis=1)))

    def gathered(df: DataFrame, line: str, at: str, *values: str) -> DataFrame:
        return df.groupBy(*by, line).agg(F.collect_list(F.struct(at, *(C(v).cast("double").alias(v) for v in values))).alias("p"))

    def spread(df: DataFrame, line: str, name: str, *values: str) -> DataFrame:
        return df.select(*by, line, F.posexplode(F.arrays_zip(*(C(f"f.{v}").alias(v) for v in values))).alias(name, "v")).select(*by, line, name, "v.*")

    rows = gathered(pairs, "y", "x", "a", "b").select(*by, "y", along_x("p.x", "p.a", "p.b").alias("f"))
    columns = gathered(spread(rows, "y", "k", "ra", "ia", "rb", "ib"), "k", "y", "ra", "ia", "rb", "ib").select(*by, "k", along_y("p.y", "p.ra", "p.ia", "p.rb", "p.ib").alias("f"))
    lines = gathered(spread(columns, "k", "sy", "re", "im"), "sy", "k", "re", "im").select(*by, "sy", back("p.k", "p.re", "p.im").alias("z"))
    return lines.select(*by, "sy", F.posexplode("z").alias("sx", "z"))


def peak(z: DataFrame, by: list[str], digits: int = 6) -> DataFrame:
    """(by, sx, sy, z) of the largest absolute value, rounded to `digits`; of equals the first row, and in it the first column."""
    best = F.max(F.struct(F.abs(F.round("z", digits)).alias("m"), (-C("sy")).alias("y"), (-C("sx")).alias("x"), "z"))
    return z.groupBy(*by).agg(best.alias("b")).select(*by, (-C("b.x")).alias("sx"), (-C("b.y")).alias("sy"), "b.z")


def _wrapped(s: Column, n: int) -> Column:
    """Shifts above half an image as negative ones."""
    return F.when(s > n / 2, s - n).otherwise(s)


def _near(s: str, at: str, n: int) -> Column:
    return F.pmod(C(s) - C(at) + n // 2, F.lit(n)) - n // 2


def _functionals(n: int, reach: int) -> tuple[int, int, list[list[float]]]:
    """First and last offset of the window along an axis of n pixels, and for each power the weights of the values that give its least-squares coefficient."""
    lo, hi = -min(reach, n // 2), min(reach, n - 1 - n // 2)
    t = np.arange(lo, hi + 1) / reach
    return lo, hi, np.linalg.pinv(np.vander(t, min(DEGREE, hi - lo) + 1, increasing=True)).tolist()


def fitted_peak(z: DataFrame, at: DataFrame, by: list[str], width: int, height: int, reach: int = REACH) -> DataFrame:
    """(by, u, v, top, xx, xy, yy): place of the maximum of the bicubic polynomial fitted around `at`, from there, its value and minus its second derivatives.

    The window is a whole grid, so each coefficient is a sum with known weights. From
    the peak Newton's steps are taken, of a pixel at most and inside the window; where
    the polynomial isn't concave they follow the slope.
    """
    (xl, xh, gx), (yl, yh, gy) = _functionals(width, reach), _functionals(height, reach)
    u, v = _near("sx", "px", width), _near("sy", "py", height)
    near = z.join(merged(at.select(*by, C("sx").alias("px"), C("sy").alias("py"))), by).select(*by, u.alias("u"), v.alias("v"), "z").where(C("u").between(xl, xh) & C("v").between(yl, yh))
    weights = lambda g, c, lo: [F.array(*(F.lit(w) for w in line))[(C(c) - lo).cast("int")] for line in g]
    near = near.select(*by, "z", F.array(*weights(gx, "u", xl)).alias("wx"), F.array(*weights(gy, "v", yl)).alias("wy"))
    powers = [(i, j) for i in range(len(gx)) for j in range(len(gy))]
    c = near.groupBy(*by).agg(*(F.sum(C("z") * C("wx")[i] * C("wy")[j]).alias(f"c{i}{j}") for i, j in powers))

    def falling(n: int, k: int) -> int:
        return n * falling(n - 1, k - 1) if k else 1

    def value(x: Column, y: Column, dx: int = 0, dy: int = 0) -> Column:
        total = F.lit(0.0)
        for i, j in powers:
            if i >= dx and j >= dy:
                term = C(f"c{i}{j}") * float(falling(i, dx) * falling(j, dy))
                for _ in range(i - dx):
                    term = term * x
                for _ in range(j - dy):
                    term = term * y
                total = total + term
        return total

    def step(s: Column, _: Column) -> Column:
        x, y = s["x"], s["y"]
        gx1, gy1, hxx, hxy, hyy = value(x, y, 1), value(x, y, 0, 1), value(x, y, 2), value(x, y, 1, 1), value(x, y, 0, 2)
        det = hxx * hyy - hxy * hxy
        concave = (hxx < 0) & (det > 0)
        sx = F.when(concave, F.try_divide(hxy * gy1 - hyy * gx1, det)).otherwise(F.sign(gx1) * 0.05)
        sy = F.when(concave, F.try_divide(hxy * gx1 - hxx * gy1, det)).otherwise(F.sign(gy1) * 0.05)
        kept = lambda p, d, lo, hi: F.least(F.greatest(p + F.least(F.greatest(d, F.lit(-1 / reach)), F.lit(1 / reach)), F.lit(lo / reach)), F.lit(hi / reach))
        return F.struct(kept(x, sx, xl, xh).alias("x"), kept(y, sy, yl, yh).alias("y"))

    start = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    found = c.withColumn("at", F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step))
    x, y = C("at.x"), C("at.y")
    second = [(-value(x, y, a, b) / reach**2).alias(n) for n, a, b in (("xx", 2, 0), ("xy", 1, 1), ("yy", 0, 2))]
    return found.select(*by, (x * reach).alias("u"), (y * reach).alias("v"), value(x, y).alias("top"), *second)


def _cubic(t: Column) -> Column:
    """Weight of a value at distance t in cubic convolution."""
    t = F.abs(t)
    inner = ((CUBIC + 2) * t - (CUBIC + 3)) * t * t + 1
    outer = ((t - 5) * t + 8) * t * CUBIC - 4 * CUBIC
    return F.when(t <= 1, inner).when(t < 2, outer).otherwise(0.0)


def _line(d: Column) -> Column:
    """Offsets and weights by which a value moved by d is dealt out along an axis."""
    return F.transform(F.sequence(F.lit(-1), F.lit(2)), lambda i: F.struct((F.floor(d) + i).cast("int").alias("o"), _cubic(d - F.floor(d) - i).alias("w")))


def _taps(k: int, dx: Column, dy: Column) -> Column:
    """Offsets and weights in both axes, for value number k."""
    return F.flatten(F.transform(_line(dx), lambda a: F.transform(_line(dy), lambda b: F.struct(F.lit(k).alias("k"), a["o"].alias("ox"), b["o"].alias("oy"), (a["w"] * b["w"]).alias("w")))))


def cubic_shift(pixels: DataFrame, by: list[str], width: int, height: int, moves: DataFrame, values: tuple[str, ...] = ("v",)) -> DataFrame:
    """Each value column moved by (dx_<column>, dy_<column>) of moves(by, ...), a row for each image, by cubic convolution; outside the image is 0."""
    taps = [_taps(k, C(f"dx_{name}"), C(f"dy_{name}")) for k, name in enumerate(values)]
    images = moves.select(*by, F.filter(F.concat(*taps), lambda t: t["w"] != 0).alias("taps"))
    sent = pixels.join(merged(images), by).select(*by, "x", "y", F.array(*(C(v).cast("double") for v in values)).alias("v"), F.explode("taps").alias("t"))
    sent = sent.select(*by, (C("x") + C("t.ox")).alias("x"), (C("y") + C("t.oy")).alias("y"), C("t.k").alias("k"), (C("v")[C("t.k")] * C("t.w")).alias("v"))
    inside = C("x").between(0, width - 1) & C("y").between(0, height - 1)
    return sent.where(inside).groupBy(*by, "x", "y").agg(*(F.sum(F.when(C("k") == k, C("v")).otherwise(0.0)).alias(n) for k, n in enumerate(values)))


def _other_peaks(z: DataFrame, limits: DataFrame, by: list[str], width: int, height: int, reach: int) -> DataFrame:
    """(by): images whose correlation has another local maximum above the limit, away from the main peak and from the border by `reach`."""
    at = z.join(merged(limits), by).where(C("z") >= C("limit")).select(*by, _near("sx", "px", width).alias("u"), _near("sy", "py", height).alias("v"), "z")
    cells = at.withColumn("gu", F.floor(C("u") / reach)).withColumn("gv", F.floor(C("v") / reach))
    around = lambda c: F.explode(F.array(C(c) - 1, C(c), C(c) + 1)).alias(c)
    other = cells.select(*by, C("u").alias("u2"), C("v").alias("v2"), C("z").alias("z2"), around("gu"), "gv").select(*by, "u2", "v2", "z2", "gu", around("gv"))
    inner = C("u").between(reach - width // 2, width - 1 - width // 2 - reach) & C("v").between(reach - height // 2, height - 1 - height // 2 - reach)
    apart = (F.abs("u") >= reach) | (F.abs("v") >= reach)
    higher = cells.where(inner & apart).join(merged(other), [*by, "gu", "gv"]).where((F.abs(C("u") - C("u2")) <= reach) & (F.abs(C("v") - C("v2")) <= reach))
    return higher.groupBy(*by, "u", "v", "z").agg(F.max("z2").alias("m")).where("z = m").select(*by).distinct()


def shifts(pairs: DataFrame, by: list[str], width: int, height: int, reach: int = REACH, error_factor: float = ERROR_FACTOR) -> DataFrame:
    """(by, dx, dy, exit, covxx, covxy, covyy, peak, error) of pairs(by, x, y, a, b): how far b lies from a.

    A bicubic polynomial is fitted to the correlation within `reach` pixels of its
    peak; its maximum is the shift, and its second derivatives with the correlation's
    error give the covariance: 2 * error * error_factor^2 * inverse. The error is that
    of a and b moved onto each other by half the shift each, with their difference as
    both images' errors. Exit 1: another peak within three errors; 2: the polynomial
    is not concave there; 3: the squared shift reaches the image's diagonal; these
    have null covariances. Missing pixels are 0.
    """
    z = cut(correlation(pairs, by, width, height))
    top = cut(peak(z, by))
    fit = top.join(merged(fitted_peak(z, top, by, width, height, reach)), by)
    fit = cut(fit.select(*by, C("sx").alias("px"), C("sy").alias("py"), (_wrapped(C("sx"), width) + C("u")).alias("rx"), (_wrapped(C("sy"), height) + C("v")).alias("ry"), C("z").alias("zmax"), "top", "xx", "xy", "yy"))
    half = fit.select(*by, *((sign * C(r) / 2).alias(f"d{axis}_{v}") for v, sign in (("a", -1), ("b", 1)) for axis, r in (("x", "rx"), ("y", "ry"))))
    moved = cubic_shift(pairs, by, width, height, half, ("a", "b"))
    d = C("a") - C("b")
    error = moved.groupBy(*by).agg(F.sqrt(F.sum(d * d * (C("a") * C("a") + C("b") * C("b")))).alias("error"))
    fit = cut(fit.join(merged(error), by, "left").withColumn("error", F.coalesce("error", F.lit(0.0))))
    crowded = _other_peaks(z, fit.select(*by, "px", "py", (C("zmax") - 3 * C("error")).alias("limit")), by, width, height, reach).withColumn("crowded", F.lit(True))
    det = C("xx") * C("yy") - C("xy") * C("xy")
    concave = (C("xx") > 0) & (C("yy") > 0) & (det > 0) & (C("error") > 0)
    far = C("rx") * C("rx") + C("ry") * C("ry") >= float(np.hypot(width, height))
    code = F.when(far, 3).when(~concave, 2).when(C("crowded"), 1).otherwise(0)
    scale = F.try_divide(2 * C("error") * error_factor**2, det)
    out = fit.join(merged(crowded), by, "left").withColumn("exit", code)
    ok = C("exit") == 0
    cov = [F.when(ok, scale * c).alias(n) for n, c in (("covxx", C("yy")), ("covxy", -C("xy")), ("covyy", C("xx")))]
    return out.select(*by, (-C("rx")).alias("dx"), (-C("ry")).alias("dy"), "exit", *cov, C("top").alias("peak"), "error")


def register(pairs: DataFrame, by: list[str], width: int, height: int, turns: list[float], rounds: int = 3) -> DataFrame:
    """(by, degrees, dx, dy, z): the turn of b about the image's middle at which it correlates best with a, and how far it lies from a then.

    The first round tries `turns`, each further one four turns around the best of the
    last at a third of the distance. Images are taken less their means. Of equal
    correlations the smaller turn counts.
    """
    mean = pairs.groupBy(*by).agg(F.avg("a").alias("ma"), F.avg("b").alias("mb"))
    whole = cut(pairs.join(merged(mean), by).select(*by, "x", "y", (C("a") - C("ma")).alias("a"), (C("b") - C("mb")).alias("b")))
    corners = cut(quads(whole, by, "b"))  # of the images as they are, for all turns
    near = min((b - a for a, b in zip(sorted(turns), sorted(turns)[1:])), default=10.0)
    each = whole.select(*by, "x", "y", "a", F.explode(F.array(*(F.lit(float(t)) for t in turns))).alias("degrees"))
    keys, best, cx, cy = [*by, "degrees"], None, (width - 1) / 2, (height - 1) / 2
    for r in range(rounds):
        t = F.radians("degrees")
        x, y = C("x") - cx, C("y") - cy
        both = sampled(each, corners, by, width, height, cx + x * F.cos(t) - y * F.sin(t), cy + x * F.sin(t) + y * F.cos(t)).withColumnRenamed("v", "b")
        found = peak(correlation(both, keys, width, height), keys)
        found = found if best is None else found.unionByName(best)
        order = Window.partitionBy(*by).orderBy(F.desc(F.round("z", 6)), "degrees")
        last, best = best, cut(found.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n"))
        discard(last)
        near /= 3
        tried = best.select(*by, F.explode(F.array(*(C("degrees") + k * near for k in (-2, -1, 1, 2)))).alias("degrees"))
        each = whole.select(*by, "x", "y", "a").join(merged(tried), by)
    for d in (whole, corners):
        discard(d)
    return best.select(*by, "degrees", (-_wrapped(C("sx"), width)).alias("dx"), (-_wrapped(C("sy"), height)).alias("dy"), "z")
