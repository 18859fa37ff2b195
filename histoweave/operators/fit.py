"""Least-squares fits: terms are summed by Spark, and each slide's own small system is solved in a task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.operators.relational import merged


def stitch(rects: DataFrame, shifts: DataFrame, tie: float = 1e-4) -> DataFrame:
    """(slide_id, n, px, py): positions that fit the measured shifts between overlapping fields best.

    A shift of a pair adds (position difference - nominal difference - shift)
    squared over its variance; a weak tie to the nominal places makes the system
    regular. Pairs with p2 < p1 and exit 0 count. x and y are solved apart.
    """
    good = shifts.where("exit = 0 and p2 < p1")
    terms = []
    for axis, d, var in (("x", "dx", "covxx"), ("y", "dy", "covyy")):
        w = 1 / F.col(var)
        pick = lambda i, j, a, b, axis=axis: good.select("slide_id", F.lit(axis).alias("axis"), F.col(i).alias("i"), F.col(j).alias("j"), a.alias("a"), b.alias("b"))
        terms += [pick("p1", "p1", w, w * F.col(d)), pick("p2", "p2", w, -w * F.col(d)), pick("p1", "p2", -w, F.lit(0.0)), pick("p2", "p1", -w, F.lit(0.0))]
    whole = terms[0]
    for t in terms[1:]:
        whole = whole.unionByName(t)
    sums = whole.groupBy("slide_id", "axis", "i", "j").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))

    def solve(places: pd.DataFrame, system: pd.DataFrame) -> pd.DataFrame:
        places = places.sort_values("n")
        at = {n: k for k, n in enumerate(places["n"])}
        out = {}
        for axis, nominal in (("x", "cx"), ("y", "cy")):
            m, r = np.eye(len(at)) * tie, np.zeros(len(at))
            s = system[system["axis"] == axis]
            i, j = s["i"].map(at).to_numpy(), s["j"].map(at).to_numpy()
            np.add.at(m, (i, j), s["a"].to_numpy())
            np.add.at(r, i, s["b"].to_numpy())
            out[axis] = places[nominal].to_numpy() + np.linalg.solve(m, r)
        return pd.DataFrame({"slide_id": places["slide_id"], "n": places["n"], "px": out["x"], "py": out["y"]})

    return rects.select("slide_id", "n", "cx", "cy").groupBy("slide_id").cogroup(sums.groupBy("slide_id")).applyInPandas(solve, "slide_id long, n long, px double, py double")


#: Fields of a slide that are solved together: a dense system of twice as many unknowns.
MOST_FIELDS = 4_000


#: Tags of overlaps along an edge of a field; the others meet at a corner.
EDGES = (2, 4, 6, 8)


def stitch_affine(
    rects: DataFrame, shifts: DataFrame, fixed_error: float = 1e-3, scale_overlap: float = 1.0, scale_jitter: float = 1.0, scale_edges: float = 1.0, scale_corners: float = 1.0, fixed_point: str | tuple[float, float] = "origin"
) -> DataFrame:
    """(slide_id, n, px, py, cov_xx, cov_xy, cov_yy, txx, txy, tyx, tyy): positions of fields and the affine matrix of their grid, fitted together.

    A measured shift adds the squared difference of its two positions from the
    nominal one plus the shift, in its covariance; a field adds that of its
    position from the affine grid through the slide's smallest one, in the shifts'
    own root mean square. A pair counts once, by its direction with p2 < p1 where
    both have exit 0. If all shifts lie along one axis the matrix's other column
    is fixed, and with too few equations its diagonal too. Fields without shifts
    lie on the grid; a slide without shifts keeps its nominal places, with null
    covariances. `scale_overlap` multiplies the shifts' errors and `scale_jitter` that
    of the grid; `scale_edges` and `scale_corners` multiply the weights of overlaps by
    their tag, a column of shifts that is needed if they differ. The grid's fixed
    point is the slide's smallest place ("origin"), the mean of its places
    ("center"), or a given one. Slides of more than MOST_FIELDS fields are refused.
    """
    edge = F.col("tag").isin(*EDGES) if scale_edges != scale_corners else F.lit(True)
    good = shifts.where("exit = 0").select("slide_id", "p1", "p2", "dx", "dy", "covxx", "covxy", "covyy", F.when(edge, scale_edges).otherwise(scale_corners).alias("scale"))
    back = good.where("p2 < p1").select("slide_id", F.col("p2").alias("p1"), F.col("p1").alias("p2"))
    once = good.where("p2 < p1").unionByName(good.where("p2 > p1").join(merged(back), ["slide_id", "p1", "p2"], "left_anti"))

    def solve(places: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        places = places.sort_values("n")
        n, size = len(places), 2 * len(places) + 4
        if n > MOST_FIELDS:
            raise ValueError(f"a slide of {n} fields; {MOST_FIELDS} are solved together")
        at = {k: i for i, k in enumerate(places["n"])}
        nominal = places[["cx", "cy"]].to_numpy(np.float64)
        pairs = pairs[pairs["p1"].isin(at) & pairs["p2"].isin(at)]
        out = places[["slide_id", "n"]].copy()
        if pairs.empty:
            return out.assign(px=nominal[:, 0], py=nominal[:, 1], cov_xx=np.nan, cov_xy=np.nan, cov_yy=np.nan, txx=1.0, txy=0.0, tyx=0.0, tyy=1.0)
        i, j = pairs["p1"].map(at).to_numpy(), pairs["p2"].map(at).to_numpy()
        d = pairs[["dx", "dy"]].to_numpy(np.float64)
        cov = np.empty((len(pairs), 2, 2))
        cov[:, 0, 0], cov[:, 1, 1] = pairs["covxx"], pairs["covyy"]
        cov[:, 0, 1] = cov[:, 1, 0] = pairs["covxy"]
        weight, target = np.linalg.inv(cov) * (pairs["scale"].to_numpy() / scale_overlap**2)[:, None, None], d + nominal[i] - nominal[j]
        a, b = np.zeros((size, size)), np.zeros(size)
        pull = np.einsum("kab,kb->ka", weight, target)
        for r in (0, 1):
            np.add.at(b, 2 * i + r, pull[:, r])
            np.add.at(b, 2 * j + r, -pull[:, r])
            for c in (0, 1):
                for rows, columns, sign in ((i, i, 1), (j, j, 1), (i, j, -1), (j, i, -1)):
                    np.add.at(a, (2 * rows + r, 2 * columns + c), sign * weight[:, r, c])
        origin = nominal.min(0) if fixed_point == "origin" else nominal.mean(0) if fixed_point == "center" else np.array(fixed_point, np.float64)
        away = nominal - origin
        every = np.arange(n)
        for axis, var in ((0, "covxx"), (1, "covyy")):
            w = 1 / pairs[var].to_numpy()
            jitter = 1 / max((w * d[:, axis] ** 2).sum() / w.sum() * scale_jitter**2, 1e-12)
            mine = 2 * every + axis
            t = 2 * n + 2 * axis + np.arange(2)  # the matrix's row of this axis
            a[mine, mine] += jitter
            b[mine] += jitter * origin[axis]
            a[np.ix_(mine, t)] -= jitter * away
            a[np.ix_(t, mine)] -= jitter * away.T
            a[np.ix_(t, t)] += jitter * away.T @ away
            b[t] -= jitter * origin[axis] * away.sum(0)
        fixed: dict[int, float] = {}
        step = nominal[i] - nominal[j]
        if not step[:, 0].any():
            fixed |= {2 * n: 1.0, 2 * n + 2: 0.0}
        if not step[:, 1].any():
            fixed |= {2 * n + 1: 0.0, 2 * n + 3: 1.0}
        equations = 2 * len(pairs) + 2 * n
        for more in ({2 * n + 1: 0.0, 2 * n + 2: 0.0}, {2 * n: 1.0, 2 * n + 3: 1.0}):
            if equations < size - len(fixed):
                fixed |= more
        free = np.array([k for k in range(size) if k not in fixed])
        held, value = np.array(sorted(fixed), np.int64), np.array([fixed[k] for k in sorted(fixed)])
        inverse = np.linalg.inv(a[np.ix_(free, free)])
        found, covariance = np.zeros(size), np.zeros((size, size))
        found[held] = value
        found[free] = inverse @ (b[free] - a[np.ix_(free, held)] @ value)
        covariance[np.ix_(free, free)] = inverse
        covariance[held, held] = fixed_error**2
        x, y = 2 * every, 2 * every + 1
        t = found[2 * n :]
        return out.assign(px=found[x], py=found[y], cov_xx=covariance[x, x], cov_xy=covariance[x, y], cov_yy=covariance[y, y], txx=t[0], txy=t[1], tyx=t[2], tyy=t[3])

    columns = ", ".join(f"{c} double" for c in ("px", "py", "cov_xx", "cov_xy", "cov_yy", "txx", "txy", "tyx", "tyy"))
    return rects.select("slide_id", "n", "cx", "cy").groupBy("slide_id").cogroup(once.groupBy("slide_id")).applyInPandas(solve, f"slide_id long, n long, {columns}")


#: Sums for a quadratic surface: powers of x and y of its six terms.
SURFACE = ((0, 0), (1, 0), (0, 1), (2, 0), (1, 1), (0, 2))


def least_squares(df: DataFrame, by: str, y: str, terms: dict[str, F.Column], weight: F.Column | None = None, expected: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(by, term, value) of weighted least squares; normal equations are sums, solved per group.

    `expected` constrains terms: each adds the squared difference of its value from
    a mean in units of an error, and an error of 0 fixes the term.
    """
    w, names = F.lit(1.0) if weight is None else weight, list(terms)
    sums = [F.sum(w * terms[a] * terms[b]).alias(f"m{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j]
    sums += [F.sum(w * terms[a] * F.col(y)).alias(f"r{i}") for i, a in enumerate(names)]
    table = df.groupBy(by).agg(*sums)

    def solve(frames):
        for pdf in frames:
            rows = []
            held = {names.index(n): (mean, error) for n, (mean, error) in (expected or {}).items()}
            for row in pdf.itertuples(index=False):
                m = np.array([[getattr(row, f"m{min(i, j)}_{max(i, j)}") for j in range(len(names))] for i in range(len(names))])
                r = np.array([getattr(row, f"r{i}") for i in range(len(names))])
                value = np.zeros(len(names))
                for k, (mean, error) in held.items():
                    if error:
                        m[k, k] += 1 / error**2
                        r[k] += mean / error**2
                    else:
                        value[k] = mean
                free = [k for k in range(len(names)) if k not in held or held[k][1]]
                value[free] = np.linalg.lstsq(m[np.ix_(free, free)], (r - m @ value)[free], rcond=None)[0]
                rows += [(getattr(row, by), n, v) for n, v in zip(names, value)]
            yield pd.DataFrame(rows, columns=[by, "term", "value"])

    return table.mapInPandas(solve, f"{by} {df.schema[by].dataType.simpleString()}, term string, value double")


def step_terms(column: F.Column, places: list[float]) -> dict[str, F.Column]:
    """A term for each jump: 1 from its place on, 0 before. Jumps may be any number."""
    return {f"step{k}": (column >= at).cast("double") for k, at in enumerate(sorted(places))}


def quadratic_surface(df: DataFrame, by: str, x: str, y: str, value: str) -> DataFrame:
    return least_squares(df, by, value, {f"x{i}y{j}": F.pow(x, F.lit(i)) * F.pow(y, F.lit(j)) for i, j in SURFACE})


def refit_without_outliers(df: DataFrame, by: str, y: str, terms: dict[str, F.Column], sigma: str, cutoff: float = 5.0, most: int = 5) -> DataFrame:
    """Fit, drop rows whose residual exceeds `cutoff` errors, and fit again until none does."""
    from histoweave.sources.written import cut

    now = cut(df)
    for _ in range(most):
        fit = least_squares(now, by, y, terms)
        wide = cut(fit.groupBy(by).pivot("term", list(terms)).agg(F.first("value")).withColumnsRenamed({n: f"_{n}" for n in terms}))
        pull = F.abs(F.col(y) - sum((F.col(f"_{n}") * c for n, c in terms.items()), F.lit(0.0))) / F.col(sigma)
        kept = cut(now.join(merged(wide), by).where(pull <= cutoff).select(*df.columns))
        if kept.count() == now.count():
            break
        now = kept
    return fit


#: Columns of which the covariance is solved on the driver.
MOST_COLUMNS = 2_000


def principal_components(sums: DataFrame, most: int = 3) -> DataFrame:
    """Leading components of a covariance given as sums by column pair; its size is checked before it is collected."""
    n = (sums.agg(F.max("j")).first()[0] or 0) + 1
    if n > MOST_COLUMNS:
        raise ValueError(f"{n} columns; the covariance of at most {MOST_COLUMNS} is solved on the driver")
    pdf = sums.toPandas()
    c = np.zeros((n, n))
    cov = pdf["product"] / pdf["n"] - pdf["si"] / pdf["n"] * pdf["sj"] / pdf["n"]
    c[pdf["i"], pdf["j"]] = cov
    c[pdf["j"], pdf["i"]] = cov
    values, vectors = np.linalg.eigh(c)
    rows = []
    for k in range(min(most, n)):
        v = vectors[:, -1 - k]
        v = v * np.sign(v[np.abs(v).argmax()])
        rows += [(k, float(values[-1 - k]), i, float(x)) for i, x in enumerate(v)]
    return sums.sparkSession.createDataFrame(pd.DataFrame(rows, columns=["component", "variance", "i", "weight"]))


def pca_state(values: DataFrame, key: list[str], state: DataFrame | None = None) -> DataFrame:
    """(i, j, n, si, sj, product): sums over the keys of values(key, i, x) by pairs of columns i <= j, added to those of earlier batches.

    A key without a value in some column adds to the pairs of its other columns
    alone. Masks are filters of the rows; nulls and NaN are no values.
    """
    row = F.sort_array(F.collect_list(F.struct("i", "x")))  # the columns of one key
    rows = values.where("x is not null and not isnan(x)").groupBy(*key).agg(row.alias("r")).select(F.posexplode("r").alias("p", "a"), "r")
    pairs = rows.select("a", F.explode(F.slice("r", F.col("p") + 1, F.size("r"))).alias("b"))
    x, y = F.col("a.x").cast("double"), F.col("b.x").cast("double")
    new = pairs.groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(F.count("*").alias("n"), F.sum(x).alias("si"), F.sum(y).alias("sj"), F.sum(x * y).alias("product"))
    if state is None:
        return new
    return state.unionByName(new).groupBy("i", "j").agg(*(F.sum(c).alias(c) for c in ("n", "si", "sj", "product")))


def pca_components(state: DataFrame, most: int = 3) -> DataFrame:
    """(component, variance, i, mean, weight) of the leading components of the sums of `pca_state`.

    The sums of at most MOST_COLUMNS columns, which is checked, are one matrix in one
    task, whatever the number of pixels. The largest weight of a component is positive.
    """
    n = state.agg(F.count_distinct("i")).first()[0]
    if n > MOST_COLUMNS:
        raise ValueError(f"{n} columns; the covariance of at most {MOST_COLUMNS} is one matrix")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        names = np.unique(pdf["i"].to_numpy())
        a, b = np.searchsorted(names, pdf["i"]), np.searchsorted(names, pdf["j"])
        c, mean = np.zeros((len(names), len(names))), np.zeros(len(names))
        c[a, b] = c[b, a] = pdf["product"] / pdf["n"] - pdf["si"] / pdf["n"] * (pdf["sj"] / pdf["n"])
        mean[a[a == b]] = (pdf["si"] / pdf["n"]).to_numpy()[a == b]
        values, vectors = np.linalg.eigh(c)
        out = []
        for k in range(min(most, len(names))):
            v = vectors[:, -1 - k]
            v = v * np.sign(v[np.abs(v).argmax()])
            out.append(pd.DataFrame({"component": k, "variance": values[-1 - k], "i": names, "mean": mean, "weight": v}))
        return pd.concat(out)

    return state.groupBy().applyInPandas(solve, f"component int, variance double, i {dict(state.dtypes)['i']}, mean double, weight double")


def pca_scores(values: DataFrame, key: list[str], components: DataFrame) -> DataFrame:
    """(key, component, score): each key's values less the means, along each component; the components are a bounded table."""
    met = values.where("x is not null").join(F.broadcast(components.select("component", "i", "mean", "weight")), "i")
    return met.groupBy(*key, "component").agg(F.sum((F.col("x") - F.col("mean")) * F.col("weight")).alias("score"))
