"""Golden values, invariants and comparisons with plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from histoweave.functions import polygons as P
from histoweave.operators import components, fit, graph, relational, spatial, workflow
import plain_images
import plain_kernels as kernels
from histoweave.sources import tables as S
from histoweave.streaming import status


def test_polygon_areas(spark):
    one = P.ring(*[(F.lit(x), F.lit(y)) for x, y in ((1, 1), (2, 1), (2, 2), (1, 2))])
    square = lambda at, side: P.box(F.lit(at), F.lit(at), F.lit(side), F.lit(side))
    holed, nested = F.array(square(0, 3), square(1, 1)), F.array(square(0, 8), square(1, 6), square(2, 4))
    row = spark.range(1).select(P.signed_area(one), P.perimeter(one), P.nested_area(holed), P.nested_perimeter(holed), P.nested_area(nested), P.nested_perimeter(nested)).first()
    assert tuple(row) == (1, 4, 8, 16, 44, 72)


def test_wkt_round_trip_and_null_polygon(spark):
    df = spark.createDataFrame([("POLYGON ((0 0,4 0,4 3,0 3,0 0),(1 1,2 1,2 2,1 2,1 1))",), ("poly",), (None,)], "w string")
    got = [r[0] for r in df.select(P.to_wkt(P.from_wkt(F.col("w")))).collect()]
    assert got == ["POLYGON ((0 0,4 0,4 3,0 3,0 0),(1 1,2 1,2 2,1 2,1 1))", None, None]


def test_bucketed_overlaps_are_the_naive_ones(spark):
    rng = random.Random(4)
    rects = [(s, n, rng.randrange(-900, 900), rng.randrange(-900, 900), rng.randrange(20, 200), rng.randrange(20, 200)) for s in range(3) for n in range(60)]
    df = spark.createDataFrame(rects, "slide_id long, n long, cx long, cy long, w long, h long")
    got = {(r.slide_id, r.p1, r.p2) for r in spatial.box_overlaps(df).collect()}
    want = {(a[0], a[1], b[1]) for a in rects for b in rects if a[0] == b[0] and a[1] != b[1] and abs(a[2] - b[2]) < a[4] and abs(a[3] - b[3]) < a[5]}
    assert got == want


def test_components_on_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 540)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[k] == 500 for k in range(500, 540)) and got[7] == 7 and 3 not in got


def test_components_look_hubs_up_apart(spark, monkeypatch):
    import random

    monkeypatch.setattr(components, "DEGREE", 3)
    monkeypatch.setattr(components, "SHARE", 0.0)
    rng = random.Random(3)
    for size, links in ((60, 30), (60, 80), (40, 39)):
        edges = [(rng.randrange(size), rng.randrange(size)) for _ in range(links)] + [(0, k) for k in range(100, 120)] + [(200, k) for k in range(101, 120, 3)]
        root = {n: n for e in edges for n in e}
        for _ in root:
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        got = {r.node: r.component for r in components.components(spark.createDataFrame([*edges, (None, 5)], "a long, b long")).collect()}
        assert got == root


def test_stitch_recovers_planted_positions(spark):
    rng = np.random.default_rng(1)
    true = {n: (n % 4 * 100 + rng.normal(), n // 4 * 80 + rng.normal()) for n in range(12)}
    rects = spark.createDataFrame([(1, n, n % 4 * 100, n // 4 * 80) for n in true], "slide_id long, n long, cx long, cy long")
    pairs = [(1, a, b, true[a][0] - true[b][0] - (a % 4 - b % 4) * 100.0, true[a][1] - true[b][1] - (a // 4 - b // 4) * 80.0, 1.0, 1.0, 0) for a in true for b in true if a != b and abs(a % 4 - b % 4) <= 1 and abs(a // 4 - b // 4) <= 1]
    got = fit.stitch(rects, spark.createDataFrame([tuple(float(x) if isinstance(x, np.floating) else x for x in p) for p in pairs], "slide_id long, p1 long, p2 long, dx double, dy double, covxx double, covyy double, exit int"), 1e-6).toPandas().set_index("n")
    shift = got.loc[0, "px"] - true[0][0]
    assert all(abs(got.loc[n, "px"] - true[n][0] - shift) < 1e-3 for n in true)


def test_shift_of_rolled_image_and_labels():
    a = np.random.default_rng(2).normal(size=(32, 32))
    dx, dy, leave = kernels.compute_shift(np.roll(a, (3, -5), (0, 1)), a)
    assert (round(dx), round(dy), leave) == (-5, 3, 0)
    mask = np.array([[1, 0, 0, 1], [0, 1, 0, 0], [0, 0, 0, 1], [1, 0, 0, 1]], bool)
    assert kernels.label(mask).tolist() == [[1, 0, 0, 2], [0, 1, 0, 0], [0, 0, 0, 3], [4, 0, 0, 3]]
    assert kernels.label(np.zeros((2, 2), bool)).max() == 0


def test_surface_fit(spark):
    rows = [(1, float(x), float(y), 2 + 3 * x - y + 0.5 * x * x + x * y - 2 * y * y) for x in range(5) for y in range(5)]
    got = {r.term: round(r.value, 6) for r in fit.quadratic_surface(spark.createDataFrame(rows, "k long, x double, y double, v double"), "k", "x", "y", "v").collect()}
    assert got == {"x0y0": 2, "x1y0": 3, "x0y1": -1, "x2y0": 0.5, "x1y1": 1, "x0y2": -2}


def test_numbering_and_duplicates(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(50)], "o long, k long")
    assert [r.number for r in relational.number_rows(df, ["o"]).orderBy("o").collect()] == list(range(1, 51))
    got = relational.renumber_duplicates(df, "k", "o").collect()
    assert len({r.k for r in got}) == 50 and {r.k for r in got if r.o < 7} == set(range(7))


def test_filter_chain_names_first_or_all_reasons(spark):
    df = spark.createDataFrame([(1, 1), (0, 9), (None, 1)], "a int, b int")
    checks = [("a", F.col("a") == 1), ("b", F.col("b") < 5)]
    assert [r.reason for r in relational.filter_chain(df, checks).collect()] == ["", "a", "a"]
    assert [r.reason for r in relational.filter_chain(df, checks, every=True).collect()] == ["", "a,b", "a"]


def plain_stitch(places, pairs, overlap=1.0, jitter=1.0, scales=None, at_point=None):
    """The same fit as whitened rows of one least-squares problem."""
    n, rows, right = len(places), [], []
    at = {k: i for i, k in enumerate(places)}
    nominal = np.array(list(places.values()), float)
    origin = nominal.min(0) if at_point is None else np.array(at_point)
    for k, (p1, p2, dx, dy, cxx, cxy, cyy) in enumerate(pairs):
        half = np.linalg.cholesky(np.linalg.inv([[cxx, cxy], [cxy, cyy]])).T / overlap * np.sqrt(scales[k] if scales else 1.0)
        m = np.zeros((2, 2 * n + 4))
        m[:, 2 * at[p1] : 2 * at[p1] + 2], m[:, 2 * at[p2] : 2 * at[p2] + 2] = half, -half
        rows.append(m)
        right.append(half @ (np.array([dx, dy]) + nominal[at[p1]] - nominal[at[p2]]))
    for axis, k in ((0, 4), (1, 6)):
        w = np.array([1 / p[k] for p in pairs])
        sigma = np.sqrt((w * np.array([p[2 + axis] for p in pairs]) ** 2).sum() / w.sum()) * jitter
        for i in range(n):
            m = np.zeros((1, 2 * n + 4))
            m[0, 2 * i + axis] = 1 / sigma
            m[0, 2 * n + 2 * axis : 2 * n + 2 * axis + 2] = -(nominal[i] - origin) / sigma
            rows.append(m)
            right.append([origin[axis] / sigma])
    return np.concatenate(rows), np.concatenate(right)


def test_stitching_with_the_affine_grid(spark):
    rng = np.random.default_rng(23)
    grid = {10 * x + y + 1: (535.0 * x, 400.0 * y) for x in range(4) for y in range(3)}
    pairs = [(a, b, *rng.normal(0, 3, 2).tolist(), 0.5, 0.1, 0.8) for a in grid for b in grid if b < a and abs(grid[a][0] - grid[b][0]) < 600 and abs(grid[a][1] - grid[b][1]) < 450]
    line = {k: (535.0 * k, 0.0) for k in range(1, 5)}
    row = [(k + 1, k, *rng.normal(0, 3, 2).tolist(), 0.5, 0.0, 0.8) for k in range(1, 4)]
    rects = spark.createDataFrame([(1, k, *v) for k, v in grid.items()] + [(2, k, *v) for k, v in line.items()] + [(3, 1, 5.0, 6.0)], "slide_id long, n long, cx double, cy double")
    both = [(1, *p, 0) for p in pairs] + [(1, p[1], p[0], -p[2] + 9, *p[3:], 0) for p in pairs[:5]] + [(2, *p, 0) for p in row] + [(2, 4, 1, 99.0, 99.0, 1.0, 0.0, 1.0, 3)]
    shifts = spark.createDataFrame(both, "slide_id long, p1 long, p2 long, dx double, dy double, covxx double, covxy double, covyy double, exit int")
    got = fit.stitch_affine(rects, shifts).toPandas().sort_values(["slide_id", "n"])
    m, r = plain_stitch(grid, pairs)
    want, cov = np.linalg.lstsq(m, r, rcond=None)[0], np.linalg.inv(m.T @ m)
    one = got[got.slide_id == 1]
    assert np.allclose(one[["px", "py"]].to_numpy().ravel(), want[:-4]) and np.allclose(one[["txx", "txy", "tyx", "tyy"]].to_numpy()[0], want[-4:])
    assert np.allclose(one.cov_xy, [cov[2 * i, 2 * i + 1] for i in range(12)]) and np.allclose(one.cov_yy, np.diag(cov)[1:24:2])
    m, r = plain_stitch(line, row)
    held = m[:, [-3, -1]] @ [0.0, 1.0]
    want = np.linalg.lstsq(np.delete(m, [8 + 1, 8 + 3], 1), r - held, rcond=None)[0]
    two = got[got.slide_id == 2]
    assert np.allclose(two[["px", "py"]].to_numpy().ravel(), want[:8]) and (two.txy == 0).all() and (two.tyy == 1).all()
    three = got[got.slide_id == 3].iloc[0]
    assert (three.px, three.py) == (5.0, 6.0) and np.isnan(three.cov_xx)


@pytest.mark.parametrize("fixed", ["origin", "center", (100.0, -30.0)])
def test_stitching_with_weights_by_tag_and_another_fixed_point(spark, fixed):
    rng = np.random.default_rng(29)
    grid = {10 * x + y + 1: (535.0 * x, 400.0 * y) for x in range(3) for y in range(3)}
    pairs = [(a, b, *rng.normal(0, 3, 2).tolist(), 0.5, 0.1, 0.8) for a in grid for b in grid if b < a and abs(grid[a][0] - grid[b][0]) < 600 and abs(grid[a][1] - grid[b][1]) < 450]
    tags = [int(np.sign(grid[a][0] - grid[b][0]) + 3 * np.sign(grid[a][1] - grid[b][1]) + 5) for a, b, *_ in pairs]
    rects = spark.createDataFrame([(1, k, *v) for k, v in grid.items()], "slide_id long, n long, cx double, cy double")
    shifts = spark.createDataFrame([(1, *p, t, 0) for p, t in zip(pairs, tags)], "slide_id long, p1 long, p2 long, dx double, dy double, covxx double, covxy double, covyy double, tag int, exit int")
    got = fit.stitch_affine(rects, shifts, scale_overlap=0.5, scale_jitter=3.0, scale_edges=2.0, scale_corners=0.25, fixed_point=fixed).toPandas().sort_values("n")
    point = {"origin": None, "center": np.mean(list(grid.values()), 0)}.get(fixed, fixed) if isinstance(fixed, str) else fixed
    m, r = plain_stitch(grid, pairs, 0.5, 3.0, [2.0 if t in (2, 4, 6, 8) else 0.25 for t in tags], point)
    want, cov = np.linalg.lstsq(m, r, rcond=None)[0], np.linalg.inv(m.T @ m)
    assert np.allclose(got[["px", "py"]].to_numpy().ravel(), want[:-4]) and np.allclose(got.cov_xx, np.diag(cov)[0:18:2]) and np.allclose(got[["txx", "txy", "tyx", "tyy"]].to_numpy()[0], want[-4:])


def test_grid_lines_within_a_tolerance(spark):
    fields = [(1, 1, 0.0), (1, 2, 0.4), (1, 3, 100.0), (1, 4, 100.3), (1, 5, 201.0), (2, 1, 5.0)]
    df = spark.createDataFrame([(s, n, x, 10.0, 100.0, 95.0) for s, n, x in fields], "slide_id long, n long, cx double, w double, o double, at double").withColumn("px", F.col("cx"))
    lines = lambda tolerance: {(r.slide_id, r.n): r.g for r in spatial.axis_regions(df, ["slide_id"], "cx", "px", "w", "o", tolerance=tolerance).collect()}
    assert lines(0.5) == {(1, 1): 1, (1, 2): 1, (1, 3): 2, (1, 4): 2, (1, 5): 3, (2, 1): 1}
    assert lines(0.0)[1, 5] == 5
    chain = spark.createDataFrame([(1, n, 0.4 * n, 10.0, 100.0, 0.4 * n) for n in range(4)], "slide_id long, n long, cx double, w double, o double, px double")
    with pytest.raises(Exception, match="off the grid"):
        spatial.axis_regions(chain, ["slide_id"], "cx", "px", "w", "o", tolerance=0.5).collect()


@pytest.mark.parametrize("few", [3, 10_000])
def test_medians_match_the_plain_ones(spark, monkeypatch, few):
    from histoweave.operators import selection

    monkeypatch.setattr(selection, "FEW", few)
    rng = random.Random(4)
    rows = [(g, rng.choice([rng.random(), float(rng.randrange(4)), rng.expovariate(0.001), -1e300, 5e-324])) for g in (1, 2, None) for _ in range(rng.randrange(150, 400))]
    rows += [(7, None), (8, 2.5), (9, 1.0), (9, 2.0), (9, None)] + [(10, 4.0)] * 50 + [(10, float(k)) for k in range(40)]
    got = {r.g: r.m for r in selection.medians(spark.createDataFrame(rows, "g int, v double"), ["g"], "v", "m").collect()}
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).extend([] if v is None else [v])
    assert got == {g: float(np.median(v)) if v else None for g, v in groups.items()}


def test_a_median_of_a_million_distinct_values(spark):
    from histoweave.operators import selection

    df = spark.range(1_000_001).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 1_000_003).cast("double").alias("v"))
    assert selection.medians(df, ["g"], "v").first()["median"] == df.agg(F.expr("median(v)")).first()[0]


@pytest.mark.parametrize("batches", [1, 4])
def test_components_of_batches_are_those_of_all(spark, batches):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5)) + 30
    on = rng.random(200) < 0.7
    rows = spark.createDataFrame([(k, 10 * i, float(x[k, i])) for k in range(200) if on[k] for i in range(5)] + [(900, 0, None), (901, 10, float("nan"))], "k int, i int, x double")
    state = None
    for b in range(batches):
        state = fit.pca_state(rows.where(F.col("k") % batches == b), ["k"], state)
    values, vectors = np.linalg.eigh(np.cov(x[on].T, bias=True))
    components = fit.pca_components(state, 3)
    found = components.toPandas()
    for c, g in found.groupby("component"):
        v = vectors[:, -1 - c]
        v = v * np.sign(v[np.abs(v).argmax()])
        assert np.isclose(g.variance.iloc[0], values[-1 - c], rtol=1e-6) and np.allclose(g.sort_values("i").weight, v, atol=1e-6) and np.allclose(g.sort_values("i")["mean"], x[on].mean(0))
    scores = fit.pca_scores(rows, ["k"], components).where("component = 0 and k < 900").toPandas().set_index("k").score
    v = vectors[:, -1] * np.sign(vectors[np.abs(vectors[:, -1]).argmax(), -1])
    assert np.allclose(scores[np.flatnonzero(on)], (x[on] - x[on].mean(0)) @ v)


def test_fits_of_the_queries_against_numpy(spark):
    from histoweave.plans import QUERIES
    from histoweave.plans.registry import Tables

    sf = "/root/testdata/sf0.001"
    t = Tables(spark, sf)
    m = t.measured.where("exit = 0").toPandas()
    wide = lambda key, by: QUERIES[key](spark, sf).toPandas().pivot(index=by, columns="term", values="value")

    def solved(columns, y, w, errors):
        """Constraints to 0 are further rows."""
        a = np.concatenate([np.column_stack(columns) * np.sqrt(w)[:, None], np.diag([1 / e if e else 0 for e in errors])])
        return np.linalg.lstsq(a, np.concatenate([np.sqrt(w) * y, np.zeros(len(errors))]), rcond=None)[0]

    found = QUERIES["la-03"](spark, sf).toPandas()
    for slide, g in m.groupby("slide_id"):
        one = np.ones(len(g))
        x = [one, (g.p1 * 535) % 1400 / 1400, (g.p2 * 400) % 2100 / 2100, g.p1 % 7, g.p2 % 5]
        for axis, var in (("dx", "covxx"), ("dy", "covyy")):
            mine = found[(found.slide_id == slide) & (found.axis == axis)].set_index("term").value
            assert np.allclose([mine[k] for k in ("one", "rx", "ry", "ix", "iy")], solved(x, g[axis].to_numpy(), 1 / g[var].to_numpy(), (0, 2, 2, 0.05, 0.05)), atol=1e-6)
    found = wide("sp-15", "slide_id")
    for slide, g in m.groupby("slide_id"):
        k = g.p1 % 10
        x = [np.ones(len(g)), k, (k >= 5).astype(float), (k >= 8).astype(float)]
        assert np.allclose(found.loc[slide, ["one", "x", "step1", "step2"]], solved(x, (g.dx - 0.25 * (k >= 3)).to_numpy(), 1 / g.covxx.to_numpy(), (0, 0, 1, 1)), atol=1e-6) and found.loc[slide, "step0"] == 0.25
    found = wide("la-04", "slide_id")
    for slide, g in m.groupby("slide_id"):
        while True:
            x = np.column_stack([np.ones(len(g)), g.p1, g.p2])
            k = np.linalg.lstsq(x, g.dx, rcond=None)[0]
            keep = np.abs(g.dx - x @ k) / (g.covxx * 0.5) <= 5
            if keep.all():
                break
            g = g[keep]
        assert np.allclose(found.loc[slide, ["one", "p1", "p2"]], k, atol=1e-6)
    p = t.pixels.toPandas()
    found = wide("ag-42", "layer")
    for layer, g in p.groupby("layer"):
        x, y = g.pixel % 4, g.pixel // 4
        k = np.linalg.lstsq(np.column_stack([np.ones(len(g)), x, y, x * x, x * y, y * y]), g.v, rcond=None)[0]
        assert np.allclose(found.loc[layer, ["x0y0", "x1y0", "x0y1", "x2y0", "x1y1", "x0y2"]], k)
    c = np.cov(p.pivot(index="vec_id", columns="k", values="v").to_numpy(float).T, bias=True)
    values, vectors = np.linalg.eigh(c)
    for r in QUERIES["ag-34"](spark, sf).toPandas().itertuples():
        v = vectors[:, -1 - r.component]
        assert np.isclose(r.variance, values[-1 - r.component]) and np.isclose(abs(r.weight), abs(v[r.i]), atol=1e-6)


def test_numbering_by_ranges_and_groups(spark):
    import random

    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None, "c"]) if i % 3 else "a", rng.randrange(10**6), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, k long, i long").repartition(4)
    for parts in (1, 5, 23, None):
        got = relational.number_rows(df, ["k", "i"], "pos", ("g",), parts).collect()
        for g in ("a", "b", "c", None):
            assert [r.pos for r in sorted((r for r in got if r.g == g), key=lambda r: (r.k, r.i))] == list(range(1, sum(x[0] == g for x in rows) + 1))
        assert sorted(r.pos for r in relational.number_rows(df, ["k", "i"], "pos", parts=parts).collect()) == list(range(1, 501))
    assert relational.number_rows(df.limit(0), ["k"], "pos", ("g",)).count() == 0


def test_dependency_cycles_are_refused(spark):
    s = spark.createDataFrame([(1, "a", "FINISHED")], "slide_id long, module string, status string")
    with pytest.raises(ValueError):
        workflow.close_over_dependencies(s, [("a", "b"), ("b", "a")])


@pytest.mark.parametrize("start,finish,error,want", [(None, 1, 1, "WAITING"), (1, 5, 3, "ERROR"), (1, 5, 7, "FINISHED"), (6, 5, 3, "RUNNING"), (1, None, 2, "ERROR"), (4, 5, 2, "FINISHED")])
def test_state_by_place(spark, start, finish, error, want):
    row = spark.createDataFrame([(start, finish, error)], "s long, f long, e long").select(workflow.state(F.col("s"), F.col("f"), F.col("e"))).first()
    assert row[0] == want


def test_flags_spread_to_a_fixed_count(spark):
    nodes = spark.createDataFrame([(1, n, int(n in (1, 3))) for n in range(1, 6)], "slide_id long, n long, flag int")
    edges = spark.createDataFrame([(1, a, b) for a, b in ((2, 1), (2, 3), (4, 3), (4, 5), (5, 4))], "slide_id long, p1 long, p2 long")
    assert {r.n for r in graph.flag_closure(nodes, edges).where("flag = 1").collect()} == {1, 2, 3}


def test_csv_reader_refuses_bad_rows_and_order(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x,y\r\n1,2\r\nz,3\r\n")
    with pytest.raises(Exception):
        S.read_csv(spark, str(tmp_path / "a.csv"), "x int, y int").collect()
    with pytest.raises(ValueError):
        S.check_order(spark, str(tmp_path / "a.csv"), spark.createDataFrame([], "y int, x int").schema)
    assert S.check_newlines(spark, str(tmp_path / "a.csv")) == 0


def test_tiff_pages_of_other_byte_orders_and_depths(spark):
    import struct

    from histoweave.sources import tiff

    data = struct.pack(">4H", 1, 300, 65535, 7)
    fields = [(256, 3, 1, struct.pack(">HH", 2, 0)), (257, 3, 1, struct.pack(">HH", 2, 0)), (258, 3, 1, struct.pack(">HH", 16, 0)), (270, 2, 6, struct.pack(">I", 200)), (273, 4, 1, struct.pack(">I", 8)), (279, 4, 1, struct.pack(">I", 8)), (282, 5, 1, struct.pack(">I", 208))]
    whole = b"MM\0*" + struct.pack(">I", 16) + data + struct.pack(">H", len(fields)) + b"".join(struct.pack(">HHI", t, k, n) + v for t, k, n, v in fields) + bytes(4)
    whole = whole.ljust(200, b"\0") + b"hello\0".ljust(8, b"\0") + struct.pack(">II", 20000, 2)
    row = tiff.read_pages(spark.createDataFrame([("a", bytearray(whole))], "path string, content binary")).first()
    assert (row.width, row.height, row.bits, row.description, row.x_resolution, row.y_resolution, row.samples) == (2, 2, 16, "hello", 10000.0, None, [1, 300, 65535, 7])
    with pytest.raises(Exception):
        tiff.read_pages(spark.createDataFrame([("a", bytearray(b"no picture"))], "path string, content binary")).collect()


def test_dense_kernels():
    a = np.random.default_rng(3).normal(size=(12, 12))
    assert np.allclose(kernels.fourier_shift(a, 2, 3), np.roll(a, (3, 2), (0, 1)))
    y, x = np.mgrid[:12, :12].astype(float)
    assert np.allclose(kernels.remap(a, x, y), a) and np.allclose(kernels.remap(3 * x + y, x * 0.5, y * 0.5), 1.5 * x + 0.5 * y)
    assert plain_images.simplify([(0, 0), (1, 0.1), (2, 0), (3, 5), (4, 0)], 0.5) == [(0, 0), (2, 0), (3, 5), (4, 0)]
    t = np.linspace(0, 6, 40)
    assert np.allclose(plain_images.fit_circle(3 + 2 * np.cos(t), -1 + 2 * np.sin(t)), (3, -1, 2))
    assert plain_images.robust_intercept(np.array([1.0, 1.1, 0.9, 1.0, 50.0, 51.0]), 10) == 1.0


@pytest.mark.parametrize("seed", range(8))
def test_outlines_enclose_the_region_s_area(seed):
    rng = np.random.default_rng(seed)
    mask = np.zeros((9, 9), bool)
    at = np.array([4, 4])
    for _ in range(60):
        mask[tuple(at)] = True
        at = np.clip(at + [(0, 1), (0, -1), (1, 0), (-1, 0)][rng.integers(4)], 0, 8)
    free, todo = np.pad(~mask, 1, constant_values=True), [(0, 0)]
    outside = np.zeros_like(free)
    while todo:
        y, x = todo.pop()
        if 0 <= y < 11 and 0 <= x < 11 and free[y, x] and not outside[y, x]:
            outside[y, x] = True
            todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1), (y + 1, x + 1), (y - 1, x - 1), (y + 1, x - 1), (y - 1, x + 1)]
    filled = int((~outside).sum())
    p = kernels.outline(mask)
    area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1]))) / 2
    assert area == filled


@pytest.mark.parametrize("seed", range(6))
def test_contours_of_all_regions_and_holes_restore_the_mask(seed):
    mask = np.random.default_rng(seed).random((9, 9)) < 0.55
    if seed == 0:  # an island in a hole
        mask = np.ones((9, 9), bool)
        mask[1:8, 1:8], mask[3:6, 3:6], mask[4, 4] = False, True, False
    found = kernels.contours(mask)
    by = {k: (depth, parent) for k, depth, parent, _ in found}
    area = sum((-1) ** depth * abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1]))) / 2 for _, depth, _, p in found)
    assert area == mask.sum() and {k for k, (depth, _) in by.items() if depth % 2 == 0} == set(range(1, kernels.label(mask).max() + 1))
    assert all(depth == (by[parent][0] + 1 if parent else 0) for depth, parent in by.values())
    if seed == 0:
        assert by == {1: (0, 0), 2: (2, 3), 3: (1, 1), 4: (3, 2)}


def test_contour_query_has_every_region(spark):
    from histoweave.plans import QUERIES

    rings = QUERIES["sp-10"](spark, "/root/testdata/sf0.001").where("depth % 2 = 0").select("vec_id", "layer", "region").distinct()
    boxes = QUERIES["im-12"](spark, "/root/testdata/sf0.001").select("vec_id", "layer", "region")
    assert rings.count() == boxes.count() and rings.exceptAll(boxes).count() == 0


def test_shift_covariance_grows_with_noise():
    rng = np.random.default_rng(3)
    a = plain_images.smooth(rng.normal(size=(32, 32)), 1.5)
    cov = []
    for noise in (0.0, 0.02, 0.1):
        b = np.roll(a, (2, -3), (0, 1)) + noise * rng.normal(size=a.shape)
        dx, dy, _ = kernels.compute_shift(a, b)
        cov.append(kernels.shift_covariance(a, b, dx, dy))
    assert all(xx > 0 and yy > 0 and xx * yy > xy * xy for xx, xy, yy in cov) and cov[0][0] < cov[1][0] < cov[2][0]


def test_every_polygon_is_rasterised(spark):
    from histoweave.plans import QUERIES
    from histoweave.plans.registry import Tables

    sf = "/root/testdata/sf0.001"
    got = QUERIES["sp-09-all"](spark, sf).select("id")
    want = Tables(spark, sf).poly.select("id")
    assert got.count() == want.count() and want.where("id % 10 != 0").exceptAll(got).count() == 0
