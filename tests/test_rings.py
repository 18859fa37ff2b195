"""Validity, nesting and ordering of rings against plain tests of points and edges."""

import random
from collections import defaultdict

import pytest

from histoweave.operators import rings


def frame(spark, shapes):
    rows = [(i, r, v, float(x), float(y)) for i, rs in shapes.items() for r, ring in enumerate(rs) for v, (x, y) in enumerate(ring)]
    return spark.createDataFrame(rows, "id long, ring int, vid int, x double, y double")


def pairs(ring):
    return list(zip(ring, ring[1:] + ring[:1]))


def inside(point, rs):
    x, y = point
    return sum((a[0] <= x) != (b[0] <= x) and a[1] + (x - a[0]) * (b[1] - a[1]) / (b[0] - a[0]) > y for r in rs for a, b in pairs(r)) % 2 == 1


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in pairs(ring)) / 2


def collected(out):
    found = defaultdict(lambda: defaultdict(list))
    for r in sorted(out.collect(), key=lambda r: (r.id, r.polygon, r.ring, r.vid)):
        found[r.id][r.polygon, r.area].append((r.ring, (r.x, r.y)))
    return {i: [(a, [[p for r, p in rows if r == k] for k in sorted({r for r, _ in rows})]) for (_, a), rows in sorted(ps.items())] for i, ps in found.items()}


BOX = [(0, 0), (8, 0), (8, 6), (0, 6)]
GOLDEN = {
    "bow tie": ([[(0, 0), (8, 6), (8, 0), (0, 6)]], [(12, [[(0, 0), (4, 3), (0, 6)]]), (12, [[(4, 3), (8, 0), (8, 6)]])]),
    "spike": ([[(0, 0), (8, 0), (8, 6), (8, 13), (8, 6), (0, 6)]], [(48, [BOX])]),
    "spike along an edge": ([[(0, 0), (8, 0), (8, 6), (8, 3), (8, 6), (0, 6)]], [(48, [BOX])]),
    "hole that touches once": ([BOX, [(0, 3), (2, 2), (2, 4)]], [(46, [[(0, 0), (8, 0), (8, 6), (0, 6), (0, 3)], [(0, 3), (2, 4), (2, 2)]])]),
    "nested repeats": ([BOX, BOX, BOX, [(1, 1), (7, 1), (7, 5), (1, 5)], [(2, 2), (6, 2), (6, 4), (2, 4)]], [(24, [BOX, [(1, 1), (1, 5), (7, 5), (7, 1)]]), (8, [[(2, 2), (6, 2), (6, 4), (2, 4)]])]),
    "hole that parts it": ([BOX, [(0, 3), (4, 4), (8, 3), (4, 2)]], [(20, [[(0, 0), (8, 0), (8, 3), (4, 2), (0, 3)]]), (20, [[(0, 3), (4, 4), (8, 3), (8, 6), (0, 6)]])]),
    "two holes that touch": ([BOX, [(1, 1), (4, 1), (4, 3)], [(4, 3), (7, 3), (7, 5)]], [(42, [BOX, [(1, 1), (4, 3), (4, 1)], [(4, 3), (7, 5), (7, 3)]])]),
    "line": ([[(0, 0), (8, 0)], [(3, 3)]], []),
    "repeated twice": ([BOX, BOX], []),
    "figure of two boxes by one corner": ([[(0, 0), (2, 0), (2, 2), (4, 2), (4, 4), (2, 4), (2, 2), (0, 2)]], [(4, [[(0, 0), (2, 0), (2, 2), (0, 2)]]), (4, [[(2, 2), (4, 2), (4, 4), (2, 4)]])]),
}


def test_golden_polygons_are_made_valid(spark):
    shapes = {i: rs for i, (rs, _) in enumerate(GOLDEN.values())}
    got = collected(rings.make_valid(frame(spark, shapes), ["id"], 1))
    for i, (name, (_, want)) in enumerate(GOLDEN.items()):
        assert got.get(i, []) == [(a, [[tuple(map(float, p)) for p in r] for r in rs]) for a, rs in want], name


def test_random_polygons_keep_what_they_cover_an_odd_number_of_times(spark):
    rng = random.Random(8)
    shapes = {i: [[(rng.randrange(-40, 40), rng.randrange(-40, 40)) for _ in range(rng.randrange(3, 9))] for _ in range(rng.randrange(1, 4))] for i in range(40)}
    scale = 64
    got = collected(rings.make_valid(frame(spark, shapes), ["id"], scale))
    for i, rs in shapes.items():
        polygons = got[i]
        assert [a for a, _ in polygons] == sorted((a for a, _ in polygons), reverse=True)
        edges = [(a, b) for _, hs in polygons for r in hs for a, b in pairs(r)]
        ends = {p for e in edges for p in e}
        assert len(edges) == len({frozenset(e) for e in edges})
        for a, hs in polygons:
            assert area(hs[0]) > 0 and all(area(r) < 0 for r in hs[1:]) and abs(sum(map(area, hs)) - a) < 1e-9
            assert all(len(set(r)) == len(r) and r[0] == min(r) for r in hs)
        for (ax, ay), (bx, by) in edges:  # no end lies on another edge
            assert not any((bx - ax) * (y - ay) == (by - ay) * (x - ax) and (x - ax) * (x - bx) + (y - ay) * (y - by) < 0 for x, y in ends)
        for _ in range(200):
            p = (rng.uniform(-41, 41), rng.uniform(-41, 41))
            near = any(abs((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])) <= 3 / scale * (abs(b[0] - a[0]) + abs(b[1] - a[1])) for r in rs for a, b in pairs(r))
            if not near:
                assert [inside(p, hs) for _, hs in polygons].count(True) == inside(p, rs)


def test_a_long_ring_crossed_by_a_comb(spark):
    n = 300
    comb = [(x, 10 if x % 2 else -10) for x in range(n)] + [(n, -20), (-1, -20)]
    got = collected(rings.make_valid(frame(spark, {1: [comb, [(-2, -1), (n + 2, -1), (n + 2, 0), (-2, 0)]]}), ["id"], 400))
    covered = sum(a for a, _ in got[1])
    both = [[(-2, -1), (n + 2, -1), (n + 2, 0), (-2, 0)], comb]
    step, want = 0.25, 0.0
    for k in range(int((n + 6) / step)):
        x = -3 + (k + 0.5) * step
        ys = sorted(a[1] + (x - a[0]) * (b[1] - a[1]) / (b[0] - a[0]) for r in both for a, b in pairs(r) if (a[0] <= x) != (b[0] <= x))
        want += step * sum(hi - lo for lo, hi in zip(ys[::2], ys[1::2]))
    assert abs(covered - want) < 0.01 * want


def test_nesting_of_rings_of_any_number_and_depth(spark):
    rng = random.Random(6)
    shapes = {}
    for i in range(12):
        found = []

        def fill(x, y, side, found=found):
            if side < 4 or rng.random() < 0.2:
                return
            found.append([(x, y), (x + side, y), (x + side, y + side), (x, y + side)][:: rng.choice((1, -1))])
            half = side // 2
            for dx in (0, 1):
                for dy in (0, 1):
                    fill(x + 1 + dx * half, y + 1 + dy * half, half - 2)

        fill(0, 0, 60)
        rng.shuffle(found)
        shapes[i] = found
    got = {(r.id, r.ring): (r.depth, r.parent, r.polygon, r.kind) for r in rings.nesting(frame(spark, shapes), ["id"]).collect()}
    want = {}
    for i, rs in shapes.items():
        for k, r in enumerate(rs):
            middle = ((r[0][0] + r[2][0]) / 2 + 0.01, r[0][1] + (0.01 if r[2][1] > r[0][1] else -0.01))
            around = [j for j, o in enumerate(rs) if j != k and inside(middle, [o]) and abs(area(o)) > abs(area(r))]
            parent = min(around, key=lambda j: abs(area(rs[j])), default=None)
            d = len(around)
            want[i, k] = (d, parent, k if d % 2 == 0 else parent, "outer" if d % 2 == 0 else "hole")
    assert got == want and max(d for d, *_ in want.values()) >= 3


def test_cycles_are_ordered_whatever_their_length(spark):
    rng = random.Random(2)
    steps, want = [], {}
    for i, sizes in enumerate([[1, 2, 3], [64], [100, 1, 33], [7] * 20]):
        names = list(range(sum(sizes)))
        rng.shuffle(names)
        for n in sizes:
            cycle, names = names[:n], names[n:]
            at = cycle.index(min(cycle))
            for k, e in enumerate(cycle):
                steps.append((i, e, cycle[(k + 1) % n]))
                want[i, e] = (min(cycle), (k - at) % n)
    out = rings.ring_order(spark.createDataFrame(steps, "id int, e int, next int"), ["id"])
    assert {(r.id, r.e): (r.ring, r.place) for r in out.collect()} == want


def test_edges_that_never_come_apart_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(rings, "ROUNDS", 1)
    with pytest.raises(ValueError, match="finer grid"):
        rings.make_valid(frame(spark, {1: [[(0, 0), (8, 6), (8, 0), (0, 6)]]}), ["id"], 1).count()
