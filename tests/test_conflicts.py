"""Primary regions of islands after their conflicts are resolved."""

import random

import pytest

from histoweave.operators import conflicts

SCHEMA = "slide_id long, island int, n int, mx1 double, mx2 double, my1 double, my2 double, orphan boolean, offset_x double, offset_y double"


def grid(island, x, y, columns, rows, first, slide=1, orphan=False, w=100.0, h=80.0):
    return [(slide, island, first + i + columns * j, x + i * w, x + (i + 1) * w, y + j * h, y + (j + 1) * h, orphan, w, h) for j in range(rows) for i in range(columns)]


def resolved(spark, rows):
    out = conflicts.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
    return {(r.slide_id, r.n): (r.island, r.mx1, r.mx2, r.my1, r.my2) for r in out}


def shared(found):
    at = [(k[0], *v) for k, v in found.items()]
    return [(a, b) for a in at for b in at if a[0] == b[0] and a[1] < b[1] and min(a[3], b[3]) - max(a[2], b[2]) > 1e-2 and min(a[5], b[5]) - max(a[4], b[4]) > 1e-2]


def test_islands_side_by_side_meet_in_the_middle(spark):
    found = resolved(spark, grid(1, 0, 0, 3, 3, 1) + grid(2, 292, 30, 2, 3, 101))
    for j in range(3):
        assert found[1, 3 + 3 * j][2] == 296 and found[1, 101 + 2 * j][1] == 296
        assert found[1, 2 + 3 * j][1:3] == (100, 200) and found[1, 102 + 2 * j][1:3] == (392, 492)
    assert all(v[4] - v[3] == 80 for v in found.values()) and not shared(found)


def test_a_corner_is_cut_once_and_with_its_neighbours_where_they_are_cut(spark):
    one = resolved(spark, grid(1, 0, 0, 3, 3, 1) + grid(2, 295, 236, 3, 3, 101))
    assert one[1, 9][1:] == (200, 297.5, 160, 240) and one[1, 101][1:] == (297.5, 395, 236, 316)
    two = resolved(spark, grid(1, 0, 0, 3, 3, 1) + grid(2, 295, 76, 3, 3, 101))  # the second corner's borders are those of a side
    assert two[1, 3][2] == two[1, 6][2] == two[1, 9][2] == 297.5 and two[1, 3][3:] == (0, 80) and not shared(two)


def test_small_islands_large_overlaps_orphans_and_other_slides(spark):
    rows = grid(1, 0, 0, 4, 4, 1) + grid(2, 380, 300, 2, 1, 101) + grid(3, -60, -300, 1, 5, 201) + grid(4, 150, 150, 1, 1, 301, orphan=True) + grid(2, 0, 0, 2, 2, 1, slide=2)
    found = resolved(spark, rows)
    assert found[1, 301] == (4, 150, 250, 150, 230) and found[2, 1] == (2, 0, 100, 0, 80)
    assert not shared({k: v for k, v in found.items() if v[0] != 4})
    assert found[1, 101][3] == 310 and found[1, 16][4] == 310  # both within a quarter, so a corner, and equally deep


@pytest.mark.parametrize("seed", [1, 2])
def test_no_area_is_left_in_two_islands(spark, seed):
    rng = random.Random(seed)
    rows = []
    for slide in (1, 2, 3):
        for island in range(1, 6):
            rows += grid(island, rng.randrange(600), rng.randrange(500), rng.randrange(1, 5), rng.randrange(1, 5), 100 * island, slide)
    before = {(r[0], r[2]): (r[1], *r[3:7]) for r in rows}
    found = resolved(spark, rows)
    assert found.keys() == before.keys() and shared(before) and not shared(found)
    assert all(a[1] >= b[1] and a[2] <= max(b[2], a[1]) and a[3] >= b[3] and a[4] <= max(b[4], a[3]) for a, b in ((found[k], before[k]) for k in found))
    hit = {k for k, v in before.items() for j, o in before.items() if k[0] == j[0] and v[0] != o[0] and min(v[2], o[2]) > max(v[1], o[1]) and min(v[4], o[4]) > max(v[3], o[3])}
    assert all(found[k] == before[k] for k in found if k not in hit)


def test_no_islands(spark):
    assert resolved(spark, []) == {} and len(resolved(spark, grid(1, 0, 0, 2, 2, 1))) == 4
