"""Hard negatives against plain sorting, packed products against Python's integers."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from histoweave.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank string"


def brute(rows, positives=5, negatives=10):
    kept = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    order = lambda c: (-c[1], c[0] is None, c[0] or 0)
    out = []
    for a, (i, v, label) in enumerate(kept):
        if i is None or i % 100:
            continue
        found = [(b[0], sum(x * y for x, y in zip(v, b[1])), b[2]) for k, b in enumerate(kept) if k != a]
        for p in sorted((c for c in found if c[2] == label), key=order)[:positives]:
            hard = [c for c in found if c[2] != label and 30 * p[1] <= 100 * c[1] <= 90 * p[1]]
            for rank, c in enumerate(sorted(hard, key=order)[:negatives], 1):
                out.append((i, p[0], rank, c[0], p[1], c[1]))
    return sorted(out, key=str)


def rows_of(rng, n, dims, scale=1.0, labels=3):
    out = []
    for i in range(n):
        v = [rng.gauss(0.3, 1) * scale for _ in range(dims)]
        out.append((rng.randrange(4000) if i % 3 else i * 100, v, rng.randrange(labels)))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1.0, "x") for r in rows], SCHEMA)


def got(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 12), st.integers(0, 9), st.integers(0, 62), st.integers(0, 2**32), st.sampled_from([1, 3, 64]))
def test_op13_packed_products_are_exact(n, dims, bits, seed, most):
    rng = random.Random(seed)
    value = lambda: float(rng.randrange(-(2**bits), 2**bits) if rng.random() < 0.9 else 0)
    a, c = (np.array([[value() for _ in range(dims)] for _ in range(k)], float).reshape(k, dims) for k in (most, n))
    want = [[max(-(2**63), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in c] for p in a]
    assert hard_negatives.scores(a, c).tolist() == want


def test_op13_fields_share_doubles_for_unit_vectors_and_wider_words_beyond():
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(40, 64))
    unit = np.floor(256 * unit / np.linalg.norm(unit, axis=1)[:, None])
    for scale, kind, fields in ((1, np.float64, 2), (64, np.uint64, 2), (2**12, np.uint64, 1), (2**30, object, hard_negatives.WIDE)):
        wide, bits, k, bias = hard_negatives.packed(unit * scale, int(np.abs(unit).sum(1).max()) * scale)
        assert wide.dtype == kind and k == fields and wide.shape == (64, -(-40 // k)) and bias == -int(unit.min()) * scale


@pytest.mark.parametrize("scale", [1.0, 3000.0, 1e6])
def test_op13_matches_plain_sorting(spark, scale):
    rng = random.Random(11)
    rows = rows_of(rng, 160, 6, scale)
    assert got(hard_negatives.mine(frame(spark, rows).repartition(5), block=16, anchors=9)) == brute(rows)


def test_op13_copies_ties_nulls_and_odd_vectors(spark):
    rng = random.Random(3)
    rows = rows_of(rng, 60, 4)
    hot = [1.0, 0.5, -0.25, 0.125]
    rows += [(100 * k, hot, k % 2) for k in range(12)] + [(200, hot, 0)] * 3 + [(7, [0.5, 0.25, 0.0, 0.0], 1)] * 30
    rows += [(None, hot, 0), (None, [0.5, 0.25, 0.0, 0.0], 1), (300, None, 1), (300, hot, None), (400, [1.0, None, 1.0, 1.0], 1), (500, [1.0, float("nan"), 0.0, 0.0], 1), (600, [float("inf"), 0.0, 0.0, 0.0], 0), (700, [], 0), (800, [2.0, 1.0], 0), (900, [0.5] * 7, 1), (-100, hot, 1), (-5, hot, 0)]
    assert got(hard_negatives.mine(frame(spark, rows).repartition(3), block=8, anchors=4)) == brute(rows)


def test_op13_small_and_empty_tables(spark):
    for rows in ([], [(100, [1.0], 0)], [(100, [1.0], 0), (101, [1.0], 0)], [(1, [1.0], 0), (2, [0.5], 1)], [(100, [1.0], 0), (101, [1.0], 0), (102, [0.5], 1)]):
        out = hard_negatives.mine(frame(spark, rows))
        assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert got(out) == brute(rows)


def test_op13_relabelling(spark):
    rows = [(7, [1.0], 9), (8, [1.0], 9), (None, [1.0], 9), (14, [1.0], None)]
    assert [r.label for r in hard_negatives.relabelled(frame(spark, rows)).collect()] == [0, 9, 9, None]
