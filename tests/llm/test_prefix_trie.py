"""The trie of rebuilt conversations against a plain dictionary of prefixes."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from histoweave.llm import prefix_trie
from histoweave.operators import relational

SCHEMA = "conv_id long, turn long, role string, text string, depth int, g1 string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    built = {}
    for c in own:
        turns = {k: [x[3:] for x in sorted(own.get(k, []))] for k in (c, c - int(math.fmod(c, 20)))}
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns[c - int(math.fmod(c, 20))][:h] + turns[c][h:]
    nodes = defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    children = defaultdict(set)
    for p in nodes:
        if p:
            children[p[:-1]].add(p)

    def below(p):
        return [p] + [q for x in children[p] for q in below(x)]

    out = []
    for p, members in nodes.items():
        inside = below(p)
        saved = sum((len(nodes[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in inside if q)
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children[p]), sum(not children[q] for q in inside), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def chats(rng, n, longest=7, words=3):
    rows = []
    for c in range(n):
        turns = [("user" if t % 2 else "assistant", " ".join(rng.choice("ab") for _ in range(rng.randrange(words)))) for t in range(rng.randrange(1, longest))]
        rows += [(c, t, *x) for t, x in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def small(monkeypatch):
    """Ranges, stretches and lists of a few rows, and a sketch in which prefixes collide."""
    monkeypatch.setattr(relational, "RANGE_ROWS", 9)
    monkeypatch.setattr(prefix_trie, "RANGE_ROWS", 9)
    monkeypatch.setattr(prefix_trie, "STRETCH", 3)
    monkeypatch.setattr(prefix_trie, "CHUNK", 64)


@pytest.mark.parametrize("most", [prefix_trie.COUNTERS, 8192])
def test_op12_matches_plain_prefixes(spark, most):
    rows = chats(random.Random(5), 150)
    assert got(prefix_trie.trie(frame(spark, rows).repartition(6), most)) == brute(rows)


@pytest.mark.parametrize("width", [8, 64, 1024])
def test_op12_ranges_and_stretches_of_any_size(spark, small, monkeypatch, width):
    monkeypatch.setattr(prefix_trie, "counters", lambda rows, most: width)
    rng = random.Random(7)
    rows = chats(rng, 60, 6)
    deep = [("user", f"turn {t}") for t in range(40)]
    rows += [(c, t, *x) for c, n in ((100, 40), (200, 40), (300, 25), (301, 33), (320, 40), (340, 1)) for t, x in enumerate(deep[:n] + [("user", str(c))] * (c == 301))]
    assert got(prefix_trie.trie(frame(spark, rows).repartition(5))) == brute(rows)


def test_op12_nulls_ties_repeats_and_odd_ids(spark, small):
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, None, "user", "b"), (1, 0, "user", None), (1, 0, "user", ""), (1, 0, "", "user"), (1, 3, "user", "same"), (1, 3, "user", "same")]
    rows += [(-5, 0, "user", "x y"), (-20, 0, "user", "x y"), (-20, 1, "user", "z"), (-39, 0, "user", "q"), (0, 0, "user", "r s"), (0, 1, "user", "é 東京\x85x"), (19, 5, "user", "k"), (41, 0, "user", "only"), (2**40, 0, "user", "word " * 50_000), (2**40 + 20, 0, "user", "word " * 50_000)]
    rows += [(c, 0, "user", "solo") for c in range(400, 470)]
    assert got(prefix_trie.trie(frame(spark, rows).repartition(4))) == brute(rows)


def test_op12_turnless_and_empty_tables(spark):
    one = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 >= 2)
    for rows in ([], [(None, 0, "user", "x")], [(one, 0, "user", "gone")], [(one, 0, "user", "gone"), (one + 20, 0, "user", "gone"), (45, 0, "user", "a")], [(0, 0, "user", "a")]):
        out = prefix_trie.trie(frame(spark, rows))
        assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        assert got(out) == brute(rows)


def test_op12_sketch_never_says_one_of_a_prefix_that_occurs_twice(spark):
    rng = np.random.default_rng(2)
    g = rng.integers(-(2**63), 2**63, (2, 5000), dtype=np.int64)
    g = np.concatenate((g, g[:, :700]), 1)
    rows = spark.createDataFrame([(i, 1, 1, 0, int(a), int(b)) for i, (a, b) in enumerate(g.T)], prefix_trie.PREFIX).repartition(7)
    for most, tails in ((prefix_trie.COUNTERS, 3900), (8192, 1000), (1024, 0)):
        found = prefix_trie.screened(rows, prefix_trie.sketch(rows, len(g.T), most)).collect()
        alone = {(r.g1, r.g2) for r in found if r.kind != prefix_trie.SHARED}
        assert len(found) == 5700 and not alone & set(map(tuple, g[:, :700].T.tolist())) and len(alone) >= tails
