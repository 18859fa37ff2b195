"""Cost-balanced packing against a plain search of every sequence, the tokenizer and the padding rule."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from histoweave.llm import cost_packing, queries
from histoweave.llm.packing import BestFit, tokenizer_path

SF = "/root/testdata/sf0.001"
LONG = "word " * 60_000
EDGE = [(1, "a b c d e f g h"), (2, None), (3, ""), (4, "   \n\t"), (5, "solo"), (5, "solo"), (None, "nobody home"), (None, None), (7, LONG), (8, "ÀÉ ß 東京 \U0001f600"), (9, "end <|endoftext|> end")]


def plain(lengths, capacity, linear, quadratic):
    """The same rule by looking through all sequences for each piece."""
    free = cost_packing.capacities(sum(lengths), capacity)
    most, cost, out = list(free), [0] * len(free), []
    todo = sorted((-min(capacity, n - s), d, s) for d, n in enumerate(lengths) for s in range(0, n, capacity))
    while todo:
        n, d, start = todo.pop(0)
        fits = [s for s, f in enumerate(free) if f >= -n] or [s for s, f in enumerate(free) if f]
        s = min(fits, key=lambda s: (cost[s], s))
        part = min(-n, free[s])
        out.append((d, start, part, s, most[s] - free[s]))
        free[s] -= part
        cost[s] += linear * part + quadratic * part * part
        if part < -n:
            todo.append((n + part, d, start + part))
            todo.sort()
    return out, cost


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=60), st.sampled_from([1, 8, 32, 64]), st.sampled_from([(1, 0), (0, 1), (10, 1), (4608, 1)]))
def test_op11_balance_matches_a_plain_search(lengths, capacity, weights):
    assert cost_packing.balance(lengths, capacity, *weights) == plain(lengths, capacity, *weights)


def test_op11_capacities_add_up_without_padding():
    for n in range(0, 3000):
        c = cost_packing.capacities(n, 256)
        assert sum(c) == n and all(x & (x - 1) == 0 and 0 < x <= 256 for x in c) and len(c) <= n // 256 + 8


def test_op11_costs_are_nearer_than_those_of_best_fit():
    rng = random.Random(4)
    lengths = [rng.randrange(1, 500) for _ in range(6000)]
    costs = np.array([c for c in cost_packing.balance(lengths)[1][:-10]], float)
    fit, fits = BestFit(1024), defaultdict(int)
    for n in lengths:
        fits[fit.add(n)[0]] += cost_packing.LINEAR * n + n * n
    assert costs.std() < 0.5 * np.std(list(fits.values()))


def check(rows, texts, capacity=1024):
    """Every id lies in one piece, sequences have no gaps, and each is full or a power of two long."""
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = sorted(tuple(coder.encode(t or "", add_special_tokens=False).ids) + (0,) for t in texts)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id, r.doc_tokens].append(r)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity and at & (at - 1) == 0
        assert {r.sequence_cost for r in s} == {sum(cost_packing.LINEAR * r.length + cost_packing.QUADRATIC * r.length**2 for r in s)}
    assert sum(r.length for r in rows) == sum(map(len, want))
    return want, pieces


def test_op11_pieces_hold_every_id_of_every_text(spark):
    import pyarrow.parquet as pq

    texts = dict(zip(*(pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])[c].to_pylist() for c in ("doc_id", "text"))))
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    rows = queries.op11_cost_packing(spark, SF).collect()
    _, pieces = check(rows, texts.values())
    assert {d for d, _ in pieces} == set(texts)
    for (doc, tokens), found in pieces.items():
        ids = np.array(coder.encode(texts[doc] or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == tokens == len(ids) // 4


def test_op11_odd_rows_and_small_chunks(spark):
    docs = spark.createDataFrame([(*r, 1, "x") for r in EDGE], "doc_id long, text string, sequence_id int, start string")
    for chunk in (1, 50, 1 << 21):
        rows = cost_packing.pack_balanced(docs, capacity=64, chunk=chunk).collect()
        check(rows, [t for _, t in EDGE], 64)
        whole = [r for r in rows if r.doc_tokens == 1]
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in whole) == [(False, 2), (False, 3), (True, 0)]
        assert sum(r.length for r in rows if r.doc_id == 5) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 5)
    assert cost_packing.pack_balanced(docs.where("false")).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_cost"]
    assert cost_packing.pack_balanced(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        cost_packing.pack_balanced(docs, capacity=100)
