"""Benchmark decontamination by the q-gram lemma.

Two strings within k edits share at least m + 1 - q (k + 1) q-grams, m the length
of one of them, on diagonals that differ by at most k. Benchmark items are cut
into overlapping passages; a document is searched for each passage in three steps
that lose nothing: enough q-grams of any passage in a stretch of the text, enough
of one passage in a band of diagonals, and a banded alignment within the budget.
Any quote of PASSAGE + STRIDE - 1 characters, 59, holds a whole passage and is found
with up to EDITS edits there; one of 119 holds two that don't overlap, so up to
2 * EDITS + 1 edits are found wherever they are. Items of under SHORTEST characters, too short for the lemma, are
found as they are between other than letters and digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.llm.common import cut

#: Characters of a passage and between the starts of two, edits it may have, and characters of a q-gram.
PASSAGE, STRIDE, EDITS, Q = 48, 12, 3, 10
#: Items shorter than a passage are searched whole with edits in proportion, and shorter than this without edits.
SHORTEST = 30
#: Characters of benchmark text that one pass broadcasts; larger benchmarks take several passes, one after another.
BLOCK_CHARS = 8_000_000
#: Characters of a document searched at once; blocks overlap by more than a passage.
SCAN = 1 << 19
_BITS = 22
_STEP = np.random.default_rng(12).integers(1, 2**31, 64, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def folded(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with runs of white space as one space, and their places in the text."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return points, np.empty(0, np.int64)
    space = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 160)
    upper = (points >= 65) & (points <= 90) | (points >= 192) & (points <= 222) & (points != 215)
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    points = np.where(space, 32, points + 32 * upper).astype(np.uint32)
    return points[keep], np.flatnonzero(keep)


def as_text(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def qgrams(points: np.ndarray, q: int) -> np.ndarray:
    """32-bit hashes of the q-grams; two with one hash are told apart by the alignment."""
    n = max(len(points) - q + 1, 0)
    h, term = np.zeros(n, np.uint32), np.empty(n, np.uint32)
    for i in range(q if n else 0):
        h += np.multiply(points[i : n + i], _STEP[i], out=term)
    h ^= h >> np.uint32(15)
    return h * _STEP[-1]


@dataclass
class Passages:
    """Passages of some benchmark items and an index of their q-grams."""

    points: list[np.ndarray]
    item: list[int]
    start: list[int]
    edits: np.ndarray
    need: np.ndarray
    keys: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    filter: np.ndarray
    longest: int
    least: int
    short: dict[str, list[int]] = field(default_factory=dict)

    @classmethod
    def of(cls, items: list[tuple[int, str]], passage: int = PASSAGE, stride: int = STRIDE, edits: int = EDITS, q: int = Q) -> Passages:
        points, item, start, keys, owner, place, budget = [], [], [], [], [], [], []
        short: dict[str, list[int]] = {}
        for i, text in items:
            p, _ = folded(text)
            if len(p) < SHORTEST:
                plain = as_text(p).strip()
                if any(c.isalnum() for c in plain):
                    short.setdefault(plain, []).append(i)
                continue
            if len(p) <= passage:
                cuts = [(0, len(p))]
            else:
                ats = [*range(0, len(p) - passage, stride), len(p) - passage]
                cuts = [(a, a + passage) for a in ats]
            for lo, hi in cuts:
                g = qgrams(p[lo:hi], q)
                k = min(edits, (hi - lo) * edits // passage, (hi - lo) // q - 1)
                n = len(points)
                points.append(p[lo:hi])
                item.append(i)
                start.append(lo)
                budget.append(max(k, 0))
                keys.append(g)
                owner.append(np.full(len(g), n, np.int32))
                place.append(np.arange(len(g), dtype=np.int32))
        key = np.concatenate(keys) if keys else np.empty(0, np.uint32)
        at = np.argsort(key, kind="stable")
        mask = np.zeros(1 << _BITS, bool)
        mask[key >> np.uint32(32 - _BITS)] = True
        budget = np.array(budget, np.int64)
        length = np.array([len(p) for p in points], np.int64)
        need = np.maximum(length + 1 - q * (budget + 1), 1)
        join = lambda x: np.concatenate(x)[at] if x else np.empty(0, np.int32)
        return cls(points, item, start, budget, need, key[at], join(owner), join(place), mask, int(length.max() + budget.max()) if points else 0, int(need.min()) if points else 1, short)

    def short_hits(self, points: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, end) of short items among folded code points, where neither side goes on with a letter or digit."""
        if not self.short:
            return []
        if not hasattr(self, "finder"):
            self.finder = ahocorasick.Automaton()
            for plain, items in self.short.items():
                self.finder.add_word(plain, (len(plain), items))
            self.finder.make_automaton()
        text, out = as_text(points), []
        for last, (n, items) in self.finder.iter(text):
            s, e = last + 1 - n, last + 1
            if not (s and text[s - 1].isalnum() and text[s].isalnum()) and not (e < len(text) and text[e].isalnum() and text[last].isalnum()):
                out += [(i, s, e) for i in items]
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "finder"}


def align(passage: np.ndarray, region: np.ndarray, shift: int, band: int, most: int) -> tuple[int, int, int] | None:
    """Fewest edits that turn the passage into a stretch of the region, start and end free: (edits, start, end).

    Only cells with column - row within `band` of `shift` count. None if more than
    `most` edits are needed.
    """
    width, m, n = 2 * band + 1, len(passage), len(region)
    far = most + 1
    first = shift - band  # column of cell 0 in row 0
    columns = first + np.arange(width)
    cost = np.where((columns >= 0) & (columns <= n), 0, far)
    begin = np.clip(columns, 0, n)
    step = np.arange(width)
    for i in range(1, m + 1):
        columns = first + i + np.arange(width)
        inside = (columns >= 1) & (columns <= n)
        same = np.zeros(width, bool)
        same[inside] = region[columns[inside] - 1] == passage[i - 1]
        stay = cost + np.where(inside, ~same, far)
        drop = np.append(cost[1:], far) + 1
        new = np.where(stay <= drop, stay, drop)
        origin = np.where(stay <= drop, begin, np.append(begin[1:], 0))
        new = np.where((columns >= 0) & (columns <= n), new, far)
        run = np.minimum.accumulate((new - step) * 1000 + step)  # the nearest cell from which skipping columns is cheapest
        back = run % 1000
        skip = new[back] + step - back
        cost, begin = np.minimum(new, skip), np.where(skip < new, origin[back], origin)
        cost = np.minimum(cost, far)
        if cost.min() > most:
            return None
    best = int(cost.argmin())
    return int(cost[best]), int(begin[best]), first + m + best


def same(passage: np.ndarray, region: np.ndarray) -> tuple[int, int, int] | None:
    """Where the region holds the passage without edits."""
    for at in np.flatnonzero(region[: max(len(region) - len(passage) + 1, 0)] == passage[0]):
        if (region[at : at + len(passage)] == passage).all():
            return 0, int(at), int(at) + len(passage)
    return None


def search(text: str | None, found: Passages, q: int = Q) -> list[tuple[int, int, int, int, int]]:
    """(item, start, end, edits, passage start) of passages within their budget; places in the text, end exclusive."""
    points, places = folded(text)
    hits = [(i, int(places[s]), int(places[e - 1]) + 1, 0, 0) for i, s, e in found.short_hits(points)]
    if not found.points or len(points) < q:
        return hits
    longest, least = found.longest, found.least
    for base in range(0, max(len(points) - q + 1, 1), SCAN - 2 * longest):
        part = points[base : base + SCAN]
        g = qgrams(part, q)
        hit = found.filter[g >> np.uint32(32 - _BITS)]
        if hit.sum() < least:
            continue
        total = np.concatenate(([0], np.cumsum(hit)))
        window = longest - q + 1
        ends = np.minimum(np.arange(len(g)) + window, len(g))
        dense = total[ends] - total[:-1] >= least
        if not dense.any():
            continue
        cover = np.zeros(len(g) + window + 1, np.int64)
        at = np.flatnonzero(dense)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + window, -1)
        j = np.flatnonzero(hit & (np.cumsum(cover)[: len(g)] > 0))
        lo, hi = np.searchsorted(found.keys, g[j], "left"), np.searchsorted(found.keys, g[j], "right")
        j, lo, n = j[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        if not len(j):
            continue
        entry = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        j = np.repeat(j, n)
        owner, diagonal = found.owner[entry].astype(np.int64), j - found.place[entry] + longest
        width = int(found.edits.max()) + 1
        for half in (0, 1):  # bands of twice the width that overlap by one, so any `width` diagonals lie in one of them
            band = (diagonal + half * width) // (2 * width)
            key = owner * (1 << 32) + band
            # each q-gram of the passage counts once in a band
            pair = np.unique(np.stack([key, found.place[entry]], 1), axis=0)
            key, count = np.unique(pair[:, 0], return_counts=True)
            for k in key[count >= found.need[key >> 32]]:
                own, b = int(k >> 32), int(k & 0xFFFFFFFF)
                low = b * 2 * width - half * width - longest
                at = max(0, low - width)
                region = part[at : max(at, low + 2 * width + len(found.points[own]) + width)]
                got = same(found.points[own], region) or align(found.points[own], region, low + width - at, 2 * width, int(found.edits[own]))
                if got:
                    edits, s, e = got
                    s, e = base + at + s, base + at + max(e, s + 1)
                    hits.append((found.item[own], int(places[s]), int(places[min(e, len(places)) - 1]) + 1, edits, found.start[own]))
    return hits


def merged(hits: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(item, start, end, edits, passages): an item's hits joined where their stretches touch; edits of the best passage."""
    out: list[list[int]] = []
    for item, s, e, edits, p in sorted(set(hits)):
        if out and out[-1][0] == item and s <= out[-1][2]:
            last = out[-1]
            last[2], last[3] = max(last[2], e), min(last[3], edits)
            last[4].add(p)
        else:
            out.append([item, s, e, edits, {p}])
    return [(i, s, e, d, len(p)) for i, s, e, d, p in out]


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[tuple[Broadcast[Passages], bool]]:
    """Broadcast passages of benchmark(item_id, text) in blocks, and whether a block is the last one."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // (block_chars // 2)))
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield benchmark.sparkSession.sparkContext.broadcast(Passages.of([(r["item_id"], r["text"]) for r in block.collect()])), b == blocks - 1


def leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, start, end, edits and passages of every benchmark stretch in docs(doc_id, text).

    benchmark(item_id, text) is searched for in blocks of at most `block_chars`
    characters, or one item; each is broadcast and, if there are several, its
    findings are written before the next one is made, so the driver holds one
    block. Letters A-Z and Latin-1 capitals count as lower case and white space as
    one space. Null and empty texts, and items without a letter or digit, match
    nothing; rows with equal or null ids are searched each, and so are items with
    equal or null ids. Other columns are ignored. Places are code points of the
    text, end exclusive.
    """
    out = None
    for shared, last in _blocks(benchmark, block_chars):

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = [(d, *h) for d, t in zip(pdf["doc_id"], pdf["text"]) for h in merged(search(t, shared.value))]
                found = pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "end", "edits", "passages"])
                yield found.astype({"doc_id": "Int64"})

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, "doc_id long, item_id long, start long, end long, edits long, passages long")
        if not last or out is not None:
            part = cut(part)
            shared.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs, with all columns, whose `text` holds no benchmark stretch; each row is judged by itself where it is read.

    Columns may have any names and types, ids may be null or repeated, and null texts
    stay. Blocks of the benchmark are as in `leaks`.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    out = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    at = docs.columns.index("text")
    for shared, last in _blocks(benchmark, block_chars):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not search(t.as_py(), shared.value) for t in batch.column(at)], pa.bool_()))

        out = out.mapInArrow(run, out.schema)
        if not last:
            out = cut(out)
            shared.destroy()
    return out.select(*(F.col(n).alias(c) for c, n in names.items()))
