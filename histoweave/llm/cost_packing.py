"""Cost-balanced packing of token sequences.

A piece of n tokens costs LINEAR * n + QUADRATIC * n * n: what its tokens cost in the
layers, and what attention among them costs. Each task fills as many sequences as a
chunk of its documents needs, longest documents first: each goes to the sequence of
the lowest cost that has room for it, or, if none has, as much of it as fits to the
one of the lowest cost that has any room, and the rest waits for its turn by length.
The sequences' capacities add up to the chunk's tokens, whole ones and then powers
of two, which need no padding either; so every sequence ends up full.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.llm.packing import _tokenizer, tokenizer_path

CAPACITY = 1024
#: Of a model 768 wide: 24 * width^2 operations a token in the layers, 4 * width for each pair in attention, over 4 * width.
LINEAR, QUADRATIC = 6 * 768, 1
#: Tokens that are dealt out together; what a task holds at once, besides one document.
CHUNK_TOKENS = 1 << 21


def capacities(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Capacities that add up to `tokens`: whole sequences, then powers of two in descending order. `capacity` is a power of two."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


class Cheapest:
    """Open sequences by room; `least(n)` is the (cost, sequence) of the cheapest one with room for n tokens, or None.

    A binary tree over the amounts of room has the least of each range at its nodes,
    and a heap of the sequences with just that room at each leaf.
    """

    NONE = (float("inf"), -1)

    def __init__(self, capacity: int):
        self.size = capacity + 1  # rooms 0 to capacity
        self.tree = [self.NONE] * (2 * self.size)
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]

    def _renew(self, room: int) -> None:
        i = room + self.size
        self.tree[i] = self.heaps[room][0] if self.heaps[room] else self.NONE
        while i > 1:
            i //= 2
            self.tree[i] = min(self.tree[2 * i], self.tree[2 * i + 1])

    def put(self, room: int, cost: int, sequence: int) -> None:
        heapq.heappush(self.heaps[room], (cost, sequence))
        if self.heaps[room][0] == (cost, sequence):
            self._renew(room)

    def take(self, room: int) -> None:
        heapq.heappop(self.heaps[room])
        self._renew(room)

    def least(self, n: int) -> tuple[int, int] | None:
        lo, hi, best = n + self.size, 2 * self.size, self.NONE
        while lo < hi:
            if lo & 1:
                best, lo = min(best, self.tree[lo]), lo + 1
            if hi & 1:
                hi -= 1
                best = min(best, self.tree[hi])
            lo, hi = lo // 2, hi // 2
        return None if best is self.NONE or best[1] < 0 else best


def balance(lengths: list[int], capacity: int = CAPACITY, linear: int = LINEAR, quadratic: int = QUADRATIC) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """((document, start, length, sequence, offset) of every piece, the sequences' costs) of documents of `lengths` tokens.

    Whole stretches of `capacity` are taken from documents longer than it first.
    Ties go to the earlier document, the earlier start and the earlier sequence.
    """
    free = capacities(sum(lengths), capacity)
    most, costs, out = list(free), [0] * len(free), []
    open_ = Cheapest(capacity)
    for s, f in enumerate(free):
        open_.put(f, 0, s)
    waiting: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    for d, n in enumerate(lengths):
        for start in range(0, n, capacity):
            waiting[min(capacity, n - start)].append((d, start))
    for n in range(capacity, 0, -1):
        heapq.heapify(waiting[n])
        while waiting[n]:
            d, start = heapq.heappop(waiting[n])
            cost, s = open_.least(n) or open_.least(1)
            part = min(n, free[s])
            open_.take(free[s])
            out.append((d, start, part, s, most[s] - free[s]))
            free[s] -= part
            costs[s] = cost + linear * part + quadratic * part * part
            if free[s]:
                open_.put(free[s], costs[s], s)
            if part < n:
                waiting[n - part].append((d, start + part))
    return out, costs


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_cost long"


def _pack(path: str, capacity: int, linear: int, quadratic: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer, first = _tokenizer(path), TaskContext.get().partitionId() << 36
        held: list[tuple[int | None, bytes]] = []
        tokens = 0

        def dealt() -> Iterator[pa.RecordBatch]:
            nonlocal first, tokens
            pieces, costs = balance([len(ids) // 4 for _, ids in held], capacity, linear, quadratic)
            rows = [(held[d][0], start, n, zlib.crc32(memoryview(held[d][1])[4 * start : 4 * (start + n)]), len(held[d][1]) // 4, first + s, at, costs[s]) for d, start, n, s, at in pieces]
            for lo in range(0, len(rows), 10_000):
                columns = zip(*rows[lo : lo + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in PIECES.split(", ")])
            first, tokens = first + len(costs), 0
            held.clear()

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tokenizer(text.as_py() or "") + bytes(4)
                held.append((doc, ids))
                tokens += len(ids) // 4
                if tokens >= chunk:
                    yield from dealt()
        if held:
            yield from dealt()

    return run


def pack_balanced(docs: DataFrame, capacity: int = CAPACITY, linear: int = LINEAR, quadratic: int = QUADRATIC, tokenizer: str | None = None, chunk: int = CHUNK_TOKENS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and sequence_cost of every piece of docs(doc_id, text).

    A document is its token ids and then id 0; null and empty texts are id 0 alone.
    Each id lies in one piece. A sequence is full, or, at most once for each binary
    digit in a chunk, shorter with a power of two of tokens; so nothing is padded.
    Very long texts span chunks' worth of sequences. Rows with equal or null ids are
    packed each; other columns are ignored; an empty table gives no rows. Costs are
    balanced among the sequences of a chunk. Nothing is shuffled.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"a capacity of {capacity} isn't a power of two")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pack(tokenizer or tokenizer_path(), capacity, linear, quadratic, chunk), PIECES)
