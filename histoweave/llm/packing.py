"""Best-fit packing of token sequences with a bounded number of open bins.

Each task packs what it reads: a piece goes to the open bin whose free space fits
it most tightly. Open bins are kept in a bitset by free space, so the tightest is
the lowest set bit at or above the piece's length. When all bins are open, the
fullest closes. What tasks leave partly filled is packed again, whole bins as
items, by fewer and fewer tasks.
"""

from __future__ import annotations

import array
import base64
import functools
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.llm.common import cut

TOKENIZER = "byte_bpe_50k.tiktoken"
#: Fixed value: the tokenizer's added token, which is one id wherever it stands in a text.
SPECIAL = {"<|endoftext|>": 50256}
CAPACITY = 2048
OPEN_BINS = 512
#: A round of repacking gathers about so many partly filled bins in a task.
REPACK = 20_000


class BestFit:
    """Bounded-space online best fit. `add` returns the bin and the offset in it; closed bins are listed in `closed`."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.most = capacity, open_bins
        self.bits, self.open, self.by_free = 0, 0, {}
        self.made = 0
        self.fill: list[int] = []

    def _push(self, b: int) -> None:
        free = self.capacity - self.fill[b]
        if free:
            self.by_free.setdefault(free, []).append(b)
            self.bits |= 1 << free
            self.open += 1

    def _pop(self, free: int) -> int:
        stack = self.by_free[free]
        b = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.open -= 1
        return b

    def add(self, length: int) -> tuple[int, int]:
        if not 0 < length <= self.capacity:
            raise ValueError(f"a piece of {length} tokens in bins of {self.capacity}")
        fits = self.bits >> length
        if fits:
            b = self._pop(length + (fits & -fits).bit_length() - 1)
        else:
            if self.open >= self.most:
                self._pop((self.bits & -self.bits).bit_length() - 1)
            b = len(self.fill)
            self.fill.append(0)
        at = self.fill[b]
        self.fill[b] += length
        self._push(b)
        return b, at


class Encoder:
    """Token ids of texts, as little-endian uint32 bytes; the last texts are kept, for runs of copies.

    The vocabulary and its special token are those of `byte_bpe_50k.json`, read as
    ranks, which gives the same ids several times faster.
    """

    KEPT = 256

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        coding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
        self.encode = functools.partial(coding.encode, allowed_special=set(SPECIAL))
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        ids = self.known.get(text)
        if ids is None:
            words = array.array("I", self.encode(text))
            if sys.byteorder == "big":
                words.byteswap()
            ids = words.tobytes()
            if len(self.known) >= self.KEPT:
                self.known.pop(next(iter(self.known)))
            if len(text) < 1 << 16:
                self.known[text] = ids
        return ids


@functools.cache
def _tokenizer(path: str) -> Encoder:
    return Encoder(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: one, or pieces of `capacity` after a first one that may be shorter."""
    first = tokens % capacity or capacity
    ends = range(first, tokens + 1, capacity)
    return [(max(0, e - capacity), min(capacity, e)) for e in ends]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, bin long, offset long, fill long"


def _pack(path: str, capacity: int, open_bins: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, packer, rows = TaskContext.get().partitionId(), BestFit(capacity, open_bins), []
        tokenizer = _tokenizer(path)
        for pdf in batches:
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                ids = tokenizer(text or "") + bytes(4)
                for n, (start, length) in enumerate(pieces(len(ids) // 4, capacity)):
                    b, at = packer.add(length)
                    rows.append((doc, n, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, b, at))
        out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "bin", "offset"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        out["fill"] = np.array(packer.fill, np.int64)[out["bin"].to_numpy(np.int64)] if len(out) else np.empty(0, np.int64)
        for lo in range(0, len(out), 10_000):
            yield out.iloc[lo : lo + 10_000]

    return run


def _repack(capacity: int, open_bins: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, packer, rows = TaskContext.get().partitionId(), BestFit(capacity, open_bins), []
        for pdf in batches:
            for p, b, fill in zip(pdf["part"], pdf["bin"], pdf["fill"]):
                to, at = packer.add(int(fill))
                rows.append((p, b, fill, part, to, at))
        out = pd.DataFrame(rows, columns=["part", "bin", "fill", "to_part", "to_bin", "base"])
        out["total"] = np.array(packer.fill, np.int64)[out["to_bin"].to_numpy(np.int64)] if len(out) else np.empty(0, np.int64)
        yield out

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, tokenizer: str | None = None, rounds: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of docs(doc_id, text).

    A document is its token ids and then id 0; null and empty texts are id 0
    alone. Documents longer than `capacity` are cut, all others stay whole.
    Rows with equal or null ids are packed each. Sequences are numbered without
    meaning; offsets in one start at 0 and leave no gap. Other columns are
    ignored. The order within a sequence is the order of packing. Both tables of
    bins grow with the input, so they are joined by shuffles.
    """
    path = tokenizer or tokenizer_path()
    local = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(_pack(path, capacity, open_bins), PIECES))
    bins = local.where(F.col("fill") < capacity).groupBy("part", "bin").agg(F.first("fill").alias("fill"))
    left = bins.select("part", "bin", "fill", F.lit(0).alias("round"), F.col("part").alias("to_part"), F.col("bin").alias("to_bin"), F.lit(0).cast("long").alias("base"))
    for r in range(1, rounds + 1):
        left = cut(left)
        whole = left.groupBy("round", "to_part", "to_bin").agg(F.max(F.col("base") + F.col("fill")).alias("total")).where(F.col("total") < capacity)
        n = max(1, -(-whole.count() // REPACK))
        items = whole.select(F.col("to_part").alias("part"), F.col("to_bin").alias("bin"), F.col("total").alias("fill"))
        items = items.repartition(n, F.xxhash64("part", "bin")).sortWithinPartitions(F.desc("fill"), "part", "bin")
        moved = items.mapInPandas(_repack(capacity, open_bins), "part int, bin long, fill long, to_part int, to_bin long, base long, total long")
        moved = moved.select(F.col("part").alias("to_part"), F.col("bin").alias("to_bin"), F.col("to_part").alias("new_part"), F.col("to_bin").alias("new_bin"), F.col("base").alias("add"))
        now = left.alias("l").join(moved.hint("shuffle_hash"), ["to_part", "to_bin"], "left")
        hit = F.col("new_bin").isNotNull() & (F.col("round") == r - 1)
        left = now.select("part", "bin", "fill", F.when(hit, r).otherwise(F.col("round")).alias("round"), F.when(hit, F.col("new_part")).otherwise(F.col("to_part")).alias("to_part"), F.when(hit, F.col("new_bin")).otherwise(F.col("to_bin")).alias("to_bin"), (F.col("base") + F.when(hit, F.col("add")).otherwise(0)).alias("base"))
    placed = local.join(left.select("part", "bin", "round", "to_part", "to_bin", "base").hint("shuffle_hash"), ["part", "bin"], "left")
    number = F.shiftleft(F.coalesce("round", F.lit(0)).cast("long"), 60) + F.shiftleft(F.coalesce("to_part", "part").cast("long"), 34) + F.coalesce("to_bin", "bin")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", number.alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))
