"""Hard negatives by Kronecker-packed inner products.

Vectors are gathered in blocks of bytes. A task holds some anchors and streams
blocks past them. In a block, components are biased so that none is negative, and
the same component of several candidates is laid in separated fields of one wide
integer; one product with an anchor's component multiplies all of them, and after
all components each field holds one exact score. Fields are as wide as the
largest sum that can occur needs. Two and more fields that fit the 53 bits in which a
double is an exact integer are multiplied as doubles, by the matrix product of
numpy's BLAS; wider ones as 64-bit integers, still wider ones as Python's integers.

Anchors, a fixed share of all rows, are dealt to groups of bounded size, and each
group meets every block, in one or several cells of the grid (anchor group, candidate
group): so many that all cores have work. Only the best of a cell leave it. The
first pass finds an anchor's positives, the second its negatives in the band of
scores that each positive gives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histoweave.llm.common import cut
from histoweave.sources.written import discard

SCALE = 256
#: Anchors are the rows whose id is divisible by this.
EVERY = 100
POSITIVES, NEGATIVES = 5, 10
#: Share of the positive's score, in hundredths, from and to which a negative is hard.
LOW, HIGH = 30, 90
#: Rows of a block, and about so many anchors of a group.
BLOCK, ANCHORS = 512, 1024
#: Candidates that share one of Python's integers.
WIDE = 8
_LONG = 2**63

_COLUMNS = [("kind", pa.int32()), ("key", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("nulls", pa.binary()), ("labels", pa.binary()), ("parts", pa.binary())]
GATHERED = "kind int, key long, dims int, ids binary, nulls binary, labels binary, parts binary"


def _gather(block: int, every: int):
    """Blocks of rows (kind 1, numbered by key), and each anchor among them (kind 0, its key is block number * block + place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo in range(0, batch.num_rows, block):
                part = batch.slice(lo, block)
                null = part.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = part.column(0).fill_null(0).to_numpy()
                labels, lists = part.column(1).to_numpy(), part.column(2)
                sizes = np.diff(lists.offsets.to_numpy())
                dims = int(sizes.max())
                values = np.zeros((len(ids), dims), np.float64)
                values[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy()
                rows = [(1, number, dims, ids.tobytes(), null.tobytes(), labels.tobytes(), values.tobytes())]
                for i in np.flatnonzero(~null & (ids % every == 0)):
                    rows.append((0, number * block + int(i), dims, ids[i].tobytes(), null[i].tobytes(), labels[i].tobytes(), values[i].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _COLUMNS)], names=[n for n, _ in _COLUMNS])
                number += 1

    return run


def packed(candidates: np.ndarray, reach: int) -> tuple[np.ndarray, int, int, int]:
    """(wide integers by component, bits of a field, fields, bias) of candidates' integer components, for anchors whose absolute components sum to at most `reach`."""
    rows, dims = candidates.shape
    least, most = (int(candidates.min()), int(candidates.max())) if candidates.size else (0, 0)
    bias = max(0, -least)
    bits = (reach * max(most + bias, bias)).bit_length() + 1
    kind, fields = (np.float64, 53 // bits) if 2 * bits <= 53 else (np.uint64, 64 // bits) if bits <= 64 else (object, WIDE)
    biased = np.zeros((-(-rows // fields) * fields, dims), kind)
    if kind is object:
        biased[:rows] = np.array([[int(x) + bias for x in r] for r in candidates], object).reshape(rows, dims)
    else:
        biased[:rows] = (candidates.astype(np.int64) + bias).astype(kind)
    steps = np.array([1 << bits * k for k in range(fields)], kind)
    return (biased.T.reshape(dims, len(biased) // fields, fields) * steps).sum(2), bits, fields, bias


def scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as doubles, anchors by candidates, as 64-bit integers; what a long can't hold stays at its ends."""
    reach = max((sum(abs(int(x)) for x in r) for r in anchors), default=0) if np.abs(anchors).max(initial=0) >= 2**40 else int(np.abs(anchors).sum(1).max(initial=0))
    wide, bits, fields, bias = packed(candidates, reach)
    kind = wide.dtype
    if kind == object:
        mine = np.array([[int(x) for x in r] for r in anchors], object).reshape(anchors.shape)
    else:
        mine = anchors if kind == np.float64 else anchors.astype(np.int64).view(np.uint64)
    half = 1 << bits - 1
    sums = mine @ wide + kind.type(sum(half << bits * k for k in range(fields))) if kind != object else mine @ wide + sum(half << bits * k for k in range(fields))
    out = np.empty((*sums.shape, fields), object if kind == object else np.int64)
    if kind == np.float64:
        sums = sums.astype(np.uint64)
    for k in range(fields):
        if kind == object:
            out[..., k] = ((sums >> bits * k) & (2 * half - 1)) - half
        else:
            out[..., k] = (((sums >> np.uint64(bits * k)) & np.uint64(2 * half - 1)) - np.uint64(half)).view(np.int64)
    out = out.reshape(len(anchors), out.shape[1] * fields)[:, : len(candidates)]
    shift = mine.sum(1) * bias if kind == object else anchors.astype(np.int64).sum(1) * bias
    out = out - shift[:, None]
    return np.array(np.clip(out, -_LONG, _LONG - 1), np.int64) if kind == object else out


def whole(parts: bytes, dims: int) -> np.ndarray:
    """Components floor(SCALE * x), as doubles, by row."""
    return np.floor(SCALE * np.frombuffer(parts, np.float64)).reshape(-1, dims)


class Best:
    """The first `k` candidates of each query by score, larger first, then by id, nulls last."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score, self.id = np.full(queries, -_LONG), np.full(queries, _LONG - 1)  # of the k-th
        self.held = [np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool)]  # query, score, id, null

    def add(self, found: np.ndarray, ids: np.ndarray, nulls: np.ndarray, allowed: np.ndarray) -> None:
        """Scores of queries by candidates, where allowed."""
        at = self.score[:, None]
        better = found > at
        better |= (found == at) & (ids < self.id[:, None])
        better &= allowed
        q, c = np.nonzero(better)
        if not len(q):
            return
        new = (q, found[q, c], ids[c], nulls[c])
        query, score, id_, null = (np.concatenate(x) for x in zip(self.held, new))
        order = np.lexsort((id_, null, ~score, query))
        query = query[order]
        starts = np.flatnonzero(np.diff(query, prepend=-1))
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(starts, append=len(query)))
        kept = order[rank < self.k]
        self.held = [x[kept] for x in (np.concatenate((self.held[0], q)), score, id_, null)]
        last = order[rank == self.k - 1]
        full = query[rank == self.k - 1]
        self.score[full], self.id[full] = score[last], id_[last]


def _searched(k: int, block: int, low: int, high: int):
    """Rows (key, anchor_id, slot, positive_id, positive_score, id, score) of the best of each cell; without positives, slot 0 and those of the same label."""

    def cell(anchors: list[dict], blocks: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        dims = max(a["dims"] for a in anchors)
        mine = np.zeros((len(anchors), dims))
        for i, a in enumerate(anchors):
            mine[i, : a["dims"]] = whole(a["parts"], a["dims"])
        key = np.array([a["key"] for a in anchors])
        label = np.concatenate([np.frombuffer(a["labels"], np.int64) for a in anchors])
        given = [a["positives"] for a in anchors]
        slots = 1 if given[0] is None else max(map(len, given))
        bands = []
        for slot in range(slots if given[0] is not None else 0):
            s = [p[slot]["score"] if len(p) > slot else None for p in given]
            bands.append((np.array([_LONG - 1 if x is None else -(-low * x // 100) for x in s])[:, None], np.array([-_LONG if x is None else high * x // 100 for x in s])[:, None]))
        best = [Best(len(anchors), k) for _ in range(slots)]
        for b in blocks:
            theirs, ids, nulls = whole(b["parts"], b["dims"]), np.frombuffer(b["ids"], np.int64), np.frombuffer(b["nulls"], bool)
            ids = np.where(nulls, _LONG - 1, ids)
            same = label[:, None] == np.frombuffer(b["labels"], np.int64)
            n = min(dims, b["dims"])
            found = scores(mine[:, :n], theirs[:, :n])
            if not bands:
                own = np.flatnonzero(key // block == b["key"])
                same[own, key[own] % block] = False
                best[0].add(found, ids, nulls, same)
            for (lo, hi), x in zip(bands, best):
                x.add(found, ids, nulls, ~same & (found >= lo) & (found <= hi))
        anchor_id = np.concatenate([np.frombuffer(a["ids"], np.int64) for a in anchors])
        for slot, x in enumerate(best):
            q, score, id_, null = x.held
            positive = [given[i][slot] if bands else {"id": None, "score": None} for i in q]
            columns = [pa.array(key[q]), pa.array(anchor_id[q]), pa.array(np.full(len(q), slot + 1, np.int32)), pa.array([p["id"] for p in positive], pa.int64()), pa.array([p["score"] for p in positive], pa.int64()), pa.array(id_, mask=null), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "anchor_id", "slot", "positive_id", "positive_score", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ({n: batch.column(n)[i].as_py() for n in batch.schema.names} for batch in batches for i in range(batch.num_rows))
        row = next(rows, None)
        while row is not None:
            name, anchors = row["cell"], []
            while row is not None and row["cell"] == name and row["kind"] == 0:
                anchors.append(row)
                row = next(rows, None)

            def blocks() -> Iterator[dict]:
                nonlocal row
                while row is not None and row["cell"] == name:
                    yield row
                    row = next(rows, None)

            if anchors:
                yield from cell(anchors, blocks())
            for _ in blocks():  # those of a cell without anchors
                pass

    return run


def mine(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, every: int = EVERY, block: int = BLOCK, anchors: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of vectors(vec_id, embedding, label).

    Rows with a null label or vector, or with a component that is null or not finite,
    take no part. A row is a row even if its id or all of it is repeated: each anchor
    row has its own positives and negatives, and its copies are other rows. Null ids
    are no anchors and come after all others among equal scores. Vectors of unequal
    length are compared as if zeros followed the shorter one; empty ones score 0.
    Scores that a long can't hold stay at its ends. A positive with a negative score
    has an empty band. Other columns are ignored; an empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vec"))
    rows = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))
    gathered = cut(rows.mapInArrow(_gather(block, every), GATHERED), "kind")
    chosen, blocks = gathered.where("kind = 0"), gathered.where("kind = 1")
    n, m = chosen.count(), blocks.count()
    groups = max(1, -(-n // anchors))
    wide = max(1, min(-(-2 * vectors.sparkSession.sparkContext.defaultParallelism // groups), m // 4))

    def search(first: DataFrame, k: int) -> DataFrame:
        a = first.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups))).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(wide - 1))))
        b = blocks.withColumn("positives", F.lit(None).cast(dict(first.dtypes)["positives"])).withColumn("part", F.pmod(F.xxhash64("key"), F.lit(wide)).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
        cells = a.unionByName(b).withColumn("cell", F.col("group") * wide + F.col("part")).drop("group", "part")
        dealt = cells.repartition(groups * wide, "cell").sortWithinPartitions("cell", "kind", "key")
        found = dealt.mapInArrow(_searched(k, block, low, high), "key long, anchor_id long, slot int, positive_id long, positive_score long, id long, score long")
        order = Window.partitionBy("key", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    kind = "array<struct<rank:int,id:bigint,score:bigint>>"
    first = cut(search(chosen.withColumn("positives", F.lit(None).cast(kind)), positives))
    known = first.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).cast(kind).alias("positives"))  # `positives` entries at most
    found = cut(search(chosen.join(known, "key").where(F.exists("positives", lambda p: p["score"] >= 0)), negatives))
    discard(first)
    discard(gathered)
    return found.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def relabelled(vectors: DataFrame) -> DataFrame:
    """Rows whose id is divisible by 7 get the label (label + 1) % 10."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
