"""Prefix trie of rebuilt conversations, screened by a count-min sketch.

A prefix is known by the running exclusive or of its turns' digests, each of which
covers the turn's place: 128 bits. Turns are range-partitioned by conversation and
place, and a range starts with what the ranges before say about its first
conversation, so a conversation can have any length.

A count-min sketch counts all prefixes; its counters stop at two and are two bits,
"seen" and "seen again". A prefix with a counter of one is in no other conversation,
nor is any longer one, so the tail after it is emitted where it is read. The others,
and the first prefix of a tail, are shuffled and grouped by digest, exactly.

The nodes whose smallest member is c form a stretch of c's own path, so sums over a
subtree need no descent: a node's weight is charged to its smallest member, and a
node's sum is that over its members of what they are charged from its depth on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoweave.llm.common import cut, fold
from histoweave.operators.relational import RANGE_ROWS, number_rows
from histoweave.sources.written import discard

#: A conversation takes its first turns, fewer than HEADS, from the one whose id is rounded to a multiple of FAMILY.
FAMILY, HEADS = 20, 4
#: Counters of each of the sketch's two rows, at most; 4 for each prefix while they are fewer. More prefixes pass the screen then, and results stay exact.
COUNTERS = 1 << 27
#: Bytes of a sketch that are merged, and characters of ids that are hashed, as one row.
CHUNK = 1 << 16
#: Places of a conversation that one window covers.
STRETCH = 4096
WORD = r"[^\x20\x09-\x0D]+"

TAIL, SHARED, EDGE = range(3)
PREFIX = "c long, pos long, total long, words long, g1 long, g2 long"


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, n (from 1), digest and words of every turn, by turn, null first, and equal ones by digest: the md5 of the role's length, a colon, the role and the text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return number_rows(rows, ["turn", "digest"], "n", ("conv_id",)).select("conv_id", "n", "digest", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (c, total), and their turns (c, pos, total, digest, words): the first of the family's head, then their own after as many."""
    h = fold("conv_id", HEADS).cast("long")
    own = turns.groupBy("conv_id").agg(F.count("*").alias("own")).select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("head"))
    size = own.select(F.col("conv_id").alias("head"), F.col("own").alias("theirs"))
    convs = cut(own.join(size, "head", "left").withColumn("taken", F.least("h", F.coalesce("theirs", F.lit(0)))).withColumn("total", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    first = turns.where(F.col("n") < HEADS).select(F.col("conv_id").alias("head"), "n", "digest", "words")
    heads = convs.join(first, "head").where("n <= h").select(F.col("conv_id").alias("c"), F.col("n").alias("pos"), "total", "digest", "words")
    rest = turns.join(convs, "conv_id").where("n > h").select(F.col("conv_id").alias("c"), (F.col("n") - F.col("h") + F.col("taken")).alias("pos"), "total", "digest", "words")
    return convs, heads.unionByName(rest)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running exclusive or of g1 and g2 in each conversation, from what the task reads first."""
    from pyspark import TaskContext

    part, before = TaskContext.get().partitionId(), (None, np.int64(0), np.int64(0))
    for batch in batches:
        if not batch.num_rows:
            continue
        c = batch.column(0).to_numpy()
        fresh = np.concatenate(([c[0] != before[0]], c[1:] != c[:-1]))
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(c)), 0))
        out = []
        for i, old in ((4, before[1]), (5, before[2])):
            sums = np.concatenate((np.zeros(1, np.int64), np.bitwise_xor.accumulate(batch.column(i).to_numpy())))
            out.append(sums[1:] ^ sums[start] ^ np.where((start == 0) & ~fresh[0], old, 0))
        before = (c[-1], out[0][-1], out[1][-1])
        columns = [*batch.columns[:4], *map(pa.array, out), pa.array(np.full(len(c), part, np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["c", "pos", "total", "words", "g1", "g2", "part"])


def prefixes(turns: DataFrame, rows: int) -> DataFrame:
    """c, pos, total, words, g1, g2 for every prefix of conversations, written in order of c and pos."""
    digest = [F.xxhash64("pos", "digest").alias("g1"), F.xxhash64(F.lit(1), "digest", "pos").alias("g2")]
    ranged = turns.select("c", "pos", "total", "words", *digest).repartitionByRange(max(8, -(-rows // RANGE_ROWS)), "c", "pos").sortWithinPartitions("c", "pos")
    out = cut(ranged.mapInArrow(_running, PREFIX + ", part int"))
    last = F.max(F.struct("c", "pos", "g1", "g2"))
    borders = out.groupBy("part").agg(F.min(F.struct("c", "pos")).alias("first"), last.alias("last")).collect()  # one row a range
    offsets, c, x1, x2 = [], None, 0, 0
    for r in sorted(borders, key=lambda r: r["part"]):
        goes_on = r["first"]["c"] == c
        if goes_on:
            offsets.append((r["part"], c, x1, x2))
        same = goes_on and r["last"]["c"] == c
        c, x1, x2 = r["last"]["c"], r["last"]["g1"] ^ (x1 if same else 0), r["last"]["g2"] ^ (x2 if same else 0)
    if not offsets:
        return out.drop("part")
    known = out.sparkSession.createDataFrame(offsets, "part int, c long, x1 long, x2 long")
    joined = out.join(F.broadcast(known), ["part", "c"], "left")  # one row a range at most
    full = [F.col(g).bitwiseXOR(F.coalesce(x, F.lit(0).cast("long"))).alias(g) for g, x in (("g1", "x1"), ("g2", "x2"))]
    return joined.select("c", "pos", "total", "words", *full)


def counters(rows: int, most: int = COUNTERS) -> int:
    """Counters of a row of the sketch: a power of two."""
    return min(most, max(1 << 13, 1 << max(0, 4 * rows - 1).bit_length()))


def cells(g1: np.ndarray, g2: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A digest's counter in each of the sketch's rows; `width` is a power of two."""
    return tuple((g.view(np.uint64) & np.uint64(width - 1)).astype(np.int64) for g in (g1, g2))


def count(seen: np.ndarray, again: np.ndarray, at: np.ndarray) -> None:
    """Count the counters `at` in bitsets of those that are at one or more, and at two."""
    cell, n = np.unique(at, return_counts=True)
    byte, bit = cell >> 3, (1 << (cell & 7)).astype(np.uint8)
    twice = (n > 1) | (seen[byte] & bit > 0)
    np.bitwise_or.at(again, byte[twice], bit[twice])
    np.bitwise_or.at(seen, byte, bit)


def _counted(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = (np.zeros((2, width // 8), np.uint8) for _ in range(2))
        for batch in batches:
            for row, at in enumerate(cells(batch.column("g1").to_numpy(), batch.column("g2").to_numpy(), width)):
                count(seen[row], again[row], at)
        for row in range(2):
            for lo in range(0, width // 8, CHUNK):
                if seen[row, lo : lo + CHUNK].any():
                    yield pa.RecordBatch.from_pydict({"row": pa.array([row], pa.int32()), "at": pa.array([lo], pa.int64()), "seen": [seen[row, lo : lo + CHUNK].tobytes()], "again": [again[row, lo : lo + CHUNK].tobytes()]})

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of equal place, which come one after another, as one."""
    place, seen, again = None, None, None

    def done() -> Iterator[pa.RecordBatch]:
        if place is not None and again.any():
            yield pa.RecordBatch.from_pydict({"row": pa.array([place[0]], pa.int32()), "at": pa.array([place[1]], pa.int64()), "again": [again.tobytes()]})

    for batch in batches:
        for i in range(batch.num_rows):
            new = (batch.column("row")[i].as_py(), batch.column("at")[i].as_py())
            s, a = (np.frombuffer(batch.column(n)[i].as_py(), np.uint8) for n in ("seen", "again"))
            if new != place:
                yield from done()
                place, seen, again = new, s.copy(), a.copy()
            else:
                again |= a | (seen & s)
                seen |= s
    yield from done()


def sketch(found: DataFrame, rows: int, most: int = COUNTERS) -> np.ndarray:
    """Two bitsets of the counters that are at two or more; the driver gets these, at most `most` / 4 bytes."""
    width = counters(rows, most)
    parts = found.select("g1", "g2").coalesce(max(8, 4 * found.sparkSession.sparkContext.defaultParallelism)).mapInArrow(_counted(width), "row int, at long, seen binary, again binary")
    merged = parts.repartition("row", "at").sortWithinPartitions("row", "at").mapInArrow(_merged, "row int, at long, again binary")
    out = np.zeros((2, width // 8), np.uint8)
    for r in merged.collect():
        bits = np.frombuffer(r["again"], np.uint8)
        out[r["row"], r["at"] : r["at"] + len(bits)] = bits
    return out


def screened(found: DataFrame, bits: np.ndarray) -> DataFrame:
    """Prefixes with `kind`: TAIL if it and the one before are proven to be of one conversation, EDGE if it is and the one before isn't or isn't in this task, else SHARED."""
    shared = found.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = shared.value
        width, last = again.shape[1] * 8, (None, 0, False)
        for batch in batches:
            if not batch.num_rows:
                continue
            c, pos = batch.column("c").to_numpy(), batch.column("pos").to_numpy()
            alone = np.zeros(len(c), bool)
            for row, at in enumerate(cells(batch.column("g1").to_numpy(), batch.column("g2").to_numpy(), width)):
                alone |= again[row, at >> 3] >> (at & 7) & 1 == 0
            follows = np.concatenate(([c[0] == last[0] and pos[0] == last[1] + 1], (c[1:] == c[:-1]) & (pos[1:] == pos[:-1] + 1)))
            start = np.maximum.accumulate(np.where(follows, 0, np.arange(len(c))))
            hits = np.cumsum(alone)
            tail = hits - np.where(start > 0, hits[start - 1], 0) > 0  # a proven one at or before it
            tail |= (start == 0) & follows[0] & last[2]
            before = np.concatenate(([last[2]], tail[:-1])) & follows
            last = (c[-1], pos[-1], tail[-1])
            kind = np.where(tail, np.where(before, TAIL, EDGE), SHARED).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(n.split()[0]) for n in PREFIX.split(", ")), pa.array(kind)], names=[*(n.split()[0] for n in PREFIX.split(", ")), "kind"])

    return found.mapInArrow(run, PREFIX + ", kind int")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (g1, g2, c) to rows of comma-joined ids, in order, of about CHUNK characters."""
    node, ids, size = None, [], 0

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (*node, ids[0])] + [pa.array([",".join(map(str, ids))])], names=["g1", "g2", "first", "ids"])

    for batch in batches:
        for g1, g2, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (g1, g2) != node or size >= CHUNK:
                if ids:
                    yield done()
                node, ids, size = (g1, g2), [], 0
            ids.append(c)
            size += 20
    if ids:
        yield done()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (g1, g2, first, ids) to the SHA-256 of each node's list."""
    node, running = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([running.hexdigest()])], names=["g1", "g2", "ends_sha256"])

    for batch in batches:
        for g1, g2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if (g1, g2) != node:
                if node:
                    yield done()
                node, running = (g1, g2), hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
    if node:
        yield done()


def ends_of(members: DataFrame, rows: int) -> DataFrame:
    """g1, g2, ends_sha256 of members(g1, g2, c): lists are written in ranges, in rows of bounded size, which one task hashes in order."""
    keys = ("g1", "g2", "c")
    lists = members.select(*keys).repartitionByRange(max(8, -(-rows // RANGE_ROWS)), *keys).sortWithinPartitions(*keys).mapInArrow(_lists, "g1 long, g2 long, first long, ids string")
    return lists.repartition("g1", "g2").sortWithinPartitions("g1", "g2", "first").mapInArrow(_hashes, "g1 long, g2 long, ends_sha256 string")


def _paths(shared: DataFrame) -> DataFrame:
    """Shared and edge prefixes with their node's n, rep and ends, the parent's rep (null at depth 1), and what their conversation adds to the node's children, leaves and savings.

    Windows cover a stretch of a conversation, with its neighbours' border rows;
    the sums of later stretches come by a join.
    """
    node = shared.where(F.col("kind") == SHARED).groupBy("g1", "g2").agg(F.count("*").alias("n"), F.min("c").alias("rep"), F.sum((F.col("pos") == F.col("total")).cast("long")).alias("ends"))
    many = shared.where(F.col("kind") == SHARED).join(node, ["g1", "g2"])
    one = shared.where(F.col("kind") == EDGE).select("*", F.lit(1).cast("long").alias("n"), F.col("c").alias("rep"), (F.col("pos") == F.col("total")).cast("long").alias("ends"))
    mine = F.col("rep") == F.col("c")
    rows = many.unionByName(one)
    rows = rows.withColumn("charge", F.when(mine, (F.col("n") - 1) * F.col("words")).otherwise(0)).withColumn("leaf", (F.col("kind") == EDGE) | (mine & (F.col("pos") == F.col("total")) & (F.col("ends") == F.col("n"))))
    stretch = [F.floor((F.col("pos") - k) / STRETCH) for k in (1, 2, 0)]
    rows = rows.withColumn("at", F.explode(F.array_distinct(F.filter(F.array(*stretch), lambda x: x >= 0)))).withColumn("copy", F.col("at") != stretch[0])
    rows = rows.withColumn("charge", F.when(F.col("copy"), 0).otherwise(F.col("charge"))).withColumn("leaf", F.col("leaf") & ~F.col("copy"))
    by = Window.partitionBy("c", "at").orderBy("pos")
    near = rows.select("*", F.lag("pos").over(by).alias("pos_"), F.lag("rep").over(by).alias("rep_"), F.lead("rep").over(by).alias("next"), F.sum("charge").over(by.rowsBetween(0, Window.unboundedFollowing)).alias("sum"), F.max("leaf").over(Window.partitionBy("c", "at")).alias("any"))
    whole = rows.where(F.col("total") > STRETCH).groupBy("c", "at").agg(F.sum("charge").alias("s"), F.max("leaf").alias("l"))
    along = Window.partitionBy("c").orderBy("at")
    later = whole.select("c", "at", F.sum("s").over(along.rowsBetween(1, Window.unboundedFollowing)).alias("later"), F.max("l").over(Window.partitionBy("c")).alias("far"))
    near = near.where(~F.col("copy")).join(later, ["c", "at"], "left")
    parent = F.when(F.col("pos") == 1, F.lit(None)).when(F.col("pos_") == F.col("pos") - 1, F.col("rep_")).otherwise(F.col("c"))
    child = (F.col("pos") < F.col("total")) & F.coalesce(F.col("next") == F.col("c"), F.lit(False))
    saved = F.col("sum") + F.coalesce("later", F.lit(0))
    return near.select("g1", "g2", "c", "pos", "total", "kind", "n", "rep", parent.alias("parent"), child.cast("long").alias("child"), (F.col("any") | F.coalesce("far", F.lit(False))).cast("long").alias("leaves"), saved.alias("saved"))


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def trie(conversations: DataFrame, most: int = COUNTERS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of conversations(conv_id, turn, role, text).

    Rows with a null conv_id belong to no conversation. Null roles and texts are
    empty; turns with equal or null numbers are ordered by the md5 of role and text;
    repeated rows are turns each. Remainders of negative ids are negative, so such an
    id is rounded towards zero. Long texts and long conversations are read whole.
    Other columns are ignored. A table without conversations has no node.
    """
    turns = cut(turns_of(conversations))
    convs, rows_of = rebuilt(turns)
    n, least, rows = convs.agg(F.count("*"), F.min("conv_id"), F.coalesce(F.sum("total"), F.lit(0))).first()
    found = cut(prefixes(rows_of, rows))
    discard(turns)
    marked = screened(found, sketch(found, rows, most))
    end, at_end, none = F.col("pos") == F.col("total"), _sha(F.col("c").cast("string")), _sha(F.lit(""))
    shared = cut(marked.where(F.col("kind") != TAIL))
    paths = cut(_paths(shared))
    root = F.lit(least).cast("long")
    turnless = convs.where("total = 0").select(F.lit(0).cast("long").alias("g1"), F.lit(0).cast("long").alias("g2"), F.col("conv_id").alias("c"))
    ends = ends_of(shared.where((F.col("kind") == SHARED) & end).select("g1", "g2", "c").unionByName(turnless), n)
    ends = cut(ends)
    nodes = paths.where(F.col("kind") == SHARED).groupBy("g1", "g2").agg(F.min("rep").alias("conv_id"), F.min("pos").alias("depth"), F.min(F.when(F.col("rep") == F.col("c"), F.coalesce("parent", root))).alias("parent_conv_id"), F.min("n").alias("n_convs"), F.sum("child").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    nodes = nodes.join(ends, ["g1", "g2"], "left").drop("g1", "g2").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    one = F.lit(1).cast("long")
    alone = [F.col("c").alias("conv_id"), F.col("pos").alias("depth"), one.alias("n_convs"), (~end).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.when(end, at_end).otherwise(none).alias("ends_sha256")]
    edges = paths.where(F.col("kind") == EDGE).select(*alone, F.coalesce("parent", root).alias("parent_conv_id"))
    inner = cut(nodes.unionByName(edges))
    tails = marked.where(F.col("kind") == TAIL).select(*alone, F.col("c").alias("parent_conv_id"))
    top = inner.where("depth = 1").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"))
    top = top.select(root.alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(n).cast("long").alias("n_convs"), "n_children", F.coalesce("n_leaves", one).alias("n_leaves"), "saved_tokens", F.lit(0).cast("long").alias("g1"), F.lit(0).cast("long").alias("g2")).where(F.lit(n > 0))
    top = top.join(ends, ["g1", "g2"], "left").drop("g1", "g2").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    for t in (shared, paths):
        discard(t)
    return tails.unionByName(inner).unionByName(top).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
