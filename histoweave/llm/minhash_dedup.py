"""MinHash near-duplicates by a signature-coordinate inverted join.

Every distinct shingle set is posted under its (coordinate, value) pairs. Two
signatures that agree on at least `matches` of `coordinates` coordinates share a
pair among the first `coordinates - matches + 1` of either when the pairs are
ordered by frequency, so only that prefix is joined; pairs of one document alone
are skipped, and a document with fewer than `matches` shared pairs is skipped
altogether. Candidates of short lists are counted pair by pair; members of long
lists are gathered into one cluster without listing their pairs. Inside a
cluster, blocks of bounded size count collisions, retain what reaches `matches`
and confirm it on the full sets.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.llm.common import cut
from histoweave.llm.words import SHINGLE, shingle_set
from histoweave.operators.components import components

COORDINATES, MATCHES = 48, 30
#: Lists up to this length are counted pair by pair.
SHORT = 32
#: Documents of a block that one task compares with another block.
BLOCK = 256
#: Node tables up to this many rows are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 500_000


@functools.cache
def _hashes(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(coordinates)
    return rng.integers(1, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, coordinates, dtype=np.uint64)


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Minimum of each coordinate's hash, as signed 32-bit integers."""
    a, b = _hashes(coordinates)
    low = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[i : i + 4096, None] * a + b).min(0))
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _rows(docs: DataFrame) -> DataFrame:
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ids.withColumn("row", F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "text"))


def signatures(docs: DataFrame, coordinates: int = COORDINATES, k: int = SHINGLE) -> DataFrame:
    """doc_id, row (a hash of id and text), n_shingles, two halves of the set's 128-bit hash, and the signature (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row, text = batch.column(0), batch.column(1), batch.column(2)
            n, first, second, sig = [], [], [], []
            for t in text:
                s = shingle_set(t.as_py(), k)
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                n.append(len(s))
                first.append((d >> 65))
                second.append((d & (2**63 - 1)))
                sig.append(signature(s, coordinates) if len(s) else None)
            yield pa.RecordBatch.from_arrays([ids, row, pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(sig, pa.list_(pa.int32()))], names=["doc_id", "row", "n_shingles", "k1", "k2", "sig"])

    return _rows(docs).select("doc_id", "row", "text").mapInArrow(run, "doc_id long, row long, n_shingles long, k1 long, k2 long, sig array<int>")


def prefixes(classes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(doc, key, hub, size): the prefix postings of documents that can have a partner, with their list's smallest member and length."""
    posts = classes.select("doc", F.posexplode("sig").alias("c", "v")).select("doc", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("v").cast("long")).alias("key"))
    shared = posts.groupBy("key").agg(F.count("*").alias("f")).where("f > 1")
    kept = posts.join(shared, "key").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("f", "key"))).alias("keys")).where(F.size("keys") >= matches)
    lists = cut(kept.select("doc", F.explode(F.slice("keys", F.lit(1), F.size("keys") - matches + 1)).alias("p")).select("doc", F.col("p.key").alias("key")))
    heads = lists.groupBy("key").agg(F.min("doc").alias("hub"), F.count("*").alias("size")).where("size > 1")
    return cut(lists.join(heads, "key"))


def candidate_edges(lists: DataFrame, classes: DataFrame, matches: int) -> DataFrame:
    """Edges whose components hold every pair that reaches `matches` collisions."""
    short = lists.where(F.col("size") <= SHORT)
    pairs = short.select("key", F.col("doc").alias("a")).join(short.select("key", F.col("doc").alias("b")), "key").where("a < b").select("a", "b").distinct()
    sig = classes.select("doc", "sig")
    same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    counted = pairs.join(sig.select(F.col("doc").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("doc").alias("b"), F.col("sig").alias("sb")), "b").where(same >= matches).select("a", "b")
    return counted.unionByName(lists.where(F.col("size") > SHORT).select(F.col("hub").alias("a"), F.col("doc").alias("b")))


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), k) for t in batch.column("text")]
            keep = [batch.column(c) for c in ("cluster", "i", "j", "doc", "own")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array([s.tobytes() for s in sets], pa.binary())], names=["cluster", "i", "j", "doc", "own", "shingles"])

    return run


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact intersection sizes of all sets of one block with all of another, by products of incidence blocks."""
    out = np.zeros((len(left), len(right)), np.float32)
    own, other = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(own, other)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    at = [np.minimum(np.searchsorted(both, x), max(len(both) - 1, 0)) for x in (own, other)]
    hit = [both[p] == x if len(both) else np.zeros(len(x), bool) for p, x in zip(at, (own, other))]
    for lo in range(0, len(both), 4096):
        sides = []
        for side, size in ((0, len(left)), (1, len(right))):
            m = np.zeros((size, min(4096, len(both) - lo)), np.float32)
            here = hit[side] & (at[side] >= lo) & (at[side] < lo + 4096)
            m[rows[side][here], at[side][here] - lo] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _links(coordinates: int, matches: int, numerator: int, denominator: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("doc")
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        left = pdf[pdf["own"] == i]
        right = left if i == j else pdf[pdf["own"] == j]
        none = pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        if left.empty or right.empty:
            return none
        sets = [[np.frombuffer(x, np.uint64) for x in side["shingles"]] for side in (left, right)]
        sigs = [np.stack([signature(s, coordinates) for s in side]) for side in sets]
        count = np.zeros((len(left), len(right)), np.int16)
        for c in range(coordinates):
            count += sigs[0][:, c, None] == sigs[1][None, :, c]
        kept = count >= matches
        if i == j:
            kept = np.triu(kept, 1)
        x, y = kept.any(1), kept.any(0)
        if not x.any():
            return none
        left, right, kept = left[x], right[y], kept[np.ix_(x, y)]
        sets = [[s for s, on in zip(side, flag) if on] for side, flag in zip(sets, (x, y))]
        inter = _overlaps(*sets)
        union = np.array([len(s) for s in sets[0]])[:, None] + np.array([len(s) for s in sets[1]])[None, :] - inter
        a, b = np.nonzero(kept & (denominator * inter >= numerator * union))
        a, b = left["doc"].to_numpy()[a], right["doc"].to_numpy()[b]
        root: dict[int, int] = {}

        def find(n: int) -> int:
            while (up := root.get(n, n)) != n:
                root[n] = root.get(up, up)
                n = up
            return n

        tree = []
        for p, q in zip(a.tolist(), b.tolist()):
            if (r := find(p)) != (s := find(q)):
                root[max(r, s)] = min(r, s)
                tree.append((p, q))
        return pd.DataFrame(tree, columns=["a", "b"], dtype=np.int64) if tree else none

    return run


def verified_links(docs: DataFrame, clusters: DataFrame, coordinates: int, matches: int, k: int, numerator: int, denominator: int) -> DataFrame:
    """A forest (a, b) of links that hold on full sets, spanning each component of a block pair's links."""
    sizes = clusters.groupBy("component").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    placed = clusters.join(sizes, "component").select(F.col("component").alias("cluster"), F.col("node").alias("doc"), own.alias("own"), blocks.alias("blocks"))
    placed = placed.select("cluster", "doc", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    placed = placed.select("cluster", "doc", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    nodes = clusters.select(F.col("node").alias("doc"))
    if nodes.count() <= BROADCAST_ROWS:
        nodes = F.broadcast(nodes)
    texts = _rows(docs).select(F.col("row").alias("doc"), "text").join(nodes, "doc", "left_semi")
    sets = placed.join(texts, "doc").mapInArrow(_sets(k), "cluster long, i int, j int, doc long, own int, shingles binary")
    return sets.groupBy("cluster", "i", "j").applyInPandas(_links(coordinates, matches, numerator, denominator), "a long, b long")


def near_duplicates(docs: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES, k: int = SHINGLE, numerator: int = 85, denominator: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs(doc_id, text).

    Documents are linked when denominator * |A and B| >= numerator * |A or B| on
    their sets of k-word shingles; component_id is the smallest doc_id reachable.
    Equal sets are one class and are linked without being paired. Null, empty and
    blank texts have an empty set and are linked with nothing. Rows that share a
    doc_id count as one document with several texts, so their classes are linked;
    a row with a null doc_id takes the component of its class, null if all ids
    reachable are, and is kept if it is null. Other columns are ignored.

    A link at exactly 0.85 is missed with the probability that fewer than 30 of
    48 coordinates agree, 3e-5; it falls steeply above that.
    """
    found = cut(signatures(docs, coordinates, k))
    classes = cut(found.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min("row").alias("doc"), F.min("doc_id").alias("id"), F.first("sig").alias("sig")))
    lists = prefixes(classes, coordinates, matches)
    clusters = components(candidate_edges(lists, classes, matches))
    links = cut(verified_links(docs, clusters, coordinates, matches, k, numerator, denominator))
    texts = found.where("n_shingles > 0 and doc_id is not null")
    several = texts.groupBy("doc_id").agg(F.min(F.struct("k1", "k2")).alias("low"), F.max(F.struct("k1", "k2")).alias("high")).where("low != high").select("doc_id")
    owned = texts.join(several, "doc_id").select("doc_id", "k1", "k2").distinct().join(classes.select("k1", "k2", "doc"), ["k1", "k2"])
    same_id = owned.join(owned.groupBy("doc_id").agg(F.min("doc").alias("a")), "doc_id").select("a", F.col("doc").alias("b")).where("a != b")
    linked = components(links.unionByName(same_id))
    grouped = classes.select("k1", "k2", "doc", "id").join(linked.withColumnRenamed("node", "doc"), "doc", "left").withColumn("group", F.coalesce("component", "doc"))
    grouped = cut(grouped.select("k1", "k2", "id", "group"))
    named = grouped.select("k1", "k2", "group").join(grouped.groupBy("group").agg(F.min("id").alias("c")), "group").select("k1", "k2", "c")
    out = found.select("doc_id", "n_shingles", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("c")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
