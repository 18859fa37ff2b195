"""Toxicity by compression distance.

Two zstandard dictionaries are made from bounded samples of labelled rows: the
ordinary one is trained on windows of ordinary texts, the toxic one has the same
content and then the passages that set toxic texts apart, the commonest nearest to
the window. A window's distance is the number of bytes by which the toxic
dictionary compresses it shorter than the ordinary one. What exceeds a threshold is
summed over a text's windows, against the square root of their number, and a second
threshold on that sum decides. Both are calibrated on labelled rows that the
dictionaries haven't seen; the score is logistic in the sum around the second one.

The toxic content isn't trained by zstandard: its trainer fills a dictionary with
what is frequent, which is ordinary words in toxic texts too (README has figures).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each class that are learned from at most, chosen by a hash.
SAMPLE = 6000
#: Sizes of the model: ordinary windows, and distinctive words, that its dictionaries are made from at most.
WINDOWS, WORDS = 40_000, 2_000
WINDOW = 64
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 4_096
LEVEL = 9
#: Bytes of a window's distance that may count as none; calibration chooses one.
THRESHOLDS = (0, 1, 2, 3)
#: A distinctive word occurs in this share of toxic texts and this many times as often as in others.
SUPPORT, RATIO = 0.02, 8.0


def windows(text: str | None) -> list[bytes]:
    """The whole text in lower case, in windows of at most WINDOW bytes that end at spaces where there are any."""
    b, out, i = (text or "").lower().encode("utf-8", "surrogatepass"), [], 0
    while i < len(b):
        j = len(b) if len(b) - i <= WINDOW else b.rfind(b" ", i + 1, i + WINDOW)
        if j < 0:
            j = i + WINDOW
        out.append(b[i:j])
        i = j
    return out


def _train(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary, without its tables; samples too few to train on are the content themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()[-max(size - 1000, size // 2) :]
    except (zstandard.ZstdError, ValueError):
        return b" ".join(dict.fromkeys(samples))[-size:]


@functools.lru_cache(maxsize=4)
def _compressor(content: bytes):
    import zstandard

    kind = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=128, dict_size=len(content), format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    kind.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=kind, compression_params=how).compress


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    threshold: float = 0.0
    intercept: float | None = None  # None: a constant score, the prior
    slope: float = 0.0
    prior: float = 0.0

    def distances(self, text: str | None) -> np.ndarray:
        """Of each window: its length by the ordinary dictionary less that by the toxic one."""
        plain, toxic = _compressor(self.ordinary), _compressor(self.ordinary + self.toxic)
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows(text)], np.float64)

    def score(self, text: str | None) -> float:
        if self.intercept is None:
            return self.prior
        return float(1 / (1 + np.exp(-np.clip(self.intercept + self.slope * excess(self.distances(text), self.threshold), -30, 30))))


def excess(distances: np.ndarray, threshold: float) -> float:
    return float(np.maximum(distances - threshold, 0).sum() / math.sqrt(max(len(distances), 1)))


def calibrate(sums: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """(weighted errors, threshold, slope): the threshold on the sums with the fewest errors, midway between two values; the slope is the ordinary sums' inverse deviation."""
    order = np.argsort(sums, kind="stable")
    x, w = sums[order], np.where(y[order] > 0, weight[order], -weight[order])
    errors = np.concatenate(([weight[y == 0].sum()], weight[y == 0].sum() + np.cumsum(w)))  # of calling the first i ordinary
    ends = np.concatenate(([True], x[1:] != x[:-1], [True]))
    best = int(np.where(ends, errors, np.inf).argmin())
    cut = x[0] - 1 if best == 0 else x[-1] + 1 if best == len(x) else (x[best - 1] + x[best]) / 2
    return float(errors[best]), float(cut), 1 / max(float(sums[y == 0].std()), 0.05)


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for toxic, text in zip(pdf["toxic"], pdf["text"]):
            found = set((text or "").lower().encode("utf-8", "surrogatepass").split())
            yield pd.DataFrame({"toxic": toxic, "word": list(found)}).astype({"toxic": "int32"})


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for text in pdf["text"]:
            yield pd.DataFrame({"w": pd.Series(list(set(windows(text))), dtype=object)})


def fit(docs: DataFrame, labels: DataFrame, train: Column, sample: int = SAMPLE) -> ToxicityModel:
    """Learn from docs(doc_id, text) and labels(doc_id, toxic), of rows where `train`, an expression of doc_id, holds.

    Null labels and texts are no training rows; a document with several labels
    counts as its largest. A class without rows gives a constant score.
    """
    known = labels.where(train & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not all(totals.get(c) for c in (0, 1)):
        return ToxicityModel(b"", b"", prior=1.0 if totals.get(1) else 0.0)
    chosen = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (0, 1)]
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * sample rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null").join(picked, "doc_id").dropDuplicates(["text"]).select("toxic", "text", F.pmod(F.xxhash64("text"), F.lit(10)).alias("part")).cache()
    seen = {r["toxic"]: r["n"] for r in rows.where("part < 7").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    few = max(2, int(SUPPORT * seen.get(1, 0)))
    words = rows.where("part < 7").select("toxic", "text").mapInPandas(_words, "toxic int, word binary").groupBy("word").agg(F.sum("toxic").alias("yes"), F.sum(1 - F.col("toxic")).alias("no"))
    apart = words.where((F.col("yes") >= few) & (F.col("yes") / max(seen.get(1, 0), 1) >= RATIO * (F.col("no") + 1) / max(seen.get(0, 0), 1)))
    apart = [(bytes(r["word"]), r["yes"]) for r in apart.orderBy(F.desc("yes"), "word").limit(WORDS).collect()]
    plain = [bytes(r["w"]) for r in rows.where("part < 7 and toxic = 0").select("text").mapInPandas(_windows, "w binary").distinct().orderBy(F.xxhash64("w"), "w").limit(WINDOWS).collect()]
    toxic = b"".join(w + b" " for w, _ in reversed(apart))[-TOXIC_BYTES:]
    model = ToxicityModel(_train(plain, ORDINARY_BYTES), toxic, prior=totals[1] / sum(totals.values()))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [model.distances(x) for x in pdf["text"]]
            yield pd.DataFrame([[t, *(excess(d, c) for c in THRESHOLDS)] for t, d in zip(pdf["toxic"], found)], columns=["toxic", *[f"x{c}" for c in THRESHOLDS]])

    held = rows.where("part >= 7").select("toxic", "text").mapInPandas(measure, ", ".join(["toxic int", *[f"x{c} double" for c in THRESHOLDS]])).toPandas()
    rows.unpersist()
    y = held["toxic"].to_numpy(np.int64)
    if toxic and 0 < y.sum() < len(y):
        weight = np.where(y > 0, totals[1] / y.sum(), totals[0] / (len(y) - y.sum())) / sum(totals.values())
        (_, cut, slope), model.threshold = min((calibrate(held[f"x{c}"].to_numpy(np.float64), y, weight), c) for c in THRESHOLDS)
        model.intercept, model.slope = -slope * cut, slope
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and predicted for every row of docs(doc_id, text).

    Null texts score as empty ones, whose sum is 0. Rows with null or equal ids
    are scored each, equal texts alike; predicted is 1 from a score of 0.5, ties
    included. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64()), pa.array([int(x >= 0.5) for x in found], pa.int32())], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")
