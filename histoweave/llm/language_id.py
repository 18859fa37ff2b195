"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts come from the training rows by one Spark aggregation; the log-probability
matrix, of languages x buckets and so of a fixed size, is broadcast. A batch of
texts is one sparse matrix of counts, texts x buckets in rows of (text, bucket,
count), whose product with the log-probabilities scores all its texts in numpy.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows a language is learned from at most in expectation, chosen by a hash of the text.
SAMPLE = 20_000
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: The broadcast matrix holds at most so many languages.
LANGUAGES = 512
#: Code points featurised at once, and n-grams that are in a sparse matrix at least before it is multiplied.
BLOCK, MATRIX = 1 << 19, 1 << 20
UNDETERMINED = "und"
_STEP = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def features(text: str, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a text, in blocks; runs of other than letters count as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points = np.concatenate(([32], np.where(letter, points, 32)[keep])).astype(np.uint32)
    if len(points) > 1 and points[-1] != 32:
        points = np.append(points, np.uint32(32))
    top = max(ORDERS)
    for lo in range(0, max(len(points) - 1, 1), BLOCK):
        part = points[max(0, lo - top + 1) : lo + BLOCK]
        first = lo - max(0, lo - top + 1)
        out = []
        for n in ORDERS:
            if len(part) < n:
                continue
            h = np.full(len(part) - n + 1, n, np.uint32)
            for i in range(n):
                h = (h ^ part[i : len(part) - n + 1 + i]) * _STEP[i]
                h ^= h >> np.uint32(15)
            out.append((h % np.uint32(buckets))[max(0, first - n + 1) :])
        if out:
            yield np.concatenate(out)


def has_letters(text: str | None) -> bool:
    return bool(text) and bool(_letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].any())


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[str, np.ndarray] = {}
    for pdf in batches:
        for lang, text in zip(pdf["lang"], pdf["text"]):
            counts = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for f in features(text):
                counts += np.bincount(f, minlength=BUCKETS)
    for lang, counts in total.items():
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": counts[at]})


@dataclass
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # buckets x languages
    log_prior: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log-probabilities of texts x languages."""
        out = np.tile(self.log_prior, (len(texts), 1))
        held, size = [], 0
        for i, text in enumerate(texts):
            for f in features(text):
                held.append((i, f))
                size += len(f)
                if size >= MATRIX:
                    self._add(out, held)
                    held, size = [], 0
        self._add(out, held)
        return out

    def _add(self, out: np.ndarray, held: list[tuple[int, np.ndarray]]) -> None:
        """Adds the product of the sparse counts of some texts' n-grams with the matrix."""
        if not held:
            return
        cell = np.repeat(np.array([i for i, _ in held], np.int64) * BUCKETS, [len(f) for _, f in held]) + np.concatenate([f for _, f in held])
        cell, n = np.unique(cell, return_counts=True)
        text, bucket = cell // BUCKETS, cell % BUCKETS
        first = np.flatnonzero(np.diff(text, prepend=-1))
        for at in range(self.log_probability.shape[1]):
            out[text[first], at] += np.add.reduceat(self.log_probability[bucket, at] * n.astype(np.float64), first)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [(UNDETERMINED, 0.0)] * len(texts)
        some = [i for i, t in enumerate(texts) if has_letters(t)] if self.languages else []
        if some:
            total = self.scores([texts[i] for i in some])
            best = total.argmax(1)
            score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
            for i, b, x in zip(some, best.tolist(), score.tolist()):
                out[i] = (self.languages[b], x)
        return out


def fit(docs: DataFrame, train: Column, sample: int = SAMPLE, smoothing: float = 0.1) -> LanguageModel:
    """Learn from rows of docs(text, lang) where `train` holds and lang and text are not null.

    A language with more than `sample` rows gives the rows whose text hash falls
    under sample / rows. No training rows give a model that answers `und`.
    """
    known = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(rows) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages; the matrix is broadcast and bounded by that")
    if not rows:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    share = F.lit(2.0)
    for lang, n in rows.items():
        if n > sample:
            share = F.when(F.col("lang") == lang, sample / n).otherwise(share)
    known = known.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / 1_000_003 < share)
    counted = known.mapInPandas(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows)
    counts = np.zeros((BUCKETS, len(languages)))
    counts[counted["bucket"], counted["lang"].map({x: i for i, x in enumerate(languages)})] = counted["n"]
    p = (counts + smoothing) / (counts.sum(0) + smoothing * BUCKETS)
    prior = np.log(np.array([rows[x] for x in languages]) / sum(rows.values()))
    return LanguageModel(languages, np.log(p).astype(np.float32), prior)


def identify(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = (), text: str = "text") -> DataFrame:
    """The columns `keep` of docs, then lang_pred and score (the posterior) for every row; `text` names the column of texts.

    Null texts and texts without letters give `und` and 0; of languages with equal
    scores the first by name is predicted. Rows with null or equal ids are
    predicted each. Kept columns named lang_pred or score are refused; rename
    them.
    """
    if {"lang_pred", "score"} & set(keep):
        raise ValueError("lang_pred and score are made here")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    sent = keep if text in keep else (*keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict(batch.column(sent.index(text)).to_pylist())
            out = [pa.array([x[i] for x in found], kind) for i, kind in ((0, pa.string()), (1, pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *out], names=[*keep, "lang_pred", "score"])

    docs = docs.select(*(F.col(c).cast("string").alias(c) if c == text else c for c in sent))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema)
