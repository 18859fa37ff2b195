"""Corpus preparation in five stages, each written as Parquet and reread by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histoweave.llm import decontamination, language_id, minhash_dedup, packing, secret_ledger
from histoweave.llm.common import cut, fold, table


def own_column(docs: DataFrame) -> str:
    """A name that no column has, for what tells rows apart inside a stage, as ids can be null or repeated."""
    name, taken = "row", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a determined language and write that to `lang`; others are rejected.

    Null, empty and letterless texts have none; rows with null or repeated ids are
    judged each, and other columns, whatever their names, stay as they are.
    """
    model = language_id.fit(docs, F.coalesce(fold("doc_id", 4) != 2, F.lit(True)))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    found = language_id.identify(docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())), model, tuple(names.values()), names["text"])
    kept = found.where(F.col("lang_pred") != language_id.UNDETERMINED)
    return kept.select(*(F.col("lang_pred" if c == "lang" else n).alias(c) for c, n in names.items()))


#: Share of common shingles, in hundredths, from which documents are near duplicates, and the coordinates of 48 that must agree; a link at exactly 0.80 is missed with probability 1.3e-5.
SIMILAR, MATCHES = 80, 26


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each near-duplicate group, one with the smallest id; a null id comes last, and texts without words have no group."""
    row = own_column(docs)
    rows = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    found = minhash_dedup.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), matches=MATCHES, numerator=SIMILAR)
    groups = found.select(F.col("doc_id").alias(row), "component_id").join(rows.select(row, F.col("doc_id").cast("long").alias("id")), row)
    kept = groups.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", row))[row].alias(row)).select(row)
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage within the edit budget; each row is judged where it is read."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by its kind in angle brackets; no document goes, null texts stay null."""
    return secret_ledger.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences; null and empty texts are one end token."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", redact),
    ("pack", pack),
]

#: SQL can't express learned languages, signatures or alignments; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
