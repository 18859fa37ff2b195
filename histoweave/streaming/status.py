"""The same states from a stream of log lines, one keyed state for each slide and module."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.operators.workflow import state


def status_stream(log: DataFrame) -> DataFrame:
    """An update of (slide_id, module, status, pos) for every key of each micro-batch.

    State is the largest place of each kind of line, four numbers a key whatever
    the length of the log; lines may come in any order.
    """
    at = lambda m: F.max(F.when(F.col("message") == m, F.col("pos"))).alias(m.lower())
    places = log.groupBy("slide_id", "module").agg(at("START"), at("FINISH"), at("ERROR"), F.max("pos").alias("pos"))
    return places.select("slide_id", "module", state(F.col("start"), F.col("finish"), F.col("error")).alias("status"), "pos")


def distinct_events(events: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """Collapses repeated events that come within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, time: str, width: str, slide: str, late: str, *by: str) -> DataFrame:
    """Events in tumbling or sliding windows, final once the watermark has passed."""
    return events.withWatermark(time, late).groupBy(F.window(time, width, slide), *by).agg(F.count("*").alias("n"))


def heartbeat_gaps(log: DataFrame, gap: str) -> DataFrame:
    """Sessions of a slide's lines; a job whose session has closed without FINISH is an orphan."""
    w = F.session_window("ts", gap)
    return log.groupBy("slide_id", w.alias("w")).agg(F.count("*").alias("lines"), F.max((F.col("message") == "FINISH").cast("int")).alias("done"), F.max("ts").alias("until"))
