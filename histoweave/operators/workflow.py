"""Run status from logs: last lines, runs, decision tables and closures over dependencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_lines(log: DataFrame) -> DataFrame:
    """Place of the last START, FINISH and ERROR line of each slide and module; last is by place in the log, not by time."""
    at = lambda m: F.max(F.when(F.col("message") == m, F.col("pos"))).alias(m.lower())
    return log.groupBy("slide_id", "module").agg(at("START"), at("FINISH"), at("ERROR"))


def state(start: Column, finish: Column, error: Column) -> Column:
    """State of a step. An error counts if it lies after the start and not after the finish."""
    hit = error.isNotNull() & (error >= start) & (finish.isNull() | (finish < start) | (error <= finish))
    return F.when(start.isNull(), "WAITING").when(hit, "ERROR").when(finish > start, "FINISHED").otherwise("RUNNING")


def run_status(log: DataFrame) -> DataFrame:
    return last_lines(log).select("slide_id", "module", state(F.col("start"), F.col("finish"), F.col("error")).alias("status"))


def runs(log: DataFrame) -> DataFrame:
    """Lines folded into runs: a run begins at each START; lines before the first one are run 0."""
    w = Window.partitionBy("slide_id", "module").orderBy("pos")
    numbered = log.withColumn("run", F.sum((F.col("message") == "START").cast("long")).over(w))
    return numbered.groupBy("slide_id", "module", "run").agg(F.count("*").alias("lines"), F.count_if(F.col("message") == "ERROR").alias("errors"), F.count_if(F.col("message") == "FINISH").alias("finishes"))


def run_history(log: DataFrame, cleanup: Column) -> DataFrame:
    """Runs with what became of them, of the run before, and the last run that began clean.

    A run ends as FINISHED, ERROR or OPEN by its last line of these kinds. It begins
    clean if it is the first or has a line for which `cleanup` holds.
    """
    w = Window.partitionBy("slide_id", "module").orderBy("pos")
    numbered = log.withColumn("run", F.sum((F.col("message") == "START").cast("long")).over(w)).withColumn("clean", cleanup).where("run > 0")
    last = F.max_by("message", F.when(F.col("message").isin("FINISH", "ERROR"), F.col("pos")))
    found = numbered.groupBy("slide_id", "module", "run").agg(last.alias("last"), F.max(F.col("clean").cast("int")).alias("clean"), F.count("*").alias("lines"))
    ended = F.when(F.col("last") == "FINISH", "FINISHED").when(F.col("last") == "ERROR", "ERROR").otherwise("OPEN")
    runs = Window.partitionBy("slide_id", "module").orderBy("run")
    begun = F.when((F.col("clean") == 1) | (F.col("run") == 1), F.col("run"))
    found = found.withColumn("ended", ended)
    return found.select("slide_id", "module", "run", "lines", "ended", F.lag("ended").over(runs).alias("previous"), F.max(begun).over(runs).alias("clean_since"))


def module_status(log: DataFrame, samples: DataFrame, needs: dict[str, str | None]) -> DataFrame:
    """Status of every module of every sample(slide_id, isgood): NA for a bad sample, READY if it waits for nothing, else the log's.

    `needs` names the module that each one needs, or None.
    """
    every = samples.select("slide_id", "isgood", F.explode(F.array(*[F.lit(m) for m in needs])).alias("module"))
    known = run_status(log)
    need = F.create_map(*[x for m, n in needs.items() if n for x in (F.lit(m), F.lit(n))])
    before = known.select("slide_id", F.col("module").alias("need"), F.col("status").alias("before"))
    found = every.join(known, ["slide_id", "module"], "left").withColumn("need", need[F.col("module")]).join(before, ["slide_id", "need"], "left")
    waits = F.coalesce("status", F.lit("WAITING")) == "WAITING"
    ready = waits & (F.col("need").isNull() | (F.col("before") == "FINISHED"))
    return found.select("slide_id", "module", F.when(F.col("isgood") == 0, "NA").when(ready, "READY").otherwise(F.coalesce("status", F.lit("WAITING"))).alias("status"))


def wanted(status: Column, ready: Column, rerun_errors: bool = True) -> Column:
    """Why a step should run or not."""
    out = F.when(~ready, "dependency").when(status == "FINISHED", "done").when(status == "RUNNING", "busy")
    return (out if rerun_errors else out.when(status == "ERROR", "failed")).otherwise("run")


def close_over_dependencies(status: DataFrame, edges: list[tuple[str, str]], key: str = "slide_id") -> DataFrame:
    """Adds `final`: a finished step whose dependencies, direct or not, aren't all finished has to run again.

    Edges are (step, what it needs) of an acyclic graph; steps are taken in
    topological order, as columns of one row a slide.
    """
    need: dict[str, list[str]] = {}
    for a, b in edges:
        need.setdefault(a, []).append(b)
        need.setdefault(b, [])
    order: list[str] = []

    def visit(step: str, above: tuple[str, ...]) -> None:
        if step in above:
            raise ValueError(f"{step} depends on itself")
        for b in need[step]:
            visit(b, (*above, step))
        if step not in order:
            order.append(step)

    for s in sorted(need):
        visit(s, ())
    wide = status.groupBy(key).pivot("module", order).agg(F.first("status"))
    for s in order:
        whole = F.lit(True)
        for b in need[s]:
            whole = whole & (F.coalesce(F.col(b), F.lit("WAITING")) == "FINISHED")
        wide = wide.withColumn(s, F.when((F.col(s) == "FINISHED") & ~whole, "OUTDATED").otherwise(F.coalesce(F.col(s), F.lit("WAITING"))))
    return wide.unpivot(key, order, "module", "final")


def file_events(before: DataFrame, after: DataFrame) -> DataFrame:
    """(file, event, was) between two listings (file, h): Changed, Renamed, Created and Deleted; `was` is the old name of a renamed file, the largest of several."""
    changed = after.join(before.withColumnRenamed("h", "old"), "file").where("h <> old").select("file", F.lit("Changed").alias("event"), F.lit(None).cast("long").alias("was"))
    gone, new = before.join(after.select("file"), "file", "left_anti"), after.join(before.select("file"), "file", "left_anti")
    old_name = gone.groupBy("h").agg(F.max("file").alias("was"))
    came = new.join(old_name, "h", "left").select("file", F.when(F.col("was").isNull(), "Created").otherwise("Renamed").alias("event"), "was")
    left = gone.join(new.select("h"), "h", "left_anti").select("file", F.lit("Deleted").alias("event"), F.lit(None).cast("long").alias("was"))
    return changed.unionByName(came).unionByName(left)
