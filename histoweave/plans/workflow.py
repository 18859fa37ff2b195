"""Run status, queues and events, in batch and as replayed streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histoweave.operators import workflow as W
from histoweave.plans.registry import Tables, query
from histoweave.sources.written import new_path
from histoweave.streaming import status as T

C = F.col

_LAST = "SELECT slide_id, module, max(CASE WHEN message='START' THEN pos END) AS start, max(CASE WHEN message='FINISH' THEN pos END) AS finish, max(CASE WHEN message='ERROR' THEN pos END) AS error FROM runlog GROUP BY slide_id, module"
_STATE = f"SELECT slide_id, module, CASE WHEN start IS NULL THEN 'WAITING' WHEN error>=start AND (finish IS NULL OR finish<start OR error<=finish) THEN 'ERROR' WHEN finish>start THEN 'FINISHED' ELSE 'RUNNING' END AS status FROM ({_LAST}) l"


@query("wn-12", _LAST)
def _(t: Tables) -> DataFrame:
    return W.last_lines(t.runlog)


@query("st-06", f"WITH s AS ({_STATE}), m AS (SELECT slide_id, isgood, 'align' AS module, NULL AS need FROM sampledef UNION ALL SELECT slide_id, isgood, 'warp', 'align' FROM sampledef) SELECT m.slide_id, m.module, CASE WHEN isgood=0 THEN 'NA' WHEN coalesce(s.status, 'WAITING')='WAITING' AND (m.need IS NULL OR b.status='FINISHED') THEN 'READY' ELSE coalesce(s.status, 'WAITING') END AS status FROM m LEFT JOIN s ON s.slide_id=m.slide_id AND s.module=m.module LEFT JOIN s b ON b.slide_id=m.slide_id AND b.module=m.need")
def _(t: Tables) -> DataFrame:
    return W.module_status(t.runlog, t.sampledef, {"align": None, "warp": "align"})


_RUNS = """WITH r AS (SELECT *, sum(CASE WHEN message='START' THEN 1 ELSE 0 END) OVER (PARTITION BY slide_id, module ORDER BY pos) AS run FROM runlog)
 SELECT slide_id, module, CAST(run AS BIGINT) AS run, count(*) AS lines, count(*) FILTER (message='ERROR') AS errors, count(*) FILTER (message='FINISH') AS finishes FROM r GROUP BY slide_id, module, run"""


_HISTORY = """WITH r AS (SELECT *, CAST(sum(CASE WHEN message='START' THEN 1 ELSE 0 END) OVER (PARTITION BY slide_id, module ORDER BY pos) AS BIGINT) AS run FROM runlog),
 g AS (SELECT slide_id, module, run, count(*) AS lines, CASE WHEN coalesce(max(CASE WHEN message='FINISH' THEN pos END), -1)>coalesce(max(CASE WHEN message='ERROR' THEN pos END), -1) THEN 'FINISHED' WHEN max(CASE WHEN message='ERROR' THEN pos END) IS NOT NULL THEN 'ERROR' ELSE 'OPEN' END AS ended, max(CASE WHEN message='INFO' THEN 1 ELSE 0 END) AS clean FROM r WHERE run>0 GROUP BY slide_id, module, run)
 SELECT slide_id, module, run, lines, ended, lag(ended) OVER w AS previous, max(CASE WHEN clean=1 OR run=1 THEN run END) OVER w AS clean_since FROM g WINDOW w AS (PARTITION BY slide_id, module ORDER BY run)"""


@query("wn-13", _HISTORY)
def _(t: Tables) -> DataFrame:
    """Runs with the end of the one before; notes in the log mark what was cleaned up."""
    return W.run_history(t.runlog, C("message") == "INFO")


@query("st-13", f"WITH h AS ({_HISTORY}), e AS (SELECT slide_id, module, nxt AS continued FROM (SELECT *, lead(message) OVER (PARTITION BY slide_id, module ORDER BY pos) AS nxt FROM runlog) x WHERE message='ERROR' QUALIFY row_number() OVER (PARTITION BY slide_id, module ORDER BY pos DESC)=1) SELECT h.slide_id, h.module, max(run) AS last_run, max_by(ended, run) AS ended, max_by(clean_since, run) AS clean_since, count(*) FILTER (previous IN ('FINISHED', 'ERROR')) AS reruns, max(e.continued) AS continued FROM h LEFT JOIN e ON e.slide_id=h.slide_id AND e.module=h.module GROUP BY h.slide_id, h.module")
def _(t: Tables) -> DataFrame:
    """The log folded to its last run, with reruns, the last clean start and the line that follows the last error."""
    last = W.run_history(t.runlog, C("message") == "INFO").groupBy("slide_id", "module").agg(F.max("run").alias("last_run"), F.max_by("ended", "run").alias("ended"), F.max_by("clean_since", "run").alias("clean_since"), F.count_if(C("previous").isin("FINISHED", "ERROR")).alias("reruns"))
    follows = F.lead("message").over(Window.partitionBy("slide_id", "module").orderBy("pos"))
    errors = t.runlog.withColumn("next", follows).where("message = 'ERROR'").groupBy("slide_id", "module").agg(F.max_by("next", "pos").alias("continued"))
    return last.join(errors, ["slide_id", "module"], "left")


@query("flt-05", f"SELECT a.slide_id, CASE WHEN NOT coalesce(b.status='FINISHED', false) THEN 'dependency' WHEN a.status='FINISHED' THEN 'done' WHEN a.status='RUNNING' THEN 'busy' ELSE 'run' END AS decision FROM (SELECT * FROM ({_STATE}) x WHERE module='warp') a LEFT JOIN (SELECT * FROM ({_STATE}) x WHERE module='align') b ON a.slide_id=b.slide_id")
def _(t: Tables) -> DataFrame:
    s = W.run_status(t.runlog)
    need = s.where("module = 'align'").select("slide_id", (C("status") == "FINISHED").alias("ready"))
    return s.where("module = 'warp'").join(need, "slide_id", "left").select("slide_id", W.wanted(C("status"), F.coalesce("ready", F.lit(False))).alias("decision"))


@query("it-02", f"WITH s AS ({_STATE}), k AS (SELECT DISTINCT slide_id FROM s), a AS (SELECT k.slide_id, coalesce(s.status, 'WAITING') AS f FROM k LEFT JOIN s ON s.slide_id=k.slide_id AND module='align'), w AS (SELECT k.slide_id, coalesce(s.status, 'WAITING') AS f FROM k LEFT JOIN s ON s.slide_id=k.slide_id AND module='warp') SELECT slide_id, 'align' AS module, f AS final FROM a UNION ALL SELECT w.slide_id, 'warp', CASE WHEN w.f='FINISHED' AND a.f<>'FINISHED' THEN 'OUTDATED' ELSE w.f END FROM w JOIN a ON a.slide_id=w.slide_id")
def _(t: Tables) -> DataFrame:
    return W.close_over_dependencies(W.run_status(t.runlog), [("warp", "align")])


@query("st-03", "SELECT DISTINCT slide_id, module, message FROM runlog")
def _(t: Tables) -> DataFrame:
    return t.runlog.dropDuplicates(["slide_id", "module", "message"]).select("slide_id", "module", "message")


@query("st-05", "SELECT DISTINCT s.slide_id FROM runlog l JOIN sampledef d ON d.slide_id=l.slide_id JOIN sampledef s ON s.batch=d.batch WHERE l.message IN ('START', 'FINISH')")
def _(t: Tables) -> DataFrame:
    hit = t.runlog.where(C("message").isin("START", "FINISH")).select("slide_id").distinct()
    batches = t.sampledef.join(hit, "slide_id", "left_semi").select("batch").distinct()
    return t.sampledef.join(batches, "batch", "left_semi").select("slide_id")


@query("st-07", "SELECT slide_id, task, row_number() OVER (PARTITION BY slide_id ORDER BY task) AS place FROM (SELECT DISTINCT slide_id, task FROM (SELECT * FROM queue_main UNION ALL SELECT * FROM queue_local) q) x")
def _(t: Tables) -> DataFrame:
    once = t.queue_main.union(t.queue_local).select("slide_id", "task").distinct()
    return once.select("slide_id", "task", F.row_number().over(Window.partitionBy("slide_id").orderBy("task")).cast("long").alias("place"))


@query("st-08", f"SELECT d.batch, bool_and(coalesce(s.status, 'WAITING')='FINISHED') AS ready FROM sampledef d LEFT JOIN (SELECT * FROM ({_STATE}) x WHERE module='align') s ON s.slide_id=d.slide_id GROUP BY d.batch")
def _(t: Tables) -> DataFrame:
    s = W.run_status(t.runlog).where("module = 'align'").select("slide_id", "status")
    return t.sampledef.join(s, "slide_id", "left").groupBy("batch").agg(F.bool_and(F.coalesce("status", F.lit("WAITING")) == "FINISHED").alias("ready"))


@query("st-10", """WITH l AS (SELECT slide_id, ts, pos, message, CASE WHEN ts-lag(ts) OVER (PARTITION BY slide_id ORDER BY ts, pos)<INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS new FROM runlog), s AS (SELECT *, sum(new) OVER (PARTITION BY slide_id ORDER BY ts, pos ROWS UNBOUNDED PRECEDING) AS g FROM l),
 g AS (SELECT slide_id, count(*) AS lines, max(CASE WHEN message='FINISH' THEN 1 ELSE 0 END) AS done, max(ts) AS until FROM s GROUP BY slide_id, g) SELECT slide_id, lines, CASE WHEN done=1 THEN 'DONE' WHEN until<(SELECT max(ts) FROM runlog)-INTERVAL 10 MINUTE THEN 'ORPHAN' ELSE 'ALIVE' END AS state FROM g""")
def _(t: Tables) -> DataFrame:
    """Jobs as sessions of a slide's lines: without a last line they are orphans once the log has gone on for longer than the timeout."""
    log = t.runlog.withColumn("ts", C("ts").cast("timestamp"))
    jobs = T.heartbeat_gaps(log, "10 minutes")
    now = F.broadcast(log.agg(F.max("ts").alias("now")))  # one row
    state = F.when(C("done") == 1, "DONE").when(C("until") < C("now") - F.expr("INTERVAL 10 MINUTES"), "ORPHAN").otherwise("ALIVE")
    return jobs.join(now).select("slide_id", "lines", state.alias("state"))


def _replayed(t: Tables, stream, mode: str) -> DataFrame:
    """The events as a file stream, run to its end into a table of the shared folder."""
    spark, out = t.spark, new_path(t.spark, "stream")
    log = t.runlog.withColumn("ts", C("ts").cast("timestamp"))
    log.write.parquet(f"{out}/in")
    source = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 4).parquet(f"{out}/in")

    def sink(df: DataFrame, epoch: int) -> None:
        df.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{out}/result/batch={epoch}")

    q = stream(source).writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{out}/result")


@query("st-04", _STATE)
def _(t: Tables) -> DataFrame:
    """The status stream's last word on each key: the same as the batch form."""
    return _replayed(t, T.status_stream, "update").groupBy("slide_id", "module").agg(F.max_by("status", "epoch").alias("status"))


@query("st-01", "SELECT CAST(ts AS DATE)::VARCHAR AS day, message, count(*) AS n FROM runlog GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    counted = _replayed(t, lambda s: s.groupBy(F.to_date("ts").cast("string").alias("day"), "message").agg(F.count("*").alias("n")), "complete")
    last = counted.agg(F.max("epoch").alias("epoch"))
    return counted.join(F.broadcast(last), "epoch").select("day", "message", "n")  # one row


@query("ld-workflow", "SELECT r.slide_id, r.n, count(c.n) AS cells, coalesce(CAST(sum(c.w*c.h) AS BIGINT), 0) AS area FROM rect r LEFT JOIN cell c ON c.slide_id=r.slide_id AND c.field=r.n GROUP BY r.slide_id, r.n")
def _(t: Tables) -> DataFrame:
    """Ordered load steps, each a written table that the next one reads: fields, cells, joined counts."""
    spark, out = t.spark, new_path(t.spark, "load")
    t.rect.write.parquet(f"{out}/fields")
    t.cell.write.parquet(f"{out}/cells")
    cells = spark.read.parquet(f"{out}/cells").groupBy("slide_id", C("field").alias("n")).agg(F.count("*").alias("cells"), F.sum(C("w") * C("h")).alias("area"))
    return spark.read.parquet(f"{out}/fields").join(cells, ["slide_id", "n"], "left").select("slide_id", "n", F.coalesce("cells", F.lit(0)).cast("long").alias("cells"), F.coalesce("area", F.lit(0)).cast("long").alias("area"))


@query("st-01-changes", """WITH a AS (SELECT doc_id AS file, md5(text) AS h FROM documents WHERE doc_id%10<>0), b AS (SELECT CASE WHEN doc_id%9=0 THEN doc_id+1000000000 ELSE doc_id END AS file, md5(CASE WHEN doc_id%7=0 THEN text||'x' ELSE text END) AS h FROM documents WHERE doc_id%10<>1),
 gone AS (SELECT * FROM a WHERE file NOT IN (SELECT file FROM b)), new AS (SELECT * FROM b WHERE file NOT IN (SELECT file FROM a)), moved AS (SELECT n.file, max(g.file) AS was FROM new n JOIN gone g ON g.h=n.h GROUP BY n.file)
 SELECT b.file, 'Changed' AS event, CAST(NULL AS BIGINT) AS was FROM a JOIN b ON a.file=b.file AND a.h<>b.h UNION ALL SELECT file, 'Renamed', was FROM moved UNION ALL SELECT file, 'Created', NULL FROM new WHERE file NOT IN (SELECT file FROM moved) UNION ALL SELECT file, 'Deleted', NULL FROM gone WHERE h NOT IN (SELECT h FROM new)""")
def _(t: Tables) -> DataFrame:
    """Two listings of files with their hashes as events; a new name for a hash whose old name is gone is a renaming."""
    a = t.documents.where("doc_id % 10 <> 0").select(C("doc_id").alias("file"), F.md5("text").alias("h"))
    name = F.when(C("doc_id") % 9 == 0, C("doc_id") + 1_000_000_000).otherwise(C("doc_id"))
    b = t.documents.where("doc_id % 10 <> 1").select(name.alias("file"), F.md5(F.when(C("doc_id") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(C("text"))).alias("h"))
    return W.file_events(a, b)
