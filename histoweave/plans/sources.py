"""Scans and sinks on files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.plans.registry import Tables, query
from histoweave.sources import tables as S
from histoweave.sources.written import new_path

C = F.col


def _csv(t: Tables, df: DataFrame, **options) -> str:
    path = new_path(t.spark, "csv")
    S.write_csv(df, path, **options)
    return path


_PART = "p_partkey bigint, p_name string, p_size int, p_retailprice double"


@query("src-01", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part WHERE p_size>10")
def _(t: Tables) -> DataFrame:
    return S.read_csv(t.spark, _csv(t, t.part.select("p_partkey", "p_name", "p_size", "p_retailprice")), _PART).where("p_size > 10")


@query("src-02", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def _(t: Tables) -> DataFrame:
    return S.read_csv(t.spark, _csv(t, t.part.select("p_partkey", "p_name", "p_size", "p_retailprice"), header=False), _PART, header=False)


@query("src-03", "SELECT * FROM (SELECT 'crlf' AS kind, true AS ordered, count(*) AS lines, CAST(0 AS BIGINT) AS bare FROM part UNION ALL SELECT 'mixed', false, count(*), count(*) FILTER (p_partkey%3=0) FROM part) x")
def _(t: Tables) -> DataFrame:
    """Column order and line ends of a file as it should be, and of one with the columns turned and some line ends bare."""
    names = ["p_partkey", "p_name"]
    good = S.line_report(t.spark, _csv(t, t.part.select(*names)), names).withColumn("kind", F.lit("crlf"))
    path = new_path(t.spark, "csv")
    line = F.concat_ws(",", "p_name", "p_partkey", F.when(C("p_partkey") % 3 != 0, "\r"))
    turned = t.part.select(F.regexp_replace(line, ",\r$", "\r").alias("value"))
    turned.write.text(path)
    t.spark.range(1, numPartitions=1).select(F.lit("p_name,p_partkey\r").alias("value")).write.mode("append").text(path)
    return good.unionByName(S.line_report(t.spark, path, names).withColumn("kind", F.lit("mixed")))


@query("src-04", "SELECT o_orderkey AS REDCapID, strftime(o_orderdate, '%Y-%m-%d') AS DateCollected, o_orderpriority AS Note FROM orders")
def _(t: Tables) -> DataFrame:
    raw = t.orders.select(C("o_orderkey").alias("REDCapID"), F.date_format("o_orderdate", "MM/dd/yyyy").alias("Date Collected"), C("o_orderpriority").alias("Note"))
    back = S.read_clinical(t.spark, _csv(t, raw))
    return back.select(C("REDCapID").cast("long").alias("REDCapID"), C("DateCollected").cast("string").alias("DateCollected"), "Note")


@query("src-05", "SELECT c_custkey, c_acctbal/2e0 AS width, 2e0 AS pscale FROM customer")
def _(t: Tables) -> DataFrame:
    long = t.customer.select("c_custkey", C("c_acctbal").alias("width"), F.lit(2.0).alias("pscale")).unpivot("c_custkey", ["width", "pscale"], "name", "value")
    return S.constants(long, "c_custkey", ["width", "pscale"], {"width": "pscale"})


@query("src-06", "SELECT p_partkey, p_size AS w, p_size*2 AS h FROM part")
def _(t: Tables) -> DataFrame:
    path = new_path(t.spark, "xml")
    t.part.select("p_partkey", C("p_size").alias("w"), (C("p_size") * 2).alias("h")).write.format("xml").options(rowTag="Rect", rootTag="Layout").save(path)
    return t.spark.read.format("xml").option("rowTag", "Rect").schema("p_partkey bigint, w int, h int").load(path)


@query("src-07", "SELECT p_partkey, k AS layer, p_size+k AS exposure FROM part, (SELECT unnest(generate_series(1, 3)) AS k) x")
def _(t: Tables) -> DataFrame:
    text = F.concat(F.lit("<E><T>"), F.concat_ws(" ", *[C("p_size") + k for k in (1, 2, 3)]), F.lit("</T></E>"))
    e = t.part.select("p_partkey", F.posexplode(F.split(F.from_xml(text, "T string")["T"], " ")).alias("k", "v"))
    return e.select("p_partkey", (C("k") + 1).cast("long").alias("layer"), C("v").cast("long").alias("exposure"))


@query("src-08", "SELECT s_suppkey, s_nationkey+1 AS width, 2e0 AS scale FROM supplier")
def _(t: Tables) -> DataFrame:
    text = F.concat(F.lit("<P><shape width='"), C("s_nationkey") + 1, F.lit("'/><scale>2.0</scale></P>"))
    return t.supplier.select("s_suppkey", F.xpath_int(text, F.lit("/P/shape/@width")).alias("width"), F.xpath_double(text, F.lit("/P/scale")).alias("scale"))


def _annotations(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    v = F.concat(*[F.concat(F.lit('<V X="'), C("n_nationkey") + k, F.lit('" Y="'), C("n_regionkey") * k, F.lit('"/>')) for k in (1, 2, 3)])
    xml = F.concat(F.lit('<R><Annotation Layer="'), C("n_regionkey") + 1, F.lit('" Name="'), C("n_name"), F.lit('"><Region Id="1" Neg="0">'), v, F.lit('</Region><Region Id="2" Neg="1">'), v, F.lit("</Region></Annotation></R>"))
    return S.annotation_rows(t.nation.select("n_nationkey", xml.alias("x")), "n_nationkey", "x")


@query("src-09", "SELECT n_nationkey, (n_regionkey+1)*1000+m AS regionid, k-1 AS vid, n_nationkey+k AS x, n_regionkey*k AS y FROM nation, (SELECT unnest(generate_series(1, 2)) AS m) a, (SELECT unnest(generate_series(1, 3)) AS k) b")
def _(t: Tables) -> DataFrame:
    return _annotations(t)[2].withColumn("vid", C("vid").cast("long"))


@query("src-09-regions", "SELECT n_nationkey, CAST(n_regionkey+1 AS BIGINT) AS layer, CAST((n_regionkey+1)*1000+m AS BIGINT) AS regionid, m-1 AS neg, CAST(3 AS INT) AS nvert FROM nation, (SELECT unnest(generate_series(1, 2)) AS m) a")
def _(t: Tables) -> DataFrame:
    return _annotations(t)[1]


@query("src-10", "SELECT vec_id, layer, CAST(sum(v) AS BIGINT) AS total FROM pixels WHERE layer IN (1, 2) GROUP BY vec_id, layer")
def _(t: Tables) -> DataFrame:
    """Pixels stored as raw little-endian blocks of a file and read back by layer."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("k", "v"))), lambda p: p["v"])
    path = new_path(t.spark, "raw")
    t.pixels.groupBy("vec_id").agg(S.pack_int32(ordered).alias("raw")).write.parquet(path)
    back = t.spark.read.parquet(path).select("vec_id", F.posexplode(S.unpack_int32(C("raw"))).alias("k", "v"))
    return back.where((C("k") % 4).isin(1, 2)).groupBy("vec_id", (C("k") % 4).alias("layer")).agg(F.sum("v").alias("total"))


@query("src-13", "SELECT vec_id, count(*) FILTER (v>0) AS n FROM pixels GROUP BY vec_id")
def _(t: Tables) -> DataFrame:
    """Masks packed as bits, eight pixels a byte, and counted from the bits."""
    bits = t.pixels.groupBy("vec_id", F.floor(C("k") / 8).alias("byte")).agg(F.sum(F.when(C("v") > 0, F.expr("shiftleft(1, 7 - k % 8)")).otherwise(0)).alias("b"))
    return bits.groupBy("vec_id").agg(F.sum(F.bit_count("b")).cast("long").alias("n"))


@query("src-14", "SELECT n_regionkey, pos, n_nationkey AS x FROM (SELECT n_regionkey, n_nationkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey)-1 AS pos FROM nation) x")
def _(t: Tables) -> DataFrame:
    path = new_path(t.spark, "json")
    t.nation.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct(C("n_nationkey").alias("x")))).alias("oligo")).write.json(path)
    spots = t.spark.read.schema("n_regionkey int, oligo array<struct<x:int>>").json(path)
    return spots.select("n_regionkey", F.posexplode("oligo").alias("pos", "s")).select("n_regionkey", C("pos").cast("long").alias("pos"), C("s.x").alias("x"))


@query("src-15", "SELECT slide_id, message, count(*) AS n FROM runlog GROUP BY slide_id, message")
def _(t: Tables) -> DataFrame:
    log = t.runlog.select(F.lit("p").alias("project"), F.lit("c").alias("cohort"), "slide_id", "message", C("ts").cast("string").alias("time"))
    return S.read_log(t.spark, _csv(t, log, header=False, sep=";")).groupBy("slide_id", "message").agg(F.count("*").alias("n"))


@query("src-17", "SELECT source, count(*) AS n FROM (SELECT DISTINCT source FROM documents WHERE regexp_matches(source, '[05]$')) x GROUP BY source")
def _(t: Tables) -> DataFrame:
    path = new_path(t.spark, "dir")
    t.documents.select("doc_id", "source").repartition("source").write.partitionBy("source").csv(path)
    files = S.scan_directory(t.spark, path, "csv$").select(F.regexp_extract("path", "source=([^/]*)", 1).alias("source"))
    return files.where(C("source").rlike("[05]$")).groupBy("source").agg(F.lit(1).cast("long").alias("n"))


@query("src-19", "SELECT n_nationkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS layer FROM nation")
def _(t: Tables) -> DataFrame:
    """A file for each region, whose rows are numbered as layers."""
    path = new_path(t.spark, "csv")
    rows = t.nation.select("n_nationkey", "n_regionkey").repartition(5, "n_regionkey").sortWithinPartitions("n_regionkey", "n_nationkey")
    rows.write.partitionBy("n_regionkey").option("header", True).csv(path)
    return S.union_numbered(t.spark, path, "n_nationkey int").select("n_nationkey", C("layer").cast("long").alias("layer"))


@query("src-20", "SELECT count(*) AS nrows FROM part")
def _(t: Tables) -> DataFrame:
    path = new_path(t.spark, "csv")
    t.part.select("p_partkey", "p_size").write.option("header", True).csv(path)
    lines = t.spark.read.text(path).groupBy(F.input_file_name().alias("file")).agg((F.count("*") - 1).alias("n"))
    return lines.agg(F.sum("n").alias("nrows"))


@query("ag-26", "SELECT p_brand, count(*) AS nrows FROM part GROUP BY p_brand")
def _(t: Tables) -> DataFrame:
    path = new_path(t.spark, "csv")
    t.part.select("p_brand", "p_partkey").write.partitionBy("p_brand").option("header", True).csv(path)
    rows = t.spark.read.schema("p_partkey bigint, p_brand string").option("header", True).csv(path)
    return rows.groupBy("p_brand").agg(F.count("*").alias("nrows"))


@query("snk-01", "SELECT count(*) AS lines, count(*) AS crlf FROM supplier")
def _(t: Tables) -> DataFrame:
    lines = t.spark.read.option("lineSep", "\n").text(_csv(t, t.supplier, header=False))
    return lines.agg(F.count("*").alias("lines"), F.count_if(F.endswith("value", F.lit("\r"))).alias("crlf"))


@query("snk-02", "SELECT r_regionkey, count(*) AS n FROM (SELECT r_regionkey FROM region UNION ALL SELECT r_regionkey FROM region) x GROUP BY r_regionkey")
def _(t: Tables) -> DataFrame:
    path, schema = new_path(t.spark, "csv"), "r_regionkey int, r_name string"
    S.write_csv(t.region, path)
    if S.read_csv(t.spark, path, schema).columns != t.region.columns:
        raise ValueError("appended rows need the table's columns")
    t.region.write.mode("append").options(header=True, lineSep="\r\n").csv(path)
    return S.read_csv(t.spark, path, schema).groupBy("r_regionkey").agg(F.count("*").alias("n"))


@query("snk-04", "SELECT doc_id, source, n_chars FROM documents")
def _(t: Tables) -> DataFrame:
    path = _csv(t, t.documents.select("doc_id", "source", "n_chars"), header=False)
    return S.read_csv(t.spark, path, "doc_id bigint, source string, n_chars bigint", header=False)


@query("snk-07", "SELECT layer, CAST(level AS INT) AS level, count(*) AS tiles FROM pixels, (SELECT unnest(generate_series(0, 2)) AS level) k WHERE pixel%pow(2, level)=0 GROUP BY layer, level")
def _(t: Tables) -> DataFrame:
    path = new_path(t.spark, "zoom")
    zoom = t.pixels.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(2)))).where(F.expr("pixel % shiftleft(1, level) = 0"))
    zoom.select("vec_id", "pixel", "v", "layer", "level").write.partitionBy("layer", "level").parquet(path)
    return t.spark.read.parquet(path).groupBy("layer", "level").agg(F.count("*").alias("tiles"))


@query("snk-09", "SELECT scan, count(*) AS n FROM (SELECT doc_id, 1 AS scan FROM documents WHERE doc_id%3=0 UNION ALL SELECT doc_id, 2 FROM documents WHERE doc_id%3=1 UNION ALL SELECT doc_id, 3 FROM documents WHERE doc_id%3=2) x GROUP BY scan")
def _(t: Tables) -> DataFrame:
    path = new_path(t.spark, "scans")
    for k in range(3):
        t.documents.where(C("doc_id") % 3 == k).select("doc_id", F.lit(k + 1).alias("scan")).write.mode("append").parquet(path)
    return t.spark.read.parquet(path).groupBy("scan").agg(F.count("*").alias("n"))
