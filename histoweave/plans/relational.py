"""Filters, projections, joins, sets, orders and numberings of the tabular layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histoweave.functions import scalars as S
from histoweave.operators import relational as R
from histoweave.plans.registry import Tables, query

C = F.col


@query("flt-01", "SELECT p_partkey, p_size FROM part WHERE p_size>40")
def _(t: Tables) -> DataFrame:
    return t.part.where("p_size > 40").select("p_partkey", "p_size")


@query("flt-03", "SELECT slide_id, batch FROM sampledef WHERE isgood=1")
def _(t: Tables) -> DataFrame:
    return t.sampledef.where("isgood = 1").select("slide_id", "batch")


_CHAIN = "CASE WHEN isgood<>1 THEN 'bad' WHEN batch>=20 THEN 'batch' WHEN cohort=3 THEN 'cohort' ELSE '' END"


@query("flt-04", f"SELECT slide_id, {_CHAIN} AS reason, concat_ws(',', CASE WHEN isgood<>1 THEN 'bad' END, CASE WHEN batch>=20 THEN 'batch' END, CASE WHEN cohort=3 THEN 'cohort' END) AS reasons FROM sampledef")
def _(t: Tables) -> DataFrame:
    checks = [("bad", C("isgood") == 1), ("batch", C("batch") < 20), ("cohort", C("cohort") != 3)]
    both = R.filter_chain(t.sampledef, checks, every=True).withColumnRenamed("reason", "reasons")
    return R.filter_chain(both, checks).select("slide_id", "reason", "reasons")


@query("flt-06", """WITH e AS (SELECT slide_id, max(CASE WHEN message='START' THEN pos END) AS a, max(CASE WHEN message='ERROR' THEN pos END) AS f, max(CASE WHEN message='FINISH' THEN pos END) AS g FROM runlog GROUP BY slide_id)
 SELECT slide_id, CASE WHEN a IS NULL THEN 'none' WHEN f>a THEN 'flagged' WHEN g>a THEN 'acquired' ELSE 'open' END AS state FROM e""")
def _(t: Tables) -> DataFrame:
    last = lambda m: F.max(F.when(C("message") == m, C("pos")))
    e = t.runlog.groupBy("slide_id").agg(last("START").alias("a"), last("ERROR").alias("f"), last("FINISH").alias("g"))
    return e.select("slide_id", F.when(C("a").isNull(), "none").when(C("f") > C("a"), "flagged").when(C("g") > C("a"), "acquired").otherwise("open").alias("state"))


@query("flt-07", "SELECT p_partkey, p_size FROM part WHERE p_size=(SELECT max(p_size) FROM part)")
def _(t: Tables) -> DataFrame:
    deepest = t.part.agg(F.max("p_size").alias("p_size"))
    return t.part.join(F.broadcast(deepest), "p_size").select("p_partkey", "p_size")  # one row


@query("flt-09", "SELECT slide_id, field, ctype, n, x, y FROM cell WHERE w*h>=36")
def _(t: Tables) -> DataFrame:
    return t.cell.where(C("w") * C("h") >= 36).select("slide_id", "field", "ctype", "n", "x", "y")


@query("flt-10", "SELECT vec_id, layer, round(avg(CASE WHEN v>0 THEN 1e0 ELSE 0e0 END), 6) AS tissue FROM pixels GROUP BY vec_id, layer HAVING sum(CASE WHEN v>0 THEN 1 ELSE 0 END)*10>=6*count(*)")
def _(t: Tables) -> DataFrame:
    g = t.pixels.groupBy("vec_id", "layer").agg(F.count_if(C("v") > 0).alias("on"), F.count("*").alias("all"))
    return g.where(C("on") * 10 >= C("all") * 6).select("vec_id", "layer", F.round(C("on") / C("all"), 6).alias("tissue"))


@query("flt-13", "SELECT c_custkey FROM customer WHERE regexp_matches(lower(c_mktsegment), '(y|on|auto)')")
def _(t: Tables) -> DataFrame:
    return t.customer.where(C("c_mktsegment").rlike("(?i)(y|on|auto)")).select("c_custkey")


@query("flt-14", "SELECT n_name, k FROM nation, (SELECT unnest(generate_series(2, 4)) AS k) x WHERE n_regionkey=1")
def _(t: Tables) -> DataFrame:
    return t.nation.where("n_regionkey = 1").select("n_name", F.explode(F.sequence(F.lit(2).cast("long"), F.lit(4).cast("long"))).alias("k"))


@query("flt-15", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE nullif(l_discount, 0) IS NOT NULL AND l_quantity>45")
def _(t: Tables) -> DataFrame:
    return t.lineitem.where(F.nullif("l_discount", F.lit(0)).isNotNull() & (C("l_quantity") > 45)).select("l_orderkey", "l_linenumber", "l_quantity")


@query("flt-16", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey HAVING count(*)>=600")
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n")).where("n >= 600")


@query("prj-01", "SELECT slide_id, n, cx+w/2e0 AS px, cy+h/2e0 AS py FROM rect")
def _(t: Tables) -> DataFrame:
    return t.rect.select("slide_id", "n", F.struct((C("cx") + C("w") / 2).alias("x"), (C("cy") + C("h") / 2).alias("y")).alias("p")).select("slide_id", "n", C("p.x").alias("px"), C("p.y").alias("py"))


@query("prj-02", "SELECT slide_id, n, cx, cy, w, h FROM rect")
def _(t: Tables) -> DataFrame:
    shared = [c for c in ("slide_id", "n", "x", "y", "cx", "cy", "w", "h") if c in t.rect.columns]
    return t.rect.select(*shared)


@query("prj-03", "SELECT slide_id, n, round(w*(2e0/0.5), 6) AS w_px, round(w*h*(2e0/0.5)*(2e0/0.5), 6) AS area_px FROM rect")
def _(t: Tables) -> DataFrame:
    return t.rect.select("slide_id", "n", F.round(S.convert_scale(C("w"), 0.5, 2.0), 6).alias("w_px"), F.round(S.convert_scale(C("w") * C("h"), 0.5, 2.0, 2), 6).alias("area_px"))


@query("prj-04", "SELECT l_orderkey, l_extendedprice, floor((l_extendedprice+1e-10)/0.5)*0.5 AS p FROM lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_extendedprice", S.floor_to_pixel(C("l_extendedprice"), 0.5).alias("p"))


@query("prj-05", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q FROM lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", S.strict_long(C("l_quantity"), 1e-9).alias("q"))


@query("prj-06", "SELECT n_nationkey, CASE n_name WHEN 'NATION_0' THEN 'good tissue' WHEN 'NATION_1' THEN 'tumor' ELSE lower(n_name) END AS name FROM nation")
def _(t: Tables) -> DataFrame:
    synonyms = t.nation.where("n_nationkey < 2").select("n_name", F.when(C("n_nationkey") == 0, "good tissue").otherwise("tumor").alias("to"))
    return t.nation.join(synonyms, "n_name", "left").select("n_nationkey", F.coalesce("to", F.lower("n_name")).alias("name"))


@query("prj-07", "SELECT c_custkey, name, value FROM (SELECT c_custkey, 'nation' AS name, CAST(c_nationkey AS DOUBLE) AS value FROM customer UNION ALL SELECT c_custkey, 'balance', c_acctbal FROM customer) x")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", C("c_nationkey").cast("double").alias("nation"), C("c_acctbal").alias("balance")).unpivot("c_custkey", ["nation", "balance"], "name", "value")


@query("prj-08", "SELECT r_regionkey, CASE r_regionkey%3 WHEN 0 THEN 'FF0000' WHEN 1 THEN '00FF00' ELSE '0000FF' END AS hex FROM region")
def _(t: Tables) -> DataFrame:
    name = F.element_at(F.array(F.lit("red"), F.lit("green"), F.lit("blue")), (C("r_regionkey") % 3 + 1).cast("int"))
    return t.region.select("r_regionkey", S.color_hex(name).alias("hex"))


@query("jn-08", "SELECT c.c_custkey, n.n_nationkey FROM customer c JOIN nation n ON 'NATION_'||c.c_nationkey=regexp_replace(n.n_name||' 1', ' 1$', '')")
def _(t: Tables) -> DataFrame:
    a = t.customer.select("c_custkey", F.concat(F.lit("NATION_"), C("c_nationkey")).alias("name"))
    b = t.nation.select("n_nationkey", F.regexp_replace(F.concat("n_name", F.lit(" 1")), " 1$", "").alias("name"))
    return a.join(b, "name").select("c_custkey", "n_nationkey")


@query("jn-09", "SELECT p_partkey, r_name FROM part JOIN region ON CAST(floor(p_partkey/1000e0) AS BIGINT)=r_regionkey")
def _(t: Tables) -> DataFrame:
    return t.part.withColumn("r_regionkey", F.floor(C("p_partkey") / 1000).cast("int")).join(t.region, "r_regionkey").select("p_partkey", "r_name")


@query("jn-10", "SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ' ' ORDER BY o_orderkey) AS vertices FROM orders GROUP BY o_custkey")
def _(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list("o_orderkey")), lambda v: v.cast("string")), " ").alias("vertices"))


@query("jn-11", "SELECT s.slide_id, coalesce(s.project, o.p) AS project FROM (SELECT slide_id, CASE WHEN isgood=1 THEN project END AS project FROM sampledef) s LEFT JOIN (SELECT o_custkey AS slide_id, min(o_orderpriority) AS p FROM orders GROUP BY o_custkey) o ON s.slide_id=o.slide_id")
def _(t: Tables) -> DataFrame:
    left = t.sampledef.select("slide_id", F.when(C("isgood") == 1, C("project")).alias("project"))
    right = t.orders.groupBy(C("o_custkey").alias("slide_id")).agg(F.min("o_orderpriority").alias("project"))
    return R.fill_from(left, right, ["slide_id"], ["project"])


@query("jn-12", "SELECT slide_id, name, batch FROM sampledef WHERE slide_id=77")
def _(t: Tables) -> DataFrame:
    return t.sampledef.where("slide_id = 77").select("slide_id", "name", "batch")


@query("jn-13", "SELECT c.project, c.slides, o.batches FROM (SELECT project, count(*) AS slides FROM sampledef GROUP BY project) c JOIN (SELECT project, count(DISTINCT batch) AS batches FROM sampledef WHERE isgood=1 AND project<>'BUILDING' GROUP BY project) o ON c.project=o.project")
def _(t: Tables) -> DataFrame:
    a = t.sampledef.groupBy("project").agg(F.count("*").alias("slides"))
    b = t.sampledef.where("isgood = 1 and project <> 'BUILDING'").groupBy("project").agg(F.countDistinct("batch").alias("batches"))
    return R.inner_merge(a, b, on="project")


@query("jn-14", "SELECT s.s_suppkey, coalesce(x.status, 'IDLE') AS status FROM supplier s LEFT JOIN (SELECT l_suppkey, max(l_returnflag) AS status FROM lineitem WHERE l_quantity>49 AND l_suppkey%2=0 GROUP BY l_suppkey) x ON x.l_suppkey=s.s_suppkey")
def _(t: Tables) -> DataFrame:
    seen = t.lineitem.where("l_quantity > 49 and l_suppkey % 2 = 0").groupBy(C("l_suppkey").alias("s_suppkey")).agg(F.max("l_returnflag").alias("status"))
    return t.supplier.select("s_suppkey").join(seen, "s_suppkey", "left").select("s_suppkey", F.coalesce("status", F.lit("IDLE")).alias("status"))


@query("jn-15", "SELECT coalesce(a.k, b.k) AS k, a.n AS customers, b.n AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_nationkey<15 GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_nationkey>5 GROUP BY 1) b ON a.k=b.k")
def _(t: Tables) -> DataFrame:
    a = t.customer.where("c_nationkey < 15").groupBy(C("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    b = t.supplier.where("s_nationkey > 5").groupBy(C("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "k", "full")


@query("jn-16", "SELECT s_suppkey, n_nationkey FROM supplier JOIN nation ON s_nationkey%5=n_regionkey AND s_suppkey%25<=n_nationkey")
def _(t: Tables) -> DataFrame:
    a = t.supplier.withColumn("n_regionkey", C("s_nationkey") % 5)
    return a.join(t.nation, "n_regionkey").where(C("s_suppkey") % 25 <= C("n_nationkey")).select("s_suppkey", "n_nationkey")


@query("jn-18", "SELECT p.vec_id, p.k, coalesce(c.id, 0) AS cell FROM pixels p LEFT JOIN (SELECT vec_id, label+100 AS id FROM embeddings WHERE label%2=0) c ON c.vec_id=p.vec_id")
def _(t: Tables) -> DataFrame:
    ids = t.embeddings.where("label % 2 = 0").select("vec_id", (C("label") + 100).alias("id"))
    return t.pixels.select("vec_id", "k").join(ids, "vec_id", "left").select("vec_id", "k", F.coalesce("id", F.lit(0)).alias("cell"))


@query("jn-22", "SELECT slide_id, field, ctype, n FROM cell WHERE x>=67 AND x+w<=602 AND y>=50 AND y+h<=450")
def _(t: Tables) -> DataFrame:
    return t.cell.where("x >= 67 and x + w <= 602 and y >= 50 and y + h <= 450").select("slide_id", "field", "ctype", "n")


@query("jn-23", """WITH s AS (SELECT slide_id, module, max(CASE WHEN message='FINISH' THEN 1 ELSE 0 END) AS done FROM runlog GROUP BY slide_id, module)
 SELECT a.slide_id, coalesce(b.done, 0)=1 AS ready FROM (SELECT DISTINCT slide_id FROM s WHERE module='warp') a LEFT JOIN (SELECT * FROM s WHERE module='align') b ON a.slide_id=b.slide_id""")
def _(t: Tables) -> DataFrame:
    s = t.runlog.groupBy("slide_id", "module").agg(F.max((C("message") == "FINISH").cast("int")).alias("done"))
    need = s.where("module = 'align'").select("slide_id", "done")
    return s.where("module = 'warp'").select("slide_id").join(need, "slide_id", "left").select("slide_id", (F.coalesce("done", F.lit(0)) == 1).alias("ready"))


@query("jn-24", "SELECT batch, slide_id FROM (SELECT DISTINCT c_nationkey AS batch FROM customer WHERE c_nationkey<10) b JOIN (SELECT c_custkey AS slide_id, CAST(ltrim('0'||c_nationkey, '0') AS VARCHAR) AS k FROM customer WHERE c_nationkey>0) s ON CAST(b.batch AS VARCHAR)=s.k")
def _(t: Tables) -> DataFrame:
    b = t.customer.where("c_nationkey < 10").select(C("c_nationkey").alias("batch")).distinct()
    s = t.customer.where("c_nationkey > 0").select(C("c_custkey").alias("slide_id"), F.ltrim(F.concat(F.lit("0"), C("c_nationkey")), F.lit("0")).alias("k"))
    return b.withColumn("k", C("batch").cast("string")).join(s, "k").select("batch", "slide_id")


@query("jn-26", "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey=b.n_regionkey AND a.n_nationkey<>b.n_nationkey AND contains(b.n_name, a.n_name)")
def _(t: Tables) -> DataFrame:
    a = t.nation.select(C("n_nationkey").alias("a"), "n_regionkey", C("n_name").alias("m"))
    b = t.nation.select(C("n_nationkey").alias("b"), "n_regionkey", C("n_name").alias("o"))
    return a.join(b, "n_regionkey").where((C("a") != C("b")) & F.contains("o", "m")).select("a", "b")


@query("jn-27", "SELECT c.p_partkey AS child, p.p_partkey AS parent FROM part c JOIN part p ON p.p_partkey=CAST(floor(c.p_partkey/10e0) AS BIGINT) WHERE c.p_partkey>0")
def _(t: Tables) -> DataFrame:
    child = t.part.where("p_partkey > 0").select(C("p_partkey").alias("child"), F.floor(C("p_partkey") / 10).alias("parent"))
    return child.join(t.part.select(C("p_partkey").alias("parent")), "parent").select("child", "parent")


@query("jn-28", "SELECT doc_id, 'missing' AS state FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'unknown' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang<>'fr')")
def _(t: Tables) -> DataFrame:
    docs, found = t.documents.select("doc_id"), t.labels.select("doc_id")
    wanted = t.documents.where("lang <> 'fr'").select("doc_id")
    return docs.join(found, "doc_id", "left_anti").withColumn("state", F.lit("missing")).union(found.join(wanted, "doc_id", "left_anti").withColumn("state", F.lit("unknown")))


@query("jn-29", "SELECT slide_id, project, rn FROM (SELECT slide_id, project, row_number() OVER (PARTITION BY project ORDER BY batch, slide_id) AS rn FROM sampledef) x WHERE rn=1")
def _(t: Tables) -> DataFrame:
    first = F.row_number().over(Window.partitionBy("project").orderBy("batch", "slide_id"))
    return t.sampledef.withColumn("rn", first.cast("long")).where("rn = 1").select("slide_id", "project", "rn")


@query("se-01", "SELECT DISTINCT n_name AS name FROM nation WHERE n_nationkey<20 AND n_name NOT IN (SELECT n_name FROM nation WHERE n_regionkey=2)")
def _(t: Tables) -> DataFrame:
    wanted = t.nation.where("n_nationkey < 15").union(t.nation.where("n_nationkey < 20"))
    return wanted.select(C("n_name").alias("name")).exceptAll(t.nation.where("n_regionkey = 99").select("n_name")).distinct().join(t.nation.where("n_regionkey = 2").select(C("n_name").alias("name")), "name", "left_anti")


_BEFORE, _AFTER = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey%5<>0", "SELECT o_orderkey, CASE WHEN o_orderkey%7=0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey%5<>1"


@query("se-03", f"SELECT *, '=>' AS side FROM ({_AFTER} EXCEPT ALL {_BEFORE}) a UNION ALL SELECT *, '<=' FROM ({_BEFORE} EXCEPT ALL {_AFTER}) b")
def _(t: Tables) -> DataFrame:
    before = t.orders.where("o_orderkey % 5 <> 0").select("o_orderkey", "o_orderstatus")
    after = t.orders.where("o_orderkey % 5 <> 1").select("o_orderkey", F.when(C("o_orderkey") % 7 == 0, "X").otherwise(C("o_orderstatus")).alias("o_orderstatus"))
    return R.side_indicator(before, after)


@query("se-04", "SELECT m.* FROM queue_main m WHERE NOT EXISTS (SELECT 1 FROM queue_local l WHERE l.task=m.task AND l.slide_id=m.slide_id AND l.antibody=m.antibody AND l.status=m.status)")
def _(t: Tables) -> DataFrame:
    return t.queue_main.join(t.queue_local, ["task", "slide_id", "antibody", "status"], "left_anti")


@query("st-09", "SELECT *, 'main' AS origin FROM queue_main UNION ALL SELECT *, 'local' FROM queue_local l WHERE NOT EXISTS (SELECT 1 FROM queue_main m WHERE m.task=l.task AND m.slide_id=l.slide_id)")
def _(t: Tables) -> DataFrame:
    return R.coalesce_queues(t.queue_main, t.queue_local, ["task", "slide_id"])


@query("se-05", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal>0)")
def _(t: Tables) -> DataFrame:
    known = t.customer.where("c_acctbal > 0").select(C("c_custkey").alias("o_custkey"))
    return t.orders.select("o_custkey").distinct().join(known, "o_custkey", "left_anti")


@query("se-06", "SELECT DISTINCT slide_id FROM runlog ORDER BY slide_id")
def _(t: Tables) -> DataFrame:
    return t.runlog.select("slide_id").distinct().orderBy("slide_id")


@query("se-07", "SELECT o_custkey, array_to_string(list_sort(list_filter(['1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW'], lambda p: NOT list_contains(list(o_orderpriority), p))), ',') AS missing FROM orders GROUP BY o_custkey")
def _(t: Tables) -> DataFrame:
    wanted = F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.array_except(wanted, F.collect_set("o_orderpriority"))), ",").alias("missing"))


@query("se-08", "SELECT n_regionkey, max(n_nationkey) AS kept, count(*)-1 AS dropped, count(DISTINCT length(n_name))>1 AS conflict FROM nation GROUP BY n_regionkey")
def _(t: Tables) -> DataFrame:
    """Of rows at one place the last stays; those that differ in what should be equal are reported as a conflict."""
    at = t.nation.groupBy("n_regionkey").agg(F.max("n_nationkey").alias("kept"), (F.count("*") - 1).alias("dropped"), F.count_distinct(F.length("n_name")).alias("different"))
    return at.select("n_regionkey", "kept", "dropped", (C("different") > 1).alias("conflict"))


@query("se-09", "SELECT name, file FROM (SELECT regexp_replace(f, '_M2$', '') AS name, f AS file, row_number() OVER (PARTITION BY regexp_replace(f, '_M2$', '') ORDER BY CASE WHEN f LIKE '%_M2' THEN 0 ELSE 1 END) AS r FROM (SELECT n_name AS f FROM nation UNION ALL SELECT n_name||'_M2' FROM nation WHERE n_regionkey=0) x) y WHERE r=1")
def _(t: Tables) -> DataFrame:
    files = t.nation.select(C("n_name").alias("file")).union(t.nation.where("n_regionkey = 0").select(F.concat("n_name", F.lit("_M2"))))
    return S.keep_second_measurement(files, "file")


@query("se-10", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.dropDuplicates(["c_mktsegment", "c_nationkey"]).select("c_mktsegment", "c_nationkey")


@query("so-01", "SELECT doc_id, source, row_number() OVER (ORDER BY source='src2', source='src1', source, doc_id) AS pos FROM documents")
def _(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "source", (C("source") == "src2").alias("last"), (C("source") == "src1").alias("next"))
    return R.number_rows(d, ["last", "next", "source", "doc_id"], "pos").select("doc_id", "source", "pos")


@query("so-02", "SELECT page_id, row_number() OVER (ORDER BY lower(url), page_id) AS pos FROM pages")
def _(t: Tables) -> DataFrame:
    return R.number_rows(t.pages.select("page_id", F.lower("url").alias("u")), ["u", "page_id"], "pos").select("page_id", "pos")


@query("so-03", "SELECT p_partkey FROM (SELECT p_partkey, p_size FROM part ORDER BY p_partkey LIMIT 100) x WHERE p_size>20")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_size").orderBy("p_partkey").limit(100).where("p_size > 20").select("p_partkey")


@query("so-04", "SELECT vec_id, layer, pixel, row_number() OVER (PARTITION BY layer ORDER BY vec_id, pixel) AS pos FROM pixels")
def _(t: Tables) -> DataFrame:
    return R.number_rows(t.pixels.select("vec_id", "layer", "pixel"), ["vec_id", "pixel"], "pos", ("layer",))


@query("so-05", "SELECT slide_id, row_number() OVER (PARTITION BY project, cohort ORDER BY batch, slide_id) AS pos FROM sampledef")
def _(t: Tables) -> DataFrame:
    return R.number_rows(t.sampledef, ["batch", "slide_id"], "pos", ("project", "cohort")).select("slide_id", "pos")


@query("so-06", "SELECT vec_id, layer, n FROM (SELECT vec_id, layer, count(*) FILTER (v>0) AS n FROM pixels GROUP BY vec_id, layer) x ORDER BY n DESC, vec_id, layer LIMIT 20")
def _(t: Tables) -> DataFrame:
    return t.pixels.groupBy("vec_id", "layer").agg(F.count_if(C("v") > 0).alias("n")).orderBy(F.desc("n"), "vec_id", "layer").limit(20)


@query("so-07", "SELECT slide_id, field, area FROM (SELECT slide_id, field, w*h AS area, row_number() OVER (PARTITION BY slide_id ORDER BY w*h DESC, field, n) AS r FROM cell) x WHERE r=1")
def _(t: Tables) -> DataFrame:
    return t.cell.groupBy("slide_id").agg(F.max(F.struct((C("w") * C("h")).alias("area"), (-C("field")).alias("f"), (-C("n")).alias("n"))).alias("m")).select("slide_id", (-C("m.f")).alias("field"), C("m.area").alias("area"))


@query("so-08", "SELECT s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY CAST(s_suppkey AS VARCHAR)) AS ncore FROM supplier")
def _(t: Tables) -> DataFrame:
    named = t.supplier.select("s_suppkey", "s_nationkey", C("s_suppkey").cast("string").alias("name"))
    return R.number_rows(named, ["name"], "ncore", ("s_nationkey",)).select("s_suppkey", "ncore")


@query("so-09", "SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS subindex FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_size", "p_partkey")).cast("long").alias("subindex"))


@query("so-10", "SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE c_mktsegment WHEN 'MACHINERY' THEN 0 WHEN 'BUILDING' THEN 1 ELSE 2 END, c_custkey) AS pos FROM customer")
def _(t: Tables) -> DataFrame:
    first = F.when(C("c_mktsegment") == "MACHINERY", 0).when(C("c_mktsegment") == "BUILDING", 1).otherwise(2)
    return R.number_rows(t.customer.select("c_custkey", "c_nationkey", first.alias("first")), ["first", "c_custkey"], "pos", ("c_nationkey",)).select("c_custkey", "pos")


@query("so-11", "SELECT slide_id, n FROM (SELECT slide_id, n, row_number() OVER (PARTITION BY slide_id ORDER BY md5(slide_id||':'||n||':7'), n) AS r FROM rect) x WHERE r<=10")
def _(t: Tables) -> DataFrame:
    mark = F.md5(F.concat_ws(":", "slide_id", "n", F.lit("7")))
    return t.rect.withColumn("r", F.row_number().over(Window.partitionBy("slide_id").orderBy(mark, "n"))).where("r <= 10").select("slide_id", "n")


@query("so-12", "SELECT a.c_custkey, b.s_suppkey FROM (SELECT c_custkey, c_nationkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer) a JOIN (SELECT s_suppkey, s_nationkey AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS r FROM supplier) b ON a.k=b.k AND a.r=b.r")
def _(t: Tables) -> DataFrame:
    rank = lambda k, o: F.row_number().over(Window.partitionBy(k).orderBy(o)).alias("r")
    a = t.customer.select("c_custkey", C("c_nationkey").alias("k"), rank("c_nationkey", "c_custkey"))
    return a.join(t.supplier.select("s_suppkey", C("s_nationkey").alias("k"), rank("s_nationkey", "s_suppkey")), ["k", "r"]).select("c_custkey", "s_suppkey")


@query("so-14", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS files FROM nation GROUP BY n_regionkey")
def _(t: Tables) -> DataFrame:
    return t.nation.groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list("n_name")), ",").alias("files"))


@query("wn-08", "SELECT layer, v, CAST(sum(count(*)) OVER (PARTITION BY layer ORDER BY v) AS BIGINT) AS below FROM pixels GROUP BY layer, v")
def _(t: Tables) -> DataFrame:
    return t.pixels.groupBy("layer", "v").agg(F.count("*").alias("n")).select("layer", "v", F.sum("n").over(Window.partitionBy("layer").orderBy("v")).alias("below"))


@query("wn-09", "SELECT p_partkey, 1000*(p_size%10)+row_number() OVER (PARTITION BY p_size%10 ORDER BY p_partkey) AS regionid FROM part")
def _(t: Tables) -> DataFrame:
    numbered = R.number_rows(t.part.select("p_partkey", (C("p_size") % 10).alias("layer")), ["p_partkey"], "m", ("layer",))
    return numbered.select("p_partkey", (1000 * C("layer") + C("m")).cast("long").alias("regionid"))


@query("wn-10", """WITH k AS (SELECT c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey)+CASE WHEN c_nationkey%3=0 AND c_acctbal<0 THEN 1 ELSE 0 END AS k FROM customer)
 SELECT c_nationkey, count(*) AS rows, min(k)=1 AND max(k)=count(*) AND count(DISTINCT k)=count(*) AS consecutive FROM k GROUP BY c_nationkey""")
def _(t: Tables) -> DataFrame:
    """Whether each nation's numbers are 1 to k; in every third nation those of customers in debt are one too high."""
    number = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) + F.when((C("c_nationkey") % 3 == 0) & (C("c_acctbal") < 0), 1).otherwise(0)
    checked = t.customer.select("c_nationkey", number.alias("k")).groupBy("c_nationkey").agg(F.count("*").alias("rows"), F.min("k").alias("low"), F.max("k").alias("top"), F.count_distinct("k").alias("different"))
    return checked.select("c_nationkey", "rows", ((C("low") == 1) & (C("top") == C("rows")) & (C("different") == C("rows"))).alias("consecutive"))


@query("wn-11", "SELECT k AS layer, coalesce(s.n, 'empty') AS name FROM (SELECT unnest(generate_series(0, 30)) AS k) g LEFT JOIN (SELECT n_nationkey AS k, n_name AS n FROM nation WHERE n_nationkey%4<>1) s USING (k)")
def _(t: Tables) -> DataFrame:
    known = t.nation.where("n_nationkey % 4 <> 1").select(C("n_nationkey").cast("long").alias("layer"), C("n_name").alias("name"))
    top = known.agg(F.max("layer").alias("m")).select(F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("m", F.lit(30).cast("long")))).alias("layer"))
    return top.join(known, "layer", "left").select("layer", F.coalesce("name", F.lit("empty")).alias("name"))


@query("wn-14", "SELECT slide_id, n, row_number() OVER (PARTITION BY slide_id ORDER BY n)||' / '||count(*) OVER (PARTITION BY slide_id) AS label FROM rect")
def _(t: Tables) -> DataFrame:
    w = Window.partitionBy("slide_id")
    return t.rect.select("slide_id", "n", F.concat_ws(" / ", F.row_number().over(w.orderBy("n")), F.count("*").over(w)).alias("label"))


@query("wn-15", """WITH q AS (SELECT o_orderkey, o_custkey AS task, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders)
 SELECT o_orderkey, task FROM q WHERE r=1 UNION ALL SELECT o_orderkey, (SELECT max(o_custkey) FROM orders)+row_number() OVER (ORDER BY o_orderkey) FROM q WHERE r>1""")
def _(t: Tables) -> DataFrame:
    return R.renumber_duplicates(t.orders.select("o_orderkey", C("o_custkey").alias("task")), "task", "o_orderkey")


@query("ag-28", "SELECT batch, count(*) AS slides FROM sampledef GROUP BY batch HAVING sum(isgood)*10>=count(*)*9")
def _(t: Tables) -> DataFrame:
    return t.sampledef.groupBy("batch").agg(F.count("*").alias("slides"), F.sum("isgood").alias("done")).where(C("done") * 10 >= C("slides") * 9).select("batch", "slides")


@query("ag-29", "SELECT antibody, max(task)+1 AS next_task FROM queue_main GROUP BY antibody")
def _(t: Tables) -> DataFrame:
    return t.queue_main.groupBy("antibody").agg((F.max("task") + 1).alias("next_task"))


@query("ag-30", "SELECT p_name AS name, count(*) AS n FROM part GROUP BY p_name HAVING count(*)>1")
def _(t: Tables) -> DataFrame:
    return t.part.groupBy(C("p_name").alias("name")).agg(F.count("*").alias("n")).where("n > 1")


@query("st-12", "SELECT o_custkey, (SELECT max(c_custkey) FROM customer WHERE c_custkey<1000)+row_number() OVER (ORDER BY o_custkey) AS new_id FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey>=1000) x")
def _(t: Tables) -> DataFrame:
    known = t.customer.where("c_custkey < 1000")
    new = t.orders.select("o_custkey").distinct().join(known.select(C("c_custkey").alias("o_custkey")), "o_custkey", "left_anti").where("o_custkey >= 1000")
    top = known.agg(F.coalesce(F.max("c_custkey"), F.lit(0)).alias("top"))
    return R.number_rows(new, ["o_custkey"], "k").crossJoin(F.broadcast(top)).select("o_custkey", (C("top") + C("k")).alias("new_id"))
