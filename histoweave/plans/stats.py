"""Image statistics on embeddings unpacked as pixels, fluxes and weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histoweave.operators import fit, selection
from histoweave.operators import stats as A
from histoweave.plans.registry import Tables, query

C = F.col


def _r(c, digits: int = 6):
    return F.round(c, digits)


@query("ag-01", "SELECT vec_id, round(avg(v), 6) AS mean, min(v) AS min, max(v) AS max, round(stddev_pop(v), 6) AS std FROM pixels GROUP BY vec_id")
def _(t: Tables) -> DataFrame:
    return t.pixels.groupBy("vec_id").agg(_r(F.avg("v")).alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"), _r(F.stddev_pop("v")).alias("std"))


_STACK = "SELECT pixel, layer, CAST(sum(CASE WHEN v>0 THEN v ELSE 0 END) AS BIGINT) AS s, CAST(sum(CASE WHEN v>0 THEN v*v ELSE 0 END) AS BIGINT) AS s2, count(*) FILTER (v>0) AS n FROM pixels GROUP BY pixel, layer"
_MEAN = f"WITH st AS ({_STACK}), me AS (SELECT pixel, layer, s/CAST(n AS DOUBLE) AS mean, sqrt(abs(s2/CAST(n AS DOUBLE)-(s/CAST(n AS DOUBLE))*(s/CAST(n AS DOUBLE)))/n) AS se FROM st)"


@query("ag-02", _STACK)
def _(t: Tables) -> DataFrame:
    return A.image_stack(t.pixels, C("v") > 0)


@query("ag-03", _MEAN + " SELECT pixel, layer, round(mean, 6) AS mean, round(se, 6) AS se FROM me")
def _(t: Tables) -> DataFrame:
    return A.mean_image(A.image_stack(t.pixels, C("v") > 0)).select("pixel", "layer", _r(C("mean")).alias("mean"), _r(C("se")).alias("se"))


@query("ag-04", _MEAN + " SELECT m.pixel, m.layer, round(mean/lv, 6) AS flat FROM me m JOIN (SELECT layer, sum(mean/(se*se))/sum(1/(se*se)) AS lv FROM me WHERE se>0 GROUP BY layer) l ON l.layer=m.layer")
def _(t: Tables) -> DataFrame:
    return A.flatfield(A.mean_image(A.image_stack(t.pixels, C("v") > 0))).select("pixel", "layer", _r(C("flat")).alias("flat"))


@query("ag-05", "SELECT pixel, layer, round(sum(CAST(m AS DOUBLE)*n)/sum(n), 6) AS mean FROM (SELECT label, pixel, layer, avg(v) AS m, count(*) AS n FROM pixels GROUP BY label, pixel, layer) x GROUP BY pixel, layer")
def _(t: Tables) -> DataFrame:
    by = t.pixels.groupBy("label", "pixel", "layer").agg(F.avg("v").alias("m"), F.count("*").alias("n"))
    return by.groupBy("pixel", "layer").agg(_r(A.weighted_mean(C("m"), C("n"))).alias("mean"))


@query("ag-06", "SELECT l_linenumber AS layer, median(l_quantity) AS exposure FROM lineitem GROUP BY l_linenumber")
def _(t: Tables) -> DataFrame:
    return selection.medians(t.lineitem.select(C("l_linenumber").alias("layer"), "l_quantity"), ["layer"], "l_quantity", "exposure")


@query("ag-07", "SELECT layer, coalesce(median(CASE WHEN v<>0 THEN v END), 0) AS threshold FROM pixels GROUP BY layer")
def _(t: Tables) -> DataFrame:
    return selection.medians(t.pixels.select("layer", F.when(C("v") != 0, C("v")).alias("v")), ["layer"], "v").select("layer", F.coalesce("median", F.lit(0.0)).alias("threshold"))


@query("ag-08", "SELECT layer, v, count(*) AS n FROM pixels GROUP BY layer, v")
def _(t: Tables) -> DataFrame:
    return A.histogram(t.pixels, "layer")


@query("ag-09", """WITH h AS (SELECT layer, CAST(floor(v/20e0) AS BIGINT) AS v, count(*) AS n FROM pixels GROUP BY 1, 2), p AS (SELECT layer, v, n/CAST(sum(n) OVER (PARTITION BY layer) AS DOUBLE) AS p FROM h),
 q AS (SELECT layer, v, sum(p) OVER w AS q1, sum(p) OVER f AS qa, coalesce(sum(p*v) OVER b, 0) AS m1, sum(p*v) OVER f AS ma, coalesce(sum(p*v*v) OVER b, 0) AS k1, sum(p*v*v) OVER f AS ka FROM p
 WINDOW w AS (PARTITION BY layer ORDER BY v), f AS (PARTITION BY layer), b AS (PARTITION BY layer ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 c AS (SELECT layer, v, round(q1*(k1/q1-(m1/q1)*(m1/q1))+(qa-q1)*((ka-k1)/(qa-q1)-((ma-m1)/(qa-q1))*((ma-m1)/(qa-q1))), 6) AS cost FROM q WHERE q1>1e-9 AND qa-q1>1e-9)
 SELECT layer, v AS threshold FROM (SELECT layer, v, row_number() OVER (PARTITION BY layer ORDER BY cost, v) AS r FROM c) x WHERE r=1""")
def _(t: Tables) -> DataFrame:
    return A.otsu(A.histogram(t.pixels.withColumn("v", F.floor(C("v") / 20)), "layer"), "layer")


@query("ag-10", "SELECT layer, round(avg(pow(v-mu, 3))/pow(sqrt(avg(pow(v-mu, 2))), 3), 6) AS skew FROM (SELECT layer, v, avg(v) OVER (PARTITION BY layer) AS mu FROM pixels) x GROUP BY layer")
def _(t: Tables) -> DataFrame:
    return A.moment(A.histogram(t.pixels, "layer"), 3, "layer").select("layer", _r(C("moment")).alias("skew"))


@query("ag-12", """WITH p AS (SELECT layer, v, pixel%4 IN (1, 2) AND pixel BETWEEN 4 AND 11 AS c FROM pixels), m AS (SELECT layer, avg(v) AS level, stddev_pop(v) AS s, stddev_pop(CASE WHEN c THEN v END) AS cs FROM p GROUP BY layer),
 r AS (SELECT layer, v, row_number() OVER (PARTITION BY layer ORDER BY v) AS r, count(*) OVER (PARTITION BY layer) AS n FROM p), q AS (SELECT layer, max(CASE WHEN r=CAST(floor(n*0.95) AS BIGINT)+1 THEN v END)-max(CASE WHEN r=CAST(floor(n*0.05) AS BIGINT)+1 THEN v END) AS d FROM r GROUP BY layer),
 k AS (SELECT layer, v, row_number() OVER (PARTITION BY layer ORDER BY v) AS r, count(*) OVER (PARTITION BY layer) AS n FROM p WHERE c), cq AS (SELECT layer, max(CASE WHEN r=CAST(floor(n*0.95) AS BIGINT)+1 THEN v END)-max(CASE WHEN r=CAST(floor(n*0.05) AS BIGINT)+1 THEN v END) AS d FROM k GROUP BY layer)
 SELECT layer, round(q.d/level, 4) AS spread, round(s/level, 4) AS std, round(cq.d/level, 4) AS central_spread, round(cs/level, 4) AS central_std FROM m JOIN q USING (layer) JOIN cq USING (layer)""")
def _(t: Tables) -> DataFrame:
    """The central part of 4 x 4 pixels is its inner 2 x 2."""
    central = (C("pixel") % 4).isin(1, 2) & C("pixel").between(4, 11)
    found = A.spreads(t.pixels, central, "layer")
    return found.select("layer", *(_r(C(c), 4).alias(c) for c in found.columns if c != "layer"))


_DELTA = "WITH m AS (SELECT layer, pixel, avg(v) FILTER (label%2=0) AS a, avg(v) FILTER (label%2=1) AS b, stddev_pop(v) AS sd FROM pixels GROUP BY layer, pixel), d AS (SELECT layer, stddev_pop(CASE WHEN (a-b)/sd<>0 THEN (a-b)/sd END) AS s FROM m GROUP BY layer)"


def _delta(t: Tables) -> DataFrame:
    half = lambda k: F.avg(F.when(C("label") % 2 == k, C("v")))
    m = t.pixels.groupBy("layer", "pixel").agg(half(0).alias("a"), half(1).alias("b"), F.stddev_pop("v").alias("sd"))
    d = (C("a") - C("b")) / C("sd")
    return m.groupBy("layer").agg(F.stddev_pop(F.when(d != 0, d)).alias("s"))


@query("ag-13", _DELTA + " SELECT layer, round(s, 6) AS s FROM d")
def _(t: Tables) -> DataFrame:
    return _delta(t).select("layer", _r(C("s")).alias("s"))


@query("ag-14", _DELTA + " SELECT round(avg(s), 6) AS s FROM d WHERE s<>0")
def _(t: Tables) -> DataFrame:
    return _delta(t).where("s <> 0").agg(_r(F.avg("s")).alias("s"))


@query("ag-15", "SELECT slide_id, round(sum(dx/covxx)/sum(1/covxx), 6) AS mean, round(sqrt(1/sum(1/covxx)), 6) AS std FROM measured WHERE exit=0 GROUP BY slide_id")
def _(t: Tables) -> DataFrame:
    w = 1 / C("covxx")
    return t.measured.where("exit = 0").groupBy("slide_id").agg(_r(A.weighted_mean(C("dx"), w)).alias("mean"), _r(F.sqrt(1 / F.sum(w))).alias("std"))


@query("ag-17", "SELECT vec_id, round(avg(v*v), 6) AS mse FROM pixels GROUP BY vec_id")
def _(t: Tables) -> DataFrame:
    return t.pixels.groupBy("vec_id").agg(_r(F.avg(C("v") * C("v"))).alias("mse"))


@query("ag-20", "SELECT l_suppkey, name, round(sum(value*l_discount)/sum(l_discount), 6) AS mean FROM (SELECT l_suppkey, l_discount, 'quantity' AS name, l_quantity AS value FROM lineitem UNION ALL SELECT l_suppkey, l_discount, 'tax', l_tax FROM lineitem) x WHERE l_discount>0 GROUP BY l_suppkey, name")
def _(t: Tables) -> DataFrame:
    long = t.lineitem.where("l_discount > 0").select("l_suppkey", "l_discount", C("l_quantity").alias("quantity"), C("l_tax").alias("tax")).unpivot(["l_suppkey", "l_discount"], ["quantity", "tax"], "name", "value")
    return long.groupBy("l_suppkey", "name").agg(_r(A.weighted_mean(C("value"), C("l_discount"))).alias("mean"))


@query("ag-21", "SELECT l_suppkey, round(sqrt(pow(stddev_pop(l_quantity), 2)*sum(l_discount*l_discount)/pow(sum(l_discount), 2)), 6) AS error FROM lineitem GROUP BY l_suppkey")
def _(t: Tables) -> DataFrame:
    w = C("l_discount")
    return t.lineitem.groupBy("l_suppkey").agg(_r(F.sqrt(F.stddev_pop("l_quantity") ** 2 * F.sum(w * w) / F.sum(w) ** 2)).alias("error"))


@query("ag-22", "SELECT label, layer, round(avg(CASE WHEN v>50 THEN 1e0 ELSE 0e0 END), 6) AS share FROM pixels GROUP BY label, layer")
def _(t: Tables) -> DataFrame:
    return t.pixels.groupBy("label", "layer").agg(_r(F.avg((C("v") > 50).cast("double"))).alias("share"))


@query("ag-24", "SELECT l_suppkey%9 AS batch, l_linenumber AS marker, round(avg(l_extendedprice), 4) AS mean, median(l_extendedprice) AS median FROM lineitem WHERE l_discount>0.02 GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.where("l_discount > 0.02").select((C("l_suppkey") % 9).alias("batch"), C("l_linenumber").alias("marker"), "l_extendedprice")
    mean = rows.groupBy("batch", "marker").agg(_r(F.avg("l_extendedprice"), 4).alias("mean"))
    return mean.join(selection.medians(rows, ["batch", "marker"], "l_extendedprice"), ["batch", "marker"])


@query("ag-25", """WITH b AS (SELECT l_linenumber AS marker, CAST(floor(ln(l_extendedprice+sqrt(l_extendedprice*l_extendedprice+1))*30) AS BIGINT) AS bin, count(*) AS n FROM lineitem GROUP BY 1, 2),
 c AS (SELECT marker, bin, sum(n) OVER (PARTITION BY marker ORDER BY bin) AS below, sum(n) OVER (PARTITION BY marker) AS total FROM b) SELECT marker, min(bin) AS threshold FROM c WHERE below*10>=total GROUP BY marker""")
def _(t: Tables) -> DataFrame:
    b = t.lineitem.groupBy(C("l_linenumber").alias("marker"), F.floor(F.asinh("l_extendedprice") * 30).alias("bin")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("marker")
    c = b.select("marker", "bin", F.sum("n").over(w.orderBy("bin")).alias("below"), F.sum("n").over(w).alias("total"))
    return c.where(C("below") * 10 >= C("total")).groupBy("marker").agg(F.min("bin").alias("threshold"))


@query("ag-31", "SELECT vec_id, layer, n FROM (SELECT vec_id, layer, count(*) FILTER (v>0) AS n, row_number() OVER (PARTITION BY vec_id ORDER BY count(*) FILTER (v>0) DESC, layer) AS r FROM pixels GROUP BY vec_id, layer) x WHERE r=1")
def _(t: Tables) -> DataFrame:
    area = t.pixels.groupBy("vec_id", "layer").agg(F.count_if(C("v") > 0).alias("n"))
    return area.groupBy("vec_id").agg(F.max(F.struct("n", (-C("layer")).alias("l"))).alias("m")).select("vec_id", (-C("m.l")).alias("layer"), C("m.n").alias("n"))


@query("ag-35", "SELECT label, round(CAST(sum(CASE WHEN v>0 THEN v ELSE 0 END) AS DOUBLE)/sum(CASE WHEN v>0 THEN 1 ELSE 0 END), 6) AS level FROM pixels GROUP BY label")
def _(t: Tables) -> DataFrame:
    return t.pixels.groupBy("label").agg(_r(F.sum(F.when(C("v") > 0, C("v")).otherwise(0)) / F.count_if(C("v") > 0)).alias("level"))


@query("ag-36", "SELECT doc_id, md5(text) AS sum FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id%2=0)")
def _(t: Tables) -> DataFrame:
    sums = t.documents.select("doc_id", F.md5("text").alias("sum"))
    return sums.join(sums.where("doc_id % 2 = 0").select("sum"), "sum", "left_anti").select("doc_id", "sum")


@query("ag-37", "SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.h IS NULL THEN 'extra' WHEN b.h IS NULL THEN 'missing' WHEN a.h<>b.h THEN 'differs' ELSE 'same' END AS state FROM (SELECT doc_id, sha256(text) AS h FROM documents WHERE doc_id%10<>0) a FULL JOIN (SELECT doc_id, sha256(CASE WHEN doc_id%7=0 THEN text||'x' ELSE text END) AS h FROM documents WHERE doc_id%10<>1) b ON a.doc_id=b.doc_id")
def _(t: Tables) -> DataFrame:
    a = t.documents.where("doc_id % 10 <> 0").select("doc_id", F.sha2("text", 256).alias("a"))
    b = t.documents.where("doc_id % 10 <> 1").select("doc_id", F.sha2(F.when(C("doc_id") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(C("text")), 256).alias("b"))
    state = F.when(C("a").isNull(), "extra").when(C("b").isNull(), "missing").when(C("a") != C("b"), "differs").otherwise("same")
    return a.join(b, "doc_id", "full").select("doc_id", state.alias("state"))


@query("ag-38", "SELECT source, count(*) AS files, max(n_chars)-min(n_chars) AS spread FROM documents GROUP BY source")
def _(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(F.count("*").alias("files"), (F.max("n_chars") - F.min("n_chars")).alias("spread"))


_CRAMER = """s AS (SELECT slide_id, sum(w) AS aa, sum(w*p1) AS ab, sum(w*p2) AS ac, sum(w*p1*p1) AS bb, sum(w*p1*p2) AS bc, sum(w*p2*p2) AS cc, sum(w*dx) AS ay, sum(w*p1*dx) AS b_y, sum(w*p2*dx) AS cy, count(*) AS n FROM {0} GROUP BY slide_id),
 {1} AS (SELECT slide_id, n, (ay*(bb*cc-bc*bc)-ab*(b_y*cc-bc*cy)+ac*(b_y*bc-bb*cy))/d AS k, (aa*(b_y*cc-bc*cy)-ay*(ab*cc-bc*ac)+ac*(ab*cy-b_y*ac))/d AS s1, (aa*(bb*cy-b_y*bc)-ab*(ab*cy-b_y*ac)+ay*(ab*bc-bb*ac))/d AS s2
 FROM (SELECT *, CASE WHEN abs(aa*(bb*cc-bc*bc)-ab*(ab*cc-bc*ac)+ac*(ab*bc-bb*ac))>1e-9 THEN aa*(bb*cc-bc*bc)-ab*(ab*cc-bc*ac)+ac*(ab*bc-bb*ac) END AS d FROM s) z)"""


@query("ag-39", "WITH m AS (SELECT slide_id, dx, p1, p2, 1/covxx AS w FROM measured WHERE exit=0), " + _CRAMER.format("m", "f") + ", kept AS (SELECT m.* FROM m JOIN f USING (slide_id) WHERE abs(dx-(k+s1*p1+s2*p2))<=4), " + _CRAMER.format("kept", "g").replace("s AS (", "s2nd AS (", 1).replace("FROM s)", "FROM s2nd)") + " SELECT slide_id, round(k, 4) AS constant, round(s1, 5) AS slope1, round(s2, 5) AS slope2, n AS rows FROM g")
def _(t: Tables) -> DataFrame:
    """Shifts on both fields' numbers, weighted, with rows of residuals over 4 left out."""
    m = t.measured.where("exit = 0").select("slide_id", "dx", "p1", "p2", "covxx")
    found = A.cut_regression(m, "slide_id", "dx", "p1", "p2", 1 / C("covxx"), 4.0)
    return found.select("slide_id", _r(C("constant"), 4).alias("constant"), _r(C("slope1"), 5).alias("slope1"), _r(C("slope2"), 5).alias("slope2"), "rows")


@query("ag-39-weighted")
def _(t: Tables) -> DataFrame:
    m = t.measured.where("exit = 0 and abs(dx) < 10")
    return A.regression(m, "slide_id", "dx", "p1", "p2", 1 / C("covxx"))


@query("ag-41", """WITH w AS (SELECT layer, vec_id%200 AS place, sum(abs(v))::DOUBLE AS w FROM pixels GROUP BY 1, 2), r AS (SELECT layer, place, sum(w) OVER (PARTITION BY layer ORDER BY place) AS upto, sum(w) OVER (PARTITION BY layer) AS total, sum(w*place) OVER (PARTITION BY layer) AS moment FROM w),
 e AS (SELECT layer, CAST(round_even(max(moment)/max(total), 0) AS BIGINT) AS centre, max(CASE WHEN upto<0.005*total THEN place END) AS a, min(CASE WHEN upto>0.995*total THEN place END) AS b FROM r GROUP BY layer) SELECT layer, centre, centre-a AS low, b-centre AS high FROM e""")
def _(t: Tables) -> DataFrame:
    """Of each layer's brightness along its images, of which 200 make a row."""
    return A.extents(t.pixels.select("layer", (C("vec_id") % 200).alias("place"), F.abs("v").alias("w")), "layer", "place", "w")


_FULL = "CASE WHEN layer<2 THEN 200 ELSE 250 END"


@query("im-06", f"WITH g AS (SELECT vec_id, pixel, CAST(floor(layer/2e0) AS BIGINT) AS grp, count(*) FILTER (v>={_FULL}) AS n FROM pixels GROUP BY 1, 2, 3) SELECT vec_id, pixel, grp, n>=1 AS saturated FROM g")
def _(t: Tables) -> DataFrame:
    """Pixels that are saturated in a layer of a group; the groups, of two layers each, have their own limits."""
    full = C("v") >= F.when(C("layer") < 2, 200).otherwise(250)
    return t.pixels.groupBy("vec_id", "pixel", F.floor(C("layer") / 2).alias("grp")).agg((F.count_if(full) >= 1).alias("saturated"))


@query("im-13", "SELECT layer, pixel, v FROM (SELECT layer, pixel, v, row_number() OVER (PARTITION BY layer, pixel ORDER BY vec_id DESC) AS r FROM pixels WHERE v>0) x WHERE r=1")
def _(t: Tables) -> DataFrame:
    return t.pixels.where("v > 0").groupBy("layer", "pixel").agg(F.max_by("v", "vec_id").alias("v"))


@query("im-15", "SELECT vec_id, pixel, round(sum(v*(layer+1)*0.5), 6) AS red, round(sum(v*(4-layer)*0.25), 6) AS green FROM pixels GROUP BY vec_id, pixel")
def _(t: Tables) -> DataFrame:
    weight = lambda a: F.element_at(F.array(*[F.lit(x) for x in a]), C("layer") + 1)
    return t.pixels.groupBy("vec_id", "pixel").agg(_r(F.sum(C("v") * weight((0.5, 1.0, 1.5, 2.0)))).alias("red"), _r(F.sum(C("v") * weight((1.0, 0.75, 0.5, 0.25)))).alias("green"))


@query("im-16", """WITH l AS (SELECT unnest(generate_series(0, 2)) AS level), p AS (SELECT vec_id, layer, CAST(level AS INT) AS level, CAST(floor(pixel%4/pow(2, level)) AS BIGINT) AS x, CAST(floor(floor(pixel/4e0)/pow(2, level)) AS BIGINT) AS y, v FROM pixels, l),
 q AS (SELECT vec_id, layer, level, x, y, round(avg(v), 4) AS v FROM p GROUP BY ALL), t AS (SELECT vec_id, layer, level, CAST(floor(x/2e0) AS BIGINT) AS tx, CAST(floor(y/2e0) AS BIGINT) AS ty, max(v) AS top, count(*) AS filled FROM q GROUP BY ALL)
 SELECT vec_id, layer, level, tx, ty, filled, 4-filled AS padded FROM t WHERE top>0""")
def _(t: Tables) -> DataFrame:
    """Three zoom levels in tiles of 2 x 2: what a tile has less than four pixels is padding, and tiles without a bright pixel are left out."""
    return A.tiles(A.pyramid(t.pixels.select("vec_id", "layer", (C("pixel") % 4).alias("x"), F.floor(C("pixel") / 4).alias("y"), "v"), ["vec_id", "layer"], 3), ["vec_id", "layer"], 2)


@query("im-21", "SELECT p.vec_id, p.k, p.v*10+e.label AS relabelled FROM pixels p JOIN embeddings e USING (vec_id) WHERE p.v>0")
def _(t: Tables) -> DataFrame:
    ids = t.embeddings.select("vec_id", C("label").alias("id"))
    return t.pixels.where("v > 0").join(ids, "vec_id").select("vec_id", "k", (C("v") * 10 + C("id")).alias("relabelled"))


@query("im-22", "WITH m AS (SELECT label, layer, v>0 AS region, median(v) AS median FROM pixels GROUP BY ALL) SELECT vec_id, p.layer, pixel, m.median AS v FROM pixels p JOIN m ON m.label=p.label AND m.layer=p.layer AND m.region=(p.v>0)")
def _(t: Tables) -> DataFrame:
    """Every pixel as the median of its region, the bright or the dark part of its class of images."""
    region = t.pixels.withColumn("region", C("v") > 0)
    median = selection.medians(region, ["label", "layer", "region"], "v")
    return region.join(median, ["label", "layer", "region"]).select("vec_id", "layer", "pixel", C("median").alias("v"))


def _components(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Masked pixels (vec_id, pixel, i, x) of four layers, and the components that two batches of them give."""
    rows = t.pixels.select("vec_id", "pixel", C("layer").alias("i"), C("v").cast("double").alias("x"), (C("pixel") % 5 != 0).alias("on"))
    key = ["vec_id", "pixel"]
    state = fit.pca_state(rows.where("on and vec_id % 3 = 0"), key)
    return rows, fit.pca_components(fit.pca_state(rows.where("on and vec_id % 3 <> 0"), key, state), 2)


@query("ag-34-sums", "SELECT a.layer AS i, b.layer AS j, CAST(count(*) AS BIGINT) AS n, sum(a.v)::DOUBLE AS si, sum(b.v)::DOUBLE AS sj, sum(a.v*b.v)::DOUBLE AS product FROM pixels a JOIN pixels b ON a.vec_id=b.vec_id AND a.pixel=b.pixel AND a.layer<=b.layer WHERE a.pixel%5<>0 GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    """Sums of masked pixels by pairs of layers, of three batches one after another."""
    rows = t.pixels.where("pixel % 5 <> 0").select("vec_id", "pixel", C("layer").alias("i"), C("v").cast("double").alias("x"))
    state = None
    for k in range(3):
        state = fit.pca_state(rows.where(C("vec_id") % 3 == k), ["vec_id", "pixel"], state)
    return state


@query("im-22-pca")
def _(t: Tables) -> DataFrame:
    """Every pixel's place along the first two components of the masked ones."""
    rows, components = _components(t)
    return fit.pca_scores(rows, ["vec_id", "pixel"], components)


_EXP = "CASE WHEN v>10 THEN greatest(0e0, least(65535e0, round_even(10+30e0/(20+layer)*(v-10), 0))) ELSE CAST(v AS DOUBLE) END"


@query("sc-15", f"SELECT vec_id, k, {_EXP} AS corrected FROM pixels")
def _(t: Tables) -> DataFrame:
    return t.pixels.select("vec_id", "k", A.correct_exposure(C("v"), C("layer") + 20, F.lit(30.0), F.lit(10)).alias("corrected"))


@query("sc-16", "SELECT vec_id, k, greatest(0e0, least(65535e0, round_even(v/(0.9+0.05*layer), 0))) AS corrected FROM pixels")
def _(t: Tables) -> DataFrame:
    return t.pixels.select("vec_id", "k", F.greatest(F.lit(0.0), F.least(F.lit(65535.0), F.rint(C("v") / (F.lit(0.9) + F.lit(0.05) * C("layer"))))).alias("corrected"))


@query("im-23", f"SELECT vec_id, k, greatest(0e0, least(65535e0, round_even(({_EXP})/(0.9+0.05*layer), 0))) AS corrected FROM pixels")
def _(t: Tables) -> DataFrame:
    first = t.pixels.withColumn("e", A.correct_exposure(C("v"), C("layer") + 20, F.lit(30.0), F.lit(10)))
    return first.select("vec_id", "k", F.greatest(F.lit(0.0), F.least(F.lit(65535.0), F.rint(C("e") / (F.lit(0.9) + F.lit(0.05) * C("layer"))))).alias("corrected"))


@query("im-24", "SELECT vec_id, count(*) FILTER (layer=1) AS pixels, count(*) FILTER (layer=1 AND vec_id%7=0 AND pixel%5=0) AS differing FROM pixels GROUP BY vec_id")
def _(t: Tables) -> DataFrame:
    """The first layer extracted from all, held against a file of it in which some images have other pixels."""
    own = t.pixels.where("layer = 1").select("vec_id", "pixel", "v")
    kept = own.select("vec_id", "pixel", F.when((C("vec_id") % 7 == 0) & (C("pixel") % 5 == 0), C("v") + 1).otherwise(C("v")).alias("other"))
    return own.join(kept, ["vec_id", "pixel"], "full").groupBy("vec_id").agg(F.count("v").alias("pixels"), F.count_if(~C("v").eqNullSafe(C("other"))).alias("differing"))


@query("ag-34-covariance", "SELECT a.k AS i, b.k AS j, CAST(sum(a.v*b.v) AS BIGINT) AS product, CAST(sum(a.v) AS BIGINT) AS si, CAST(sum(b.v) AS BIGINT) AS sj, count(*) AS n FROM pixels a JOIN pixels b ON a.vec_id=b.vec_id AND a.k<=b.k GROUP BY a.k, b.k")
def _(t: Tables) -> DataFrame:
    return A.covariance(t.pixels, "vec_id", "k", "v")
