"""Scalar functions, polygons and warps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.functions import polygons as P
from histoweave.functions import scalars as S
from histoweave.operators import rings
from histoweave.operators.relational import dealt
from histoweave.plans.registry import Tables, query

C = F.col


def _r(c, digits: int = 6):
    return F.round(c, digits)


def _box():
    return P.box(C("x0"), C("y0"), C("wd"), C("ht"))


def _hole():
    return P.box(C("x0") + 2, C("y0") + 2, C("wd") - 4, C("ht") - 4)


@query("sc-01", "SELECT c_custkey, CAST(regexp_extract(c_name, '#0*([0-9]+)', 1) AS BIGINT) AS number, regexp_extract(c_name, '^([A-Za-z]+)', 1) AS kind FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.regexp_extract("c_name", "#0*([0-9]+)", 1).cast("long").alias("number"), F.regexp_extract("c_name", "^([A-Za-z]+)", 1).alias("kind"))


@query("sc-02", "SELECT n_nationkey, regexp_replace(n_name, '_?[0-9]+$', '') AS stem FROM nation")
def _(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", F.regexp_replace("n_name", "_?[0-9]+$", "").alias("stem"))


@query("sc-03", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders")
def _(t: Tables) -> DataFrame:
    text = F.when(C("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return t.orders.select("o_orderkey", S.parse_time(text, "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss").cast("date").cast("string").alias("d"))


@query("sc-04", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.unix_timestamp(C("ts").cast("timestamp")).alias("t"))


@query("sc-05", "SELECT s_suppkey, lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS id FROM supplier")
def _(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", F.lpad(C("s_suppkey").cast("string"), 5, "0").alias("id"))


@query("sc-06", "SELECT page_id, 'mnt/'||regexp_replace(substr(url, 9), '[.][^./]*$', '.fw') AS path FROM pages WHERE starts_with(url, 'https://')")
def _(t: Tables) -> DataFrame:
    return t.pages.where(F.startswith("url", F.lit("https://"))).select("page_id", S.replace_suffix(S.map_mount(C("url"), {"https://": "mnt/"}), ".fw").alias("path"))


@query("sc-07", "SELECT l_orderkey, l_linenumber, CAST(sign(l_quantity-25) AS INT) AS s, CAST(floor(l_extendedprice/7) AS BIGINT) AS q, round_even(l_quantity/2, 0) AS half, abs(l_quantity-25) AS a FROM lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.sign(C("l_quantity") - 25).cast("int").alias("s"), F.floor(C("l_extendedprice") / 7).alias("q"), F.rint(C("l_quantity") / 2).alias("half"), F.abs(C("l_quantity") - 25).alias("a"))


@query("sc-08", "SELECT p_partkey, round(ln(p_retailprice+sqrt(p_retailprice*p_retailprice+1)), 6) AS a, round(ln(p_retailprice), 6) AS l, round(atan2(p_size, p_retailprice), 6) AS t, round(sqrt(p_retailprice), 6) AS r FROM part")
def _(t: Tables) -> DataFrame:
    p = C("p_retailprice")
    return t.part.select("p_partkey", _r(F.asinh(p)).alias("a"), _r(F.ln(p)).alias("l"), _r(F.atan2("p_size", p)).alias("t"), _r(F.sqrt(p)).alias("r"))


@query("sc-09", "SELECT slide_id, field, n, ctype, ctype|((n%3)<<8) AS code, (ctype|((n%3)<<8))&255 AS low FROM cell")
def _(t: Tables) -> DataFrame:
    code = S.cell_type(C("ctype"), C("n") % 3)
    return t.cell.select("slide_id", "field", "n", "ctype", code.alias("code"), code.bitwiseAND(255).alias("low"))


@query("sc-10", "SELECT id, wd*ht AS area, 2*(wd+ht) AS perimeter FROM poly")
def _(t: Tables) -> DataFrame:
    return t.poly.select("id", P.signed_area(_box()).alias("area"), P.perimeter(_box()).alias("perimeter"))


def _w(x: str) -> str:
    return f"CAST(CAST({x} AS BIGINT) AS VARCHAR)"


@query("sc-11", f"SELECT id, 'POLYGON (('||{_w('x0')}||' '||{_w('y0')}||','||{_w('x0+wd')}||' '||{_w('y0')}||','||{_w('x0+wd')}||' '||{_w('y0+ht')}||','||{_w('x0')}||' '||{_w('y0+ht')}||','||{_w('x0')}||' '||{_w('y0')}||'))' AS wkt, wd*ht AS area FROM poly")
def _(t: Tables) -> DataFrame:
    text = t.poly.select("id", P.to_wkt(F.array(_box())).alias("wkt"))
    return text.select("id", "wkt", P.nested_area(P.from_wkt(C("wkt"))).alias("area"))


@query("sc-12", "SELECT id, x0 AS first_x, y0 AS first_y, wd*ht AS area FROM poly")
def _(t: Tables) -> DataFrame:
    turned = F.reverse(P.shifted(P.shifted(_box())))
    n = dealt(t.poly, "id").select("id", P.normalised(turned).alias("p"))
    return n.select("id", C("p")[0]["x"].alias("first_x"), C("p")[0]["y"].alias("first_y"), P.signed_area(C("p")).alias("area"))


@query("sc-13", "SELECT doc_id, CASE lang WHEN 'en' THEN 1.0 WHEN 'fr' THEN 0.5 ELSE 0.25 END AS scale FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.when(C("lang") == "en", 1.0).when(C("lang") == "fr", 0.5).otherwise(0.25).alias("scale"))


@query("sc-14", "SELECT p_partkey, round(1.1*cos(p_size/100e0), 6) AS a, round(-1.1*sin(p_size/100e0)+0.01, 6) AS b, round(0.9*sin(p_size/100e0), 6) AS c, round(0.9*cos(p_size/100e0), 6) AS d FROM part")
def _(t: Tables) -> DataFrame:
    r = C("p_size") / 100
    return t.part.select("p_partkey", _r(1.1 * F.cos(r)).alias("a"), _r(-1.1 * F.sin(r) + 0.01).alias("b"), _r(0.9 * F.sin(r)).alias("c"), _r(0.9 * F.cos(r)).alias("d"))


@query("sc-17", "SELECT slide_id, n, round(x*(1+1e-3*r2)+2e-3*x*y, 6) AS wx, round(y*(1+1e-3*r2)+1e-3*(r2+2*y*y), 6) AS wy FROM (SELECT slide_id, n, x, y, x*x+y*y AS r2 FROM (SELECT slide_id, n, (cx-2500)/1000e0 AS x, (cy-2000)/1000e0 AS y FROM rect) a) b")
def _(t: Tables) -> DataFrame:
    x, y = (C("cx") - 2500) / 1000, (C("cy") - 2000) / 1000
    r2 = x * x + y * y
    return t.rect.select("slide_id", "n", _r(x * (1 + 1e-3 * r2) + 2e-3 * x * y).alias("wx"), _r(y * (1 + 1e-3 * r2) + 1e-3 * (r2 + 2 * y * y)).alias("wy"))


@query("sc-18", "SELECT slide_id, n, CAST(floor((cx-100)/1400e0) AS BIGINT) AS tile, cx-100-CAST(floor((cx-100)/1400e0) AS BIGINT)*1400 AS rel FROM rect")
def _(t: Tables) -> DataFrame:
    tile = F.floor((C("cx") - 100) / 1400)
    return t.rect.select("slide_id", "n", tile.alias("tile"), (C("cx") - 100 - tile * 1400).alias("rel"))


@query("sc-19", "SELECT p_partkey, list_contains(string_split(p_name, ' '), 'ring') AS has FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_contains(F.split("p_name", " "), "ring").alias("has"))


@query("sc-20", "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("sc-21", "SELECT p_partkey FROM part WHERE regexp_matches(p_type, '^(?i:econ)')")
def _(t: Tables) -> DataFrame:
    return t.part.where(C("p_type").rlike("(?i)^econ")).select("p_partkey")


@query("sc-22", "SELECT page_id, sha256(html) AS sha, page_id%11=0 AS mismatch FROM pages")
def _(t: Tables) -> DataFrame:
    """Hashes held against those that were noted, of which every eleventh is of another text."""
    noted = t.pages.select("page_id", F.sha2(F.when(C("page_id") % 11 == 0, F.concat("html", F.lit(" "))).otherwise(C("html")), 256).alias("noted"))
    found = t.pages.select("page_id", F.sha2("html", 256).alias("sha")).join(noted, "page_id")
    return found.select("page_id", "sha", (C("sha") != C("noted")).alias("mismatch"))


@query("wn-06", "SELECT id, k, CASE WHEN k%2=1 THEN wd ELSE ht END AS length FROM poly, (SELECT unnest(generate_series(1, 4)) AS k) e")
def _(t: Tables) -> DataFrame:
    return t.poly.select("id", F.posexplode(P.edge_lengths(_box())).alias("k", "length")).select("id", (C("k") + 1).cast("long").alias("k"), "length")


@query("wn-07", "SELECT id, greatest(wd, ht) AS longest, CAST(greatest(wd, ht)*3>=(2*(wd+ht)-greatest(wd, ht))*2 AS INT) AS unclosed FROM poly")
def _(t: Tables) -> DataFrame:
    e = P.edge_lengths(_box())
    top = F.array_max(e)
    return t.poly.select("id", top.alias("longest"), (top * 3 >= (F.aggregate(e, F.lit(0.0), lambda s, v: s + v) - top) * 2).cast("int").alias("unclosed"))


@query("sp-05", "SELECT slide_id, n, CAST((w-20)*(h-20) AS DOUBLE) AS area FROM rect")
def _(t: Tables) -> DataFrame:
    return t.rect.select("slide_id", "n", P.signed_area(P.box(C("cx") + 10, C("cy") + 10, C("w") - 20, C("h") - 20)).alias("area"))


@query("sp-06", "SELECT id, wd*ht-(wd-4)*(ht-4) AS area, 2*(wd+ht)+2*(wd+ht-8) AS perimeter FROM poly")
def _(t: Tables) -> DataFrame:
    rings = F.array(_box(), _hole())
    return t.poly.select("id", P.nested_area(rings).alias("area"), P.nested_perimeter(rings).alias("perimeter"))


@query("sp-07", "SELECT id, depth, CASE WHEN depth%2=0 THEN 'outer' ELSE 'hole' END AS kind FROM poly, (SELECT unnest(generate_series(0, 1)) AS depth) d")
def _(t: Tables) -> DataFrame:
    d = t.poly.select("id", F.posexplode(F.array(_box(), _hole())).alias("depth", "ring"))
    return d.select("id", C("depth").cast("long").alias("depth"), F.when(C("depth") % 2 == 0, "outer").otherwise("hole").alias("kind"))


@query("sp-07-nested", """WITH r AS (SELECT id, 1+id%5 AS n, unnest(generate_series(0, CAST(id%5 AS BIGINT))) AS ring FROM poly),
 d AS (SELECT id, n, ring, CASE WHEN id%2=1 THEN n-1-ring ELSE ring END AS depth FROM r),
 e AS (SELECT id, ring, depth, CASE WHEN depth=0 THEN NULL WHEN id%2=1 THEN ring+1 ELSE ring-1 END AS parent FROM d UNION ALL SELECT id, 9, 0, NULL FROM poly)
 SELECT id, CAST(ring AS INT) AS ring, CAST(depth AS BIGINT) AS depth, CAST(parent AS INT) AS parent, CAST(CASE WHEN depth%2=0 THEN ring ELSE parent END AS INT) AS polygon, CASE WHEN depth%2=0 THEN 'outer' ELSE 'hole' END AS kind FROM e""")
def _(t: Tables) -> DataFrame:
    """Up to five rings in one another, outermost first or last, and one beside them."""
    x, y, w, h, n = (C(c).cast("long") for c in ("x0", "y0", "wd", "ht", "n"))
    level = t.poly.withColumn("n", 1 + C("id") % 5).select("*", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("ring"))
    inset = F.when(C("id") % 2 == 1, n - 1 - C("ring")).otherwise(C("ring"))
    level = level.select("id", "ring", (2 * x + inset).alias("l"), (2 * y + inset).alias("b"), (2 * (x + w) - inset).alias("r"), (2 * (y + h) - inset).alias("t"))
    beside = t.poly.select("id", F.lit(9).cast("long").alias("ring"), (2 * (x + w) + 2).alias("l"), (2 * y).alias("b"), (2 * (x + w) + 4).alias("r"), (2 * y + 2).alias("t"))
    corners = F.array(*(F.struct(C(a).alias("x"), C(b).alias("y")) for a, b in (("l", "b"), ("r", "b"), ("r", "t"), ("l", "t"))))
    vertices = level.unionByName(beside).select("id", C("ring").cast("int").alias("ring"), F.posexplode(corners).alias("vid", "p")).select("id", "ring", "vid", "p.x", "p.y")
    return rings.nesting(vertices, ["id"])


def _faulty(poly: DataFrame) -> DataFrame:
    """(id, ring, vid, x, y) of a box that is plain, crosses itself, has a spike, a hole that touches it once, repeated and nested rings, or a hole that parts it, by the id."""
    w, h, mw, mh = 2 * C("wd"), 2 * C("ht"), C("wd"), C("ht")
    zero, box = F.lit(0.0), ((0, 0), (w, 0), (w, h), (0, h))
    inset = lambda k: ((k, k), (w - k, k), (w - k, h - k), (k, h - k))
    shapes = [[box], [((0, 0), (w, h), (w, 0), (0, h))], [((0, 0), (w, 0), (w, h), (w, h + 7), (w, h), (0, h))], [box, ((0, mh), (2, mh - 1), (2, mh + 1))], [box, box, box, inset(1), inset(2)], [box, ((0, mh), (mw, mh + 1), (w, mh), (mw, mh - 1))]]
    points = lambda rs: F.array(*(F.struct(F.lit(r).alias("ring"), F.lit(v).alias("vid"), (C("x0") + zero + x).alias("x"), (C("y0") + zero + y).alias("y")) for r, ring in enumerate(rs) for v, (x, y) in enumerate(ring)))
    chosen = points(shapes[0])
    for k, rs in enumerate(shapes[1:], 1):
        chosen = F.when(C("id") % len(shapes) == k, points(rs)).otherwise(chosen)
    return poly.select("id", F.explode(chosen).alias("p")).select("id", "p.*")


@query("sp-08", """WITH s AS (SELECT id, id%6 AS k, 2*wd AS w, 2*ht AS h FROM poly),
 e AS (SELECT id, w*h AS area, 0 AS holes, 4 AS points FROM s WHERE k IN (0, 2)
  UNION ALL SELECT id, w*h/4, 0, 3 FROM s, (VALUES (1), (2)) v(i) WHERE k=1
  UNION ALL SELECT id, w*h-2, 1, 8 FROM s WHERE k=3
  UNION ALL SELECT id, w*h-(w-2)*(h-2), 1, 8 FROM s WHERE k=4 UNION ALL SELECT id, (w-4)*(h-4), 0, 4 FROM s WHERE k=4
  UNION ALL SELECT id, (w*h-w)/2, 0, 5 FROM s, (VALUES (1), (2)) v(i) WHERE k=5)
 SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY area DESC) AS INT) AS polygon, area, CAST(holes AS BIGINT) AS holes, CAST(points AS BIGINT) AS points FROM e""")
def _(t: Tables) -> DataFrame:
    """Area, holes and vertices of the valid polygons that invalid ones fall into."""
    valid = rings.make_valid(_faulty(t.poly), ["id"], scale=4)
    return valid.groupBy("id", "polygon").agg(F.max("area").alias("area"), F.max("ring").cast("long").alias("holes"), F.count("*").alias("points"))


def _rasterised(poly: DataFrame) -> DataFrame:
    """Pixels whose centre lies in each polygon and not in its hole; a row a polygon, also where ids are repeated or a size is null."""
    return dealt(poly, "id").select("id", P.pixels(_box(), _hole()).alias("pixels"))


@query("sp-09", "SELECT id, CAST(wd*ht-(wd-4)*(ht-4) AS BIGINT) AS pixels FROM poly")
def _(t: Tables) -> DataFrame:
    return _rasterised(t.poly)


@query("sp-09-all", "SELECT id, CAST(wd*ht-(wd-4)*(ht-4) AS BIGINT) AS pixels FROM poly")
def _(t: Tables) -> DataFrame:
    return _rasterised(t.poly)


@query("sp-12", "SELECT id, floor((x0+0.3+1e-10)/0.5)*0.5 AS x, floor((y0+0.7+1e-10)/0.5)*0.5 AS y FROM poly")
def _(t: Tables) -> DataFrame:
    g = P.round_to_grid(P.ring((C("x0") + 0.3, C("y0") + 0.7)), 0.5)
    return t.poly.select("id", g[0]["x"].alias("x"), g[0]["y"].alias("y"))


@query("sp-13", "SELECT slide_id, n, CASE n%3 WHEN 0 THEN cx+12.5 WHEN 1 THEN cx+0.01*cx-0.02*cy+3 ELSE cx END AS wx FROM rect")
def _(t: Tables) -> DataFrame:
    x, y = C("cx"), C("cy")
    return t.rect.select("slide_id", "n", F.when(C("n") % 3 == 0, x + 12.5).when(C("n") % 3 == 1, x + 0.01 * x - 0.02 * y + 3).otherwise(x).alias("wx"))


@query("sp-14", "SELECT slide_id, n, round(0.01*(cx%1400)+0.002*(cy%2100)+0.5*floor(cx/1400e0)-0.25*floor(cy/2100e0)+1.5, 6) AS dx FROM rect")
def _(t: Tables) -> DataFrame:
    return t.rect.select("slide_id", "n", _r(0.01 * (C("cx") % 1400) + 0.002 * (C("cy") % 2100) + 0.5 * F.floor(C("cx") / 1400) - 0.25 * F.floor(C("cy") / 2100) + 1.5).alias("dx"))


@query("sp-17", "SELECT id, round(64*wd*wd*sin(2*pi()/128), 4) AS area FROM poly")
def _(t: Tables) -> DataFrame:
    return dealt(t.poly, "id").select("id", _r(P.signed_area(P.circle(C("x0"), C("y0"), C("wd"), 128)), 4).alias("area"))


@query("sp-18", "SELECT slide_id, field, ctype, n FROM cell WHERE x>=67 AND x+w<=602 AND y>=50 AND y+h<=450")
def _(t: Tables) -> DataFrame:
    edge = lambda a, b: C(a) + C(b)
    return t.cell.where(C("x").between(67, 602) & (edge("x", "w") <= 602) & C("y").between(50, 450) & (edge("y", "h") <= 450)).select("slide_id", "field", "ctype", "n")


@query("sp-19", "SELECT c.slide_id, c.field, c.n, CAST(floor(r.cx*2e0+c.x) AS BIGINT) AS gx, CAST(floor(r.cy*2e0+c.y) AS BIGINT) AS gy FROM cell c JOIN rect r ON r.slide_id=c.slide_id AND r.n=c.field")
def _(t: Tables) -> DataFrame:
    r = t.rect.select("slide_id", C("n").alias("field"), "cx", "cy")
    return t.cell.join(r, ["slide_id", "field"]).select("slide_id", "field", "n", F.floor(C("cx") * 2.0 + C("x")).alias("gx"), F.floor(C("cy") * 2.0 + C("y")).alias("gy"))


@query("sp-20", "SELECT slide_id, field, n, CAST(w*h*10<=2*(w+h)*8 AS INT) AS thin FROM cell")
def _(t: Tables) -> DataFrame:
    b = P.box(F.lit(0), F.lit(0), C("w"), C("h"))
    return t.cell.select("slide_id", "field", "n", (P.signed_area(b) * 10 <= P.perimeter(b) * 8).cast("int").alias("thin"))
