"""Fields, overlaps, islands and grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histoweave.operators import conflicts, graph, spatial
from histoweave.operators.relational import merged
from histoweave.plans.registry import Tables, query


@query("jn-01", "SELECT * FROM overlap")
def _(t: Tables) -> DataFrame:
    return t.overlap


@query("flt-12", """SELECT r.slide_id, r.n, count(o.p1) AS degree, CASE WHEN count(o.p1)=8 THEN 'bulk' WHEN count(o.p1)<8 THEN 'edge' ELSE 'other' END AS kind
 FROM rect r LEFT JOIN overlap o ON r.slide_id=o.slide_id AND r.n=o.p1 GROUP BY r.slide_id, r.n""")
def _(t: Tables) -> DataFrame:
    return spatial.edge_and_bulk(t.rect, t.overlap)


@query("gr-03", "SELECT r.slide_id, r.n, count(o.p1) AS degree FROM rect r LEFT JOIN overlap o ON r.slide_id=o.slide_id AND r.n=o.p1 GROUP BY r.slide_id, r.n")
def _(t: Tables) -> DataFrame:
    return spatial.degrees(t.rect, t.overlap).select("slide_id", "n", "degree")


@query("gr-04", "SELECT slide_id, p2 AS n, tag, p1 AS neighbour FROM overlap")
def _(t: Tables) -> DataFrame:
    return graph.neighbours_by_tag(t.overlap)


_ISLANDS = """WITH RECURSIVE walk(slide_id, n, m) AS (SELECT slide_id, n, n FROM rect UNION SELECT w.slide_id, w.n, o.p2 FROM walk w JOIN {edges} o ON o.slide_id=w.slide_id AND o.p1=w.m),
 isl AS (SELECT slide_id, n, min(m) AS island FROM walk GROUP BY slide_id, n) """


@query("gr-01", _ISLANDS.format(edges="overlap") + "SELECT slide_id, n, island FROM isl")
def _(t: Tables) -> DataFrame:
    return graph.islands(t.rect, t.overlap)


@query("ag-33", _ISLANDS.format(edges="overlap") + "SELECT slide_id, island, count(*) AS members FROM isl GROUP BY slide_id, island")
def _(t: Tables) -> DataFrame:
    return graph.island_sizes(graph.islands(t.rect, t.overlap))


@query("gr-02", _ISLANDS.format(edges="overlap") + """, sz AS (SELECT slide_id, island, count(*) AS members FROM isl GROUP BY slide_id, island), b AS (SELECT slide_id, max(members) AS m FROM sz GROUP BY slide_id)
 SELECT sz.slide_id, island, members FROM sz JOIN b USING (slide_id) WHERE members >= CASE WHEN m>=45 THEN 45 WHEN m>=8 THEN 8 ELSE 1 END""")
def _(t: Tables) -> DataFrame:
    return graph.sized_islands(graph.islands(t.rect, t.overlap), 45, 8)


@query("gr-05", _ISLANDS.format(edges="(SELECT * FROM measured WHERE exit=0 AND tag IN (4,6))") + """, sz AS (SELECT slide_id, island, count(*) AS members FROM isl GROUP BY slide_id, island)
 SELECT i.slide_id, i.n, CASE WHEN members=1 THEN 0 ELSE i.island END AS gc FROM isl i JOIN sz USING (slide_id, island)""")
def _(t: Tables) -> DataFrame:
    found = graph.islands(t.rect, t.measured.where("exit = 0 and tag in (4, 6)"))
    return found.join(merged(graph.island_sizes(found)), ["slide_id", "island"]).select("slide_id", "n", F.when(F.col("members") == 1, 0).otherwise(F.col("island")).alias("gc"))


@query("gr-06", "SELECT slide_id, p1, p2, tag FROM overlap WHERE (x1=x2 OR abs(x1-x2)=535) AND (y1=y2 OR abs(y1-y2)=400)")
def _(t: Tables) -> DataFrame:
    on = lambda a, b, d: F.abs(F.col(a) - F.col(b)).isin(0, d)
    return t.overlap.where(on("x1", "x2", 535) & on("y1", "y2", 400)).select("slide_id", "p1", "p2", "tag")


@query("ag-18", """WITH g AS (SELECT slide_id, n, (SELECT min(b.cx) FROM rect b WHERE b.slide_id=a.slide_id AND b.cy=a.cy AND b.cx>a.cx)-a.cx AS gap FROM rect a),
 c AS (SELECT slide_id, gap, count(*) AS times FROM g WHERE gap IS NOT NULL GROUP BY slide_id, gap)
 SELECT slide_id, gap, times FROM (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY times DESC, gap) AS rn FROM c) x WHERE rn=1""")
def _(t: Tables) -> DataFrame:
    return spatial.hpf_offset(t.rect, "cx")


@query("wn-03", "SELECT slide_id, cx, dense_rank() OVER (PARTITION BY slide_id ORDER BY cx) AS g FROM (SELECT DISTINCT slide_id, cx FROM rect) x")
def _(t: Tables) -> DataFrame:
    return spatial.grid_index(t.rect, "cx", 1.0)


_LINES = """WITH d AS (SELECT slide_id, cx, w, dense_rank() OVER (PARTITION BY slide_id ORDER BY cx) AS g FROM rect), m AS (SELECT slide_id, g, avg(cx) AS start, avg(cx+w) AS stop FROM d GROUP BY slide_id, g) """


@query("wn-04", _LINES + "SELECT slide_id, g, start, (lead(start) OVER (PARTITION BY slide_id ORDER BY g)+stop)/2 AS boundary FROM m")
def _(t: Tables) -> DataFrame:
    return spatial.region_boundaries(t.rect, "cx", "w", 1.0)


def _axis(name: str, place: str, at: str, size: str, offset: int) -> str:
    """DuckDB text of `axis_regions`, as common tables whose last one is `name`."""
    n = name
    return f"""{n}_g AS (SELECT *, dense_rank() OVER (PARTITION BY slide_id, island ORDER BY {place}) AS g FROM fld),
 {n}_a AS (SELECT slide_id, island, g, avg({at}) AS a, max({size}) AS size FROM {n}_g GROUP BY slide_id, island, g),
 {n}_b AS (SELECT *, max(g) OVER (PARTITION BY slide_id, island) AS last, (a+size+lead(a) OVER (PARTITION BY slide_id, island ORDER BY g))/2 AS b FROM {n}_a),
 {n}_d AS (SELECT *, lead(b) OVER (PARTITION BY slide_id, island ORDER BY g)-b AS d FROM {n}_b),
 {n}_m AS (SELECT slide_id, island, avg(CASE WHEN abs(d-md)<=sd THEN d END) AS m FROM (SELECT *, avg(d) OVER f AS md, stddev_pop(d) OVER f AS sd FROM {n}_d WINDOW f AS (PARTITION BY slide_id, island)) z GROUP BY slide_id, island),
 {n}_r AS (SELECT *, b-m*g AS r FROM {n}_d JOIN {n}_m USING (slide_id, island)),
 {n}_j AS (SELECT *, b IS NOT NULL AND count(r) OVER u>=2 AND abs(r-avg(r) OVER u)*sqrt(count(r) OVER u)>100*stddev_pop(r) OVER u AS up, b IS NOT NULL AND count(r) OVER v>=2 AND abs(r-avg(r) OVER v)*sqrt(count(r) OVER v)>100*stddev_pop(r) OVER v AS down FROM {n}_r
 WINDOW u AS (PARTITION BY slide_id, island ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), v AS (PARTITION BY slide_id, island ORDER BY g DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 {n}_e AS (SELECT slide_id, island, coalesce(min(g) FILTER (up), max(last)) AS lo, coalesce(max(g) FILTER (down), 0) AS hi FROM {n}_j GROUP BY slide_id, island),
 {n}_o AS (SELECT slide_id, island, avg(r) FILTER (g<lo) AS lft, avg(r) FILTER (g>hi) AS rgt, max(b) AS one, max(a+size/2e0) AS mid FROM {n}_j JOIN {n}_e USING (slide_id, island) GROUP BY slide_id, island),
 {n} AS (SELECT x.slide_id, x.n, x.g, j.last, coalesce(lag_b, CASE WHEN j.last>2 THEN lft WHEN j.last=2 THEN one-{offset} ELSE mid-{offset}/2e0 END) AS low, coalesce(j.b, CASE WHEN j.last>2 THEN rgt+j.m*j.last WHEN j.last=2 THEN one+{offset} ELSE mid+{offset}/2e0 END) AS high
 FROM {n}_g x JOIN (SELECT *, lag(b) OVER (PARTITION BY slide_id, island ORDER BY g) AS lag_b FROM {n}_j) j ON j.slide_id=x.slide_id AND j.island=x.island AND j.g=x.g JOIN {n}_o o ON o.slide_id=x.slide_id AND o.island=x.island)"""


_FIELDS = _ISLANDS.format(edges="overlap") + ", fld AS (SELECT r.slide_id, isl.island, r.n, r.cx, r.cy, r.w, r.h, r.cx+((r.n*7)%5-2)*0.5+CASE WHEN r.cx>3000 THEN 40 ELSE 0 END AS px, r.cy+((r.n*3)%7-3)*0.5 AS py FROM rect r JOIN isl USING (slide_id, n))"


def _regions(t: Tables) -> DataFrame:
    c, n = F.col, F.col("n")
    px = c("cx") + (n * 7 % 5 - 2) * 0.5 + F.when(c("cx") > 3000, 40).otherwise(0)
    fields = t.rect.join(merged(graph.islands(t.rect, t.overlap)), ["slide_id", "n"]).select("slide_id", "island", "n", "cx", "cy", "w", "h", px.alias("px"), (c("cy") + (n * 3 % 7 - 3) * 0.5).alias("py"), F.lit(535).alias("offset_x"), F.lit(400).alias("offset_y"))
    near = t.overlap.join(merged(fields.select("slide_id", "island", n.alias("p2"))), ["slide_id", "p2"])
    return spatial.primary_regions(fields, near, ["slide_id", "island"])


@query("sp-02", f"""{_FIELDS}, {_axis('ax', 'cx', 'px', 'w', 535)}, {_axis('ay', 'cy', 'py', 'h', 400)}, tag AS (SELECT slide_id, p2 AS n, bool_or(tag IN (1, 4, 7)) AS l, bool_or(tag IN (3, 6, 9)) AS r, bool_or(tag IN (1, 2, 3)) AS u, bool_or(tag IN (7, 8, 9)) AS d FROM overlap GROUP BY slide_id, p2)
 SELECT f.slide_id, f.island, f.n, round(CASE WHEN NOT coalesce(l, false) OR (ax.g=1 AND ax.low<px) THEN px ELSE ax.low END, 6) AS mx1, round(CASE WHEN NOT coalesce(r, false) OR (ax.g=ax.last AND ax.high>px+w) THEN px+w ELSE ax.high END, 6) AS mx2,
 round(CASE WHEN NOT coalesce(u, false) OR (ay.g=1 AND ay.low<py) THEN py ELSE ay.low END, 6) AS my1, round(CASE WHEN NOT coalesce(d, false) OR (ay.g=ay.last AND ay.high>py+h) THEN py+h ELSE ay.high END, 6) AS my2
 FROM fld f JOIN ax ON ax.slide_id=f.slide_id AND ax.n=f.n JOIN ay ON ay.slide_id=f.slide_id AND ay.n=f.n LEFT JOIN tag ON tag.slide_id=f.slide_id AND tag.n=f.n""")
def _(t: Tables) -> DataFrame:
    """Primary regions of fields that lie a little off the grid, with a jump of the stage in the middle."""
    return _regions(t).select("slide_id", "island", "n", *(F.round(c, 6).alias(c) for c in ("mx1", "mx2", "my1", "my2")))


@query("wn-01", "SELECT slide_id, n, row_number() OVER (PARTITION BY slide_id ORDER BY t, n) AS number FROM rect")
def _(t: Tables) -> DataFrame:
    return t.rect.select("slide_id", "n", F.row_number().over(Window.partitionBy("slide_id").orderBy("t", "n")).cast("long").alias("number"))


@query("wn-02", "SELECT slide_id, p1, p2, row_number() OVER (PARTITION BY slide_id ORDER BY p1, p2) AS n FROM overlap")
def _(t: Tables) -> DataFrame:
    return t.overlap.select("slide_id", "p1", "p2", F.row_number().over(Window.partitionBy("slide_id").orderBy("p1", "p2")).cast("long").alias("n"))


@query("jn-02", "SELECT o.slide_id, o.p1, o.p2, a.file AS file1, b.file AS file2 FROM overlap o JOIN rect a ON a.slide_id=o.slide_id AND a.n=o.p1 JOIN rect b ON b.slide_id=o.slide_id AND b.n=o.p2")
def _(t: Tables) -> DataFrame:
    name = lambda p, f: t.rect.select("slide_id", F.col("n").alias(p), F.col("file").alias(f))
    return t.overlap.select("slide_id", "p1", "p2").join(merged(name("p1", "file1")), ["slide_id", "p1"]).join(merged(name("p2", "file2")), ["slide_id", "p2"]).select("slide_id", "p1", "p2", "file1", "file2")


@query("jn-03", "SELECT slide_id, p1, p2, tag FROM overlap WHERE p1%3<>0 AND p2%3<>0")
def _(t: Tables) -> DataFrame:
    chosen = t.rect.where("n % 3 <> 0").select("slide_id", "n")
    both = t.overlap.join(merged(chosen.withColumnRenamed("n", "p1")), ["slide_id", "p1"], "left_semi").join(merged(chosen.withColumnRenamed("n", "p2")), ["slide_id", "p2"], "left_semi")
    return both.select("slide_id", "p1", "p2", "tag")


@query("jn-04", "SELECT slide_id, n FROM rect r WHERE EXISTS (SELECT 1 FROM measured m WHERE m.exit=1 AND m.slide_id=r.slide_id AND (m.p1=r.n OR m.p2=r.n))")
def _(t: Tables) -> DataFrame:
    bad = t.measured.where("exit = 1")
    ends = bad.select("slide_id", F.col("p1").alias("n")).union(bad.select("slide_id", "p2"))
    return t.rect.select("slide_id", "n").join(merged(ends), ["slide_id", "n"], "left_semi")


@query("jn-05", "SELECT a.slide_id, a.p1, a.p2, a.dx AS dx, -b.dx AS mirrored FROM measured a JOIN measured b ON a.slide_id=b.slide_id AND a.p1=b.p2 AND a.p2=b.p1")
def _(t: Tables) -> DataFrame:
    m = t.measured
    back = m.select("slide_id", F.col("p2").alias("p1"), F.col("p1").alias("p2"), (-F.col("dx")).alias("mirrored"))
    return m.select("slide_id", "p1", "p2", "dx").join(merged(back), ["slide_id", "p1", "p2"])


@query("jn-06", "SELECT o.slide_id, o.p1, o.p2, m.dx FROM overlap o LEFT JOIN (SELECT * FROM measured WHERE exit=0) m ON m.slide_id=o.slide_id AND m.p1=o.p1 AND m.p2=o.p2")
def _(t: Tables) -> DataFrame:
    good = t.measured.where("exit = 0").select("slide_id", "p1", "p2", "dx")
    return t.overlap.select("slide_id", "p1", "p2").join(merged(good), ["slide_id", "p1", "p2"], "left")


@query("jn-07", "SELECT r.slide_id, r.n, f.file FROM rect r JOIN (SELECT slide_id, cx, cy, file FROM rect WHERE n%7<>0) f ON f.slide_id=r.slide_id AND f.cx=r.cx AND f.cy=r.cy")
def _(t: Tables) -> DataFrame:
    files = t.rect.where("n % 7 <> 0").select("slide_id", "cx", "cy", "file")
    return t.rect.select("slide_id", "n", "cx", "cy").join(merged(files), ["slide_id", "cx", "cy"]).select("slide_id", "n", "file")


@query("jn-17", "SELECT r.slide_id, r.n, e.layer, e.exp FROM rect r JOIN (SELECT CAST(floor(l_partkey/100e0) AS BIGINT) AS slide_id, l_partkey%100+1 AS n, l_linenumber AS layer, max(l_quantity) AS exp FROM lineitem GROUP BY 1,2,3) e ON e.slide_id=r.slide_id AND e.n=r.n")
def _(t: Tables) -> DataFrame:
    k = F.col("l_partkey")
    e = t.lineitem.groupBy(F.floor(k / 100).alias("slide_id"), (k % 100 + 1).alias("n"), F.col("l_linenumber").alias("layer")).agg(F.max("l_quantity").alias("exp"))
    return t.rect.select("slide_id", "n").join(merged(e), ["slide_id", "n"])


@query("jn-19", "SELECT r.slide_id, r.n, x.tx, y.ty FROM rect r, (SELECT unnest(generate_series(0, 9)) AS tx) x, (SELECT unnest(generate_series(0, 9)) AS ty) y WHERE r.cx < (tx+1)*1024 AND r.cx+r.w > tx*1024 AND r.cy < (ty+1)*1024 AND r.cy+r.h > ty*1024")
def _(t: Tables) -> DataFrame:
    return spatial.tiles_covered(t.rect, 1024).select("slide_id", "n", "tx", "ty")


@query("sp-21", "SELECT r.slide_id, r.n, x.tx, y.ty, least(r.cx+r.w, (tx+1)*512)-greatest(r.cx, tx*512) AS wide, least(r.cy+r.h, (ty+1)*512)-greatest(r.cy, ty*512) AS high FROM rect r, (SELECT unnest(generate_series(0, 19)) AS tx) x, (SELECT unnest(generate_series(0, 19)) AS ty) y WHERE r.cx < (tx+1)*512 AND r.cx+r.w > tx*512 AND r.cy < (ty+1)*512 AND r.cy+r.h > ty*512")
def _(t: Tables) -> DataFrame:
    return spatial.tiles_covered(t.rect, 512)


@query("jn-21", "SELECT a.slide_id, a.n AS p1, b.n AS p2 FROM rect a JOIN rect b ON a.slide_id=b.slide_id AND abs((a.n-1)%10-(b.n-1)%10)+abs(floor((a.n-1)/10e0)-floor((b.n-1)/10e0))=1")
def _(t: Tables) -> DataFrame:
    a = t.rect.select("slide_id", F.col("n").alias("p1"), ((F.col("n") - 1) % 10).alias("ix"), F.floor((F.col("n") - 1) / 10).alias("iy"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((1, 0), (-1, 0), (0, 1), (0, -1))])
    b = a.withColumn("s", F.explode(steps)).select("slide_id", F.col("p1").alias("p2"), (F.col("ix") + F.col("s.i")).alias("ix"), (F.col("iy") + F.col("s.j")).alias("iy"))
    return a.join(merged(b), ["slide_id", "ix", "iy"]).select("slide_id", "p1", "p2")


_OCTETS = "SELECT slide_id, p1, count(*) AS good FROM measured WHERE exit=0 GROUP BY slide_id, p1 HAVING count(*)=8"


@query("ag-23", f"WITH q AS ({_OCTETS}) SELECT m.slide_id, m.p1, max(CASE WHEN tag=1 THEN p2 END) AS t1, max(CASE WHEN tag=2 THEN p2 END) AS t2, max(CASE WHEN tag=3 THEN p2 END) AS t3, max(CASE WHEN tag=4 THEN p2 END) AS t4, max(CASE WHEN tag=6 THEN p2 END) AS t6, max(CASE WHEN tag=7 THEN p2 END) AS t7, max(CASE WHEN tag=8 THEN p2 END) AS t8, max(CASE WHEN tag=9 THEN p2 END) AS t9 FROM measured m JOIN q ON q.slide_id=m.slide_id AND q.p1=m.p1 WHERE exit=0 GROUP BY m.slide_id, m.p1")
def _(t: Tables) -> DataFrame:
    tags = (1, 2, 3, 4, 6, 7, 8, 9)
    by = t.measured.where("exit = 0").groupBy("slide_id", "p1").agg(F.count("*").alias("good"), *[F.max(F.when(F.col("tag") == k, F.col("p2"))).alias(f"t{k}") for k in tags])
    return by.where("good = 8").drop("good")


@query("jn-25", f"WITH q AS ({_OCTETS}) SELECT m.slide_id, m.p1, count(DISTINCT r.file) AS files, min(r.file) AS first_file FROM measured m JOIN q ON q.slide_id=m.slide_id AND q.p1=m.p1 JOIN rect r ON r.slide_id=m.slide_id AND r.n=m.p2 WHERE m.exit=0 GROUP BY m.slide_id, m.p1")
def _(t: Tables) -> DataFrame:
    m = t.measured.where("exit = 0")
    octets = m.groupBy("slide_id", "p1").agg(F.count("*").alias("good")).where("good = 8")
    files = t.rect.select("slide_id", F.col("n").alias("p2"), "file")
    joined = m.select("slide_id", "p1", "p2").join(merged(octets), ["slide_id", "p1"], "left_semi").join(merged(files), ["slide_id", "p2"])
    return joined.groupBy("slide_id", "p1").agg(F.countDistinct("file").alias("files"), F.min("file").alias("first_file"))


@query("ag-16", "SELECT slide_id, round(sum(mse*npix)/sum(npix), 6) AS mse FROM measured WHERE exit=0 GROUP BY slide_id")
def _(t: Tables) -> DataFrame:
    return t.measured.where("exit = 0").groupBy("slide_id").agg(F.round(F.sum(F.col("mse") * F.col("npix")) / F.sum("npix"), 6).alias("mse"))


@query("ag-19", "SELECT slide_id, p1 AS n, round(sum((mse-2)/mse*npix)/sum(npix), 6) AS rel FROM measured WHERE mse<>0 GROUP BY slide_id, p1")
def _(t: Tables) -> DataFrame:
    return t.measured.where("mse <> 0").groupBy("slide_id", F.col("p1").alias("n")).agg(F.round(F.sum((F.col("mse") - 2) / F.col("mse") * F.col("npix")) / F.sum("npix"), 6).alias("rel"))


@query("ag-32", "SELECT slide_id, min(cx) AS x1, max(cx+w) AS x2, min(cy) AS y1, max(cy+h) AS y2 FROM rect GROUP BY slide_id")
def _(t: Tables) -> DataFrame:
    end = lambda a, b: F.max(F.col(a) + F.col(b))
    return t.rect.groupBy("slide_id").agg(F.min("cx").alias("x1"), end("cx", "w").alias("x2"), F.min("cy").alias("y1"), end("cy", "h").alias("y2"))


@query("ag-27", "SELECT slide_id, min(t) AS first_t, max(t) AS last_t FROM rect GROUP BY slide_id")
def _(t: Tables) -> DataFrame:
    return t.rect.groupBy("slide_id").agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"))


@query("ag-40", """SELECT slide_id, i, round(sum(cos(i*atan2(dy, dx))), 6) AS c, round(sum(sin(i*atan2(dy, dx))), 6) AS s, round(sqrt(avg(dx*dx+dy*dy)), 6) AS rms
 FROM measured, (SELECT unnest(generate_series(0, 3)) AS i) k WHERE exit=0 GROUP BY slide_id, i""")
def _(t: Tables) -> DataFrame:
    m = t.measured.where("exit = 0").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    a = F.col("i") * F.atan2("dy", "dx")
    return m.groupBy("slide_id", "i").agg(F.round(F.sum(F.cos(a)), 6).alias("c"), F.round(F.sum(F.sin(a)), 6).alias("s"), F.round(F.sqrt(F.avg(F.col("dx") ** 2 + F.col("dy") ** 2)), 6).alias("rms"))


#: Columns and rows of 535 x 400 in two islands, moved onto each other: below it, to the right, or at its corner.
_CROSSING = """c AS (SELECT slide_id, n, CAST(floor(cx/535e0) AS BIGINT) AS i, CAST(floor(cy/400e0) AS BIGINT) AS j, slide_id%3 AS k FROM rect),
 f AS (SELECT slide_id, n, i, j, k, CASE WHEN k=0 THEN CASE WHEN j<5 THEN 1 ELSE 2 END WHEN k=1 THEN CASE WHEN i<5 THEN 1 WHEN i>6 THEN 2 END WHEN i<5 AND j<5 THEN 1 WHEN i>6 AND j>6 THEN 2 END AS island FROM c),
 g AS (SELECT slide_id, n, i, j, k, CAST(island AS INT) AS island, i*535.0::DOUBLE+CASE WHEN island=1 THEN 0 WHEN k=0 THEN 200 WHEN k=1 THEN -1110 ELSE -1100 END AS x, j*400.0::DOUBLE+CASE WHEN island=1 THEN 0 WHEN k=0 THEN -30 WHEN k=1 THEN 130 ELSE -820 END AS y FROM f WHERE island IS NOT NULL)"""


def _crossing(t: Tables) -> DataFrame:
    i, j, k = F.floor(F.col("cx") / 535), F.floor(F.col("cy") / 400), F.col("slide_id") % 3
    island = F.when(k == 0, F.when(j < 5, 1).otherwise(2)).when(k == 1, F.when(i < 5, 1).when(i > 6, 2)).otherwise(F.when((i < 5) & (j < 5), 1).when((i > 6) & (j > 6), 2))
    second = F.col("island") == 2
    x = i * 535.0 + F.when(second, F.when(k == 0, 200).when(k == 1, -1110).otherwise(-1100)).otherwise(0)
    y = j * 400.0 + F.when(second, F.when(k == 0, -30).when(k == 1, 130).otherwise(-820)).otherwise(0)
    f = t.rect.withColumn("island", island).where("island is not null").withColumn("mx1", x).withColumn("my1", y)
    return f.select("slide_id", "island", "n", "mx1", (F.col("mx1") + 535).alias("mx2"), "my1", (F.col("my1") + 400).alias("my2"), F.lit(False).alias("orphan"), F.lit(535.0).alias("offset_x"), F.lit(400.0).alias("offset_y"))


@query("sp-03", f"""WITH {_CROSSING} SELECT slide_id, island, n,
 x+CASE WHEN island=2 AND i=7 AND (k=1 OR (k=2 AND j=7)) THEN CASE WHEN k=1 THEN 20 ELSE 15 END ELSE 0 END AS mx1, x+535-CASE WHEN island=1 AND i=4 AND (k=1 OR (k=2 AND j=4)) THEN CASE WHEN k=1 THEN 20 ELSE 15 END ELSE 0 END AS mx2,
 y+CASE WHEN k=0 AND j=5 AND island=2 AND EXISTS (SELECT 1 FROM g o WHERE o.slide_id=g.slide_id AND o.island=1 AND o.j=4 AND o.x<g.x+535 AND g.x<o.x+535) THEN 15 ELSE 0 END AS my1,
 y+400-CASE WHEN k=0 AND j=4 AND island=1 AND EXISTS (SELECT 1 FROM g o WHERE o.slide_id=g.slide_id AND o.island=2 AND o.j=5 AND o.x<g.x+535 AND g.x<o.x+535) THEN 15 ELSE 0 END AS my2 FROM g""")
def _(t: Tables) -> DataFrame:
    """Regions of two islands moved onto each other, cut where they share area."""
    return conflicts.resolve(_crossing(t)).select("slide_id", "island", "n", "mx1", "mx2", "my1", "my2")


@query("sp-03-pairs", f"""WITH {_CROSSING} SELECT a.slide_id, a.n AS p1, b.n AS p2 FROM g a JOIN g b ON a.slide_id=b.slide_id AND a.island<b.island AND a.x<b.x+535 AND b.x<a.x+535 AND a.y<b.y+400 AND b.y<a.y+400""")
def _(t: Tables) -> DataFrame:
    """Fields of different islands whose regions share area."""
    return conflicts.region_overlaps(_crossing(t)).select("slide_id", F.col("a.n").alias("p1"), F.col("b.n").alias("p2"))


@query("sp-01", "SELECT slide_id, p1, p2, greatest(0, 669-abs(x1-x2)-16)*greatest(0, 500-abs(y1-y2)-16) AS area FROM overlap")
def _(t: Tables) -> DataFrame:
    o = t.overlap
    return o.select("slide_id", "p1", "p2", spatial.common_area(F.col("x1") - F.col("x2"), F.col("y1") - F.col("y2"), F.lit(669), F.lit(500)).cast("long").alias("area"))


@query("sp-04", "SELECT slide_id, least(0, CAST(floor((min(cx-300)-10)/100e0) AS BIGINT)*100) AS shift FROM rect GROUP BY slide_id")
def _(t: Tables) -> DataFrame:
    return t.rect.groupBy("slide_id").agg(F.min(F.col("cx") - 300).alias("m")).select("slide_id", F.least(F.lit(0).cast("long"), F.floor((F.col("m") - 10) / 100) * 100).alias("shift"))


@query("jn-20", "SELECT a.slide_id, a.n AS p1, b.n AS p2, least(a.cx+a.w, b.cx+b.w)-greatest(a.cx, b.cx) AS wide FROM rect a JOIN rect b ON a.slide_id=b.slide_id AND a.n<b.n AND a.cx<b.cx+b.w-1 AND b.cx<a.cx+a.w-1 AND a.cy<b.cy+b.h-1 AND b.cy<a.cy+a.h-1")
def _(t: Tables) -> DataFrame:
    o = t.overlap.where((F.col("p1") < F.col("p2")) & (F.abs(F.col("x1") - F.col("x2")) < 668) & (F.abs(F.col("y1") - F.col("y2")) < 499))
    return o.select("slide_id", "p1", "p2", (669 - F.abs(F.col("x1") - F.col("x2"))).alias("wide"))


@query("se-02", "SELECT DISTINCT slide_id, n FROM (SELECT slide_id, p1 AS n FROM measured WHERE exit=1 UNION ALL SELECT slide_id, p2 FROM measured WHERE exit=1) x")
def _(t: Tables) -> DataFrame:
    bad = t.measured.where("exit = 1")
    return bad.select("slide_id", F.explode(F.array("p1", "p2")).alias("n")).distinct()


@query("flt-02", "SELECT slide_id, n FROM rect WHERE n IN (1,5,9) OR (n BETWEEN 20 AND 29)")
def _(t: Tables) -> DataFrame:
    return t.rect.where(F.col("n").isin(1, 5, 9) | F.col("n").between(20, 29)).select("slide_id", "n")


@query("flt-08", "SELECT slide_id, p1, p2, dx, dy FROM measured WHERE exit=0")
def _(t: Tables) -> DataFrame:
    return t.measured.where("exit = 0").select("slide_id", "p1", "p2", "dx", "dy")


@query("flt-11", "SELECT slide_id, n FROM rect WHERE floor(cx/2048e0)=floor((cx+w-1)/2048e0) AND floor(cy/2048e0)=floor((cy+h-1)/2048e0)")
def _(t: Tables) -> DataFrame:
    same = lambda a, b: F.floor(F.col(a) / 2048) == F.floor((F.col(a) + F.col(b) - 1) / 2048)
    return t.rect.where(same("cx", "w") & same("cy", "h")).select("slide_id", "n")


@query("it-01", """WITH f AS (SELECT slide_id, n, CASE WHEN n%3=0 THEN 1 ELSE 0 END AS flag FROM rect), s AS (SELECT o.slide_id, o.p1 AS n, avg(f.flag) AS share FROM overlap o JOIN f ON f.slide_id=o.slide_id AND f.n=o.p2 GROUP BY 1, 2)
 SELECT f.slide_id, f.n, CASE WHEN flag=1 OR coalesce(share, 0)>0.5 THEN 1 ELSE 0 END AS flag FROM f LEFT JOIN s USING (slide_id, n)""")
def _(t: Tables) -> DataFrame:
    return graph.propagate_flags(t.rect.select("slide_id", "n", F.when(F.col("n") % 3 == 0, 1).otherwise(0).alias("flag")), t.overlap)


@query("it-01-closure")
def _(t: Tables) -> DataFrame:
    return graph.flag_closure(t.rect.select("slide_id", "n", F.when(F.col("n") % 3 == 0, 1).otherwise(0).alias("flag")), t.overlap)


@query("la-06", "SELECT slide_id, p1, p2, round(covxx+covyy-2*covxy, 6) AS var FROM measured WHERE p1<p2")
def _(t: Tables) -> DataFrame:
    return t.measured.where("p1 < p2").select("slide_id", "p1", "p2", F.round(F.col("covxx") + F.col("covyy") - 2 * F.col("covxy"), 6).alias("var"))
