"""Image operations on pixel tables; the images are those of the embeddings, of 4 x 4 pixels in 4 layers."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.operators import outlines, raster, stats
from histoweave.operators.relational import merged
from histoweave.plans.registry import Tables, query
from histoweave.sources import png, slides, tiff
from histoweave.sources.written import new_path

C = F.col
BY, SIDE = ["vec_id", "layer"], 4


def _r(c, n: int = 6):
    return F.round(c, n)


def _mirrored(place: str) -> str:
    """DuckDB text of a place in an image that goes on mirrored."""
    m = f"((({place})%8+8)%8)"
    return f"(CASE WHEN {m}<4 THEN {m} ELSE 7-{m} END)"


def _taps(taps: dict[int, float]) -> str:
    return "(VALUES " + ", ".join(f"({o}, {w!r}::DOUBLE)" for o, w in taps.items()) + ") k(o, w)"


def _pass(source: str, axis: str, taps: dict[int, float]) -> str:
    other = "y" if axis == "x" else "x"
    return f"SELECT a.vec_id, a.layer, a.x, a.y, sum(b.v*k.w) AS v FROM {source} a, {_taps(taps)} JOIN {source} b ON b.vec_id=a.vec_id AND b.layer=a.layer AND b.{other}=a.{other} AND b.{axis}={_mirrored(f'a.{axis}+k.o')} GROUP BY a.vec_id, a.layer, a.x, a.y"


def _smooth(source: str, name: str) -> str:
    """Common tables that end in `name`."""
    taps = raster.gaussian(1.0)
    return f"{name}_y AS ({_pass(source, 'y', taps)}), {name} AS ({_pass(name + '_y', 'x', taps)})"


@query("im-03", f"WITH {_smooth('img', 's')} SELECT vec_id, layer, x, y, round(v, 6) AS v FROM s")
def _(t: Tables) -> DataFrame:
    return raster.smooth(t.img, BY, SIDE, SIDE, 1.0).select(*BY, "x", "y", _r(C("v")).alias("v"))


_SECOND = {-1: 1.0, 0: -2.0, 1: 1.0}


@query("im-05", f"""WITH lx AS ({_pass('img', 'x', _SECOND)}), ly AS ({_pass('img', 'y', _SECOND)}), {_smooth('img', 's')},
 n AS (SELECT s.vec_id, s.layer, s.x, s.y, (lx.v+ly.v)/(abs(s.v)+1e-9) AS v FROM s JOIN lx USING (vec_id, layer, x, y) JOIN ly USING (vec_id, layer, x, y)),
 q AS (SELECT vec_id, layer, x, y, v*v AS v FROM n), {_smooth('n', 'm')}, {_smooth('q', 'k')}
 SELECT vec_id, layer, count(*) FILTER (greatest(0, k.v-m.v*m.v)<0.5) AS blurred FROM k JOIN m USING (vec_id, layer, x, y) GROUP BY vec_id, layer""")
def _(t: Tables) -> DataFrame:
    """Pixels of each image whose blur score marks them as blurred."""
    return raster.blur_score(t.img, BY, SIDE, SIDE).groupBy(*BY).agg(F.count_if(C("v") < 0.5).alias("blurred"))


_LABEL = """RECURSIVE reach AS (SELECT vec_id, layer, x, y, y*4+x AS c FROM img WHERE v>0
 UNION SELECT b.vec_id, b.layer, b.x, b.y, a.c FROM reach a JOIN img b ON a.vec_id=b.vec_id AND a.layer=b.layer AND abs(a.x-b.x)<2 AND abs(a.y-b.y)<2 AND b.v>0),
 least AS (SELECT vec_id, layer, x, y, min(c) AS c FROM reach GROUP BY ALL), lab AS (SELECT vec_id, layer, x, y, dense_rank() OVER (PARTITION BY vec_id, layer ORDER BY c) AS region FROM least)"""


@query("im-09", f"WITH {_LABEL} SELECT * FROM lab")
def _(t: Tables) -> DataFrame:
    return raster.regions(t.img.where("v > 0"), BY, SIDE, SIDE)


@query("im-12", f"WITH {_LABEL} SELECT vec_id, layer, region, min(x) AS x, min(y) AS y, max(x)-min(x)+1 AS w, max(y)-min(y)+1 AS h, count(*) AS area FROM lab GROUP BY vec_id, layer, region")
def _(t: Tables) -> DataFrame:
    """Bounding boxes and areas of the regions of each image."""
    return raster.boxes(raster.regions(t.img.where("v > 0"), BY, SIDE, SIDE), BY)


#: Border edges with the set pixel to the right, followed from each of them; a ring is known by its first edge, and lies in those with an odd number of edges above its first pixel.
_RINGS = """RECURSIVE m AS MATERIALIZED (SELECT vec_id, layer, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y FROM img WHERE v>0),
 e AS MATERIALIZED (SELECT vec_id, layer, y+b AS y0, x+a AS x0, y+d AS y1, x+c AS x1 FROM m, (VALUES (0, 0, 1, 0, 0, -1), (1, 0, 1, 1, 1, 0), (1, 1, 0, 1, 0, 1), (0, 1, 0, 0, -1, 0)) s(a, b, c, d, i, j) WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.vec_id=m.vec_id AND o.layer=m.layer AND o.x=m.x+i AND o.y=m.y+j)),
 s AS MATERIALIZED (SELECT e.vec_id, e.layer, e.y0*512+e.x0*64+e.y1*8+e.x1 AS e, n.y0*512+n.x0*64+n.y1*8+n.x1 AS nx FROM e JOIN e n ON n.vec_id=e.vec_id AND n.layer=e.layer AND n.y0=e.y1 AND n.x0=e.x1
  QUALIFY row_number() OVER (PARTITION BY e.vec_id, e.layer, e.y0, e.x0, e.y1, e.x1 ORDER BY (e.x1-e.x0)*(n.y1-n.y0)-(e.y1-e.y0)*(n.x1-n.x0))=1),
 w AS (SELECT vec_id, layer, e AS start, e AS cur, CAST(0 AS BIGINT) AS k FROM s UNION ALL SELECT w.vec_id, w.layer, start, s.nx, k+1 FROM w JOIN s ON s.vec_id=w.vec_id AND s.layer=w.layer AND s.e=w.cur WHERE s.nx<>start),
 r AS MATERIALIZED (SELECT *, min(cur) OVER (PARTITION BY vec_id, layer, start) AS ring FROM w),
 p AS MATERIALIZED (SELECT vec_id, layer, ring, k, cur, CAST(floor(cur/512e0) AS BIGINT)%8 AS y0, CAST(floor(cur/64e0) AS BIGINT)%8 AS x0, CAST(floor(cur/8e0) AS BIGINT)%8 AS y1, cur%8 AS x1 FROM r WHERE start=ring),
 g AS MATERIALIZED (SELECT vec_id, layer, ring, sum(x0*y1-x1*y0)/2 AS signed, count(*) AS perimeter, CAST(floor(ring/64e0) AS BIGINT)%8 AS x, CAST(floor(ring/512e0) AS BIGINT)%8 AS y FROM p GROUP BY vec_id, layer, ring),
 h AS MATERIALIZED (SELECT g.vec_id, g.layer, g.ring, o.ring AS around FROM g JOIN p o ON o.vec_id=g.vec_id AND o.layer=g.layer AND o.ring<>g.ring AND o.y0=o.y1 AND least(o.x0, o.x1)=g.x AND o.y0<g.y GROUP BY g.vec_id, g.layer, g.ring, o.ring HAVING count(*)%2=1),
 d AS MATERIALIZED (SELECT vec_id, layer, g.ring, count(around) AS depth FROM g LEFT JOIN h USING (vec_id, layer, ring) GROUP BY vec_id, layer, g.ring),
 u AS MATERIALIZED (SELECT h.vec_id, h.layer, h.ring, max_by(h.around, d.depth) AS parent FROM h JOIN d ON d.vec_id=h.vec_id AND d.layer=h.layer AND d.ring=h.around GROUP BY h.vec_id, h.layer, h.ring),
 z AS MATERIALIZED (SELECT vec_id, layer, ring, row_number() OVER (PARTITION BY vec_id, layer ORDER BY signed<0, y, x) AS region, signed<0 AS hole, perimeter, abs(signed) AS area FROM g),
 q AS MATERIALIZED (SELECT z.vec_id, z.layer, z.ring, z.region, z.hole, d.depth, coalesce(o.region, 0) AS parent, z.area, z.perimeter FROM z JOIN d ON d.vec_id=z.vec_id AND d.layer=z.layer AND d.ring=z.ring LEFT JOIN u ON u.vec_id=z.vec_id AND u.layer=z.layer AND u.ring=z.ring LEFT JOIN z o ON o.vec_id=u.vec_id AND o.layer=u.layer AND o.ring=u.parent)"""


def _contours(t: Tables) -> tuple[DataFrame, DataFrame]:
    return outlines.contours(t.img.where("v > 0"), BY)


@query("sp-10", f"""WITH {_RINGS}, c AS (SELECT vec_id, layer, ring, CASE WHEN hole THEN (perimeter-k)%perimeter ELSE k END AS spot, x0 AS x, y0 AS y, region, depth, parent
  FROM (SELECT p.*, q.hole, q.perimeter, q.region, q.depth, q.parent, x1-x0 AS dx, y1-y0 AS dy, lag(x1-x0) OVER o AS bx, lag(y1-y0) OVER o AS b_y, last_value(x1-x0) OVER a AS lx, last_value(y1-y0) OVER a AS ly FROM p JOIN q USING (vec_id, layer, ring)
  WINDOW o AS (PARTITION BY vec_id, layer, ring ORDER BY k), a AS (PARTITION BY vec_id, layer, ring ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) i WHERE dx<>coalesce(bx, lx) OR dy<>coalesce(b_y, ly))
 SELECT vec_id, layer, region, depth, parent, row_number() OVER (PARTITION BY vec_id, layer, region ORDER BY spot)-1 AS vid, x, y FROM c""")
def _(t: Tables) -> DataFrame:
    """Outlines of all regions and holes of each image, as corners in order, with depth and parent."""
    found, corners = _contours(t)
    number = [C(c).cast("long").alias(c) for c in ("region", "depth", "parent", "vid", "x", "y")]
    return corners.join(merged(found), [*BY, "ring"]).withColumnRenamed("ring", "region").select(*BY, *number)


@query("im-12-polygons", f"""WITH {_LABEL}, a AS (SELECT vec_id, layer, region, CAST(count(*) AS BIGINT) AS area, CAST(sum((SELECT 4-count(*) FROM lab o WHERE o.vec_id=lab.vec_id AND o.layer=lab.layer AND abs(o.x-lab.x)+abs(o.y-lab.y)=1)) AS BIGINT) AS perimeter FROM lab GROUP BY vec_id, layer, region) SELECT * FROM a""")
def _(t: Tables) -> DataFrame:
    """Each region's polygon: its area without its holes' and the length of all its rings."""
    found, _ = _contours(t)
    region = F.when(C("hole"), C("parent")).otherwise(C("ring")).alias("region")
    return found.groupBy(*BY, region).agg(F.sum(F.when(C("hole"), -C("area")).otherwise(C("area"))).alias("area"), F.sum("perimeter").alias("perimeter"))


@query("im-07", f"WITH {_LABEL} SELECT vec_id, layer, region, min(y*4+x) AS first_pixel, count(*) AS n FROM lab GROUP BY vec_id, layer, region")
def _(t: Tables) -> DataFrame:
    """A mask as its connected regions, each with its first pixel and size."""
    return raster.regions(t.img.where("v > 0"), BY, SIDE, SIDE).groupBy(*BY, "region").agg(F.min(C("y") * SIDE + C("x")).alias("first_pixel"), F.count("*").alias("n"))


@query("im-08", f"WITH {_LABEL}, big AS (SELECT vec_id, layer, region FROM lab GROUP BY vec_id, layer, region HAVING count(*)>=3) SELECT vec_id, layer, x, y FROM lab JOIN big USING (vec_id, layer, region)")
def _(t: Tables) -> DataFrame:
    """Pixels of the regions of at least three."""
    found = raster.regions(t.img.where("v > 0"), BY, SIDE, SIDE)
    big = found.groupBy(*BY, "region").count().where("count >= 3").drop("count")
    return found.join(big, [*BY, "region"], "left_semi").select(*BY, "x", "y")


def _trimmed(rounds: int) -> str:
    steps = [f"t{i+1} AS MATERIALIZED (SELECT a.vec_id, a.layer, a.x, a.y FROM t{i} a JOIN t{i} b ON a.vec_id=b.vec_id AND a.layer=b.layer AND abs(a.x-b.x)<2 AND abs(a.y-b.y)<2 GROUP BY ALL HAVING count(*)>=3)" for i in range(rounds)]
    return "t0 AS (SELECT vec_id, layer, x, y FROM img WHERE v>0), " + ", ".join(steps)


@query("im-11", f"WITH {_trimmed(14)} SELECT * FROM t14")
def _(t: Tables) -> DataFrame:
    """Sixteen pixels are trimmed in fourteen rounds at most, as two neighbours need three pixels."""
    return raster.trim_tails(t.img.where("v > 0"), BY)


def _near(source: str, f: str) -> str:
    return f"SELECT a.vec_id, a.layer, a.x, a.y, {f}(b.v) AS v FROM {source} a JOIN {source} b ON a.vec_id=b.vec_id AND a.layer=b.layer AND abs(a.x-b.x)<2 AND abs(a.y-b.y)<2 GROUP BY ALL"


@query("im-20", f"WITH m0 AS (SELECT vec_id, layer, x, y, CAST(v>0 AS INT) AS v FROM img), m1 AS ({_near('m0', 'min')}), m2 AS ({_near('m1', 'max')}), m3 AS ({_near('m2', 'max')}), m4 AS ({_near('m3', 'min')}) SELECT vec_id, layer, x, y FROM m4 WHERE v=1")
def _(t: Tables) -> DataFrame:
    mask = t.img.withColumn("v", (C("v") > 0).cast("int"))
    return raster.open_close(mask, BY, SIDE, SIDE).where("v = 1").select(*BY, "x", "y")


_TURN = "(VALUES (0, 0e0), (1, 0.25e0), (2, -0.5e0), (3, -0.25e0)) f(k, f)"


def _kernel(d: float) -> str:
    return f"SELECT i, sum(cos(2*pi()*f.f*(i-({d})))/4) AS re, sum(sin(2*pi()*f.f*(i-({d})))/4) AS im FROM (SELECT unnest(generate_series(0, 3)) AS i) n, {_TURN} GROUP BY i"


@query("im-02", f"""WITH kx AS ({_kernel(0.5)}), ky AS ({_kernel(-0.25)}), h AS (SELECT vec_id, layer, (x+i)%4 AS x, y, sum(v*re) AS re, sum(v*im) AS im FROM img, kx GROUP BY vec_id, layer, (x+i)%4, y)
 SELECT vec_id, layer, x, (y+i)%4 AS y, round(sum(h.re*ky.re-h.im*ky.im), 6) AS v FROM h, ky GROUP BY vec_id, layer, x, (y+i)%4""")
def _(t: Tables) -> DataFrame:
    """Images moved by half a pixel and a quarter back."""
    return raster.fourier_shift(t.img, BY, SIDE, SIDE, 0.5, -0.25).select(*BY, C("x").cast("long").alias("x"), C("y").cast("long").alias("y"), _r(C("v")).alias("v"))


@query("im-17", """WITH g AS (SELECT vec_id, layer, x AS tx, y AS ty, least(greatest(1.5+(x-1.5)*(1+0.05*((x-1.5)*(x-1.5)+(y-1.5)*(y-1.5))/4), 0), 3) AS mx, least(greatest(1.5+(y-1.5)*(1+0.05*((x-1.5)*(x-1.5)+(y-1.5)*(y-1.5))/4), 0), 3) AS my FROM img),
 c AS (SELECT *, least(floor(mx), 2) AS sx, least(floor(my), 2) AS sy FROM g), a AS (SELECT vec_id, layer, tx, ty, sx+i AS x, sy+j AS y, (CASE WHEN i=1 THEN mx-sx ELSE 1-(mx-sx) END)*(CASE WHEN j=1 THEN my-sy ELSE 1-(my-sy) END) AS w FROM c, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) o(i, j))
 SELECT a.vec_id, a.layer, tx AS x, ty AS y, round(sum(b.v*w), 3) AS v FROM a JOIN img b ON a.vec_id=b.vec_id AND a.layer=b.layer AND a.x=b.x AND a.y=b.y GROUP BY a.vec_id, a.layer, tx, ty""")
def _(t: Tables) -> DataFrame:
    """Images corrected for a radial warp, bilinear."""
    found = raster.remap(t.img, BY, SIDE, SIDE, *raster.radial_places(SIDE, SIDE, 0.05))
    return found.select(*BY, "x", "y", _r(C("v"), 3).alias("v"))


def _skew_rounds(rounds: int) -> str:
    """Common tables of one Otsu threshold after the other; r<i> has place and skew of round i."""
    out = ["u0 AS (SELECT vec_id, layer, v, count(*)::DOUBLE AS n FROM img GROUP BY ALL)"]
    for i in range(rounds):
        w = "(PARTITION BY vec_id, layer ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        out.append(f"c{i} AS (SELECT vec_id, layer, v, sum(n) OVER f AS s0, sum(n*v) OVER f AS s1, sum(n*v*v) OVER f AS s2, sum(n*v*v*v) OVER f AS s3, coalesce(sum(n) OVER b, 0) AS b0, coalesce(sum(n*v) OVER b, 0) AS b1, coalesce(sum(n*v*v) OVER b, 0) AS b2 FROM u{i} WINDOW f AS (PARTITION BY vec_id, layer), b AS {w})")
        cost = "(b2-b1*b1/b0)+((s2-b2)-(s1-b1)*(s1-b1)/(s0-b0))"
        skew = "(s3/s0-3*(s1/s0)*s2/s0+2*(s1/s0)*(s1/s0)*(s1/s0))/((s2/s0-(s1/s0)*(s1/s0))*sqrt(s2/s0-(s1/s0)*(s1/s0)))"
        out.append(f"r{i} AS (SELECT vec_id, layer, v AS place, {skew} AS skew FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, layer ORDER BY {cost}, v) AS r FROM c{i} WHERE b0>0 AND s0>=3 AND s0*s2>s1*s1) z WHERE r=1)")
        out.append(f"u{i + 1} AS (SELECT u.* FROM u{i} u JOIN r{i} r USING (vec_id, layer) WHERE u.v<r.place)")
    return ", ".join(out)


_DROPS = " UNION ALL ".join(["SELECT vec_id, layer, place, 1 AS i, NULL::DOUBLE AS fall FROM r0", *(f"SELECT b.vec_id, b.layer, b.place, {i + 1}, a.skew-b.skew FROM r{i - 1} a JOIN r{i} b USING (vec_id, layer)" for i in range(1, 5))])


@query("ag-11", f"WITH {_skew_rounds(5)}, d AS ({_DROPS}), p AS (SELECT vec_id, layer, place FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, layer ORDER BY fall DESC NULLS LAST, i) AS r FROM d) z WHERE r=1) SELECT k.vec_id, k.layer, coalesce(p.place, 0)::DOUBLE AS threshold FROM (SELECT DISTINCT vec_id, layer FROM img) k LEFT JOIN p USING (vec_id, layer)")
def _(t: Tables) -> DataFrame:
    return raster.otsu_by_skew(t.img, BY)


@query("wn-05", """WITH r AS (SELECT vec_id, layer, pixel, v, count(v) OVER w AS n, sum(v::DOUBLE) OVER w AS s, sum(v::DOUBLE*v) OVER w AS q FROM pixels WINDOW w AS (PARTITION BY vec_id, layer ORDER BY pixel ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 j AS (SELECT vec_id, layer, pixel, s/n AS mean, row_number() OVER (PARTITION BY vec_id, layer ORDER BY pixel) AS k FROM r WHERE n>=3 AND abs(v-s/n)>3*greatest(sqrt(greatest(n*q-s*s, 0))/n, 1e-6))
 SELECT a.vec_id, a.layer, round(coalesce(max(j.mean), avg(a.v)), 6) AS intercept FROM pixels a LEFT JOIN j ON a.vec_id=j.vec_id AND a.layer=j.layer AND j.k=1 GROUP BY a.vec_id, a.layer""")
def _(t: Tables) -> DataFrame:
    return raster.robust_intercept(t.pixels, BY, "pixel", 3.0).select(*BY, _r(C("intercept")).alias("intercept"))


@query("sp-16", """WITH p AS (SELECT vec_id, layer, (1000+v)*cos(2*pi()*pixel/16) AS x, (1000+v)*sin(2*pi()*pixel/16) AS y FROM pixels), m AS (SELECT vec_id, layer, avg(x) AS mx, avg(y) AS my FROM p GROUP BY ALL),
 c AS (SELECT vec_id, layer, mx, my, x-mx AS u, y-my AS v FROM p JOIN m USING (vec_id, layer)),
 s AS (SELECT vec_id, layer, mx, my, sum(u*u) AS uu, sum(u*v) AS uv, sum(v*v) AS vv, sum(u*(u*u+v*v)) AS uz, sum(v*(u*u+v*v)) AS vz, avg(u*u+v*v) AS z FROM c GROUP BY ALL),
 f AS (SELECT *, (uz*vv-vz*uv)/(2*(uu*vv-uv*uv)) AS cu, (vz*uu-uz*uv)/(2*(uu*vv-uv*uv)) AS cv FROM s) SELECT vec_id, layer, round(mx+cu, 5) AS cx, round(my+cv, 5) AS cy, round(sqrt(z+cu*cu+cv*cv), 5) AS radius FROM f""")
def _(t: Tables) -> DataFrame:
    """Sixteen spots around a ring, as far out as their pixels are bright."""
    angle = 2 * math.pi * C("pixel") / 16
    spots = t.pixels.select(*BY, ((1000 + C("v")) * F.cos(angle)).alias("x"), ((1000 + C("v")) * F.sin(angle)).alias("y"))
    return raster.fit_circle(spots, BY).select(*BY, *(_r(C(c), 5).alias(c) for c in ("cx", "cy", "radius")))


@query("sp-11")
def _(t: Tables) -> DataFrame:
    """Each image row by row as a line of its values, simplified."""
    line = t.pixels.select(*BY, "pixel", C("pixel").cast("double").alias("x"), C("v").cast("double").alias("y"))
    return raster.simplify(line, BY, "pixel", 100.0)


_TISSUE = f"v0 AS (SELECT vec_id, 0 AS layer, x, y, CAST(count(*) FILTER (v>0)>=2 AS INT) AS v FROM img GROUP BY vec_id, x, y), v1 AS ({_near('v0', 'min')}), v2 AS ({_near('v1', 'max')}), v3 AS ({_near('v2', 'max')}), v4 AS ({_near('v3', 'min')})"


@query("im-04", f"WITH RECURSIVE {_TISSUE}, on4 AS (SELECT * FROM v4 WHERE v=1), reach AS (SELECT vec_id, x, y, y*4+x AS c FROM on4 UNION SELECT b.vec_id, b.x, b.y, a.c FROM reach a JOIN on4 b ON a.vec_id=b.vec_id AND abs(a.x-b.x)<2 AND abs(a.y-b.y)<2), least AS (SELECT vec_id, x, y, min(c) AS c FROM reach GROUP BY ALL), big AS (SELECT vec_id, c FROM least GROUP BY ALL HAVING count(*)>=6) SELECT vec_id, x, y FROM least JOIN big USING (vec_id, c)")
def _(t: Tables) -> DataFrame:
    """Pixels that are bright in two layers at least, opened and closed, in regions of at least six."""
    votes = t.img.groupBy("vec_id", "x", "y").agg((F.count_if(C("v") > 0) >= 2).cast("int").alias("v"))
    mask = raster.open_close(votes, ["vec_id"], SIDE, SIDE).where("v = 1")
    found = raster.regions(mask, ["vec_id"], SIDE, SIDE)
    big = found.groupBy("vec_id", "region").count().where("count >= 6").drop("count")
    return found.join(big, ["vec_id", "region"], "left_semi").select("vec_id", "x", "y")


def _sized(source: str, name: str, value: int, least: int) -> str:
    """Common tables that end in `name`: the mask `source` (vec_id, x, y, v) without its regions of `value` of fewer than `least` pixels."""
    near = "a.vec_id=b.vec_id AND abs(a.x-b.x)<2 AND abs(a.y-b.y)<2"
    return f"""{name}_r AS (SELECT vec_id, x, y, y*4+x AS c FROM {source} WHERE v={value} UNION SELECT b.vec_id, b.x, b.y, a.c FROM {name}_r a JOIN {source} b ON {near} WHERE b.v={value}),
 {name}_l AS (SELECT vec_id, x, y, min(c) AS c FROM {name}_r GROUP BY ALL), {name}_s AS (SELECT vec_id, x, y FROM {name}_l JOIN (SELECT vec_id, c FROM {name}_l GROUP BY ALL HAVING count(*)<{least}) k USING (vec_id, c)),
 {name} AS (SELECT m.vec_id, m.x, m.y, CASE WHEN s.x IS NULL THEN m.v ELSE 1-m.v END AS v FROM {source} m LEFT JOIN {name}_s s ON s.vec_id=m.vec_id AND s.x=m.x AND s.y=m.y)"""


_GROUPS = """g AS (SELECT vec_id, x, y, count(*) FILTER (v>0 AND layer<2) AS a, count(*) FILTER (v>0 AND layer>=2) AS b FROM img GROUP BY vec_id, x, y),
 t AS (SELECT vec_id, x, y, CASE WHEN a<1 AND b<1 THEN 0 WHEN a>0 AND b>0 THEN 1 ELSE CAST(a+b>2.4 AS INT) END AS v FROM g)"""


@query("im-04-groups", f"WITH RECURSIVE {_GROUPS}, {_sized('t', 'one', 1, 3)}, {_sized('one', 'two', 0, 3)} SELECT vec_id, x, y, CAST(v AS INT) AS v FROM two")
def _(t: Tables) -> DataFrame:
    """The tissue mask of two groups of two layers, without islands or gaps of fewer than three pixels."""
    masks = t.img.withColumn("v", (C("v") > 0).cast("int"))
    votes = raster.group_votes(masks, ["vec_id"], {"nuclear": (0, 1), "other": (2, 3)}, "nuclear")
    return raster.size_filter(votes, ["vec_id"], SIDE, SIDE, 3).select("vec_id", "x", "y", "v")


@query("im-20-open", f"WITH RECURSIVE m0 AS (SELECT vec_id, 0 AS layer, x, y, CAST(count(*) FILTER (v>0)>=2 AS INT) AS v FROM img GROUP BY vec_id, x, y), m1 AS ({_near('m0', 'min')}), m2 AS ({_near('m1', 'max')}), m3 AS ({_near('m2', 'max')}), m4 AS ({_near('m3', 'min')}), {_sized('m4', 'o', 1, 5)} SELECT vec_id, x, y FROM o WHERE v=1")
def _(t: Tables) -> DataFrame:
    """A mask opened and closed, and then its regions of at least five pixels."""
    mask = t.img.groupBy("vec_id", "x", "y").agg((F.count_if(C("v") > 0) >= 2).cast("int").alias("v"))
    done = raster.open_close(mask, ["vec_id"], SIDE, SIDE)
    return raster.size_filter(done, ["vec_id"], SIDE, SIDE, 5, values=(1,)).where("v = 1").select("vec_id", "x", "y")


def _weights(axis: str) -> str:
    """DuckDB text of the whole weight w with which a pixel at f comes into the one at t along an axis."""
    return f"SELECT t, f, sum(w) AS w FROM (SELECT t, {_mirrored('t+k.o')} AS f, k.w FROM (SELECT unnest(generate_series(0, 3)) AS t) a, {_taps(raster.gaussian(1.0))}) z GROUP BY t, f"


@query("im-03-errors", f"""WITH {_smooth('img', 's')}, w AS ({_weights('x')}), e AS (SELECT vec_id, layer, x, y, (abs(v)%7+1)::DOUBLE AS error FROM img),
 q AS (SELECT e.vec_id, e.layer, wx.t AS x, wy.t AS y, sqrt(sum(error*error*wx.w*wx.w*wy.w*wy.w)) AS error FROM e JOIN w wx ON wx.f=e.x JOIN w wy ON wy.f=e.y GROUP BY ALL)
 SELECT vec_id, layer, x, y, round(s.v, 6) AS v, round(q.error, 6) AS error FROM s JOIN q USING (vec_id, layer, x, y)""")
def _(t: Tables) -> DataFrame:
    """Smoothed images with the errors that their pixels' errors give."""
    noisy = t.img.withColumn("error", (F.abs("v") % 7 + 1).cast("double"))
    return raster.smooth_errors(noisy, BY, SIDE, SIDE, 1.0).select(*BY, "x", "y", _r(C("v")).alias("v"), _r(C("error")).alias("error"))


@query("snk-06-png", f"SELECT vec_id::VARCHAR||'-'||layer||'.png' AS path, CAST(4 AS INT) AS width, CAST(4 AS INT) AS height, string_agg(CAST(least(65535, greatest(0, v)) AS VARCHAR), ' ' ORDER BY y, x) AS samples FROM img GROUP BY vec_id, layer")
def _(t: Tables) -> DataFrame:
    """Images written as PNG files of 16 bits and read back."""
    samples = F.transform(F.sort_array(F.collect_list(F.struct("y", "x", "v"))), lambda p: p["v"])
    name = F.concat_ws("", C("vec_id").cast("string"), F.lit("-"), C("layer").cast("string"), F.lit(".png"))
    files = t.img.groupBy(*BY).agg(samples.alias("s")).select(name.alias("path"), png.write(F.lit(SIDE), C("s"), 16).alias("content"))
    out = new_path(t.spark, "png")
    files.write.parquet(out)
    return png.read(t.spark.read.parquet(out)).select("path", "width", "height", F.array_join(C("samples").cast("array<string>"), " ").alias("samples"))


@query("im-14-assembled", "WITH p AS (SELECT layer, (vec_id%20)*3+x AS x, CAST(floor(vec_id/20e0) AS BIGINT)*3+y AS y, vec_id, v FROM img), l AS (SELECT layer, x, y, v, row_number() OVER (PARTITION BY layer, x, y ORDER BY vec_id DESC) AS r FROM p) SELECT layer, x, y, CAST(least(255, greatest(0, v)) AS BIGINT) AS grey FROM l WHERE r=1")
def _(t: Tables) -> DataFrame:
    """All images as fields of one slide, 20 in a row and overlapping by a pixel; the last field's pixel is seen, clipped to 8 bits."""
    placed = t.img.select("layer", (C("vec_id") % 20 * 3 + C("x")).alias("x"), (F.floor(C("vec_id") / 20) * 3 + C("y")).alias("y"), "vec_id", "v")
    seen = placed.groupBy("layer", "x", "y").agg(F.max_by("v", "vec_id").alias("v"))
    return seen.select("layer", "x", "y", F.least(F.lit(255), F.greatest(F.lit(0), C("v"))).cast("long").alias("grey"))


_FLAT = "CAST(greatest(0e0, least(65535e0, round_even((CASE WHEN v>10 THEN greatest(0e0, least(65535e0, round_even(10+30e0/(20+layer)*(v-10), 0))) ELSE CAST(v AS DOUBLE) END)/(0.9+0.05*layer), 0))) AS DOUBLE)"


@query("im-23-warped", f"""WITH i AS (SELECT vec_id, layer, x, y, {_FLAT} AS v FROM img), g AS (SELECT vec_id, layer, x AS tx, y AS ty, least(greatest(1.5+(x-1.5)*(1+0.05*((x-1.5)*(x-1.5)+(y-1.5)*(y-1.5))/4), 0), 3) AS mx, least(greatest(1.5+(y-1.5)*(1+0.05*((x-1.5)*(x-1.5)+(y-1.5)*(y-1.5))/4), 0), 3) AS my FROM img),
 c AS (SELECT *, least(floor(mx), 2) AS sx, least(floor(my), 2) AS sy FROM g), a AS (SELECT vec_id, layer, tx, ty, sx+i AS x, sy+j AS y, (CASE WHEN i=1 THEN mx-sx ELSE 1-(mx-sx) END)*(CASE WHEN j=1 THEN my-sy ELSE 1-(my-sy) END) AS w FROM c, (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) o(i, j))
 SELECT a.vec_id, a.layer, tx AS x, ty AS y, round(sum(b.v*w), 3) AS v FROM a JOIN i b ON a.vec_id=b.vec_id AND a.layer=b.layer AND a.x=b.x AND a.y=b.y GROUP BY a.vec_id, a.layer, tx, ty""")
def _(t: Tables) -> DataFrame:
    """Exposure, flat field and warp corrected one after the other."""
    e = stats.correct_exposure(C("v"), C("layer") + 20, F.lit(30.0), F.lit(10))
    flat = F.greatest(F.lit(0.0), F.least(F.lit(65535.0), F.rint(e / (F.lit(0.9) + F.lit(0.05) * C("layer")))))
    found = raster.remap(t.img.withColumn("v", flat), BY, SIDE, SIDE, *raster.radial_places(SIDE, SIDE, 0.05))
    return found.select(*BY, "x", "y", _r(C("v"), 3).alias("v"))


_GREY = "CAST(least(255, greatest(0, v)) AS INT)"


def _stored(t: Tables, levels: int) -> DataFrame:
    """Each image as the content of a TIFF: its layers as pages, and these again at half the size for each further level; in a table like those of a scan of files."""
    grey = t.img.withColumn("v", F.least(F.lit(255), F.greatest(F.lit(0), C("v"))))
    zoomed = stats.pyramid(grey, BY, levels).withColumn("v", F.floor("v"))
    samples = F.transform(F.sort_array(F.collect_list(F.struct("y", "x", "v"))), lambda p: p["v"])
    pages = zoomed.groupBy(*BY, "level").agg(samples.alias("samples"), (F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"))
    every = F.transform(F.sort_array(F.collect_list(F.struct("level", "layer", F.struct("width", "height", "samples").alias("p")))), lambda p: p["p"])
    files = pages.groupBy("vec_id").agg(tiff.write_pages(every).alias("content")).select(F.concat(F.col("vec_id").cast("string"), F.lit(".tif")).alias("path"), "content")
    out = new_path(t.spark, "tiff")
    files.write.parquet(out)
    return t.spark.read.parquet(out)


@query("src-11", f"SELECT vec_id::VARCHAR||'.tif' AS path, CAST(layer AS INT) AS page, CAST(sum({_GREY}) AS BIGINT) AS total, true AS ok FROM img WHERE layer IN (1, 3) GROUP BY vec_id, layer")
def _(t: Tables) -> DataFrame:
    """Two layers of component images of two groups of two layers, which the number of pages is held against."""
    pages = tiff.read_pages(_stored(t, 1), {1, 3})
    found = pages.where("samples is not null").select("path", "page", F.explode("samples").alias("v")).groupBy("path", "page").agg(F.sum("v").alias("total"))
    return found.join(tiff.layer_groups(pages, [2, 2]).select("path", "ok"), "path")


@query("src-12", "SELECT DISTINCT vec_id::VARCHAR||'.tif' AS path, CAST(zoom AS INT) AS zoom, CAST(4/zoom AS INT) AS width, CAST(4/zoom AS INT) AS height, CAST(4 AS BIGINT) AS pages FROM img, (VALUES (1), (2), (4)) z(zoom)")
def _(t: Tables) -> DataFrame:
    """Zoom levels of pyramids of three sizes."""
    return tiff.zoom_levels(tiff.read_pages(_stored(t, 3), set()))


def _deflated(t: Tables) -> DataFrame:
    """As `_stored` with two levels, deflated with differences: full size in tiles of two by two, half size in strips of a row."""
    grey = t.img.withColumn("v", F.least(F.lit(255), F.greatest(F.lit(0), C("v"))))
    zoomed = stats.pyramid(grey, BY, 2).withColumn("v", F.floor("v").cast("int"))
    samples = F.transform(F.sort_array(F.collect_list(F.struct("y", "x", "v"))), lambda p: p["v"])
    each = zoomed.groupBy(*BY, "level").agg(samples.alias("samples"), (F.max("x") + 1).alias("width"))
    every = F.sort_array(F.collect_list(F.struct("level", "layer", "width", "samples")))

    @F.pandas_udf("binary")
    def written(width: pd.Series, samples: pd.Series) -> pd.Series:
        how = lambda a: {"compression": 8, "predictor": 2} | ({"tile": 2} if a.shape[1] == SIDE else {"rows": 1})
        sheets = [[np.array(v, np.uint8).reshape(-1, w) for w, v in zip(ws, vs)] for ws, vs in zip(width, samples)]
        return pd.Series([slides.encoded([(a, how(a)) for a in file]) for file in sheets])

    files = each.groupBy("vec_id").agg(every.alias("p")).select(F.concat(C("vec_id").cast("string"), F.lit(".tif")).alias("path"), written("p.width", "p.samples").alias("content"))
    out = new_path(t.spark, "tiff")
    files.write.parquet(out)
    return t.spark.read.parquet(out)


@query("src-11-compressed", f"SELECT vec_id::VARCHAR||'.tif' AS path, CAST(layer AS INT) AS page, CAST(sum({_GREY}) AS BIGINT) AS total, layer<>3 AS ok FROM img WHERE layer IN (1, 3) GROUP BY vec_id, layer")
def _(t: Tables) -> DataFrame:
    """Two layers of deflated, tiled component images; the last one is asked for together with one of another group."""
    files = _deflated(t)
    total = slides.pixels(files, {1, 3}).groupBy("path", "page").agg(F.sum("v").cast("long").alias("total"))
    found = slides.pages(files)
    ok = [slides.layer_groups(found, [4, 4], layers).select("path", F.lit(page).alias("page"), "ok") for page, layers in ((1, [2]), (3, [4, 5]))]
    return total.join(ok[0].unionByName(ok[1]), ["path", "page"])


@query("src-12-compressed", "SELECT DISTINCT vec_id::VARCHAR||'.tif' AS path, CAST(zoom AS INT) AS zoom, CAST(4/zoom AS BIGINT) AS width, CAST(4/zoom AS BIGINT) AS height, CAST(4 AS BIGINT) AS pages FROM img, (VALUES (1), (2)) z(zoom)")
def _(t: Tables) -> DataFrame:
    """Zoom levels of deflated pyramids of two sizes."""
    return tiff.zoom_levels(slides.pages(_deflated(t)))


@query("snk-06", f"WITH l AS (SELECT unnest(generate_series(0, 1)) AS level), p AS (SELECT vec_id, layer, level, CAST(floor(x/pow(2, level)) AS INT) AS x, CAST(floor(y/pow(2, level)) AS INT) AS y, CAST(floor(avg({_GREY})) AS INT) AS v FROM img, l GROUP BY ALL) SELECT vec_id::VARCHAR||'.tif' AS path, CAST(level*4+layer AS INT) AS page, string_agg(v::VARCHAR, ' ' ORDER BY y, x) AS samples FROM p GROUP BY vec_id, layer, level")
def _(t: Tables) -> DataFrame:
    """Images written as TIFF pages of two sizes and read back sample by sample."""
    return tiff.read_pages(_stored(t, 2)).select("path", "page", F.array_join(C("samples").cast("array<string>"), " ").alias("samples"))


@query("snk-10", "SELECT route, slide_id, count(*) AS lines FROM (SELECT 'main' AS route, slide_id FROM runlog UNION ALL SELECT 'sample', slide_id FROM runlog WHERE message<>'INFO' UNION ALL SELECT 'image', slide_id FROM runlog WHERE message='ERROR') x GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    """Log lines written to the main log, those that matter to the sample's and errors to the image's, and read back."""
    routes = F.array_compact(F.array(F.lit("main"), F.when(C("message") != "INFO", F.lit("sample")), F.when(C("message") == "ERROR", F.lit("image"))))
    path = new_path(t.spark, "log")
    t.runlog.select(F.explode(routes).alias("route"), F.concat_ws(";", "module", "slide_id", "message", C("ts").cast("string")).alias("line")).write.partitionBy("route").text(path)
    back = t.spark.read.schema("value string, route string").text(path)
    return back.groupBy("route", F.split("value", ";")[1].cast("long").alias("slide_id")).agg(F.count("*").alias("lines"))
