"""Fits and dense kernels on the given tables; most have no SQL form and are held against numpy in the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.operators import fit, registration, stats
from histoweave.operators.relational import merged
from histoweave.plans.registry import Tables, query

C = F.col


@query("la-01")
def _(t: Tables) -> DataFrame:
    return fit.stitch_affine(t.rect, t.measured)


@query("la-03")
def _(t: Tables) -> DataFrame:
    """Ten parameters: a matrix on the place in a tile, one on the tile's number, both expected to be small, and a constant, for both directions."""
    m = t.measured.where("exit = 0").withColumns({"rx": (C("p1") * 535) % 1400 / 1400, "ry": (C("p2") * 400) % 2100 / 2100, "ix": C("p1") % 7, "iy": C("p2") % 5})
    terms = {"one": F.lit(1.0), "rx": C("rx"), "ry": C("ry"), "ix": C("ix").cast("double"), "iy": C("iy").cast("double")}
    expected = {"rx": (0.0, 2.0), "ry": (0.0, 2.0), "ix": (0.0, 0.05), "iy": (0.0, 0.05)}
    both = [fit.least_squares(m, "slide_id", d, terms, 1 / C(v), expected).withColumn("axis", F.lit(d)) for d, v in (("dx", "covxx"), ("dy", "covyy"))]
    return both[0].unionByName(both[1])


@query("la-04")
def _(t: Tables) -> DataFrame:
    m = t.measured.where("exit = 0").select("slide_id", "dx", "p1", "p2", (C("covxx") * 0.5).alias("sigma"))
    return fit.refit_without_outliers(m, "slide_id", "dx", {"one": F.lit(1.0), "p1": C("p1").cast("double"), "p2": C("p2").cast("double")}, "sigma")


@query("ag-42")
def _(t: Tables) -> DataFrame:
    return fit.quadratic_surface(t.pixels.withColumns({"x": C("pixel") % 4, "y": F.floor(C("pixel") / 4)}), "layer", "x", "y", "v")


@query("ag-34")
def _(t: Tables) -> DataFrame:
    return fit.principal_components(stats.covariance(t.pixels, "vec_id", "k", "v"))


_PAIRS = """a AS (SELECT vec_id, layer, x, y, v FROM img WHERE vec_id%2=0), b AS (SELECT vec_id-1 AS vec_id, layer, x, y, v FROM img WHERE vec_id%2=1)"""


def _pairs(t: Tables) -> DataFrame:
    """Each image of an even number as `a`, and that of the next number as `b`."""
    b = t.img.where("vec_id % 2 = 1").select((C("vec_id") - 1).alias("vec_id"), "layer", "x", "y", C("v").alias("b"))
    return t.img.where("vec_id % 2 = 0").withColumnRenamed("v", "a").join(merged(b), ["vec_id", "layer", "x", "y"])


@query("im-01")
def _(t: Tables) -> DataFrame:
    """Shifts between two images, with their covariances."""
    return registration.shifts(_pairs(t), ["vec_id", "layer"], 4, 4)


@query("im-01-peak", f"""WITH {_PAIRS}, z AS (SELECT a.vec_id, a.layer, (a.x-b.x+4)%4 AS sx, (a.y-b.y+4)%4 AS sy, sum(a.v*b.v) AS z FROM a JOIN b ON b.vec_id=a.vec_id AND b.layer=a.layer GROUP BY ALL)
 SELECT vec_id, layer, CAST(sx AS INT) AS sx, CAST(sy AS INT) AS sy, CAST(z AS BIGINT) AS z FROM z QUALIFY row_number() OVER (PARTITION BY vec_id, layer ORDER BY abs(z) DESC, sy, sx)=1""")
def _(t: Tables) -> DataFrame:
    """The whole shift at which two images correlate most."""
    keys = ["vec_id", "layer"]
    return registration.peak(registration.correlation(_pairs(t), keys, 4, 4), keys, 3).withColumn("z", F.round("z").cast("long"))


@query("im-18")
def _(t: Tables) -> DataFrame:
    """The turn and the shift between two images."""
    return registration.register(_pairs(t), ["vec_id", "layer"], 4, 4, [-20.0, -10.0, 0.0, 10.0, 20.0], 2)


_W = "CASE WHEN abs({t})<=1 THEN (1.25*abs({t})-2.25)*{t}*{t}+1 WHEN abs({t})<2 THEN ((abs({t})-5)*abs({t})+8)*abs({t})*-0.75+3 ELSE 0 END"


@query("im-02-bicubic", f"""WITH s AS (SELECT a.vec_id, a.layer, a.x, a.y, b.v, a.x-b.x-(a.vec_id%5-2)*0.2937::DOUBLE AS dx, a.y-b.y-(a.layer-1.5::DOUBLE)*0.4713::DOUBLE AS dy FROM img a JOIN img b ON b.vec_id=a.vec_id AND b.layer=a.layer)
 SELECT vec_id, layer, x, y, round(sum(v*({_W.format(t='dx')})*({_W.format(t='dy')})), 4) AS v FROM s GROUP BY vec_id, layer, x, y""")
def _(t: Tables) -> DataFrame:
    """Images moved by a part of a pixel by cubic convolution, each by its own shift."""
    moves = t.img.select("vec_id", "layer").distinct().select("vec_id", "layer", ((C("vec_id") % 5 - 2) * 0.2937).alias("dx_v"), ((C("layer") - 1.5) * 0.4713).alias("dy_v"))
    return registration.cubic_shift(t.img, ["vec_id", "layer"], 4, 4, moves).select("vec_id", "layer", "x", "y", F.round("v", 4).alias("v"))


@query("im-14", "WITH m AS (SELECT layer, avg(CASE WHEN v>0 THEN v END) AS level FROM pixels GROUP BY layer) SELECT vec_id, p.layer, pixel, CAST(floor(least(255e0, greatest(0e0, v/level*100))) AS BIGINT) AS grey FROM pixels p JOIN m ON m.layer=p.layer")
def _(t: Tables) -> DataFrame:
    """Pixels over their layer's mean level in tissue, clipped to 8 bits; the levels are one row a layer."""
    level = t.pixels.groupBy("layer").agg(F.avg(F.when(C("v") > 0, C("v"))).alias("level"))
    grey = F.floor(F.least(F.lit(255.0), F.greatest(F.lit(0.0), C("v") / C("level") * 100)))
    return t.pixels.join(F.broadcast(level), "layer").select("vec_id", "layer", "pixel", grey.alias("grey"))


@query("sp-15")
def _(t: Tables) -> DataFrame:
    """A warp with steps where the first field's column passes the stage's jumps, besides the linear terms; the first step is known."""
    m = t.measured.where("exit = 0")
    column = (C("p1") % 10).cast("double")
    terms = {"one": F.lit(1.0), "x": column} | fit.step_terms(column, [3, 5, 8])
    return fit.least_squares(m, "slide_id", "dx", terms, 1 / C("covxx"), {"step0": (0.25, 0.0), "step1": (0.0, 1.0), "step2": (0.0, 1.0)})


@query("so-13", "SELECT label, v, row_number() OVER (PARTITION BY label ORDER BY v DESC) AS place FROM (SELECT label, layer, CAST(sum(v*v) AS BIGINT) AS v FROM pixels GROUP BY label, layer) x")
def _(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    power = t.pixels.groupBy("label", "layer").agg(F.sum(C("v") * C("v")).alias("v"))
    return power.select("label", "v", F.row_number().over(Window.partitionBy("label").orderBy(F.desc("v"))).cast("long").alias("place"))
