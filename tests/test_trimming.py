"""Trimming counts each pixel once and joins nothing; convolutions of several values, in images smaller and larger than the kernel."""

from pyspark.sql import functions as F

from histoweave.operators import raster


def test_repeated_pixels_count_once(spark):
    rows = [(1, 0, 0), (1, 0, 0), (1, 1, 0), (1, 1, 0), (2, 0, 0), (2, 1, 0), (2, 0, 1), (2, None, 3), (2, 3, 3)]
    df = spark.createDataFrame(rows, "k int, x int, y int")
    assert sorted(map(tuple, raster.trim_tails(df, ["k"]).collect())) == [(2, 0, 0), (2, 0, 1), (2, 1, 0)]


def test_convolution_mirrors_at_both_borders(spark):
    taps = {-2: 0.1, -1: 0.2, 0: 0.4, 1: 0.25, 2: 0.05}
    for size in (1, 2, 3, 4, 5, 6, 9):
        line = [float((i * 7) % 5 + 1) for i in range(size)]
        mirrored = lambda i: line[m if (m := i % (2 * size)) < size else 2 * size - 1 - m]  # noqa: B023, E731
        df = spark.createDataFrame([(1, i, 0, v) for i, v in enumerate(line)], "k int, x int, y int, v double").withColumn("w", 2 * F.col("v"))
        found = {r["x"]: (r["v"], r["w"]) for r in raster.convolve(df, ["k"], "x", size, taps, "v", "w").collect()}
        assert sorted(found) == list(range(size))
        for i in range(size):
            want = sum(w * mirrored(i + o) for o, w in taps.items())
            assert abs(found[i][0] - want) < 1e-12 and abs(found[i][1] - 2 * want) < 1e-12
