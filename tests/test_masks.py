"""Votes of layer groups, size filters, errors of smoothing, and PNG files."""

import struct
import zlib

import numpy as np
import pandas as pd
import pytest

import plain_kernels as kernels
from histoweave.operators import raster
from histoweave.sources import png

W, H = 9, 7


def frame(spark, **columns):
    first = next(iter(columns.values()))
    rows = [(1, x, y, *(c[y, x].item() for c in columns.values())) for y in range(first.shape[0]) for x in range(first.shape[1])]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["i", "x", "y", *columns]))


def array(df, column="v"):
    out = np.zeros((H, W))
    for r in df.collect():
        out[r["y"], r["x"]] = r[column]
    return out


def test_size_filter_takes_islands_and_then_gaps(spark):
    for seed in range(3):
        mask = (np.random.default_rng(seed).random((H, W)) < 0.5).astype(int)
        want = mask.copy()
        for value in (1, 0):
            lab = kernels.label(want == value)
            for k in range(1, lab.max() + 1):
                if (lab == k).sum() < 4:
                    want[lab == k] = 1 - value
        assert (array(raster.size_filter(frame(spark, v=mask), ["i"], W, H, 4)) == want).all()


def test_votes_need_the_nuclear_group_and_another_one(spark):
    masks = np.random.default_rng(1).random((7, H, W)) < 0.5
    rows = pd.concat([frame(spark, v=m.astype(int)).toPandas().assign(layer=k) for k, m in enumerate(masks)])
    groups = {"nuclear": (0, 1), "b": (2, 4), "c": (5, 6)}
    got = array(raster.group_votes(spark.createDataFrame(rows), ["i"], groups, "nuclear"))
    stacked = {k: masks[a : b + 1].sum(0) for k, (a, b) in groups.items()}
    tissue = sum((stacked[k] > b - a - 1) * (10 if k == "nuclear" else 1) for k, (a, b) in groups.items()) > 10
    background = sum((stacked[k] < (b - a + 1) / 2) * (10 if k == "nuclear" else 1) for k, (a, b) in groups.items()) > 10
    assert (got == np.where(background, 0, np.where(tissue, 1, masks.sum(0) > 0.6 * 7))).all()


@pytest.mark.parametrize("sigma", [0.6, 3.0])
def test_errors_of_smoothed_pixels(spark, sigma):
    rng = np.random.default_rng(3)
    v, error = rng.normal(size=(H, W)), rng.random((H, W)) + 0.1

    def matrix(n):
        m = np.zeros((n, n))
        for goal in range(n):
            for o, w in raster.gaussian(sigma).items():
                s = (goal + o) % (2 * n)
                m[goal, s if s < n else 2 * n - 1 - s] += w
        return m

    my, mx = matrix(H), matrix(W)
    found = raster.smooth_errors(frame(spark, v=v, error=error), ["i"], W, H, sigma)
    assert np.allclose(array(found), my @ v @ mx.T) and np.allclose(array(found, "error"), np.sqrt(my**2 @ error**2 @ (mx**2).T))


def with_filters(a, kinds):
    """A file whose rows have the filters of `kinds`, from their definition."""
    wide = a.dtype.itemsize
    rows = a.astype(f">u{wide}").view(np.uint8).reshape(len(a), -1).astype(int)
    body = b""
    for y, kind in enumerate(kinds):
        line = []
        for i, v in enumerate(rows[y]):
            left, up, corner = (rows[y, i - wide] if i >= wide else 0, rows[y - 1, i] if y else 0, rows[y - 1, i - wide] if y and i >= wide else 0)
            p = left + up - corner
            near = min((left, up, corner), key=lambda c: abs(p - c))
            line.append((v - (0, left, up, (left + up) // 2, near)[kind]) % 256)
        body += bytes([kind, *line])
    chunk = lambda n, d: struct.pack(">I", len(d)) + n + d + struct.pack(">I", zlib.crc32(n + d))
    packed = zlib.compress(body)
    return png.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", a.shape[1], len(a), 8 * wide, 0, 0, 0, 0)) + chunk(b"tEXt", b"a\0b") + chunk(b"IDAT", packed[:9]) + chunk(b"IDAT", packed[9:]) + chunk(b"IEND", b"")


@pytest.mark.parametrize("kind", [np.uint8, np.uint16])
def test_png_files_of_all_filters(spark, kind):
    a = np.random.default_rng(7).integers(0, np.iinfo(kind).max, (5, 6)).astype(kind)
    files = {"own": png.encoded(a), "all": with_filters(a, [4, 1, 3, 2, 4]), "plain": with_filters(a, [0, 4, 0, 3, 1])}
    rows = png.read(spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()], "path string, content binary")).collect()
    assert len(rows) == 3 and all((r.width, r.height, r.samples) == (6, 5, a.ravel().tolist()) for r in rows)


def test_damaged_png_files_fail(spark):
    good = png.encoded(np.zeros((2, 2), np.uint8))
    for bad in (b"", b"GIF89a", good[:-20], good.replace(b"IDAT", b"IDAX"), good[:20] + b"\xff" + good[21:]):
        with pytest.raises(Exception):
            png.read(spark.createDataFrame([("a", bytearray(bad))], "path string, content binary")).collect()
