"""Shifts, turns and moved images against planted values and plain numpy."""

import numpy as np
import pandas as pd
import pytest

import plain_kernels as kernels
from histoweave.operators import registration

W, H = 48, 40


def scene(dx, dy, low=3.0, high=5.0):
    rng = np.random.default_rng(5)
    y, x = np.mgrid[:H, :W].astype(float)
    out = np.zeros((H, W))
    for _ in range(25):
        cx, cy, s, h = rng.uniform(14, W - 14), rng.uniform(14, H - 14), rng.uniform(low, high), rng.uniform(20, 100)
        out += h * np.exp(-((x - dx - cx) ** 2 + (y - dy - cy) ** 2) / (2 * s * s))
    return out


def frame(spark, pairs):
    rows = [(i, x, y, float(a[y, x]), float(b[y, x])) for i, (a, b) in pairs.items() for y in range(a.shape[0]) for x in range(a.shape[1])]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["i", "x", "y", "a", "b"]))


def plain_shift(a, b, reach):
    """The same fit by numpy's least squares and Newton's steps."""
    h, w = a.shape
    z = np.real(np.fft.ifft2(np.fft.fft2(a) * np.conj(np.fft.fft2(b))))
    py, px = np.unravel_index(np.abs(z).argmax(), z.shape)
    ys, xs = (np.arange(-min(reach, n // 2), min(reach, n - 1 - n // 2) + 1) for n in (h, w))
    v, u = np.meshgrid(ys / reach, xs / reach, indexing="ij")
    terms = [(i, j) for i in range(4) for j in range(4)]
    c = np.linalg.lstsq(np.stack([(u**i * v**j).ravel() for i, j in terms], 1), z[np.ix_((py + ys) % h, (px + xs) % w)].ravel(), rcond=None)[0].reshape(4, 4)
    poly, d = np.polynomial.polynomial.polyval2d, np.polynomial.polynomial.polyder
    at = np.zeros(2)
    for _ in range(60):
        g = np.array([poly(*at, d(c, axis=0)), poly(*at, d(c, axis=1))])
        hess = np.array([[poly(*at, d(c, 2, axis=0)), poly(*at, d(d(c, axis=0), axis=1))], [poly(*at, d(d(c, axis=0), axis=1)), poly(*at, d(c, 2, axis=1))]])
        at = at - np.linalg.solve(hess, g)
    wrap = lambda s, n: s - n if s > n / 2 else s
    return -(wrap(px, w) + at[0] * reach), -(wrap(py, h) + at[1] * reach), -hess / reach**2


def test_planted_shifts_are_found_and_match_a_plain_fit(spark):
    rng = np.random.default_rng(1)
    plan = {1: (0.0, 0.0), 2: (2.3, -1.7), 3: (-3.55, 0.25), 4: (1.1, 4.4)}
    pairs = {i: (scene(0, 0) + 0.2 * rng.normal(size=(H, W)), scene(dx, dy) + 0.2 * rng.normal(size=(H, W))) for i, (dx, dy) in plan.items()}
    got = {r.i: r for r in registration.shifts(frame(spark, pairs), ["i"], W, H, 2).collect()}
    for i, (dx, dy) in plan.items():
        r = got[i]
        assert abs(r.dx - dx) < 0.02 and abs(r.dy - dy) < 0.02 and r.exit == 0 and r.covxx > 0 and r.covxx * r.covyy > r.covxy**2
        x, y, hess = plain_shift(*pairs[i], 2)
        assert np.allclose((r.dx, r.dy), (x, y), atol=1e-6)
        cov = 2 * r.error * 0.25**2 * np.linalg.inv(hess)
        assert np.allclose((r.covxx, r.covxy, r.covyy), (cov[0, 0], cov[0, 1], cov[1, 1]), rtol=1e-4)
    far = {r.i: r for r in registration.shifts(frame(spark, {i: pairs[i] for i in (2, 3)}), ["i"], W, H).collect()}
    assert all(np.allclose((far[i].dx, far[i].dy), plain_shift(*pairs[i], 10)[:2], atol=1e-6) for i in far)


def test_exits_of_far_repeated_and_flat_images(spark):
    y, x = np.mgrid[:H, :W].astype(float)
    stripes = 100 + 50 * np.cos(2 * np.pi * x / 16) * np.exp(-((y - 20) ** 2) / 40)
    one, other = scene(0, 0), np.roll(scene(0, 0), (9, 14), (0, 1))
    pairs = {1: (one, other), 2: (stripes, stripes + np.random.default_rng(3).normal(size=(H, W)) * 9), 3: (np.zeros((H, W)), np.zeros((H, W)))}
    got = {r.i: (r.exit, r.covxx is None) for r in registration.shifts(frame(spark, pairs), ["i"], W, H, 3).collect()}
    assert got == {1: (3, True), 2: (1, True), 3: (2, True)}


def test_correlation_of_missing_pixels_and_odd_sizes(spark):
    rng = np.random.default_rng(8)
    for w, h in ((5, 4), (1, 3), (6, 1), (7, 7)):
        a, b = rng.normal(size=(2, h, w))
        a[0, 0] = b[0, 0] = 0
        z = {(r.sx, r.sy): r.z for r in registration.correlation(frame(spark, {1: (a, b)}).where("x + y > 0"), ["i"], w, h).collect()}
        want = np.real(np.fft.ifft2(np.fft.fft2(a) * np.conj(np.fft.fft2(b))))
        assert all(np.isclose(z.get((x, y), 0.0), want[y, x], atol=1e-9) for y in range(h) for x in range(w)) and (len(z) == w * h or h == 1)


def test_turn_and_shift_between_two_images(spark):
    a = scene(0, 0, 1.5, 3.0)
    y, x = np.mgrid[:H, :W].astype(float)
    cx, cy, pairs = (W - 1) / 2, (H - 1) / 2, {}
    for i, (deg, dx, dy) in enumerate([(0.0, 0, 0), (8.0, 3, -2), (-17.0, -4, 1)]):
        t = np.deg2rad(deg)
        pairs[i] = a, kernels.remap(np.roll(a, (dy, dx), (0, 1)), cx + (x - cx) * np.cos(t) + (y - cy) * np.sin(t), cy - (x - cx) * np.sin(t) + (y - cy) * np.cos(t))
    got = {r.i: (r.degrees, r.dx, r.dy) for r in registration.register(frame(spark, pairs), ["i"], W, H, [float(t) for t in range(-30, 31, 6)], 4).collect()}
    for i, (deg, dx, dy) in enumerate([(0.0, 0, 0), (8.0, 3, -2), (-17.0, -4, 1)]):
        assert abs(got[i][0] - deg) <= 0.6 and got[i][1:] == (dx, dy)


@pytest.mark.parametrize("dx, dy", [(0.0, 0.0), (2.0, -1.0), (0.3, 0.75), (-1.6, 9.5)])
def test_cubic_shift_is_a_convolution(spark, dx, dy):
    a = np.random.default_rng(2).normal(size=(9, 11))

    def weight(t):
        t = abs(t)
        return 1.25 * t**3 - 2.25 * t**2 + 1 if t <= 1 else -0.75 * (t**3 - 5 * t**2 + 8 * t - 4) if t < 2 else 0

    kx, ky = (np.array([[weight(i - j - d) for j in range(n)] for i in range(n)]) for n, d in ((11, dx), (9, dy)))
    moves = spark.createDataFrame([(1, dx, dy)], "i int, dx_v double, dy_v double")
    df = frame(spark, {1: (a, a)}).select("i", "x", "y", "a").withColumnRenamed("a", "v")
    got = np.zeros((9, 11))
    for r in registration.cubic_shift(df, ["i"], 11, 9, moves).collect():
        got[r.y, r.x] = r.v
    assert np.allclose(got, ky @ a @ kx.T)
