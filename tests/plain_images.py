"""Plain numpy versions of image operations, which the Spark ones are held against."""

import numpy as np


def smooth(a: np.ndarray, sigma: float) -> np.ndarray:
    """Separable Gaussian with reflected borders."""
    r = max(1, int(4 * sigma + 0.5))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    k /= k.sum()
    out = a.astype(float)
    for axis in (0, 1):
        p = np.pad(out, [(r, r) if i == axis else (0, 0) for i in (0, 1)], mode="symmetric")
        out = np.apply_along_axis(np.convolve, axis, p, k, mode="valid")
    return out


def blur_score(a: np.ndarray) -> np.ndarray:
    """Local variance of the Laplacian over the local mean."""
    p = np.pad(a.astype(float), 1, mode="symmetric")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]
    scale = np.abs(smooth(a.astype(float), 1.0)) + 1e-9
    n = lap / scale
    return np.maximum(smooth(n * n, 1.0) - smooth(n, 1.0) ** 2, 0)


def trim_tails(mask: np.ndarray) -> np.ndarray:
    """Removes pixels with fewer than two neighbours until none is left."""
    out = mask.copy()
    while True:
        p = np.pad(out, 1).astype(int)
        near = sum(p[1 + i : p.shape[0] - 1 + i, 1 + j : p.shape[1] - 1 + j] for i in (-1, 0, 1) for j in (-1, 0, 1)) - out
        new = out & (near >= 2)
        if (new == out).all():
            return out
        out = new


def otsu_by_skew(values: np.ndarray, most: int = 5) -> float:
    """Otsu thresholds of what lies below the last one, the one after which the skew of the rest drops most."""
    best, now, last = 0.0, values.astype(float), None
    drop = -np.inf
    for _ in range(most):
        if len(now) < 3 or now.std() == 0:
            break
        cuts = np.unique(now)[1:]
        cost = [len(lo) * lo.var() + len(hi) * hi.var() for lo, hi in ((now[now < c], now[now >= c]) for c in cuts)]
        at = cuts[int(np.argmin(cost))]
        skew = float((((now - now.mean()) / now.std()) ** 3).mean())
        if last is not None and last - skew > drop:
            drop, best = last - skew, at
        if last is None:
            best = at
        last, now = skew, now[now < at]
    return float(best)


def radial_warp(shape: tuple[int, int], k: float) -> tuple[np.ndarray, np.ndarray]:
    """Where each pixel of a radially corrected image comes from."""
    h, w = shape
    y, x = np.mgrid[:h, :w].astype(float)
    cx, cy, unit = (w - 1) / 2, (h - 1) / 2, max(h, w) / 2
    r2 = ((x - cx) ** 2 + (y - cy) ** 2) / unit**2
    return cx + (x - cx) * (1 + k * r2), cy + (y - cy) * (1 + k * r2)


def close_mask(mask: np.ndarray, steps: int = 1) -> np.ndarray:
    """Binary opening and then closing with a 3 x 3 square; outside counts as unset."""

    def grow(m: np.ndarray) -> np.ndarray:
        p = np.pad(m, 1)
        return np.any([p[1 + i : p.shape[0] - 1 + i, 1 + j : p.shape[1] - 1 + j] for i in (-1, 0, 1) for j in (-1, 0, 1)], axis=0)

    shrink = lambda m: ~grow(~m)
    out = mask.astype(bool)
    for f in [shrink] * steps + [grow] * steps + [grow] * steps + [shrink] * steps:
        out = f(out)
    return out


def simplify(points: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """Ramer-Douglas-Peucker: the ends stay, and any point further than the tolerance from the chord."""
    p = np.array(points, float)
    keep, todo = {0, len(p) - 1}, [(0, len(p) - 1)]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        d = p[hi] - p[lo]
        n = np.hypot(*d)
        q = p[lo + 1 : hi] - p[lo]
        far = np.abs(d[0] * q[:, 1] - d[1] * q[:, 0]) / n if n else np.hypot(q[:, 0], q[:, 1])
        at = lo + 1 + int(far.argmax())
        if far.max() > tolerance:
            keep.add(at)
            todo += [(lo, at), (at, hi)]
    return [tuple(x) for x in p[sorted(keep)].tolist()]


def fit_circle(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Centre and radius of the algebraic least-squares circle."""
    m = np.column_stack([2 * x, 2 * y, np.ones(len(x))])
    (cx, cy, c), *_ = np.linalg.lstsq(m, x * x + y * y, rcond=None)
    return float(cx), float(cy), float(np.sqrt(max(c + cx * cx + cy * cy, 0)))


def robust_intercept(values: np.ndarray, sigmas: float = 100.0) -> float:
    """Mean of the values before the first that lies over `sigmas` running deviations from the running mean."""
    for i in range(3, len(values)):
        head = values[:i]
        if abs(values[i] - head.mean()) > sigmas * max(head.std(), 1e-6):
            return float(head.mean())
    return float(values.mean()) if len(values) else float("nan")
