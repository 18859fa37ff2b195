"""Plain numpy versions of image kernels, which the Spark ones are held against."""

import numpy as np


def compute_shift(a: np.ndarray, b: np.ndarray) -> tuple[float, float, int]:
    """Shift of b against a by FFT cross correlation, refined by a parabola through the peak: (dx, dy, exit).

    Exit 0 is a clear peak, 1 a second one almost as high, 3 a shift beyond a
    third of the image.
    """
    f = np.fft.fft2(a - a.mean()) * np.conj(np.fft.fft2(b - b.mean()))
    c = np.real(np.fft.ifft2(f))
    y, x = np.unravel_index(int(c.argmax()), c.shape)
    h, w = c.shape

    def fine(low: float, mid: float, high: float) -> float:
        bend = low - 2 * mid + high
        return 0.0 if bend == 0 else float(np.clip(0.5 * (low - high) / bend, -0.5, 0.5))

    dy = y + fine(c[(y - 1) % h, x], c[y, x], c[(y + 1) % h, x])
    dx = x + fine(c[y, (x - 1) % w], c[y, x], c[y, (x + 1) % w])
    dy, dx = dy - h if dy > h / 2 else dy, dx - w if dx > w / 2 else dx
    rest = c.copy()
    for i in (-1, 0, 1):
        for j in (-1, 0, 1):
            rest[(y + i) % h, (x + j) % w] = -np.inf
    leave = 3 if abs(dx) > w / 3 or abs(dy) > h / 3 else 1 if rest.max() > 0.95 * c[y, x] else 0
    return dx, dy, leave


def shift_covariance(a: np.ndarray, b: np.ndarray, dx: float, dy: float, factor: float = 0.25) -> tuple[float, float, float]:
    """(covxx, covxy, covyy) of a shift from `compute_shift`: 2 * error * factor^2 * the inverse of minus the Hessian at the correlation's peak.

    The error is that of the correlation of a and b moved onto it, with their
    difference as both images' errors. NaN where the peak has no positive definite one.
    """
    a, b = a - a.mean(), b - b.mean()
    c = np.real(np.fft.ifft2(np.fft.fft2(a) * np.conj(np.fft.fft2(b))))
    y, x = np.unravel_index(int(c.argmax()), c.shape)
    h, w = c.shape
    at = lambda i, j: float(c[(y + i) % h, (x + j) % w])
    xx, yy = at(0, -1) - 2 * at(0, 0) + at(0, 1), at(-1, 0) - 2 * at(0, 0) + at(1, 0)
    xy = (at(1, 1) - at(1, -1) - at(-1, 1) + at(-1, -1)) / 4
    det = xx * yy - xy * xy
    if not (xx < 0 and yy < 0 and det > 0):
        return float("nan"), float("nan"), float("nan")
    moved = fourier_shift(b, dx, dy)
    error = float(np.sqrt((((a - moved) ** 2) * (a * a + moved * moved)).sum()))
    scale = 2 * error * factor**2 / det
    return -yy * scale, xy * scale, -xx * scale


def label(mask: np.ndarray, diagonal: bool = True) -> np.ndarray:
    """Numbers the 8-connected regions of a mask, or the 4-connected ones, from 1 in order of their first pixel."""
    out = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    while True:
        p = np.pad(out, 1)
        p = np.where(p == 0, mask.size + 1, p)
        low = np.min([p[1 + i : p.shape[0] - 1 + i, 1 + j : p.shape[1] - 1 + j] for i in (-1, 0, 1) for j in (-1, 0, 1) if diagonal or not i or not j], axis=0)
        new = np.where(mask, low, 0)
        if (new == out).all():
            break
        out = new
    return np.searchsorted(np.unique(out[out > 0]), out) + (out > 0) if mask.any() else out


def fourier_shift(a: np.ndarray, dx: float, dy: float) -> np.ndarray:
    """The image moved by a part of a pixel, periodic at its borders."""
    h, w = a.shape
    turn = np.exp(-2j * np.pi * (np.fft.fftfreq(h)[:, None] * dy + np.fft.fftfreq(w)[None, :] * dx))
    return np.real(np.fft.ifft2(np.fft.fft2(a) * turn))


def remap(a: np.ndarray, mx: np.ndarray, my: np.ndarray) -> np.ndarray:
    """Bilinear samples of an image at the given places, clamped to its borders."""
    h, w = a.shape
    mx, my = np.clip(mx, 0, w - 1), np.clip(my, 0, h - 1)
    x, y = np.minimum(mx.astype(int), w - 2), np.minimum(my.astype(int), h - 2)
    u, v = mx - x, my - y
    return (1 - v) * ((1 - u) * a[y, x] + u * a[y, x + 1]) + v * ((1 - u) * a[y + 1, x] + u * a[y + 1, x + 1])


def outline(mask: np.ndarray, diagonal: bool = False) -> list[tuple[int, int]]:
    """Corner points of the outer border of one 4-connected region, or 8-connected one if `diagonal`, clockwise in image coordinates, on pixel edges."""
    p = np.pad(mask.astype(bool), 1)
    inside = lambda x, y: bool(p[y + 1, x + 1])
    ys, xs = np.nonzero(mask)
    if not len(xs):
        return []
    x, y = int(xs[ys == ys.min()].min()), int(ys.min())
    start, d, out = (x, y), (1, 0), []
    while True:
        x, y = x + d[0], y + d[1]
        # pixels ahead, left and right of the edge walked so far
        left = {(1, 0): (x, y - 1), (0, 1): (x, y), (-1, 0): (x - 1, y), (0, -1): (x - 1, y - 1)}[d]
        right = {(1, 0): (x, y), (0, 1): (x - 1, y), (-1, 0): (x - 1, y - 1), (0, -1): (x, y - 1)}[d]
        if diagonal and inside(*left):
            turn = (d[1], -d[0])
        elif not inside(*right):
            turn = (-d[1], d[0])
        elif inside(*left):
            turn = (d[1], -d[0])
        else:
            turn = d
        if turn != d:
            out.append((x, y))
        d = turn
        if (x, y) == start and d == (1, 0):
            return out[-1:] + out[:-1]


def contours(mask: np.ndarray) -> list[tuple[int, int, int, list[tuple[int, int]]]]:
    """(ring, depth, parent, outline) of every 8-connected region and every 4-connected hole of a mask.

    Regions have the numbers of `label`, holes those after. Regions have even
    depths, from 0, and the hole they lie in as parent; holes have odd depths and
    the region around them. Parent 0 is none.
    """
    p = np.pad(mask.astype(bool), 1)
    regions, gaps = label(p), label(~p, diagonal=False)  # the first gap is the outside, as it has the first pixel
    n, holes = int(regions.max()), int(gaps.max()) - 1
    number = np.where(p, regions, np.where(gaps > 1, gaps - 1 + n, 0))
    parent = {0: -1}
    for k in range(1, n + holes + 1):
        y, x = np.argwhere(number == k)[0]
        parent[k] = int(number[y - 1, x])  # above a topmost pixel is what surrounds it

    def depth(k: int) -> int:
        return -1 if k == 0 else depth(parent[k]) + 1

    return [(k, depth(k), parent[k], [(x - 1, y - 1) for x, y in outline(number == k, diagonal=k <= n)]) for k in range(1, n + holes + 1)]


def best_rotation(a: np.ndarray, b: np.ndarray, degrees: list[float]) -> tuple[float, float, float]:
    """The rotation of b, of those given, and the shift at which it correlates best with a."""
    h, w = a.shape
    y, x = np.mgrid[:h, :w].astype(float)
    cx, cy, best = (w - 1) / 2, (h - 1) / 2, (-np.inf, 0.0, 0.0, 0.0)
    for deg in degrees:
        t = np.deg2rad(deg)
        turned = remap(b, cx + (x - cx) * np.cos(t) - (y - cy) * np.sin(t), cy + (x - cx) * np.sin(t) + (y - cy) * np.cos(t))
        c = np.real(np.fft.ifft2(np.fft.fft2(a - a.mean()) * np.conj(np.fft.fft2(turned - turned.mean()))))
        i, j = np.unravel_index(int(c.argmax()), c.shape)
        if c[i, j] > best[0]:
            best = (float(c[i, j]), deg, float(j - w if j > w / 2 else j), float(i - h if i > h / 2 else i))
    return best[1:]
