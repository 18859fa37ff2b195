"""Draws of the number of tables of a dish from its conditional distribution.

With c customers, o tables of other dishes and probability p at the parent, t tables
have the weight S(c, t) * product of (theta + d * (o + i)) for i < t * p^t, S the
generalised Stirling numbers of discount d: S(c + 1, t) = S(c, t - 1) + (c - d t) S(c, t).
Up to TABLED customers all weights come from this recursion, so draws are exact.
Of a dish with more, TABLED customers are seated so TRIES times; the others follow, a
part STEP of those who sit at once, and one seating is kept by its importance weight.
Tests hold both to the exact distribution.
"""

from __future__ import annotations

import functools

import numpy as np

#: Customers up to which the numbers are tabled, and weights that are held at once.
TABLED, CELLS = 1024, 1 << 20
#: Customers up to which weights are products instead of sums of logarithms.
SMALL = 32
#: Weights of a larger dish that are made at first, and the logarithm, below the largest one's, from which they are negligible.
FIRST, NEGLIGIBLE = 48, -40.0
#: Seatings of a larger dish, of which one is kept, and the share of its customers that are seated together.
TRIES, STEP = 64, 1 / 64


@functools.lru_cache(maxsize=8)
def log_stirling(d: float, most: int = TABLED) -> np.ndarray:
    """Logarithms of S(c, t) for c and t up to `most`."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(most):
        t = np.arange(1, c + 2)
        stay = np.where(c - d * t > 0, np.log(np.maximum(c - d * t, 1e-300)), -np.inf) + out[c, 1 : c + 2]
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c, : c + 1], stay)
    return out


@functools.lru_cache(maxsize=8)
def scaled(d: float) -> np.ndarray:
    """S(c, t) / (c - 1)! for c and t up to SMALL, by t and c."""
    falling = np.concatenate(([0.0, 0.0], np.cumsum(np.log(np.arange(1, SMALL)))))
    return np.ascontiguousarray(np.exp(log_stirling(d)[: SMALL + 1, : SMALL + 1] - falling[:, None]).T)


@functools.lru_cache(maxsize=8)
def _by_tables(d: float) -> np.ndarray:
    return np.ascontiguousarray(log_stirling(d).T)


def _drawn(share: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A number of tables for each column of weights."""
    np.cumsum(share, axis=0, out=share)
    return 1 + (share < rng.random(share.shape[1]) * share[-1]).sum(0).clip(max=len(share) - 1)


def _few(c: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float, theta: float, rng: np.random.Generator) -> np.ndarray:
    """Dishes in descending order of c; a column of weights each.

    Weights rise to one maximum and fall, so of a larger dish only the first FIRST are
    made, and more if the last of them isn't negligible yet.
    """
    out, first, more = np.empty(len(c), np.int64), (theta + d * others) * parent, d * parent
    at = large = int(np.searchsorted(-c, -SMALL, "left"))
    while at < len(c):
        wide = int(c[at])
        to = min(at + CELLS // wide, int(np.searchsorted(-c, -(wide // 2), "left")))  # so that columns are not much longer than they need to be
        share = np.cumprod(first[at:to] + more[at:to] * np.arange(wide)[:, None], axis=0)
        share *= scaled(d)[1 : wide + 1, c[at:to]]
        out[at:to] = _drawn(share, rng)
        at = to
    todo, wide = np.arange(large), FIRST
    while len(todo):
        left = []
        for lo in range(0, len(todo), CELLS // wide):
            i = todo[lo : lo + CELLS // wide]
            w = min(wide, int(c[i[0]]))
            share = np.cumsum(np.log(first[i] + more[i] * np.arange(w)[:, None]), axis=0)
            share += _by_tables(d)[1 : w + 1, c[i]]
            share -= share.max(0)
            whole = (c[i] <= w) | (share[-1] < NEGLIGIBLE)
            left.append(i[~whole])
            out[i[whole]] = _drawn(np.exp(share[:, whole]), rng)
        todo, wide = np.concatenate(left), 4 * wide
    return out


def _many(c: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float, theta: float, rng: np.random.Generator) -> np.ndarray:
    steps, t = np.arange(TABLED), np.empty((len(c), TRIES), np.int64)
    for i in range(len(c)):
        weight = np.cumsum(np.log((theta + d * (others[i] + steps)) * parent[i])) + log_stirling(d)[TABLED, 1:]
        share = np.cumsum(np.exp(weight - weight.max()))
        t[i] = 1 + np.searchsorted(share, rng.random(TRIES) * share[-1]).clip(max=TABLED - 1)
    a, b, log_weight, n = ((theta + d * others) * parent)[:, None], d * parent[:, None], np.zeros(t.shape), TABLED
    while k := int(np.searchsorted(-c, -n, "left")):  # dishes with more than n customers
        together = max(1, int(n * STEP))
        new = a[:k] + b[:k] * t[:k]
        sure = new + (n - d * t[:k])
        size = np.minimum(together, c[:k] - n)[:, None]
        log_weight[:k] += size * np.log(sure + (size - 1) / 2)
        t[:k] += rng.binomial(size, new / sure)
        n += together
    share = np.cumsum(np.exp(log_weight - log_weight.max(1, keepdims=True)), axis=1)
    kept = (share < rng.random(len(c))[:, None] * share[:, -1:]).sum(1).clip(max=TRIES - 1)
    return t[np.arange(len(c)), kept]


def draw_tables(c: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float, theta: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with c customers, beside `others` tables and with the parents' probabilities; none for no customers."""
    t = np.minimum(c, 1)
    order = np.argsort(-c, kind="stable")[: int((c > 1).sum())]
    large = int((c[order] > TABLED).sum())
    for draw, i in ((_many, order[:large]), (_few, order[large:])):
        if len(i):
            t[i] = draw(c[i], np.asarray(others, np.float64)[i], np.asarray(parent, np.float64)[i], float(d), float(theta), rng)
    return t
