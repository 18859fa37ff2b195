"""License scans: winnowed fingerprints of templates pick candidates, banded alignment measures them.

Templates and texts are words of letters and digits in lower case. A template is
indexed by the hashes of its k-word runs that are minimal in some window; texts
are winnowed alike, so a shared run of `window + k - 1` words shares a
fingerprint. Templates under LONG words are indexed by all their word pairs. A
band of diagonals with enough fingerprints is aligned, and coverage is the share of
the template's words that the alignment matches. Words by which a template differs
from one that is nearly the same have to match, and so does the coverage weighted
by how few templates have a word, so that a notice of one license is not taken for
that of another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.llm.words import grams, spans, text_bytes

#: Words of a run and runs of a window, for templates of LONG words and for shorter ones.
K, WINDOW = 3, 2
SHORT_K, SHORT_WINDOW, LONG = 2, 1, 20
#: Cells of the alignment on each side of its diagonal, and the least coverage reported.
BAND, COVERAGE = 16, 0.8

#: A table of templates is collected and sent to all tasks if it has at most so many rows and characters.
MOST_TEMPLATES, MOST_CHARACTERS = 5_000, 20_000_000

#: Wording of public licences and of the notices that refer to them.
TEMPLATES = {
    "agpl-3.0-notice": "Licensed under the GNU Affero General Public License, version 3",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "bsd-clauses": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-disclaimer": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "bsd-notice": "Licensed under the BSD License",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0",
    "gpl-2.0-abbreviated": "Licensed under the GNU GPL version 2",
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-2.0-short-notice": "Licensed under the GNU General Public License, version 2",
    "gpl-3.0-abbreviated": "Licensed under the GNU GPL version 3",
    "gpl-3.0-short-notice": "Licensed under the GNU General Public License, version 3",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-notice": "Licensed under the ISC License",
    "lgpl-2.1-notice": "Licensed under the GNU Lesser General Public License, version 2.1",
    "lgpl-3.0-notice": "Licensed under the GNU Lesser General Public License, version 3",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-notice": "Licensed under the MIT License",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

#: Bytes between words: all of ASCII but letters and digits; bytes of other characters belong to words.
BETWEEN = np.ones(256, bool)
BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def winnow(hashes: np.ndarray, k: int = K, window: int = WINDOW) -> np.ndarray:
    """Places of the k-word runs whose hash is the smallest, the last of equals, of a window of runs."""
    g = grams(hashes, min(k, len(hashes))) if len(hashes) else hashes
    if len(g) <= window:
        return np.array([len(g) - 1 - int(g[::-1].argmin())]) if len(g) else np.empty(0, np.int64)
    low, at = g[: len(g) - window + 1].copy(), np.arange(len(g) - window + 1)
    for i in range(1, window):
        later = g[i : len(g) - window + 1 + i]
        at = np.where(later <= low, np.arange(i, i + len(at)), at)
        low = np.minimum(low, later)
    return np.unique(at)


@dataclass
class Index:
    """Fingerprints of some templates, in order of their hashes."""

    k: int
    window: int
    keys: np.ndarray
    owner: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, words: list[np.ndarray], owners: list[int], k: int, window: int) -> Index:
        at = [winnow(words[o], k, window) for o in owners]
        key = np.concatenate([np.empty(0, np.uint64), *(grams(words[o], k)[p] for o, p in zip(owners, at))])
        owner = np.repeat(np.array(owners, np.int64), [len(p) for p in at])
        order = np.argsort(key, kind="stable")
        return cls(k, window, key[order], owner[order], np.concatenate([np.empty(0, np.int64), *at])[order])

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owners, places in the text and diagonals (that place less the one in the template) of all shared fingerprints."""
        if len(h) < self.k or not len(self.keys):
            return (np.empty(0, np.int64),) * 3
        at = winnow(h, self.k, self.window)
        g = grams(h, self.k)[at]
        lo, hi = np.searchsorted(self.keys, g, "left"), np.searchsorted(self.keys, g, "right")
        n = hi - lo
        entry = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        at = np.repeat(at, n)
        return self.owner[entry], at, at - self.place[entry]


@dataclass
class Templates:
    names: list[str]
    words: list[np.ndarray]
    weight: list[np.ndarray]
    needed: list[np.ndarray]
    ends_plainly: list[bool]
    indexes: list[Index]

    @classmethod
    def of(cls, texts: dict[str, str], coverage: float = COVERAGE) -> Templates:
        names = sorted(texts)
        words = [spans(text_bytes(texts[name]), BETWEEN)[2] for name in names]
        for name, w in zip(names, words):
            if len(w) < SHORT_K:
                raise ValueError(f"template {name} has fewer than {SHORT_K} words")
        known, n = np.unique(np.concatenate([np.empty(0, np.uint64), *(np.unique(w) for w in words)]), return_counts=True)
        weight = [np.log1p(len(words) / n[np.searchsorted(known, w)]) for w in words]
        short = [i for i, w in enumerate(words) if len(w) < LONG]
        far = [i for i in range(len(words)) if i not in set(short)]
        indexes = [Index.of(words, short, SHORT_K, SHORT_WINDOW), Index.of(words, far, K, WINDOW)]
        needed = []
        for i, w in enumerate(words):
            must = np.zeros(len(w), bool)
            for j, other in enumerate(words):  # templates only; the shared fingerprints leave few pairs
                if i != j and 2 * len(np.intersect1d(w, other)) >= len(np.unique(w)):
                    same = matched(w, other)
                    if same.sum() >= coverage * len(w):
                        must |= ~same
            needed.append(must)
        plain = [not np.isin(w[-1], w[max(0, len(w) - 3) : -1]) for w in words]
        return cls(names, words, weight, needed, plain, indexes)

    def accepts(self, owner: int, which: np.ndarray, coverage: float) -> bool:
        """Whether some of a template's words are enough: by number, by weight, and those that have to match."""
        weight = self.weight[owner]
        return bool(which.sum() >= coverage * len(which) and weight[which].sum() >= coverage * weight.sum() and which[self.needed[owner]].all())

    @classmethod
    def of_table(cls, table: DataFrame, coverage: float = COVERAGE) -> Templates:
        """Of table(name, text), whose size is checked before it is collected; nulls are ignored, and of equal names the first text stays."""
        rows = table.where("name is not null and text is not null").groupBy("name").agg(F.min("text").alias("text"))
        n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
        if n > MOST_TEMPLATES or size > MOST_CHARACTERS:
            raise ValueError(f"{n} templates of {size} characters; they travel with every task and are bounded by {MOST_TEMPLATES} and {MOST_CHARACTERS}")
        return cls.of({r["name"]: r["text"] for r in rows.collect()}, coverage)


def common(template: np.ndarray, part: np.ndarray, low: int, high: int) -> np.ndarray:
    """Lengths of the longest common subsequences of their starts, cells with column - row outside [low, high] left out."""
    shift = np.arange(len(part))[None, :] - np.arange(len(template))[:, None]
    same = (template[:, None] == part[None, :]) & (shift >= low) & (shift <= high)
    table = np.zeros((len(template) + 1, len(part) + 1), np.int32)
    for i in range(len(template)):
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(table[i, 1:], table[i, :-1] + same[i]))
    return table


def matched(template: np.ndarray, part: np.ndarray, low: int = -(2**31), high: int = 2**31) -> np.ndarray:
    """Which words of the template are in one longest common subsequence."""
    table, out = common(template, part, low, high), np.zeros(len(template), bool)
    i, j = len(template), len(part)
    while i and j and table[i, j]:
        if table[i, j] == table[i - 1, j]:
            i -= 1
        elif table[i, j] == table[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out[i] = True
    return out


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int, np.ndarray]:
    """(matches, first, last + 1, which words): the longest common subsequence of the template and the words near a diagonal, and the tightest place of it in the text: the first end, and then the last start."""
    lo = max(0, diagonal - band)
    part = text[lo : max(lo, diagonal + len(template) + band)]
    none = np.zeros(len(template), bool)
    if not len(part):
        return 0, 0, 0, none
    low, high = diagonal - lo - band, diagonal - lo + band
    row = common(template, part, low, high)[-1]
    n = int(row[-1])
    if not n:
        return 0, 0, 0, none
    last = int(np.searchsorted(row, n))
    turn = last - len(template)  # of both, so a shift s becomes turn - s
    back = common(template[::-1], part[:last][::-1], turn - high, turn - low)[-1]
    first = last - int(np.searchsorted(back, n))
    which = np.ones(len(template), bool) if n == len(template) else matched(template, part[first:last], low - first, high - first)
    return n, lo + first, lo + last, which


def scan_text(text: str | None, templates: Templates, coverage: float = COVERAGE, band: int = BAND) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, start, end, words) of each match; code points of the text, end exclusive.

    Of overlapping matches of one template the one with more matched words stays,
    of equals the first, and a match inside a better one of another template goes.
    """
    b = text_bytes(text)
    start, end, h = spans(b, BETWEEN)
    owners, places, diagonals = (np.concatenate(x) for x in zip(*(i.hits(h) for i in templates.indexes)))
    found = []
    for owner in np.unique(owners).tolist():
        words = templates.words[owner]
        if not templates.accepts(owner, np.isin(words, h), coverage):
            continue  # the text lacks too many of the words
        mine = owners == owner
        at, diagonal = places[mine], diagonals[mine]
        edits = len(words) - math.ceil(coverage * len(words))
        # with `edits` words changed, left out or added, so many fingerprints of a short template stay
        least = max(1, len(words) - 2 * edits - 1) if len(words) < LONG else 1
        by_diagonal = np.sort(diagonal)
        near = np.searchsorted(by_diagonal, diagonal + band, "right") - np.searchsorted(by_diagonal, diagonal - band, "left")
        done, failed = 0, set()
        for p, d in sorted(zip(at[near >= least].tolist(), diagonal[near >= least].tolist())):
            if p < done or d in failed:
                continue  # in the match before, or on a diagonal that has none
            if templates.ends_plainly[owner] and d >= 0 and np.array_equal(h[d : d + len(words)], words):
                found.append((len(words), 1.0, owner, d, d + len(words)))  # what an alignment near d would find
                done = max(done, d + len(words))
                continue
            if not templates.accepts(owner, np.isin(words, h[max(0, d - band) : max(0, d + len(words) + band)]), coverage):
                failed.add(d)
                continue
            for width in (2, band):  # an unchanged copy is found at its own place though others are near
                n, s, e, which = align(words, h, d, width)
                if n and templates.accepts(owner, which, coverage):
                    found.append((n, n / len(words), owner, s, e))
                    done = max(done, e)
                    break
            else:
                failed.add(d)
    found.sort(key=lambda x: (-x[0], -x[1], x[3], x[2]))
    reach = max(map(len, templates.words), default=0) + 2 * band  # no match is longer
    kept: dict[int, list[tuple]] = {}
    for f in found:  # the better ones come first
        near = (k for place in range(f[3] // reach - 1, f[3] // reach + 2) for k in kept.get(place, ()))
        if not any((f[3] >= k[3] and f[4] <= k[4]) or (f[2] == k[2] and f[3] < k[4] and k[3] < f[4]) for k in near):
            kept.setdefault(f[3] // reach, []).append(f)
    point = np.concatenate(([0], np.cumsum((b & 0xC0) != 0x80)))
    return [(templates.names[o], c, int(point[start[s]]), int(point[end[e - 1]]), n) for n, c, o, s, e in sorted(sum(kept.values(), []), key=lambda x: (x[3], x[4], x[2]))]


def scan(docs: DataFrame, texts: dict[str, str] | DataFrame | None = None, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, license, coverage, start, end and words of every match in docs(doc_id, text).

    Templates are a dictionary, or a table (name, text) of a checked size; they
    travel with the tasks. Null and empty texts match nothing; rows with equal or
    null ids are scanned each; other columns are ignored. A match has the share
    `coverage` of the template's words, also by weight (a word of few templates
    weighs more, so losing a rare one can refuse a match that the number of words
    allows), and all words by which the template differs from one that is nearly the
    same. It is looked for where a short template shares word pairs enough, or a
    longer one a run of `WINDOW + K - 1` words. A template of one word raises
    ValueError.
    """
    templates = Templates.of_table(texts, coverage) if isinstance(texts, DataFrame) else Templates.of(TEMPLATES if texts is None else texts, coverage)
    shared = docs.sparkSession.sparkContext.broadcast(templates)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(d, *m) for d, t in zip(pdf["doc_id"], pdf["text"]) for m in scan_text(t, shared.value, coverage)]
            yield pd.DataFrame(rows, columns=["doc_id", "license", "coverage", "start", "end", "words"]).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, "doc_id long, license string, coverage double, start long, end long, words long")
