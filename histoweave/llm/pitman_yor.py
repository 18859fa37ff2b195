"""Hierarchical Pitman-Yor language model of the words of a text.

A text has one of CLASSES classes, by a hash of its most frequent word, each as
likely as the others, so that texts of one language share restaurants. A word is
predicted in three nested contexts: the class and the word before, the class, and
nothing. Each context is a restaurant whose tables are customers of the next one,
so the context restaurants of a class share their parent, and those of all classes
the root. The root's base is diffuse: what it draws anew is a new word. So all
words that training lacks are one event, as they are in the add-one base, and the
model spreads its mass over the same V + 1 events.

Words are dealt to places by their hash, frequent ones to several places by their
context, so that a word's tables in all restaurants of its line lie together. A
sweep goes through all restaurants: the customers of a dish leave, and its number of
tables is drawn anew from its distribution given the current tables of all others and
the current probabilities of the parent. What places share is small: after every sweep the
tables of each context are summed over the places by Spark, and those of the
classes and of split words on the driver, whose number is bounded by parameters.

Between stages everything is in rows (place, name, at, n, blob): the arrays of one
place are some columns of bytes, so n-grams take a few bytes each in a shuffle.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.llm.common import cut, fold
from histoweave.llm.seating import draw_tables
from histoweave.llm.words import mix, spans, text_bytes
from histoweave.sources.written import discard

CLASSES = 32
BURN_IN, SAMPLES = 2, 4
STRENGTH = 0.5
#: Dishes are seated again in so many blocks, between which all totals of a place are brought up to date.
BLOCKS = 4
#: Tokens of a place, and text bytes that are counted together before they are dealt to places.
PLACE_TOKENS, BATCH_BYTES = 1_000_000, 4_000_000
#: Words with a larger share of a part's tokens than this can be dealt to several places; so at most 2^20 words are.
HOT_SHARE = 2.0**-20
_KEY = np.uint64(2**48 - 1)
TEXT_END, TEXT_START = np.uint64(2**64 - 1), np.uint64(2**64 - 2)
ROWS = "place int, name string, at long, n long, blob binary"
_COLUMNS = ["place", "name", "at", "n", "blob"]


def put(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers as compressed planes of as few bytes as the largest number needs."""
    import zstandard

    out = []
    for a in arrays:
        a = np.ascontiguousarray(a, "<u8")
        width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
        out.append(len(a).to_bytes(8, "little") + bytes([width]) + np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def get(blob: bytes) -> list[np.ndarray]:
    import zstandard

    data, at, out = zstandard.ZstdDecompressor().decompress(bytes(blob)), 0, []
    while at < len(data):
        n, width = int.from_bytes(data[at : at + 8], "little"), data[at + 8]
        planes = np.frombuffer(data, np.uint8, n * width, at + 9).reshape(width, n)
        a = np.zeros((n, 8), np.uint8)
        a[:, :width] = planes.T
        out.append(a.reshape(-1).view("<u8").astype(np.int64))
        at += 9 + n * width
    return out


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys start."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and where each text's words end."""
    parts = [text_bytes(t).tobytes() for t in texts]
    start, _, h = spans(np.frombuffer(b" ".join(parts), np.uint8))
    return h, np.searchsorted(start, np.cumsum([len(p) + 1 for p in parts]))


class Tokens:
    """Tokens of several texts: words and an end for each, with the class and context of every one."""

    def __init__(self, texts: list[str | None]):
        h, last = words_of(texts)
        sizes = np.diff(last, prepend=0)
        self.size = sizes + 1
        self.word = np.insert(h, last, TEXT_END)
        kind = np.zeros(len(texts), np.int64)
        for i, (lo, hi) in enumerate(zip((last - sizes).tolist(), last.tolist())):
            if hi > lo:
                key, n = np.unique(h[lo:hi], return_counts=True)
                kind[i] = int(key[n.argmax()] % np.uint64(CLASSES))
        self.doc = np.repeat(np.arange(len(texts)), self.size)
        self.kind = kind[self.doc]
        before = np.concatenate(([TEXT_START], self.word[:-1]))
        before[np.cumsum(self.size) - self.size] = TEXT_START
        self.context = mix(before * np.uint64(2 * CLASSES + 1) + self.kind.astype(np.uint64)) & _KEY
        self.word = mix(self.word) & _KEY


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows gathered to about BATCH_BYTES of text; one longer text is a batch of its own."""
    held, size = [], 0
    for pdf in frames:
        length = pdf["text"].map(lambda t: len(t) if t else 0).to_numpy(np.int64)
        cuts = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(length) // BATCH_BYTES)))).tolist()
        for lo, hi in zip([0, *cuts], [*cuts, len(pdf)]):
            if hi > lo:
                held.append(pdf.iloc[lo:hi])
                size += int(length[lo:hi].sum()) + 50 * (hi - lo)
                if size >= BATCH_BYTES:
                    yield pd.concat(held)
                    held, size = [], 0
    if held:
        yield pd.concat(held)


def _frequent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A part's number of tokens (key -1) and counts of the words that have a share above HOT_SHARE of them."""
    keys, counts, total = np.empty(0, np.uint64), np.empty(0, np.int64), 0
    for pdf in _batches(frames):
        h, last = words_of(pdf["text"].tolist())
        k, n = np.unique(mix(np.append(h, np.full(len(last), TEXT_END))) & _KEY, return_counts=True)
        total += int(n.sum())
        both, at = np.unique(np.concatenate((keys, k)), return_inverse=True)
        keys, counts = both, np.bincount(at, np.concatenate((counts, n)), len(both)).astype(np.int64)
        if len(keys) > 4_000_000:  # frequent words lose little; this decides on no result, only on what is split
            keep = counts > 1
            keys, counts = keys[keep], counts[keep]
    keep = counts > max(total * HOT_SHARE, 1000)
    yield pd.DataFrame({"key": np.append(keys[keep].astype(np.int64), -1), "n": np.append(counts[keep], total)})


def place_of(word: np.ndarray, context: np.ndarray, places: int, hot: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Where a word in a context is dealt to; words in the sorted array `hot` to several places."""
    at = mix(word)
    if len(hot):
        i = np.minimum(np.searchsorted(hot, word), len(hot) - 1)
        is_hot = hot[i] == word
        at[is_hot] += mix(context[is_hot]) % parts[i[is_hot]].astype(np.uint64)
    return (at % np.uint64(places)).astype(np.int64)


def _deal(places: int, shared):
    """Packets of a batch's tokens for each place, and what is known of its documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        hot, parts = shared.value
        batch = TaskContext.get().partitionId() << 32
        for pdf in _batches(frames):
            t = Tokens(pdf["text"].tolist())
            train = ~pdf["held_out"].to_numpy(bool)
            place = place_of(t.word, t.context, places, hot, parts)
            order = np.lexsort((t.kind << 48 | t.context.astype(np.int64), t.word, place))
            place, word, kind, context, doc = place[order], t.word[order], t.kind[order], t.context[order], t.doc[order]
            first = runs(place, word, kind, context)
            times = np.diff(np.append(first, len(doc)))
            trained = np.add.reduceat(train[doc].astype(np.int64), first)
            bounds = np.searchsorted(place, np.arange(places + 1))
            entry = np.searchsorted(first, bounds)
            rows = []
            for p in np.flatnonzero(np.diff(bounds)).tolist():
                lo, hi = entry[p], entry[p + 1]
                at = first[lo:hi]
                w = runs(word[at])
                rows.append((p, "packet", batch, 0, put(word[at][w], np.diff(np.append(w, hi - lo)), kind[at], context[at], trained[lo:hi], times[lo:hi], doc[bounds[p] : bounds[p + 1]])))
            rows.append((int(batch % places), "docs", batch, 0, put(pdf["doc_id"].to_numpy(np.int64).view(np.uint64), pdf["no_id"].to_numpy(np.int64), ~train, t.size)))
            yield pd.DataFrame(rows, columns=_COLUMNS)
            batch += 1

    return run


def _stage(f: Callable[[int, dict[str, dict[int, bytes]]], list[tuple]]):
    """A grouped stage: f gets all blobs of a place by name and `at`, and gives rows."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, dict[int, bytes]] = {}
        for name, at, blob in zip(pdf["name"], pdf["at"], pdf["blob"]):
            found.setdefault(name, {})[at] = blob
        out = f(int(key[0]), found)
        return pd.DataFrame(out, columns=_COLUMNS).astype({"place": "int32", "at": "int64", "n": "int64"})

    return run


def _run(rows: DataFrame, f) -> DataFrame:
    """The stage's rows, written in a folder for each name so that a stage reads what it needs."""
    out = rows.groupBy("place").applyInPandas(_stage(f), ROWS)
    return cut(out.withColumn("part", F.when(F.col("blob").isNull(), "total").otherwise(F.col("name"))), "part")


def _pick(rows: DataFrame, *names: str) -> DataFrame:
    return rows.where(F.col("part").isin(*names)).select(*_COLUMNS)


def parent_key(word: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return (word.astype(np.int64) << 6) | kind


def _build(places: int, shared):
    """Merges a place's packets: its n-grams in order of word, class and context, where they occur, and its contexts for their homes."""

    def run(place: int, found: dict) -> list[tuple]:
        hot = shared.value[0].astype(np.int64)
        rows = [(place, "docs", at, 0, blob) for at, blob in found.get("docs", {}).items()]
        if "packet" not in found:
            return rows
        word, kind, context, trained, sizes = [], [], [], [], []
        batches = sorted(found["packet"])
        for b in batches:
            w, per, k, x, c, _, _ = get(found["packet"][b])
            word.append(np.repeat(w, per))
            kind.append(k)
            context.append(x)
            trained.append(c)
            sizes.append(len(k))
        word, kind, context, trained = (np.concatenate(a) for a in (word, kind, context, trained))
        order = np.lexsort((kind << 48 | context, word))
        word, kind, context = word[order], kind[order], context[order]
        first = runs(word, kind, context)
        c = np.add.reduceat(trained[order], first)
        where = np.empty(len(order), np.int64)
        where[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        for b, entry in zip(batches, np.split(where, np.cumsum(sizes)[:-1])):
            _, _, _, _, _, times, doc = get(found["packet"][b])
            rows.append((place, "occurs", b, 0, put(np.diff(entry, prepend=0), times, doc)))
        word, kind, context = word[first], kind[first], context[first]
        home = context % places
        order = np.lexsort((context, home))
        first = runs(home[order], context[order])
        keys, of_home = context[order][first], home[order][first]
        at = np.empty(len(order), np.int64)
        at[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        customers = np.bincount(at, c, len(keys)).astype(np.int64)
        for h in np.unique(of_home).tolist():
            mine = of_home == h
            rows.append((h, "context", place, 0, put(keys[mine], customers[mine])))
            rows.append((h, "told", place, 0, put(np.bincount(at, c > 0, len(keys)).astype(np.int64)[mine])))
        line, root = runs(word, kind), runs(word)
        raw = np.add.reduceat(c, root)
        is_hot = np.isin(word[root], hot)
        rows.append((place, "ngrams", 0, 0, put(at, c, np.diff(np.append(line, len(c))), kind[line], np.searchsorted(line, root), word[root] * is_hot)))
        tables = np.add.reduceat((c > 0).astype(np.int64), line)
        split = is_hot[np.searchsorted(root, line, "right") - 1]
        for name, n in (("N", raw.sum()), ("V", ((raw > 0) & ~is_hot).sum()), ("leaf1", (c == 1).sum()), ("leaf2", (c == 2).sum()), ("line1", (tables == 1)[~split].sum()), ("line2", (tables == 2)[~split].sum())):
            rows.append((place, name, 0, int(n), None))
        families = np.add.reduceat((tables > 0).astype(np.int64), np.searchsorted(line, root))
        rows += [(place, "root1", 0, int((families == 1)[~is_hot].sum()), None), (place, "root2", 0, int((families == 2)[~is_hot].sum()), None)]
        rows += [(place, "raw", int(w), int(n), None) for w, n in zip(word[root][is_hot], raw[is_hot])]
        rows += _shared_rows(place, word[line], kind[line], split, tables, (tables > 0).astype(np.int64))
        return rows

    return run


def _shared_rows(place: int, word: np.ndarray, kind: np.ndarray, split: np.ndarray, customers: np.ndarray, tables: np.ndarray) -> list[tuple]:
    """Totals of the classes over words that aren't split, and the customers of each line of a split word."""
    out = []
    for name, values in (("customers", customers), ("tables", tables)):
        total = np.bincount(kind[~split], values[~split], CLASSES).astype(np.int64)
        out += [(place, name, int(k), int(total[k]), None) for k in np.flatnonzero(total)]
    return out + [(place, "line", int(k), int(n), None) for k, n in zip(parent_key(word, kind)[split], customers[split])]


def _homes(place: int, found: dict) -> list[tuple]:
    """A home's contexts: for each place where it keeps which, and their customers in all."""
    origins = sorted(found.get("context", {}))
    if not origins:
        return []
    keys, customers = zip(*(get(found["context"][o]) for o in origins))
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, np.concatenate(customers), len(known)).astype(np.int64)
    parts = np.split(at, np.cumsum([len(k) for k in keys])[:-1])
    return [row for o, i in zip(origins, parts) for row in ((place, "index", o, 0, put(i)), (o, "cu", place, 0, put(total[i])))]


def _sum_tables(place: int, found: dict) -> list[tuple]:
    """Tables of a home's contexts in all, told to each place."""
    origins = sorted(found.get("index", {}))
    if not origins:
        return []
    index = [get(found["index"][o])[0] for o in origins]
    total = np.bincount(np.concatenate(index), np.concatenate([get(found["told"][o])[0] for o in origins])).astype(np.int64)
    return [(o, "tu", place, 0, put(total[i])) for o, i in zip(origins, index)]


class State:
    """Seating of a place, with the totals that it shares with others."""

    def __init__(self, found: dict, shared: dict, seats: bytes | None):
        if "arrays" not in found:  # the same for all samples
            found["arrays"] = (get(found["ngrams"][0]), np.concatenate([get(found["cu"][h])[0] for h in sorted(found["cu"])]))
        (self.at, self.c, per, self.kind, self.family, self.hot_word), self.cu = found["arrays"]
        self.line = np.repeat(np.arange(len(per)), per)
        self.root = np.repeat(np.arange(len(self.family)), np.diff(np.append(self.family, len(per))))
        word = self.hot_word[self.root]
        self.split = word > 0
        self.d, self.theta = shared["d"], shared["theta"]
        self.customers, self.tables = shared["customers"].astype(np.float64), shared["tables"].astype(np.float64)
        active = self.c > 1
        self.active = np.flatnonzero(active)
        self.t = np.minimum(self.c, 1)
        own = np.bincount(self.line, self.t, len(per)).astype(np.int64)
        self.up = np.minimum(own, 1)
        if seats is not None:
            t, up = get(seats)
            self.t[self.active] = t
            self.up = up
        self.own = np.bincount(self.line, self.t, len(per)).astype(np.int64)
        self.pc = self.own.copy()
        i = np.flatnonzero(self.split)
        known = [shared["lines"][k] for k in parent_key(word[i], self.kind[i]).tolist()]
        self.pc[i], self.up[i] = [k[0] for k in known], [k[1] for k in known]
        self.rc = np.bincount(self.root, self.up, len(self.family)).astype(np.int64)
        hot = np.flatnonzero(self.hot_word)
        self.rc[hot] = [shared["words"][w] for w in self.hot_word[hot].tolist()]
        self.roots = shared["roots"]
        self.tu = None

    def with_tables(self, told: dict[int, bytes]) -> State:
        self.tu = np.concatenate([get(told[h])[0] for h in sorted(told)])
        return self

    def p_root(self, customers: np.ndarray, total: float) -> np.ndarray:
        return np.maximum(customers - self.d[0], 1 - self.d[0]) / (self.theta + total)

    def p_line(self, i: np.ndarray, pc: np.ndarray, up: np.ndarray) -> np.ndarray:
        """Of the dish of line i in its class, with pc customers and up tables."""
        k = self.kind[i]
        base = self.p_root(self.rc[self.root[i]], self.roots)
        return (np.maximum(pc - self.d[1] * up, 0) + (self.theta + self.d[1] * self.tables[k]) * base) / (self.theta + self.customers[k])

    def seat_lines(self, rng: np.random.Generator) -> None:
        """The class restaurants' dishes, but for those of split words, which the driver seats."""
        todo = np.flatnonzero((self.pc > 1) & ~self.split)
        for block in range(BLOCKS):
            i = todo[block::BLOCKS]
            k, r, t = self.kind[i], self.root[i], self.up[i]
            base = self.p_root(self.rc[r] - t + 1, self.roots)
            new = draw_tables(self.pc[i], self.tables[k] - t, base, self.d[1], self.theta, rng)
            self.up[i] = new
            np.add.at(self.rc, r, new - t)
            self.roots += int((new - t).sum())
            self.tables += np.bincount(k, new - t, CLASSES)

    def seat_dishes(self, rng: np.random.Generator) -> None:
        for block in range(BLOCKS):
            i = self.active[block::BLOCKS]
            line, u, t = self.line[i], self.at[i], self.t[i]
            pc = self.pc[line] - t + 1  # the first customer's table is there in any case
            parent = self.p_line(line, pc, np.minimum(self.up[line], pc))
            new = draw_tables(self.c[i], self.tu[u] - t, parent, self.d[2], self.theta, rng)
            self.t[i] = new
            np.add.at(self.pc, line, new - t)
            np.add.at(self.tu, u, new - t)
            self.customers += np.bincount(self.kind[line], new - t, CLASSES)
        self.up = np.minimum(self.up, self.pc)

    def predictive(self, types: int) -> np.ndarray:
        """Of every n-gram, in training or not; `types` are the words at the root."""
        base = np.where(self.rc > 0, self.p_root(self.rc, self.roots), (self.theta + self.d[0] * types) / (self.theta + self.roots))
        k = self.kind
        parent = (np.maximum(self.pc - self.d[1] * self.up, 0) + (self.theta + self.d[1] * self.tables[k]) * base[self.root]) / (self.theta + self.customers[k])
        cu, tu = self.cu[self.at], self.tu[self.at]
        return (np.maximum(self.c - self.d[2] * self.t, 0) + (self.theta + self.d[2] * tu) * parent[self.line]) / (self.theta + cu)


def _sweep(shared, seed: int, number: int):
    def run(place: int, found: dict) -> list[tuple]:
        if "ngrams" not in found:
            return []
        rng = np.random.default_rng([seed, number, place])
        s = State(found, shared.value, found["seats"][number - 1] if "seats" in found else None).with_tables(found["tu"])
        if number > 1:
            s.seat_lines(rng)
        s.seat_dishes(rng)
        rows = [(place, "seats", number, 0, put(s.t[s.active], s.up))]
        tables = np.bincount(s.at, s.t, len(s.cu)).astype(np.int64)
        ends = np.cumsum([len(get(found["cu"][h])[0]) for h in sorted(found["cu"])])
        for h, part in zip(sorted(found["cu"]), np.split(tables, ends[:-1])):
            rows.append((h, "told", place, 0, put(part)))
        own = np.bincount(s.line, s.t, len(s.kind)).astype(np.int64)
        return rows + _shared_rows(place, s.hot_word[s.root], s.kind, s.split, own, np.minimum(s.up, own))

    return run


def _score(shared):
    """Of each batch with tokens in a place: sums over its documents."""

    def run(place: int, found: dict) -> list[tuple]:
        rows = [(place, "docs", at, 0, blob) for at, blob in found.get("docs", {}).items()]
        if "ngrams" not in found:
            return rows
        samples, known = shared.value
        p = 0.0
        for number, now in samples.items():
            told = {at - (number << 32): blob for at, blob in found["tu"].items() if at >> 32 == number}
            s = State(found, now, found["seats"][number]).with_tables(told)
            p = p + s.predictive(known["V"]) / len(samples)
        raw = np.bincount(s.root[s.line], s.c, len(s.family)).astype(np.int64)
        hot = np.flatnonzero(s.hot_word)
        raw[hot] = [known["raw"][w] for w in s.hot_word[hot].tolist()]
        raw = raw[s.root[s.line]]
        base = np.log10(raw + 1.0) - math.log10(known["N"] + known["V"] + 1)
        score, is_known = np.log10(p), raw > 0
        for batch, blob in found["occurs"].items():
            step, times, doc = get(blob)
            i = np.repeat(np.cumsum(step), times)
            at, local = np.unique(doc, return_inverse=True)
            sums = [np.bincount(local, x[i], len(at)) for x in (score, base)]
            rows.append((place, "sums", batch, 0, put(at, np.bincount(local, is_known[i], len(at)).astype(np.int64), *(x.view(np.uint64) for x in sums))))
        return rows

    return run


def _finish(total: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, null, held, size = get(pdf[pdf["name"] == "docs"]["blob"].iloc[0])
        known, score, base = np.zeros(len(ids), np.int64), np.zeros(len(ids)), np.zeros(len(ids))
        for blob in pdf[pdf["name"] == "sums"].sort_values("place")["blob"]:
            at, k, s, b = get(blob)
            known[at] += k
            score[at] += s.view(np.float64)
            base[at] += b.view(np.float64)
        score -= math.log10(CLASSES)
        out = pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "held_out": held > 0, "n_tokens": size, "n_known": known, "train_tokens": total, "base_score": base, "score": score, "perplexity": 10.0 ** (-score / size)})
        out.loc[null > 0, "doc_id"] = pd.NA
        return out

    return run


def _discount(n: dict, level: str) -> float:
    a, b = n.get(level + "1", 0), n.get(level + "2", 0)
    return min(0.95, max(0.1, a / max(a + 2 * b, 1)))


def _totals(rows: DataFrame) -> dict[str, dict[int, int]]:
    """Sums of the small rows over places: totals by class, and lines of split words, of which there are at most 2^20 words."""
    out: dict[str, dict[int, int]] = {}
    for r in _pick(rows, "total").groupBy("name", "at").agg(F.sum("n").alias("n")).collect():
        out.setdefault(r["name"], {})[r["at"]] = r["n"]
    return out


def _together(n: dict, tables: dict[int, int] | None, d: list[float], theta: float, rng: np.random.Generator | None) -> dict:
    """What all places share: class and root totals, and the lines of split words, seated here if `rng` is given."""
    lines = {k: (c, min(c, tables.get(k, 1) if tables else 1)) for k, c in n.get("line", {}).items()}
    out = {"d": d, "theta": theta}
    totals = {x: np.array([n.get(x, {}).get(k, 0) for k in range(CLASSES)], np.int64) for x in ("customers", "tables")}
    if rng is not None and lines:
        keys = np.array(sorted(lines), np.int64)
        c, t = (np.array([lines[k][i] for k in keys.tolist()], np.int64) for i in (0, 1))
        kind, word = keys & 63, keys >> 6
        _, at = np.unique(word, return_inverse=True)
        every = totals["tables"] + np.bincount(kind, t, CLASSES).astype(np.int64)
        rc = np.bincount(at, t)
        base = np.maximum(rc[at] - t + 1 - d[0], 1 - d[0]) / (theta + every.sum())
        new = draw_tables(c, (every[kind] - t).astype(np.float64), base, d[1], theta, rng)
        lines = {k: (int(a), int(b)) for k, a, b in zip(keys.tolist(), c, new)}
    words: dict[int, int] = {}
    for k, (c, t) in lines.items():
        words[k >> 6] = words.get(k >> 6, 0) + t
        totals["customers"][k & 63] += c
        totals["tables"][k & 63] += t
    return out | totals | {"lines": lines, "words": words, "roots": int(totals["tables"].sum())}


def score_documents(docs: DataFrame, theta: float = STRENGTH, burn_in: int = BURN_IN, samples: int = SAMPLES, seed: int = 5) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity for every row of docs(doc_id, text).

    Rows whose crc32 of the id modulo 7 is 2 are held out; all others, ids null
    included, train. Null and empty texts are the end token alone. base_score is
    the add-one unigram score of the tokens, score the model's log10 probability
    of them, from predictive probabilities averaged over `samples` sweeps after
    `burn_in`; perplexity is 10 ** (-score / n_tokens). A word that training lacks
    is the event of a new word in both. Rows with equal ids are scored each, and
    repeated texts count as often as they occur; other columns are ignored.

    Discounts are n1 / (n1 + 2 n2) of each level's customer counts at the first
    seating, of one table to a dish. Draws depend on the seed, the sweep and the
    place alone, so a lost task is repeated to the same state.
    """
    spark = docs.sparkSession
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), F.coalesce(fold("doc_id", 7) == 2, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    counted = {r["key"]: r["n"] for r in ids.select("text").mapInPandas(_frequent, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where((F.col("key") < 0) | (F.col("n") > PLACE_TOKENS // 4)).collect()}
    places = max(4, -(-counted.pop(-1, 0) // PLACE_TOKENS))
    hot = np.array(sorted(counted), np.uint64)
    parts = np.array([-(-4 * counted[k] // PLACE_TOKENS) for k in sorted(counted)], np.int64)
    dealing = spark.sparkContext.broadcast((hot, parts))
    built = _run(ids.mapInPandas(_deal(places, dealing), ROWS), _build(places, dealing))
    n = _totals(built)
    of_all = {k: v[0] for k, v in n.items() if 0 in v}
    raw = n.get("raw", {})
    known = {"N": of_all.get("N", 0), "V": of_all.get("V", 0) + sum(c > 0 for c in raw.values()), "raw": raw}
    d = [_discount(of_all, level) for level in ("root", "line", "leaf")]
    homes = _run(_pick(built, "context"), _homes)
    fixed = _pick(built, "ngrams").unionByName(_pick(homes, "cu"))
    tables = _run(_pick(homes, "index").unionByName(_pick(built, "told")), _sum_tables)
    shared, swept, state, kept = _together(n, None, d, theta, None), None, {}, []
    for number in range(1, burn_in + samples + 1):
        inputs = fixed.unionByName(_pick(tables, "tu"))
        if swept is not None:
            inputs = inputs.unionByName(_pick(swept, "seats"))
        before = (swept, tables)
        swept = _run(inputs, _sweep(spark.sparkContext.broadcast(shared), seed, number))
        tables = _run(_pick(homes, "index").unionByName(_pick(swept, "told")), _sum_tables)
        n, seated = _totals(swept), {k: t for k, (_, t) in shared["lines"].items()}
        if number > burn_in:
            state[number] = _together(n, seated, d, theta, None)
            kept.append((number, swept, tables))
        if number <= burn_in + 1:
            for old in before:
                discard(old)
        shared = _together(n, seated, d, theta, np.random.default_rng([seed, number]))
    final = fixed.unionByName(_pick(built, "occurs", "docs"))
    for number, seats, told in kept:
        final = final.unionByName(_pick(seats, "seats")).unionByName(_pick(told, "tu").withColumn("at", F.col("at") + (number << 32)))
    sums = _run(final, _score(spark.sparkContext.broadcast((state, known))))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return _pick(sums, "docs", "sums").groupBy("at").applyInPandas(_finish(known["N"]), schema)
