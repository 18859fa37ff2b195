"""TIFF pages: written by built-in functions, and read from (path, content) tables such as Spark's binaryFile gives.

Pages are uncompressed grey ones of 8 bits. The reader takes both byte orders and 8
or 16 bits, and knows the resolution and description fields of slide scanners.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = "page int, width int, height int, bits int, description string, x_resolution double, y_resolution double, samples array<int>"
#: Bytes of a directory of the writer: its length, ten fields and the place of the next one.
_DIRECTORY = 2 + 12 * 10 + 4
_TYPES = {1: ("B", 1), 2: ("B", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8)}


def _little(value: Column | int, size: int) -> Column:
    """Hexadecimal digits of a little-endian number."""
    digits = F.lpad(F.hex((value if isinstance(value, Column) else F.lit(value)).cast("long")), 2 * size, "0")
    return F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(size))])


def write_pages(pages: Column) -> Column:
    """A TIFF of an array of structs (width, height, samples), samples an array of integers from 0 to 255."""
    size = lambda p: F.size(p["samples"])

    def before(i: Column) -> Column:
        """Where page i's samples start."""
        return F.aggregate(F.slice(pages, F.lit(1), i), F.lit(8), lambda at, p: at + size(p) + _DIRECTORY)

    def field(tag: int, kind: int, value: Column | int) -> Column:
        return F.concat(_little(tag, 2), _little(kind, 2), _little(1, 4), _little(value, 4))

    def page(p: Column, i: Column) -> Column:
        start = before(i)
        following = before(i + 1) + size(F.try_element_at(pages, i + 2))
        n = size(p)
        fields = [field(256, 4, p["width"]), field(257, 4, p["height"]), field(258, 4, 8), field(259, 4, 1), field(262, 4, 1), field(273, 4, start), field(277, 4, 1), field(278, 4, p["height"]), field(279, 4, n), field(296, 4, 1)]
        return F.concat(F.array_join(F.transform(p["samples"], lambda v: _little(v, 1)), ""), _little(10, 2), *fields, _little(F.when(i + 1 < F.size(pages), following).otherwise(0), 4))

    head = F.concat(F.lit("49492A00"), _little(8 + size(pages[0]), 4))
    return F.unhex(F.concat(head, F.array_join(F.transform(pages, page), "")))


def directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple]]]:
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if order is None:
        raise ValueError("no TIFF")
    (at,) = struct.unpack_from(order + "I", data, 4)
    seen = set()
    while at:
        if at in seen:
            raise ValueError("directories go round")
        seen.add(at)
        (n,) = struct.unpack_from(order + "H", data, at)
        found = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
            code, size = _TYPES.get(kind, ("", 1))
            if code:
                where = at + 10 + 12 * k if size * count <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * k)[0]
                found[tag] = struct.unpack_from(order + code * count, data, where)
        yield order, found
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)


def _rows(data: bytes, layers: set[int] | None) -> Iterator[tuple]:
    for k, (order, f) in enumerate(directories(data)):
        if f.get(259, (1,))[0] != 1 or f.get(258, (8,))[0] not in (8, 16):
            raise ValueError(f"page {k}: compression {f.get(259)}, bits {f.get(258)}")
        over = lambda tag, f=f: f[tag][0] / f[tag][1] if tag in f and f[tag][1] else None
        samples = None
        if layers is None or k in layers:
            raw = b"".join(data[at : at + n] for at, n in zip(f[273], f[279]))
            bits = f.get(258, (8,))[0]
            samples = list(struct.unpack(f"{order}{len(raw) * 8 // bits}{'B' if bits == 8 else 'H'}", raw))
        yield k, f[256][0], f[257][0], f.get(258, (8,))[0], bytes(f[270]).rstrip(b"\0").decode("utf-8", "replace") if 270 in f else None, over(282), over(283), samples


def read_pages(files: DataFrame, layers: set[int] | None = None) -> DataFrame:
    """A row for each page of files(path, content); samples only of the layers named, by page from 0. A file that is none, or is compressed, fails."""
    names = ["path", *(c.split()[0] for c in PAGE.split(", "))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for path, content in zip(pdf["path"], pdf["content"]):
                yield pd.DataFrame([(path, *r) for r in _rows(bytes(content), layers)], columns=names)

    return files.select("path", "content").mapInPandas(run, f"path string, {PAGE}")


def layer_groups(pages: DataFrame, groups: list[int]) -> DataFrame:
    """(path, layers, ok): whether a file has as many full-size pages as the layer groups have layers in all."""
    full = pages.groupBy("path").agg(F.max("width").alias("w"))
    count = pages.join(full, "path").where("width = w").groupBy("path").agg(F.count("*").alias("layers"))
    return count.select("path", "layers", (F.col("layers") == sum(groups)).alias("ok"))


def zoom_levels(pages: DataFrame) -> DataFrame:
    """(path, zoom, width, height, pages): pages of one size are one zoom level, whose factor is that of the largest page's width."""
    top = pages.groupBy("path").agg(F.max("width").alias("top"))
    return pages.join(top, "path").groupBy("path", F.rint(F.col("top") / F.col("width")).cast("int").alias("zoom"), "width", "height").agg(F.count("*").alias("pages"))
