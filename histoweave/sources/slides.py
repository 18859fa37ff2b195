"""Compressed and tiled TIFF slides, read strip by strip and tile by tile.

A file (path, content, as Spark's binaryFile gives it) is only cut into its strips
and tiles where it is read; these are dealt to all tasks, which decode them, so one
large slide is the work of many. Classic and big files, both byte orders, strips and
tiles, together or a plane for each band; no compression, PackBits, LZW or deflate;
horizontal and floating-point predictors; samples of 8 to 64 bits, whole or floating.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tags of a directory that are read, and codes and sizes of field types.
WIDTH, HEIGHT, BITS, COMPRESSION, DESCRIPTION, STRIPS, BANDS, ROWS, STRIP_BYTES, X_RESOLUTION, Y_RESOLUTION, PLANES, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT = 256, 257, 258, 259, 270, 273, 277, 278, 279, 282, 283, 284, 317, 322, 323, 324, 325, 339
TYPES = {1: "B", 2: "B", 3: "H", 4: "I", 5: "II", 6: "b", 7: "B", 8: "h", 9: "i", 10: "ii", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
CHUNK = [("path", pa.string()), ("page", pa.int32()), ("chunk", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("w", pa.int64()), ("h", pa.int64()), ("stride", pa.int64()), ("bands", pa.int32()), ("band", pa.int32()), ("bits", pa.int32()), ("format", pa.int32()), ("order", pa.string()), ("compression", pa.int32()), ("predictor", pa.int32()), ("raw", pa.binary())]
PAGE = [("path", pa.string()), ("page", pa.int32()), ("width", pa.int64()), ("height", pa.int64()), ("bits", pa.int32()), ("bands", pa.int32()), ("compression", pa.int32()), ("chunks", pa.int32()), ("description", pa.string()), ("x_resolution", pa.float64()), ("y_resolution", pa.float64())]


def _schema(columns: list[tuple[str, pa.DataType]]) -> str:
    names = {pa.string(): "string", pa.int32(): "int", pa.int64(): "long", pa.float64(): "double", pa.binary(): "binary"}
    return ", ".join(f"{n} {names[t]}" for n, t in columns)


def directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple]]]:
    """Byte order and fields of each page."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    magic = struct.unpack_from(order + "H", data, 2)[0] if order and len(data) >= 8 else 0
    if magic not in (42, 43):
        raise ValueError("no TIFF")
    number, count, entry, inline = ("I", "H", 12, 4) if magic == 42 else ("Q", "Q", 20, 8)
    at, seen = struct.unpack_from(order + number, data, 4 if magic == 42 else 8)[0], set()
    while at:
        if at in seen:
            raise ValueError("directories go round")
        seen.add(at)
        n, first, fields = struct.unpack_from(order + count, data, at)[0], at + struct.calcsize(count), {}
        for p in range(first, first + n * entry, entry):
            tag, kind = struct.unpack_from(order + "HH", data, p)
            many = struct.unpack_from(order + number, data, p + 4)[0]
            if kind in TYPES:
                code = order + TYPES[kind] * many
                place = p + entry - inline
                fields[tag] = struct.unpack_from(code, data, place if struct.calcsize(code) <= inline else struct.unpack_from(order + number, data, place)[0])
        yield order, fields
        at = struct.unpack_from(order + number, data, first + n * entry)[0]


def _one(fields: dict[int, tuple], tag: int, default: int | None = None) -> int:
    found = fields.get(tag, (default,))[0]
    if found is None:
        raise ValueError(f"a page lacks field {tag}")
    return int(found)


def _ratio(fields: dict[int, tuple], tag: int) -> float | None:
    return fields[tag][0] / fields[tag][1] if tag in fields and fields[tag][1] else None


def _grid(f: dict[int, tuple]) -> tuple[tuple, tuple, int, int]:
    """Places and lengths of a page's chunks, and the size that each has before the page's border cuts it."""
    if TILES in f:
        return f[TILES], f[TILE_BYTES], _one(f, TILE_WIDTH), _one(f, TILE_HEIGHT)
    return f.get(STRIPS, ()), f.get(STRIP_BYTES, ()), _one(f, WIDTH), min(_one(f, ROWS, 2**32 - 1), _one(f, HEIGHT))


def _chunks_of(path: str, data: bytes, layers: set[int] | None) -> Iterator[tuple]:
    for page, (order, f) in enumerate(directories(data)):
        if layers is not None and page not in layers:
            continue
        places, sizes, w, h = _grid(f)
        width, height, bands = _one(f, WIDTH), _one(f, HEIGHT), _one(f, BANDS, 1)
        apart = _one(f, PLANES, 1) == 2
        across = -(-width // w)
        down = -(-height // h)
        if len(places) != across * down * (bands if apart else 1) or len(places) != len(sizes):
            raise ValueError(f"{path}, page {page}: {len(places)} chunks")
        if len(set(f.get(BITS, (1,)))) > 1:
            raise ValueError(f"{path}, page {page}: bands of different depths")
        for k, (at, n) in enumerate(zip(places, sizes)):
            x, y = k % across * w, k // across % down * h
            if at + n > len(data):
                raise ValueError(f"{path}, page {page}: chunk {k} ends after the file")
            yield path, page, k, x, y, min(w, width - x), min(h, height - y), w, 1 if apart else bands, k // (across * down), _one(f, BITS, 1), _one(f, FORMAT, 1), order, _one(f, COMPRESSION, 1), _one(f, PREDICTOR, 1), data[at : at + n]


def _pages_of(path: str, data: bytes) -> Iterator[tuple]:
    for page, (_, f) in enumerate(directories(data)):
        text = bytes(f[DESCRIPTION]).rstrip(b"\0").decode("utf-8", "replace") if DESCRIPTION in f else None
        yield path, page, _one(f, WIDTH), _one(f, HEIGHT), _one(f, BITS, 1), _one(f, BANDS, 1), _one(f, COMPRESSION, 1), len(_grid(f)[0]), text, _ratio(f, X_RESOLUTION), _ratio(f, Y_RESOLUTION)


def packbits(data: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += 2 + n
        else:
            out += data[at + 1 : at + 2] * (257 - n if n > 128 else 0)
            at += 2 if n > 128 else 1
    return bytes(out)


def lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the highest first; 256 clears the table, 257 ends, and widths grow one code early."""
    fresh = [bytes((i,)) for i in range(256)] + [b"", b""]
    table, out, last, width, held, bits = list(fresh), [], b"", 9, 0, 0
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table, last, width = list(fresh), b"", 9
            continue
        if code > len(table) or (code == len(table) and not last):
            raise ValueError(f"LZW code {code} of {len(table)}")
        now = table[code] if code < len(table) else last + last[:1]
        out.append(now)
        if last:
            table.append(last + now[:1])
        last, width = now, min(12, max(9, (len(table) + 1).bit_length()))
    return b"".join(out)


def decoded(raw: bytes, c: dict) -> np.ndarray:
    """Rows, columns and bands of a chunk, within the page."""
    codecs = {1: bytes, 5: lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: packbits}
    if c["compression"] not in codecs or c["bits"] not in (8, 16, 32, 64) or c["format"] not in (1, 2, 3):
        raise ValueError(f"{c['path']}, page {c['page']}: compression {c['compression']}, {c['bits']} bits, format {c['format']}")
    size, line = c["bits"] // 8, c["stride"] * c["bands"]
    plain = np.frombuffer(codecs[c["compression"]](raw), np.uint8)
    need = line * c["h"] * size
    if len(plain) < need:
        raise ValueError(f"{c['path']}, page {c['page']}, chunk {c['chunk']}: {len(plain)} of {need} bytes")
    plain = plain[:need]
    kind = f"{c['order']}{'uif'[c['format'] - 1]}{size}"
    if c["predictor"] == 3:  # bytes of a row by significance, the highest first, and then differences of bytes
        b = np.cumsum(plain.reshape(c["h"], -1, c["bands"]), axis=1, dtype=np.uint8).reshape(c["h"], size, line)
        values = np.ascontiguousarray(b.transpose(0, 2, 1)).view(f">f{size}")[..., 0]
    else:
        values = plain.view(kind if c["predictor"] == 1 else f"{c['order']}u{size}").reshape(c["h"], line)
        if c["predictor"] == 2:
            whole = values.astype(f"=u{size}").reshape(c["h"], c["stride"], c["bands"])
            values = np.cumsum(whole, axis=1, dtype=whole.dtype).view(f"={'uif'[c['format'] - 1]}{size}")
    return values.reshape(c["h"], c["stride"], c["bands"])[:, : c["w"]]


def _read(each, columns: list[tuple[str, pa.DataType]], some: int):
    """Rows of each file, some at a time."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(zip(*rows), columns)], names=[n for n, _ in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            for path, content in zip(b.column("path"), b.column("content")):
                for row in each(path.as_py(), content.as_py()):
                    held.append(row)
                    if len(held) == some:
                        yield batch(held)
                        held = []
        if held:
            yield batch(held)

    return run


def pages(files: DataFrame) -> DataFrame:
    """path, page, width, height, bits, bands, compression, chunks, description and resolutions of each page of files(path, content). What is no TIFF fails; nulls are no files."""
    return files.where("content is not null").select("path", "content").mapInArrow(_read(_pages_of, PAGE, 1000), _schema(PAGE))


def chunks(files: DataFrame, layers: set[int] | None = None, tasks: int | None = None) -> DataFrame:
    """The strips and tiles of the pages named, by number from 0, or of all, not decoded yet and dealt evenly to `tasks`."""
    cut = files.where("content is not null").select("path", "content").mapInArrow(_read(lambda p, d: _chunks_of(p, d, layers), CHUNK, 16), _schema(CHUNK))
    by = (F.xxhash64("path", "page", "chunk"),)
    return cut.repartition(tasks, *by) if tasks else cut.repartition(*by)


def decode(parts: DataFrame) -> DataFrame:
    """path, page, chunk, x, y, w, h, bands, band and values: what each of `chunks` holds, row by row and band by band, as doubles."""
    names = [("path", pa.string()), ("page", pa.int32()), ("chunk", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("w", pa.int64()), ("h", pa.int64()), ("bands", pa.int32()), ("band", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                c = {n: b.column(n)[i].as_py() for n, _ in CHUNK}
                values = decoded(c.pop("raw"), c).astype(np.float64).ravel()
                yield pa.RecordBatch.from_arrays([*(pa.array([c[n]], t) for n, t in names), pa.array([values])], names=[*(n for n, _ in names), "values"])

    return parts.mapInArrow(run, _schema(names) + ", values array<double>")


def pixels(files: DataFrame, layers: set[int] | None = None, tasks: int | None = None) -> DataFrame:
    """(path, page, band, x, y, v) of files(path, content)."""
    each = decode(chunks(files, layers, tasks)).select("path", "page", "x", "y", "w", "bands", "band", F.posexplode("values").alias("k", "v"))
    k, w = F.col("k").cast("long"), F.col("w")
    place = F.floor(k / F.col("bands"))
    return each.select("path", "page", (F.col("band") + k % F.col("bands")).cast("int").alias("band"), (F.col("x") + place % w).alias("x"), (F.col("y") + F.floor(place / w)).alias("y"), "v")


def layer_groups(of: DataFrame, groups: list[int], layers: list[int]) -> DataFrame:
    """(path, pages, ok) of pages(path, page, width, height, bits): whether a file has just the pages of all groups, the layers asked for, from 1, are of one group, and that group's pages are of one size and depth."""
    ends = [sum(groups[: k + 1]) for k in range(len(groups))]
    asked = {next((k for k, e in enumerate(ends) if layer <= e), None) for layer in layers}
    mine = next(iter(asked)) if len(asked) == 1 and None not in asked and min(layers) > 0 else None
    number: Column = F.col("page") + 1
    inside = number.between(ends[mine] - groups[mine] + 1, ends[mine]) if mine is not None else F.lit(False)
    shape = F.when(inside, F.struct("width", "height", "bits"))
    return of.groupBy("path").agg(F.count("*").alias("pages"), ((F.count("*") == sum(groups)) & F.lit(mine is not None) & F.coalesce(F.min(shape) == F.max(shape), F.lit(False))).alias("ok"))


def encoded(sheets: list[tuple[np.ndarray, dict]], order: str = "<") -> bytes:
    """A file of pages (rows x columns array, how), `how` with compression 1 or 8, predictor 1 or 2, tile (sides, else strips of `rows`) and description."""
    out, back = bytearray({"<": b"II*\0", ">": b"MM\0*"}[order] + bytes(4)), 4
    for a, how in sheets:
        h, w = a.shape
        tile, rows = how.get("tile"), how.get("rows", h)
        tw, th = (tile, tile) if tile else (w, rows)
        places, sizes = [], []
        for y in range(0, h, th):
            for x in range(0, w, tw):
                part = a[y : y + th, x : x + tw]
                if tile:
                    part = np.pad(part, ((0, th - part.shape[0]), (0, tw - part.shape[1])))
                if how.get("predictor", 1) == 2:
                    part = np.diff(part, axis=1, prepend=part[:, :1] * 0)
                raw = part.astype(part.dtype.newbyteorder(order)).tobytes()
                raw = zlib.compress(raw) if how.get("compression", 1) == 8 else raw
                places.append(len(out))
                sizes.append(len(raw))
                out += raw
        kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
        text = how.get("description", "").encode() + b"\0"
        fields = [(WIDTH, 4, [w]), (HEIGHT, 4, [h]), (BITS, 3, [8 * a.dtype.itemsize]), (COMPRESSION, 3, [how.get("compression", 1)]), (DESCRIPTION, 2, list(text)), *([] if tile else [(STRIPS, 4, places), (ROWS, 4, [rows]), (STRIP_BYTES, 4, sizes)]), (PREDICTOR, 3, [how.get("predictor", 1)]), *([(TILE_WIDTH, 4, [tw]), (TILE_HEIGHT, 4, [th]), (TILES, 4, places), (TILE_BYTES, 4, sizes)] if tile else []), (FORMAT, 3, [kind])]
        entries = b""
        for tag, code, values in fields:
            body = struct.pack(order + TYPES[code] * len(values), *values)
            if len(body) > 4:
                at = len(out)
                out += body + bytes(len(body) % 2)
                body = struct.pack(order + "I", at)
            entries += struct.pack(order + "HHI", tag, code, len(values)) + body.ljust(4, b"\0")
        struct.pack_into(order + "I", out, back, len(out))
        out += struct.pack(order + "H", len(fields)) + entries
        back = len(out)
        out += bytes(4)
    return bytes(out)
