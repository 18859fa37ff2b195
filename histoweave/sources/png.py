"""Grey PNG images: written row by row in tasks, and read back."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(name: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))


def encoded(a: np.ndarray) -> bytes:
    """Rows x columns of 8 or 16 bits; each row as its differences upwards."""
    h, w = a.shape
    wide = a.dtype.itemsize
    rows = a.astype(f">u{wide}").view(np.uint8).reshape(h, w * wide)
    up = rows - np.vstack([np.zeros((1, w * wide), np.uint8), rows[:-1]])[:h]
    body = np.hstack([np.full((h, 1), 2, np.uint8), up]).tobytes()
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8 * wide, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(body)) + _chunk(b"IEND", b"")


def _paeth(a: int, b: int, c: int) -> int:
    p = a + b - c
    return min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]


def decoded(data: bytes) -> np.ndarray:
    """Of a grey image of 8 or 16 bits that is not interlaced, with all five filters; checksums are checked."""
    if data[:8] != SIGNATURE:
        raise ValueError("no PNG")
    at, body, head = 8, [], None
    while at < len(data):
        (n,), name = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        part = data[at + 8 : at + 8 + n]
        if len(part) < n or struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(name + part):
            raise ValueError(f"damaged {name!r}")
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif name == b"IDAT":
            body.append(part)
        at += 12 + n
    if head is None or head[2] not in (8, 16) or head[3] or head[6]:
        raise ValueError(f"not a plain grey image: {head}")
    w, h, wide = head[0], head[1], head[2] // 8
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(h, 1 + w * wide)
    out = np.zeros((h + 1, w * wide), np.uint8)
    for y, line in enumerate(lines):
        kind, row, above = int(line[0]), line[1:], out[y]
        if kind == 2:
            row = row + above
        elif kind == 1:
            row = np.cumsum(row.reshape(-1, wide), axis=0, dtype=np.uint8).ravel()
        elif kind in (3, 4):
            made = [0] * wide
            for i, v in enumerate(row.tolist()):
                left, up, corner = made[i], int(above[i]), int(above[i - wide]) if i >= wide else 0
                made.append((v + ((left + up) // 2 if kind == 3 else _paeth(left, up, corner))) & 255)
            row = np.array(made[wide:], np.uint8)
        elif kind:
            raise ValueError(f"filter {kind}")
        out[y + 1] = row
    return out[1:].view(f">u{wide}").astype(np.int64)


def write(width: Column, samples: Column, bits: int = 8) -> Column:
    """The content of an image of `width` columns, of an array of whole numbers in order of rows; what the bits can't hold is clipped."""

    @F.pandas_udf("binary")
    def written(w: pd.Series, v: pd.Series) -> pd.Series:
        return pd.Series([encoded(np.clip(np.asarray(x, np.int64), 0, 2**bits - 1).astype(f"u{bits // 8}").reshape(-1, n)) for n, x in zip(w, v)])

    return written(width, samples)


def read(files: DataFrame) -> DataFrame:
    """path, width, height and samples of files(path, content); what is no grey PNG fails."""

    @F.pandas_udf("width int, height int, samples array<int>")
    def found(content: pd.Series) -> pd.DataFrame:
        images = [decoded(c) for c in content]
        return pd.DataFrame({"width": [a.shape[1] for a in images], "height": [a.shape[0] for a in images], "samples": [a.ravel() for a in images]})

    return files.select("path", found("content").alias("f")).select("path", "f.*")
