"""TIFF media columns: directories, PackBits, LZW and deflate, strips and tiles, predictors; one row per page.

The reader takes any baseline byte layout: both byte orders, classic TIFF, 1 to
4 byte unsigned samples, chunky or planar. The writer makes 8-bit grey pages.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
NAMES = {NONE: "none", LZW: "lzw", DEFLATE: "deflate", OLD_DEFLATE: "deflate", PACKBITS: "packbits"}
#: Bytes of a value by TIFF field type.
_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4}
_CODES = {1: "B", 3: "H", 4: "I", 13: "I", 6: "b", 8: "h", 9: "i"}
#: Rows of samples of a page that texts are stored in, and bytes of samples that a page may have to be read.
PAGE_ROWS, PAGE_BYTES = 512, 1 << 31
CLEAR, END = 256, 257


class BadTiff(ValueError):
    """The bytes are no TIFF that this reader knows."""


def packbits_encode(data: bytes) -> bytes:
    """Runs of three and more equal bytes as pairs, all else as literals of up to 128 bytes."""
    a = np.frombuffer(data, np.uint8)
    if not len(a):
        return b""
    starts = np.concatenate(([0], np.flatnonzero(a[1:] != a[:-1]) + 1))
    lengths = np.diff(np.append(starts, len(a)))
    out, lit = bytearray(), 0

    def literals(lo: int, hi: int) -> None:
        for p in range(lo, hi, 128):
            q = min(hi, p + 128)
            out.append(q - p - 1)
            out.extend(data[p:q])

    for s, n in zip(starts[lengths >= 3].tolist(), lengths[lengths >= 3].tolist()):
        literals(lit, s)
        for p in range(0, n, 128):
            k = min(128, n - p)
            if k == 1:
                out += bytes((0, data[s]))
            else:
                out += bytes((257 - k, data[s]))
        lit = s + n
    literals(lit, len(data))
    return bytes(out)


def packbits_decode(data: bytes, most: int = PAGE_BYTES) -> bytes:
    """Up to about `most` bytes of it, as the other decoders."""
    out, i, n = bytearray(), 0, len(data)
    while i < n and len(out) < most:
        h = data[i]
        if h < 128:
            out += data[i + 1 : i + 2 + h]
            i += h + 2
        else:
            if h > 128:
                if i + 1 >= n:
                    raise BadTiff("a PackBits run ends early")
                out += data[i + 1 : i + 2] * (257 - h)
            i += 2 if h > 128 else 1
    return bytes(out)


def _pack_codes(codes: list[int], widths: list[int]) -> bytes:
    """Codes of 9 to 12 bits, the highest bit first."""
    c, w = np.array(codes, np.uint16), np.array(widths)
    bits = np.unpackbits(c.astype(">u2").view(np.uint8).reshape(-1, 2), axis=1)
    keep = np.arange(16)[None, :] >= 16 - w[:, None]
    return np.packbits(bits[keep]).tobytes()


def lzw_encode(data: bytes) -> bytes:
    codes, widths = [CLEAR], [9]
    known: dict[bytes, int] = {}
    size, width, prefix = 258, 9, b""
    for i in range(len(data)):
        longer = prefix + data[i : i + 1]
        if len(longer) == 1 or longer in known:
            prefix = longer
            continue
        codes.append(known[prefix] if len(prefix) > 1 else prefix[0])
        widths.append(width)
        known[longer] = size
        size += 1
        if size == (1 << width):  # one code early, as TIFF has it
            width += 1
        if size == 4095:
            codes.append(CLEAR)
            widths.append(12)
            known, size, width = {}, 258, 9
        prefix = data[i : i + 1]
    if prefix:
        codes.append(known[prefix] if len(prefix) > 1 else prefix[0])
        widths.append(width)
        size += 1
        if size == (1 << width) and width < 12:
            width += 1
    codes.append(END)
    widths.append(width)
    return _pack_codes(codes, widths)


_SINGLE = [bytes((i,)) for i in range(256)] + [b"", b""]


def lzw_decode(data: bytes, most: int = PAGE_BYTES) -> bytes:
    out, strings, width, old = [], list(_SINGLE), 9, b""
    acc = have = size = 0
    for byte in data:
        acc = (acc << 8) | byte
        have += 8
        if have < width:
            continue
        have -= width
        code = acc >> have
        acc &= (1 << have) - 1
        if code == CLEAR:
            strings, width, old = list(_SINGLE), 9, b""
            continue
        if code == END:
            return b"".join(out)
        if code < len(strings):
            now = strings[code]
        elif old and code == len(strings):
            now = old + old[:1]
        else:
            raise BadTiff(f"LZW code {code} is not known yet")
        out.append(now)
        size += len(now)
        if size >= most:
            break
        if old and len(strings) < 4096:
            strings.append(old + now[:1])
            if len(strings) + 1 >= (1 << width) and width < 12:
                width += 1
        old = now
    return b"".join(out)


ENCODERS = {NONE: bytes, LZW: lzw_encode, DEFLATE: lambda b: zlib.compress(b, 6), PACKBITS: packbits_encode}


def _inflate(data: bytes, most: int) -> bytes:
    return zlib.decompressobj().decompress(data, max(most, 1))


DECODERS = {NONE: lambda data, most: data, LZW: lzw_decode, DEFLATE: _inflate, OLD_DEFLATE: _inflate, PACKBITS: packbits_decode}
#: Bytes with their bits in reverse order, for files whose fill order is 2.
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def _predict(block: np.ndarray) -> np.ndarray:
    out = block.copy()
    out[:, 1:] = block[:, 1:] - block[:, :-1]
    return out


@dataclass(frozen=True)
class Layout:
    """How pages are stored."""

    compression: int = DEFLATE
    predictor: int = 1
    tile: int = 0  # side of square tiles, a multiple of 16; 0: strips
    rows_per_strip: int = 128


def write(pages: list[np.ndarray], layout: Layout) -> bytes:
    """A little-endian TIFF of 8-bit grey pages."""
    out = bytearray(b"II*\0" + bytes(4))
    link = 4
    encode = ENCODERS[layout.compression]
    for image in pages:
        h, w = image.shape
        if layout.tile:
            t = layout.tile
            padded = np.zeros((-(-h // t) * t, -(-w // t) * t), np.uint8)
            padded[:h, :w] = image
            blocks = [padded[y : y + t, x : x + t] for y in range(0, h, t) for x in range(0, w, t)]
        else:
            blocks = [image[y : y + layout.rows_per_strip] for y in range(0, h, layout.rows_per_strip)]
        offsets, counts = [], []
        for b in blocks:
            coded = encode((_predict(b) if layout.predictor == 2 else b).tobytes())
            offsets.append(len(out))
            counts.append(len(coded))
            out += coded + bytes(len(coded) % 2)
        fields = [(256, 4, [w]), (257, 4, [h]), (258, 3, [8]), (259, 3, [layout.compression]), (262, 3, [1]), (277, 3, [1])]
        if layout.tile:
            fields += [(322, 4, [layout.tile]), (323, 4, [layout.tile]), (324, 4, offsets), (325, 4, counts)]
        else:
            fields += [(273, 4, offsets), (278, 4, [layout.rows_per_strip]), (279, 4, counts)]
        if layout.predictor != 1:
            fields.append((317, 3, [layout.predictor]))
        entries = b""
        for tag, kind, values in sorted(fields):
            raw = struct.pack(f"<{len(values)}{_CODES[kind]}", *values)
            if len(raw) > 4:
                at = len(out)
                out += raw
                raw = struct.pack("<I", at)
            entries += struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(fields)) + entries
        link = len(out)
        out += bytes(4)
    return bytes(out)


def directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple]]]:
    """Byte order and the fields of each image directory."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise BadTiff("no TIFF header")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at:
        if at in seen or at + 2 > len(data):
            raise BadTiff("the directory chain is broken")
        seen.add(at)
        (n,) = struct.unpack_from(order + "H", data, at)
        fields = {}
        for e in range(at + 2, at + 2 + 12 * n, 12):
            tag, kind, count = struct.unpack_from(order + "HHI", data, e)
            size = _SIZES.get(kind, 1) * count
            where = e + 8 if size <= 4 else struct.unpack_from(order + "I", data, e + 8)[0]
            if kind in _CODES:
                fields[tag] = struct.unpack_from(f"{order}{count}{_CODES[kind]}", data, where)
        yield order, fields
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)


def decode_page(data: bytes, order: str, f: dict[int, tuple]) -> np.ndarray:
    """Samples of a page as (height, width, samples per pixel)."""
    try:
        w, h, n = f[256][0], f[257][0], f.get(277, (1,))[0]
        depth, how = f.get(258, (1,))[0], f.get(259, (NONE,))[0]
        planar, predictor = f.get(284, (1,))[0], f.get(317, (1,))[0]
        tiled = 324 in f
        offsets, counts = (f[324], f[325]) if tiled else (f[273], f.get(279) or (len(data) - f[273][0],))
        bw, bh = (f[322][0], f[323][0]) if tiled else (w, min(f.get(278, (h,))[0], h))
        fill = f.get(266, (1,))[0]
    except (KeyError, IndexError) as e:
        raise BadTiff(f"a field is missing: {e}") from e
    if depth not in (8, 16, 32) or how not in DECODERS or predictor not in (1, 2) or planar not in (1, 2) or fill not in (1, 2):
        raise BadTiff(f"depth {depth}, compression {how}, predictor {predictor}, planes {planar}, fill order {fill}")
    if min(w, h, n, bw, bh) < 1 or w * h * n * depth // 8 > PAGE_BYTES or bw * bh * n * depth // 8 > PAGE_BYTES:
        raise BadTiff(f"{w} x {h} pixels of {n} samples in blocks of {bw} x {bh}")
    kind, chunk = np.dtype(f"{order}u{depth // 8}"), n if planar == 1 else 1
    out = np.zeros((h, w, n), kind.newbyteorder("="))
    across, down = -(-w // bw), -(-h // bh)
    blocks = across * down * (n if planar == 2 else 1)
    if min(len(offsets), len(counts)) < blocks:
        raise BadTiff(f"{min(len(offsets), len(counts))} of {blocks} strips or tiles")
    for i, (at, size) in enumerate(zip(offsets[:blocks], counts)):
        plane, k = divmod(i, across * down)
        y, x = k // across * bh, k % across * bw
        rows = bh if tiled else min(bh, h - y)
        coded = data[at : at + size]
        raw = DECODERS[how](coded.translate(_REVERSED) if fill == 2 else coded, rows * bw * chunk * kind.itemsize)
        if len(raw) < rows * bw * chunk * kind.itemsize:
            raise BadTiff("a strip or tile is too short")
        block = np.frombuffer(raw, kind, rows * bw * chunk).reshape(rows, bw, chunk)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=kind.newbyteorder("="))
        part = block[: h - y, : w - x]
        if planar == 1:
            out[y : y + rows, x : x + bw] = part
        else:
            out[y : y + rows, x : x + bw, plane] = part[:, :, 0]
    return out


def read(data: bytes) -> Iterator[tuple[np.ndarray, dict[int, tuple]]]:
    for order, fields in directories(data):
        yield decode_page(data, order, fields), fields


PAGE = "page int, width int, height int, samples int, compression string, predictor int, layout string, mean double, low int, high int, pixels binary, error string"


def _page_rows(data: bytes) -> Iterator[tuple]:
    n = 0
    try:
        for a, f in read(data):
            yield n, a.shape[1], a.shape[0], a.shape[2], NAMES[f.get(259, (NONE,))[0]], f.get(317, (1,))[0], "tiles" if 324 in f else "strips", float(a.mean()) if a.size else None, int(a.min()) if a.size else None, int(a.max()) if a.size else None, a.tobytes(), None
            n += 1
    except (BadTiff, struct.error, zlib.error, OverflowError) as e:
        yield n, *[None] * 10, str(e)


def _page_frame(key, row: tuple, names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame([row], columns=names).astype({c: "Int64" for c in ("width", "height", "samples", "predictor", "low", "high")})
    out.insert(0, "key", key)
    return out


def pages(media: DataFrame, key: str, content: str) -> DataFrame:
    """One row per page of a binary TIFF column, after the key.

    A null content gives no row; broken files give the pages before the fault and
    then one row with `error` set and the other fields null. Pages without pixels,
    of more than PAGE_BYTES, or with too few strips or tiles are faults; surplus
    strips are ignored. Rows with null or equal keys are read each. A task holds one page
    at a time, besides its file.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in PAGE.split(", ")]
        for pdf in batches:
            for k, data in zip(pdf["key"], pdf["content"]):
                if data is None:
                    continue
                yield from (_page_frame(k, row, names) for row in _page_rows(bytes(data)))

    return media.select(F.col(key).alias("key"), F.col(content).cast("binary").alias("content")).mapInPandas(run, f"key {media.schema[key].dataType.simpleString()}, {PAGE}")


def layout_of(payload: bytes) -> Layout:
    """Equal payloads, equal layouts; all codecs, strips, tiles and predictors occur, the slow LZW for one in 16."""
    c = zlib.crc32(payload)
    return Layout({0: NONE, 1: LZW, 2: PACKBITS, 3: PACKBITS}.get(c % 16, DEFLATE), 1 + (c >> 4) % 2, 64 * ((c >> 5) % 2))


def payload_of(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw)), len(raw)


def text_to_tiff(payload: bytes) -> bytes:
    image = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    return write([image[y : y + PAGE_ROWS] for y in range(0, len(image), PAGE_ROWS)], layout_of(payload))


def text_media(docs: DataFrame) -> DataFrame:
    """Digests of every text of docs(doc_id, text), stored as TIFF pages of 64 samples a row and read back.

    doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256 and feature (pages, layout and the mean, extremes and horizontal
    variation of the samples). Null and empty texts are 64 zero samples. Rows with
    equal or null ids are given each.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                payload, n = payload_of(text)
                media = text_to_tiff(payload)
                back, total, low, high, turn, count, kind = hashlib.sha256(), 0, 255, 0, 0, 0, ""
                tail = b""
                for a, f in read(media):
                    raw = a.tobytes()
                    back.update(raw)
                    tail = raw[-64:]
                    total += int(a.sum(dtype=np.int64))
                    low, high = min(low, int(a.min())), max(high, int(a.max()))
                    turn += int(np.abs(np.diff(a[:, :, 0].astype(np.int16), axis=1)).sum())
                    count += 1
                    kind = f"{NAMES[f[259][0]]},{f.get(317, (1,))[0]},{'tiles' if 324 in f else 'strips'}"
                feature = f"pages={count};layout={kind};mean={total / len(payload):.4f};min={low};max={high};variation={turn / len(payload):.4f}"
                rows.append((n, len(payload), back.hexdigest(), zlib.crc32(tail), len(media), hashlib.sha256(media).hexdigest(), feature))
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
            yield out

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
