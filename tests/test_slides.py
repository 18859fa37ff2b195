"""Compressed and tiled TIFF slides, from files written by hand."""

import struct
import zlib

import numpy as np
import pytest

from histoweave.sources import slides


def files(spark, **content):
    return spark.createDataFrame([(k, bytearray(v) if v is not None else None) for k, v in content.items()], "path string, content binary")


def images(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.path, r.page, r.band), {})[r.x, r.y] = r.v
    return {k: np.array([[p[x, y] for x in range(max(x for x, _ in p) + 1)] for y in range(max(y for _, y in p) + 1)]) for k, p in out.items()}


def lzw_encoded(data):
    table, codes, width, last = {bytes((i,)): i for i in range(256)}, [(256, 9)], 9, b""
    for b in data:
        now = last + bytes((b,))
        if now in table:
            last = now
            continue
        codes.append((table[last], width))
        table[now] = len(table) + 2
        width = max(9, (len(table) + 2).bit_length())
        if len(table) + 2 == 4094:
            codes.append((256, width))
            table, width = {bytes((i,)): i for i in range(256)}, 9
        last = bytes((b,))
    codes += [(table[last], width)] if last else []
    codes.append((257, max(9, (len(table) + 3).bit_length())))
    bits = "".join(f"{c:0{w}b}" for c, w in codes)
    return int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")


def by_hand(pages, order="<", big=False):
    """A file of pages (chunks, fields); strips get their places here."""
    number, entry, inline = ("Q", 20, 8) if big else ("I", 12, 4)
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "H", 43 if big else 42) + (struct.pack(order + "HH", 8, 0) if big else b"") + bytes(inline))
    back = 8 if big else 4
    for chunks, fields in pages:
        at = []
        for c in chunks:
            at.append(len(out))
            out += c
        tiles = any(t == 322 for t, _, _ in fields)
        fields = sorted([*fields, (324 if tiles else 273, 4, at), (325 if tiles else 279, 4, [len(c) for c in chunks])])
        body = b""
        for tag, kind, values in fields:
            raw = struct.pack(order + {2: "B", 3: "H", 4: "I", 5: "II"}[kind] * (len(values) // (2 if kind == 5 else 1)), *values)
            count = len(values) // (2 if kind == 5 else 1)
            if len(raw) > inline:
                place = len(out)
                out += raw
                raw = struct.pack(order + number, place)
            body += struct.pack(order + "HH" + number, tag, kind, count) + raw.ljust(inline, b"\0")
        struct.pack_into(order + number, out, back, len(out))
        out += struct.pack(order + ("Q" if big else "H"), len(fields)) + body
        back = len(out)
        out += bytes(inline)
    return bytes(out)


def fields(w, h, bits=8, **more):
    tags = {"compression": (259, 3), "bands": (277, 3), "rows": (278, 4), "planes": (284, 3), "predictor": (317, 3), "format": (339, 3), "tw": (322, 4), "th": (323, 4)}
    return [(256, 4, [w]), (257, 4, [h]), (258, 3, [bits] * more.get("bands", 1)), *((*tags[k], [v]) for k, v in more.items())]


def test_a_tiled_deflated_pyramid_of_many_pages_is_dealt_by_tile(spark):
    rng = np.random.default_rng(4)
    big = [rng.integers(0, 60000, (70, 50)).astype(np.uint16) for _ in range(3)]
    sheets = [(a, {"compression": 8, "predictor": 2, "tile": 16, "description": f"layer {k}"}) for k, a in enumerate(big)]
    sheets += [(a[::2, ::2].copy(), {"compression": 8, "rows": 7}) for a in big] + [(a[::4, ::4].copy(), {}) for a in big]
    for order in "<>":
        df = files(spark, one=slides.encoded(sheets, order), none=None)
        got = images(slides.pixels(df, tasks=6))
        assert len(got) == 9 and all((got["one", k, 0] == a).all() for k, (a, _) in enumerate(sheets))
        parts = slides.chunks(df, tasks=6)
        assert parts.count() == 3 * 5 * 4 + 3 * 5 + 3 and len({r[0] for r in parts.selectExpr("spark_partition_id()").distinct().collect()}) > 1
    pages = slides.pages(df)
    assert [(r.width, r.height, r.description) for r in pages.orderBy("page").collect()][:4] == [(50, 70, "layer 0"), (50, 70, "layer 1"), (50, 70, "layer 2"), (25, 35, "")]
    assert set(images(slides.pixels(df, {4}))) == {("one", 4, 0)}
    groups = lambda g, layers: [r.ok for r in slides.layer_groups(pages, g, layers).collect()]
    assert groups([3, 3, 3], [1, 3]) == [True] and groups([3, 3, 3], [3, 4]) == [False]  # two groups at once
    assert groups([3, 3], [1]) == [False] and groups([3, 3, 3, 1], [1]) == [False] and groups([4, 5], [1]) == [False]  # pages too many, too few, of two sizes
    assert groups([3, 3, 3], [10]) == [False] and groups([3, 3, 3], [0]) == [False]


def test_codecs_predictors_and_layouts(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 5, (9, 40)).astype(np.uint8)
    noise = rng.integers(0, 256, 9000).astype(np.uint8)
    f = rng.normal(size=(6, 10)).astype(np.float32)
    planes = np.ascontiguousarray(f.astype(">f4").view(np.uint8).reshape(6, 10, 4).transpose(0, 2, 1)).reshape(6, 40)
    floating = np.diff(planes, axis=1, prepend=np.zeros((6, 1), np.uint8)).astype(np.uint8).tobytes()
    rgb = rng.integers(0, 256, (4, 6, 3)).astype(np.uint8)
    differences = np.diff(rgb, axis=1, prepend=np.zeros((4, 1, 3), np.uint8)).astype(np.uint8).tobytes()
    packed = b"\xfe\xaa\x02\x80\x00\x2a\xfd\xaa\x03\x80\x00\x2a\x22\xf7\xaa"  # a published example of PackBits
    signed = rng.integers(-30000, 30000, (3, 5)).astype(">i2")
    cases = {
        "lzw": by_hand([([lzw_encoded(a[:5].tobytes()), lzw_encoded(a[5:].tobytes())], fields(40, 9, compression=5, rows=5))]),
        "long": by_hand([([lzw_encoded(noise.tobytes())], fields(90, 100, compression=5))]),
        "float": by_hand([([zlib.compress(floating)], fields(10, 6, 32, compression=8, predictor=3, format=3))]),
        "rgb": by_hand([([differences], fields(6, 4, bands=3, predictor=2))], ">"),
        "apart": by_hand([([rgb[:2, :, k].tobytes() if i == 0 else rgb[2:, :, k].tobytes() for k in range(3) for i in range(2)], fields(6, 4, bands=3, planes=2, rows=2))]),
        "packed": by_hand([([packed], fields(24, 1, compression=32773))]),
        "big": by_hand([([signed.tobytes()], fields(5, 3, 16, format=2))], ">", big=True),
    }
    got = images(slides.pixels(files(spark, **cases)))
    assert (got["lzw", 0, 0] == a).all() and (got["long", 0, 0] == noise.reshape(100, 90)).all() and (got["float", 0, 0] == f).all() and (got["big", 0, 0] == signed).all()
    assert all((got[k, 0, b] == rgb[..., b]).all() for k in ("rgb", "apart") for b in range(3))
    assert got["packed", 0, 0][0].astype(int).tolist() == [0xAA, 0xAA, 0xAA, 0x80, 0, 0x2A, 0xAA, 0xAA, 0xAA, 0xAA, 0x80, 0, 0x2A, 0x22, *[0xAA] * 10]


@pytest.mark.parametrize("content", [b"", b"no picture at all", b"II*\0\x08\0\0\0", by_hand([([b"abc"], fields(2, 2))]), by_hand([([b"abcd"], fields(2, 2, compression=7))]), by_hand([([b"ab"], fields(2, 2, rows=1))]), by_hand([([lzw_encoded(b"abcd")[:1] + b"\xff\xff\xff"], fields(2, 2, compression=5))])])
def test_what_cannot_be_read_fails(spark, content):
    with pytest.raises(Exception):
        slides.pixels(files(spark, bad=content)).collect()


def test_no_files(spark):
    assert slides.pixels(files(spark, a=None)).count() == 0 and slides.pages(files(spark, a=None).where("false")).count() == 0
