"""TIFF windows: forms of the file, reading no more than a window touches, the data source."""

import struct
import zlib

import numpy as np
import pytest

from orbitlake.sources import tiff


def pack_lzw(data):
    """The published algorithm: codes grow one entry early."""
    out, held, bits = bytearray(), 0, 0

    def put(code, width):
        nonlocal held, bits
        held, bits = held << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
            held &= (1 << bits) - 1

    table, width, w = {bytes([i]): i for i in range(256)}, 9, b""
    put(256, 9)
    n = 258
    for b in data:
        if w + bytes([b]) in table:
            w += bytes([b])
            continue
        put(table[w], width)
        table[w + bytes([b])] = n
        n += 1
        width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
        if n == 4094:
            put(256, 12)
            table, width, n = {bytes([i]): i for i in range(256)}, 9, 258
        w = bytes([b])
    if w:
        put(table[w], width)
        n += 1
        width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
    put(257, width)
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


def make(pixels, order="<", tile=None, compression=1, nodata=None, rows=3, big=False, predictor=False, geo=None, planar=False):
    """A small file: pixels (height, width, band)."""
    h, w, n = pixels.shape
    planes = [pixels[:, :, i : i + 1] for i in range(n)] if planar else [pixels]
    parts = []
    for p in planes:
        if tile:
            p = np.pad(p, ((0, -h % tile), (0, -w % tile), (0, 0)))
            parts += [p[r : r + tile, c : c + tile] for r in range(0, h, tile) for c in range(0, w, tile)]
        else:
            parts += [p[r : r + rows] for r in range(0, h, rows)]
    if predictor:
        parts = [np.concatenate((p[:, :1], np.diff(p, axis=1)), axis=1).astype(pixels.dtype) for p in parts]
    pack = {1: bytes, 5: pack_lzw, 8: zlib.compress}[compression]
    data = [pack(np.ascontiguousarray(p).tobytes()) for p in parts]
    word, size = ("Q", 8) if big else ("I", 4)
    out = bytearray(struct.pack(order + "2sH", b"II" if order == "<" else b"MM", 43 if big else 42) + (struct.pack(order + "HHQ", 8, 0, 0) if big else struct.pack(order + "I", 0)))
    offsets = []
    for d in data:
        offsets.append(len(out))
        out += d
    kind = {"u": 1, "i": 2, "f": 3}[pixels.dtype.kind]
    long = 16 if big else 4
    tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [8 * pixels.dtype.itemsize] * n), (259, 3, [compression]), (277, 3, [n]), (284, 3, [2 if planar else 1]), (317, 3, [2 if predictor else 1]), (339, 3, [kind] * n)]
    tags += [(322, 4, [tile]), (323, 4, [tile]), (324, long, offsets), (325, long, [*map(len, data)])] if tile else [(273, long, offsets), (278, 4, [rows]), (279, long, [*map(len, data)])]
    if nodata is not None:
        tags.append((42113, 2, list(str(nodata).encode() + b"\0")))
    if geo:
        tags += [(33550, 12, [geo[2], geo[3], 0.0]), (33922, 12, [0.0, 0.0, 0.0, geo[0], geo[1], 0.0])]
    entries = []
    for tag, code, values in sorted(tags):
        raw = struct.pack(f"{order}{len(values)}{ {2: 'B', 3: 'H', 4: 'I', 12: 'd', 16: 'Q'}[code]}", *values)
        if len(raw) > size:
            at = len(out)
            out += raw
            raw = struct.pack(order + word, at)
        entries.append(struct.pack(order + "HH" + word, tag, code, len(values)) + raw.ljust(size, b"\0"))
    at = len(out)
    out += struct.pack(order + ("Q" if big else "H"), len(entries)) + b"".join(entries) + struct.pack(order + word, 0)
    struct.pack_into(order + word, out, 8 if big else 4, at)
    return bytes(out)


class Counting:
    def __init__(self, content):
        self.content, self.bytes = content, 0

    def __call__(self, at, size):
        self.bytes += size
        return self.content[at : at + size]


FORMS = [
    ("<", "u2", {}), (">", "f4", {"compression": 8}), ("<", "i2", {"tile": 16, "compression": 8}), (">", "u1", {"tile": 16}), ("<", "f8", {"rows": 50}), ("<", "u2", {"compression": 5, "tile": 16}), (">", "u2", {"compression": 5, "rows": 7}),
    ("<", "u1", {"big": True, "tile": 16, "compression": 5}), (">", "f4", {"big": True}), ("<", "u2", {"predictor": True, "compression": 5}), ("<", "i4", {"planar": True, "tile": 16}), (">", "u1", {"planar": True, "big": True, "compression": 8}),
]


@pytest.mark.parametrize("order,dtype,options", FORMS)
def test_windows_of_all_forms(order, dtype, options):
    rng = np.random.default_rng(8)
    image = rng.integers(0, 100, (61, 45, 2)).astype(np.dtype(dtype).newbyteorder(order))
    read = Counting(make(image, order, **options))
    layout = tiff.Layout(read)
    for band in (0, 1):
        for rows, cols in (((0, 61), (0, 45)), ((5, 9), (40, 99)), ((-3, 17), (16, 17)), ((60, 61), (44, 45)), ((70, 80), (0, 5))):
            got = layout.window(read, rows, cols, band)
            assert (got == image[max(rows[0], 0) : rows[1], cols[0] : cols[1], band]).all() and got.shape == image[max(rows[0], 0) : rows[1], cols[0] : cols[1], band].shape


def test_lzw_of_long_and_repetitive_data():
    rng = np.random.default_rng(2)
    for data in (b"", b"a", b"a" * 10_000, bytes(rng.integers(0, 256, 60_000, dtype=np.uint8)), bytes(rng.integers(0, 3, 60_000, dtype=np.uint8))):
        assert tiff.unpack_lzw(pack_lzw(data), len(data)) == data
    with pytest.raises(ValueError):
        tiff.unpack_lzw(b"\xff\xff\xff\xff", 9)


def test_bytes_read_follow_the_window():
    image = np.random.default_rng(1).integers(0, 60_000, (1024, 1024, 1)).astype("<u2")
    content = make(image, tile=64)
    small, large = Counting(content), Counting(content)
    tiff.Layout(small).window(small, (128, 192), (128, 192))
    tiff.Layout(large).window(large, (0, 512), (0, 512))
    header = Counting(content)
    tiff.Layout(header)
    assert small.bytes - header.bytes == 64 * 64 * 2 and large.bytes - header.bytes == 512 * 512 * 2 and header.bytes < 4096


def test_files_that_are_none():
    image = np.zeros((4, 4, 1), "<u2")
    for bad in (b"", b"GIF89a..", make(image)[:2] + b"+" + make(image)[3:], make(image)[:40], make(image, big=True)[:40]):
        with pytest.raises(ValueError):
            tiff.Layout(Counting(bad))
    with pytest.raises(ValueError):
        tiff.Layout(Counting(make(image))).blocks(1)


def test_data_source(spark, tmp_path):
    rng = np.random.default_rng(4)
    images = {f"{k}.tif": rng.integers(0, 9, (50, 70, 1)).astype("<i2") for k in "ab"}
    for name, image in images.items():
        (tmp_path / name).write_bytes(make(image, tile=16, compression=5, nodata=3, geo=(100.0, 10.0, 0.5, 0.25)))
    df = tiff.read_windows(spark, str(tmp_path), window=32)
    rows = df.collect()
    assert len(rows) == 2 * 50 * 70 and df.rdd.getNumPartitions() == 2 * 2 * 3
    for r in rows:
        v = images[r["file"]][r["row"], r["col"], 0]
        assert r["v"] == (None if v == 3 else v) and (r["block_row"], r["block_col"]) == (r["row"] // 32, r["col"] // 32)
        assert (r["x"], r["y"]) == (100 + 0.5 * (r["col"] + 0.5), 10 - 0.25 * (r["row"] + 0.5))
    part = tiff.read_windows(spark, str(tmp_path / "a.tif"), window=32, rows=(40, 60), cols=(30, 34))
    assert sorted((r["row"], r["col"]) for r in part.collect()) == [(r, c) for r in range(40, 50) for c in range(30, 34)]
    assert tiff.read_windows(spark, str(tmp_path), rows=(90, 99)).count() == 0


def test_filters_narrow_the_windows(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(make(np.arange(64 * 64, dtype="<i4").reshape(64, 64, 1), tile=16))
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, IsNotNull, LessThan

    reader = tiff.PushingTiffReader({"path": str(tmp_path), "window": "16"})
    rest = list(reader.pushFilters([GreaterThanOrEqual(("row",), 20), LessThan(("row",), 30), EqualTo(("col",), 40), IsNotNull(("v",)), EqualTo(("file",), "a.tif")]))
    assert [type(f).__name__ for f in rest] == ["IsNotNull", "EqualTo"]
    assert [(w.rows, w.cols) for w in reader.partitions()] == [((20, 30), (40, 41))]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = tiff.read_windows(spark, str(tmp_path), window=16).where("row >= 20 and row < 22 and col = 40 and v > 0")
        assert sorted(r["v"] for r in got.collect()) == [20 * 64 + 40, 21 * 64 + 40]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
