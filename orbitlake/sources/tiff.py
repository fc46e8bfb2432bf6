"""TIFF files by blocks: the layout is read from the header, and of the pixels only the strips or tiles that a window touches.

`spark.read.format("tiff_blocks")` deals the windows of all files to partitions; each reads its own blocks by seek, from any store that Arrow reaches. Filters on row
and col narrow the windows before anything is read (where Spark pushes filters down to Python sources), and so do the options.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

#: TIFF tags and field types that the reader knows.
WIDTH, HEIGHT, BITS, COMPRESSION, SAMPLES, ROWS_PER_STRIP, PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, SAMPLE_FORMAT, NODATA = 256, 257, 258, 259, 277, 278, 284, 317, 322, 323, 339, 42113
STRIPS, TILES = (273, 279), (324, 325)
PIXEL_SCALE, TIE_POINT = 33550, 33922
FIELD_TYPES = {1: "u1", 2: "S1", 3: "u2", 4: "u4", 6: "i1", 8: "i2", 9: "i4", 11: "f4", 12: "f8", 16: "u8", 17: "i8"}
RAW, LZW, DEFLATE = 1, 5, (8, 32946)
Read = Callable[[int, int], bytes]


def unpack_lzw(data: bytes, size: int) -> bytes:
    """Codes of 9 to 12 bits, high bits first; 256 clears the table, 257 ends; a code grows one entry before its width is used up. size: bytes that are wanted."""
    clear, end, most = 256, 257, 4095
    table: list[bytes] = []
    out, total, held, bits, width, before = [], 0, 0, 0, 9, b""
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == clear:
            table, width, before = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        if code == end or total >= size:
            break
        if not table:
            table = [bytes([i]) for i in range(256)] + [b"", b""]
        if code < len(table):
            piece = table[code]
        elif code == len(table) and before:
            piece = before + before[:1]
        else:
            raise ValueError(f"LZW: code {code} before there are so many")
        if before and len(table) <= most:
            table.append(before + piece[:1])
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
        before = piece
        out.append(piece)
        total += len(piece)
    return b"".join(out)[:size]


class Layout:
    """Of a file's first image: size, types, where its strips or tiles are, and origin and size of a pixel (None without such tags). Classic or BigTIFF."""

    def __init__(self, read: Read):
        head = read(0, 16)
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        kind = int(np.frombuffer(head, order + "u2", 1, 2)[0]) if order and len(head) >= 8 else 0
        if kind not in (42, 43) or kind == 43 and len(head) < 16:
            raise ValueError("not a TIFF file")
        big = kind == 43
        if big and int(np.frombuffer(head, order + "u2", 1, 4)[0]) != 8:
            raise ValueError("not a BigTIFF file of 64-bit offsets")
        number, width = (order + "u8", 8) if big else (order + "u4", 4)
        at = int(np.frombuffer(head, number, 1, 8 if big else 4)[0])
        count = read(at, width if big else 2)
        if len(count) < (width if big else 2):
            raise ValueError("TIFF: the file ends before its directory")
        n = int(np.frombuffer(count, order + ("u8" if big else "u2"))[0])
        first, size = at + (8 if big else 2), 4 + 2 * width
        entries, tags = read(first, n * size), {}
        for i in range(n):
            entry = entries[i * size : (i + 1) * size]
            tag, code = (int(x) for x in np.frombuffer(entry, order + "u2", 2))
            if code in FIELD_TYPES:
                count, where = (int(x) for x in np.frombuffer(entry, number, 2, 4))
                dtype = np.dtype(FIELD_TYPES[code]).newbyteorder(order)
                inline = count * dtype.itemsize <= width
                tags[tag] = np.frombuffer(entry[4 + width :] if inline else read(where, count * dtype.itemsize), dtype, count)
        one = lambda tag, default=None: int(tags[tag][0]) if tag in tags else default
        self.width, self.height, self.samples, self.planar = one(WIDTH), one(HEIGHT), one(SAMPLES, 1), one(PLANAR, 1) == 2
        self.compression, self.predictor, bits = one(COMPRESSION, RAW), one(PREDICTOR, 1), one(BITS, 1)
        if self.compression not in (RAW, LZW, *DEFLATE) or self.predictor not in (1, 2) or bits not in (8, 16, 32, 64):
            raise ValueError(f"TIFF: compression {self.compression}, predictor {self.predictor} or {bits} bits can't be read")
        self.dtype = np.dtype(f"{ {1: 'u', 2: 'i', 3: 'f'}[one(SAMPLE_FORMAT, 1)]}{bits // 8}").newbyteorder(order)
        self.nodata = float(tags[NODATA].tobytes().strip(b"\0 ") or b"nan") if NODATA in tags else np.nan
        self.tiled = TILES[0] in tags
        self.w, self.h = (one(TILE_WIDTH), one(TILE_HEIGHT)) if self.tiled else (self.width, min(one(ROWS_PER_STRIP, self.height), self.height))
        self.offsets, self.sizes = (tags[t] for t in (TILES if self.tiled else STRIPS))
        self.across = -(-self.width // self.w)
        self.scale = tuple(float(x) for x in tags[PIXEL_SCALE][:2]) if PIXEL_SCALE in tags else None
        self.tie = tuple(float(x) for x in tags[TIE_POINT][:6]) if TIE_POINT in tags else None

    def blocks(self, band: int = 0) -> int:
        """Blocks of one band; raises where there is no such band."""
        if not 0 <= band < self.samples:
            raise ValueError(f"TIFF: no band {band} of {self.samples}")
        return self.across * -(-self.height // self.h)

    def touched(self, rows: tuple[int, int], cols: tuple[int, int]) -> Iterator[int]:
        """Blocks that hold pixels of a window (ends excluded)."""
        for i in range(max(rows[0], 0) // self.h, -(-min(rows[1], self.height) // self.h)):
            for j in range(max(cols[0], 0) // self.w, -(-min(cols[1], self.width) // self.w)):
                yield i * self.across + j

    def block(self, read: Read, k: int, band: int = 0) -> tuple[int, int, np.ndarray]:
        """Row and column of the first pixel of a block, and its values: float64, no data as NaN."""
        i = k + self.blocks(band) * band * self.planar
        depth = 1 if self.planar else self.samples
        row, col = k // self.across * self.h, k % self.across * self.w
        rows = self.h if self.tiled else min(self.h, self.height - row)
        data = read(int(self.offsets[i]), int(self.sizes[i]))
        if self.compression in DEFLATE:
            data = zlib.decompress(data)
        elif self.compression == LZW:
            data = unpack_lzw(data, rows * self.w * depth * self.dtype.itemsize)
        values = np.frombuffer(data, self.dtype, rows * self.w * depth).reshape(rows, self.w, depth)
        if self.predictor == 2:
            values = np.cumsum(values, axis=1, dtype=self.dtype.newbyteorder("="))
        values = values[: self.height - row, : self.width - col, 0 if self.planar else band].astype(float)
        return row, col, np.where(values == self.nodata, np.nan, values)

    def window(self, read: Read, rows: tuple[int, int], cols: tuple[int, int], band: int = 0) -> np.ndarray:
        """The pixels of a window (ends excluded), cut at the image's edges; no more is read than the blocks that it touches."""
        r0, r1, c0, c1 = max(rows[0], 0), min(rows[1], self.height), max(cols[0], 0), min(cols[1], self.width)
        out = np.full((max(r1 - r0, 0), max(c1 - c0, 0)), np.nan)
        for k in self.touched(rows, cols):
            row, col, v = self.block(read, k, band)
            a, b, c, d = max(row, r0), min(row + v.shape[0], r1), max(col, c0), min(col + v.shape[1], c1)
            out[a - r0 : b - r0, c - c0 : d - c0] = v[a - row : b - row, c - col : d - col]
        return out


class Window(InputPartition):
    def __init__(self, path: str, rows: tuple[int, int], cols: tuple[int, int]):
        self.path, self.rows, self.cols = path, rows, cols


def _open(path: str):
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
    return store.open_input_file(name)


def _files(path: str, ending: str) -> list[str]:
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
    info = store.get_file_info(name)
    if info.type == fs.FileType.File:
        return [path]
    head = path[: len(path) - len(name)]  # scheme and host, which the names in a listing lack
    return sorted(head + f.path for f in store.get_file_info(fs.FileSelector(name, recursive=True)) if f.type == fs.FileType.File and f.path.endswith(ending))


def reader_of(file) -> Read:
    def read(at: int, size: int) -> bytes:
        file.seek(at)
        return file.read(size)

    return read


class TiffReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.ending, self.band, self.side = options["path"], options.get("ending", ".tif"), int(options.get("band", 0)), int(options.get("window", 1024))
        bound = lambda name, default: int(options.get(name, default))
        self.rows, self.cols = [bound("first_row", 0), bound("end_row", 1 << 40)], [bound("first_col", 0), bound("end_col", 1 << 40)]

    def partitions(self) -> list[Window]:
        """A window of side pixels a partition; of each file, the header alone is read."""
        out = []
        for path in _files(self.path, self.ending):
            with _open(path) as file:
                layout = Layout(reader_of(file))
            layout.blocks(self.band)
            r0, r1, c0, c1 = max(self.rows[0], 0), min(self.rows[1], layout.height), max(self.cols[0], 0), min(self.cols[1], layout.width)
            for r in range(r0 // self.side * self.side, r1, self.side):
                for c in range(c0 // self.side * self.side, c1, self.side):
                    out.append(Window(path, (max(r, r0), min(r + self.side, r1)), (max(c, c0), min(c + self.side, c1))))
        return out

    def read(self, partition: Window) -> Iterator[pa.RecordBatch]:
        if partition is None or partition.path is None:
            return
        with _open(partition.path) as file:
            read = reader_of(file)
            layout = Layout(read)
            values = layout.window(read, partition.rows, partition.cols, self.band)
        r, c = np.indices(values.shape)
        r, c, v = r.ravel() + partition.rows[0], c.ravel() + partition.cols[0], values.ravel()
        name = partition.path.rsplit("/", 1)[-1]
        if layout.scale and layout.tie:
            x, y = layout.tie[3] + (c + 0.5 - layout.tie[0]) * layout.scale[0], layout.tie[4] - (r + 0.5 - layout.tie[1]) * layout.scale[1]
        else:
            x = y = np.full(len(v), np.nan)
        number = lambda a: pa.array(a, pa.float64(), from_pandas=True)  # noqa: E731  NaN is NULL
        for i in range(0, len(v), 1 << 16):
            s = slice(i, i + (1 << 16))
            n = len(v[s])
            yield pa.record_batch(
                [pa.array([name] * n), pa.array(r[s] // self.side, pa.int32()), pa.array(c[s] // self.side, pa.int32()), pa.array(r[s], pa.int32()), pa.array(c[s], pa.int32()), number(v[s]), number(x[s]), number(y[s])],
                ["file", "block_row", "block_col", "row", "col", "v", "x", "y"],
            )


class PushingTiffReader(TiffReader):
    """Takes filters on row and col as bounds of the windows; Spark allows it where spark.sql.python.filterPushdown.enabled is set."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            side = {("row",): self.rows, ("col",): self.cols}.get(getattr(f, "attribute", None))
            if side is None or not isinstance(getattr(f, "value", None), int):
                yield f
                continue
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                side[0] = max(side[0], f.value + isinstance(f, GreaterThan))
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                side[1] = min(side[1], f.value + (not isinstance(f, LessThan)))
            if not isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                yield f


class TiffSource(DataSource):
    """Options: path (a file, or a folder that is searched for ending, .tif), band, window (pixels a side of a partition), first_row, end_row, first_col, end_col (ends excluded),
    pushdown (true: filters narrow the windows)."""

    @classmethod
    def name(cls) -> str:
        return "tiff_blocks"

    def schema(self) -> str:
        return "file string, block_row int, block_col int, row int, col int, v double, x double, y double"

    def reader(self, schema) -> TiffReader:
        return (PushingTiffReader if self.options.get("pushdown") == "true" else TiffReader)(dict(self.options))


def read_windows(spark: SparkSession, path: str, window: int = 1024, band: int = 0, rows: tuple[int, int] | None = None, cols: tuple[int, int] | None = None) -> DataFrame:
    """Pixels of a band by windows: file, block_row, block_col, row, col, v (NULL for no data), and the pixel centre's coordinates x, y where the file has a scale and a tie point. rows, cols: a part (ends excluded)."""
    spark.dataSource.register(TiffSource)
    reader = spark.read.format("tiff_blocks").option("path", path).option("window", window).option("band", band)
    reader = reader.option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    for name, ends in (("row", rows), ("col", cols)):
        if ends:
            reader = reader.option(f"first_{name}", ends[0]).option(f"end_{name}", ends[1])
    return reader.load()
