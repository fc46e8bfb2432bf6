"""Raster operators on long pixel tables (id, row, col, v): joins and groups on pixel positions; per-image kernels only where no relational form exists."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _size(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg((F.max("row") + 1).alias("_h"), (F.max("col") + 1).alias("_w"))


def pad_or_crop(df: DataFrame, height: int, width: int, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Each axis by itself: cropped around the centre if larger, else padded at its end by reflection (the edge is not repeated), to and fro as often as it takes."""
    sized = df.join(_size(df, keys), list(keys))

    def target(i: str, n: str, want: int) -> Column:
        """Places in the new image that a pixel goes to."""
        shift = F.floor((F.col(n) - want) / 2).cast("int")
        cropped = F.when((F.col(i) >= shift) & (F.col(i) < shift + want), F.array(F.col(i) - shift)).otherwise(F.array().cast("array<int>"))
        period = F.greatest(2 * (F.col(n) - 1), F.lit(1))
        padded = F.filter(F.sequence(F.lit(0), F.lit(want - 1)), lambda j: (j % period == F.col(i)) | (j % period == period - F.col(i)) | (F.col(n) == 1))
        return F.when(F.col(n) > want, cropped).otherwise(padded)

    out = sized.withColumn("_r", F.explode(target("row", "_h", height))).withColumn("_c", F.explode(target("col", "_w", width)))
    return out.select(*keys, F.col("_r").alias("row"), F.col("_c").alias("col"), *[c for c in df.columns if c not in (*keys, "row", "col")])


def modal_size(df: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """One row: the commonest height and width (the smallest of equals)."""
    return _size(df, keys).agg(F.mode("_h", True).alias("height"), F.mode("_w", True).alias("width"))


def patches(df: DataFrame, width: int, stride: int, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Sliding windows: each pixel goes to every window that holds it (wrow, wcol: number of the window; row, col: place in it). Windows begin at multiples of the stride below size - width, that bound excluded."""
    sized = df.join(_size(df, keys), list(keys))

    def of(i: str, n: str) -> Column:
        low = F.greatest(F.lit(0), F.ceil((F.col(i) - width + 1) / stride)).cast("int")
        high = F.floor(F.col(i) / stride).cast("int")
        return F.filter(F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>")), lambda k: k * stride < F.col(n) - width)

    out = sized.withColumn("wrow", F.explode(of("row", "_h"))).withColumn("wcol", F.explode(of("col", "_w")))
    return out.withColumn("row", F.col("row") - F.col("wrow") * stride).withColumn("col", F.col("col") - F.col("wcol") * stride).drop("_h", "_w")


def neighbourhood(df: DataFrame, offsets: Sequence[tuple[int, int]], aggregate, keys: Sequence[str] = ("id",), value: str = "v") -> DataFrame:
    """aggregate over the pixels at the offsets of each pixel, those outside the image left out. Each pixel is sent to the places that see it and the places of the image alone are kept."""
    shifts = F.array(*[F.struct(F.lit(-a).alias("r"), F.lit(-b).alias("c")) for a, b in offsets])
    sent = df.select(*keys, "row", "col", value, F.explode(shifts).alias("_s")).select(*keys, (F.col("row") + F.col("_s.r")).alias("row"), (F.col("col") + F.col("_s.c")).alias("col"), value)
    seen = sent.groupBy(*keys, "row", "col").agg(aggregate(F.col(value)).alias(value))
    return seen.join(df.select(*keys, "row", "col"), [*keys, "row", "col"], "left_semi")


def square_offsets(radius: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1)]


def dilate(df: DataFrame, radius: int = 1, **kw) -> DataFrame:
    return neighbourhood(df, square_offsets(radius), F.max, **kw)


def erode(df: DataFrame, radius: int = 1, **kw) -> DataFrame:
    return neighbourhood(df, square_offsets(radius), F.min, **kw)


def close_open(df: DataFrame, close: int = 3, open_: Sequence[tuple[int, int]] = ((0, 0), (0, -1), (-1, 0), (-1, -1)), **kw) -> DataFrame:
    """Closing with a square of 2 * close + 1 pixels, then opening with a 2 x 2 element."""
    closed = erode(dilate(df, close, **kw), close, **kw)
    return neighbourhood(neighbourhood(closed, open_, F.min, **kw), [(-a, -b) for a, b in open_], F.max, **kw)


def shadows(clouds: DataFrame, dark: DataFrame, azimuth: float, distance: int, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Dark pixels that a cloud's shadow may reach: up to distance pixels from a cloud, away from the sun (azimuth in degrees)."""
    angle = np.radians(90 - azimuth)
    steps = sorted({(int(round(s * np.sin(angle))), -int(round(s * np.cos(angle)))) for s in range(1, distance + 1)})
    cast = clouds.select(*keys, "row", "col", F.explode(F.array(*[F.struct(F.lit(a).alias("r"), F.lit(b).alias("c")) for a, b in steps])).alias("_s"))
    reach = cast.select(*keys, (F.col("row") + F.col("_s.r")).alias("row"), (F.col("col") + F.col("_s.c")).alias("col")).distinct()
    return dark.join(reach, [*keys, "row", "col"], "left_semi")


def threshold_to_zero(v: Column, t: float) -> Column:
    """Values at or below t become 0; t is on the 0 to 255 scale as a whole number."""
    return F.when(v > F.lit(int(t * 255)), v).otherwise(F.lit(0))


def overview(df: DataFrame, levels: Sequence[int], keys: Sequence[str] = ("id",), value: str = "v") -> DataFrame:
    """Averages over blocks of 2 ** level pixels a side, each level from the full image: level, row, col, value."""
    f = F.pow(F.lit(2), F.col("level")).cast("int")
    lv = df.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels])))
    return lv.groupBy(*keys, "level", F.floor(F.col("row") / f).cast("int").alias("row"), F.floor(F.col("col") / f).cast("int").alias("col")).agg(F.avg(value).alias(value))


def merge_tiles(tiles: DataFrame, order: str, keys: Sequence[str] = ("row", "col"), value: str = "v") -> DataFrame:
    """One raster of overlapping tiles: the first valid value by order wins."""
    return tiles.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, order).alias(value))


# --- kernels that need a whole image: one group an image, bounded by the tile size ------------------------------------


def _image(pdf: pd.DataFrame, value: str = "v", fill: float = 0.0) -> np.ndarray:
    out = np.full((int(pdf["row"].max()) + 1, int(pdf["col"].max()) + 1), fill)
    out[pdf["row"], pdf["col"]] = pdf[value].fillna(fill)
    return out


def hessian_determinants(image: np.ndarray, sigmas: Sequence[float]) -> np.ndarray:
    """Determinant of the Hessian at each scale by box filters on the integral image."""
    total = np.pad(image, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
    h, w = image.shape
    rows, cols = np.mgrid[:h, :w]

    def box(r: np.ndarray, c: np.ndarray, height: int, width: int) -> np.ndarray:
        r0, r1, c0, c1 = (np.clip(x, 0, m) for x, m in ((r, h), (r + height, h), (c, w), (c + width, w)))
        return total[r1, c1] - total[r0, c1] - total[r1, c0] + total[r0, c0]

    out = []
    for sigma in sigmas:
        size = int(3 * sigma)
        size += 1 - size % 2
        lobe, half, weight = max(1, size // 3), size // 2, 1.0 / size / size
        mid = box(rows - half, cols - lobe // 2, size, lobe)
        dxx = (box(rows - half, cols - half, size, size) - 3 * mid) * -weight
        mid = box(rows - lobe // 2, cols - half, lobe, size)
        dyy = (box(rows - half, cols - half, size, size) - 3 * mid) * -weight
        dxy = (box(rows - lobe, cols + 1, lobe, lobe) + box(rows + 1, cols - lobe, lobe, lobe) - box(rows - lobe, cols - lobe, lobe, lobe) - box(rows + 1, cols + 1, lobe, lobe)) * -weight
        out.append(dxx * dyy - 0.81 * dxy * dxy)
    return np.stack(out)


def _local_max(cube: np.ndarray) -> np.ndarray:
    p = np.pad(cube, 1, constant_values=-np.inf)
    best = cube
    for d in np.ndindex(*(3,) * cube.ndim):
        best = np.maximum(best, p[tuple(slice(a, a + n) for a, n in zip(d, cube.shape))])
    return cube >= best


def find_blobs(image: np.ndarray, min_sigma: float, max_sigma: float, threshold: float, num_sigma: int = 10, overlap: float = 0.5) -> list[tuple[int, int, float]]:
    """Maxima over place and scale above the threshold; of two discs that overlap by more than that share, the larger stays."""
    sigmas = np.linspace(min_sigma, max_sigma, num_sigma)
    cube = hessian_determinants(image, sigmas)
    found = [(int(r), int(c), float(sigmas[s])) for s, r, c in np.argwhere(_local_max(cube) & (cube > threshold))]
    kept: list[tuple[int, int, float]] = []
    for r, c, s in sorted(found, key=lambda b: (-b[2], b[0], b[1])):
        if all(disc_overlap(r, c, s, *k) <= overlap for k in kept):
            kept.append((r, c, s))
    return kept


def disc_overlap(r1: float, c1: float, a: float, r2: float, c2: float, b: float) -> float:
    """Shared area of two discs of radius sqrt(2) * sigma, as a share of the smaller."""
    a, b, d = a * 2**0.5, b * 2**0.5, float(np.hypot(r1 - r2, c1 - c2))
    if d >= a + b:
        return 0.0
    if d <= abs(a - b):
        return 1.0
    x, y = (d * d + a * a - b * b) / (2 * d * a), (d * d + b * b - a * a) / (2 * d * b)
    area = a * a * np.arccos(np.clip(x, -1, 1)) + b * b * np.arccos(np.clip(y, -1, 1)) - 0.5 * np.sqrt(max(0.0, (-d + a + b) * (d + a - b) * (d - a + b) * (d + a + b)))
    return float(area / (np.pi * min(a, b) ** 2))


def detect_blobs(df: DataFrame, key: str = "id", min_sigma: float = 3.5, max_sigma: float = 100, threshold: float = 0.0025, prediction: float = 0.75, rescale: bool = False) -> DataFrame:
    """Blobs of each image's predictions at or above prediction: key, row, col, sigma. rescale: by the image's maximum first."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        image = _image(pdf)
        image = np.where(image < prediction, 0, image)
        if rescale and image.max() > 0:
            image = image / image.max()
        found = find_blobs(image, min_sigma, max_sigma, threshold)
        return pd.DataFrame([(pdf[key].iloc[0], *b) for b in found], columns=[key, "row", "col", "sigma"])

    return df.groupBy(key).applyInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, row int, col int, sigma double")


def _local_maximum(image: np.ndarray, distance: int) -> np.ndarray:
    """The largest value within distance of each pixel, in both directions."""
    for axis in (0, 1):
        ends = [(distance, distance) if k == axis else (0, 0) for k in (0, 1)]
        padded = np.pad(image, ends, constant_values=-np.inf)
        image = np.lib.stride_tricks.sliding_window_view(padded, 2 * distance + 1, axis=axis).max(axis=-1)
    return image


def detect_peaks(df: DataFrame, key: str = "id", threshold: float = 0.85, distance: int = 100, border: int | None = None) -> DataFrame:
    """Local maxima above the threshold: pixels no smaller than any within distance (in rows and columns), the strongest first, none within distance of one
    taken before. The border of the image (distance pixels, unless given) has none. An image that is flat has none; missing and null pixels are below all others."""
    rim = distance if border is None else border

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        image = np.full((int(pdf["row"].max()) + 1, int(pdf["col"].max()) + 1), -np.inf)
        image[pdf["row"], pdf["col"]] = pdf["v"].fillna(-np.inf)
        peak = (image == _local_maximum(image, distance)) & (image > max(threshold, image.min()))
        inner = np.zeros_like(peak)
        inner[rim : image.shape[0] - rim, rim : image.shape[1] - rim] = True
        at = np.argwhere(peak & inner)
        kept: list[tuple[int, int, float]] = []
        for r, c in at[np.lexsort((at[:, 1], at[:, 0], -image[at[:, 0], at[:, 1]]))]:
            if all(max(abs(r - a), abs(c - b)) > distance for a, b, _ in kept):
                kept.append((r, c, image[r, c]))
        return pd.DataFrame([(pdf[key].iloc[0], *k) for k in kept], columns=[key, "row", "col", "v"])

    return df.groupBy(key).applyInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, row int, col int, v double")


def upscale(image: np.ndarray, scale: int, a: float = -0.5) -> np.ndarray:
    """Bicubic interpolation to scale times the size, edges repeated."""

    def axis(x: np.ndarray, n: int) -> np.ndarray:
        at = (np.arange(n * scale) + 0.5) / scale - 0.5
        base = np.floor(at).astype(int)
        out = np.zeros((n * scale, x.shape[1]))
        for k in range(-1, 3):
            d = np.abs(at - (base + k))
            w = np.where(d <= 1, (a + 2) * d**3 - (a + 3) * d**2 + 1, np.where(d < 2, a * d**3 - 5 * a * d**2 + 8 * a * d - 4 * a, 0))
            out += w[:, None] * x[np.clip(base + k, 0, n - 1)]
        return out

    return axis(axis(image, image.shape[0]).T, image.shape[1]).T


def blur(image: np.ndarray, radius: int, sigma: float) -> np.ndarray:
    """Gaussian blur, separable, edges mirrored without repeating them."""
    k = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma * sigma))
    k /= k.sum()
    for ax in (0, 1):
        n = image.shape[ax]
        pos = np.arange(-radius, n + radius)
        pos = np.abs(pos) % max(1, 2 * (n - 1))
        pos = np.where(pos >= n, 2 * (n - 1) - pos, pos)
        padded = np.take(image, pos, ax)
        image = sum(w * np.take(padded, np.arange(i, i + n), ax) for i, w in enumerate(k))
    return image


def label_components(mask: np.ndarray) -> np.ndarray:
    """8-connected components, numbered from 1 in row order: runs of pixels, joined where runs of neighbouring rows meet."""
    rows, ends = np.nonzero(np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1))
    row, start, stop = rows[::2], ends[::2], ends[1::2]
    root = list(range(len(row)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    width = mask.shape[1] + 2
    # runs of the row above that end no earlier than a pixel before the run, up to those that begin no later than a pixel after it
    low = np.searchsorted(row * width + stop, (row - 1) * width + start, side="left")
    high = np.searchsorted(row * width + start, (row - 1) * width + stop, side="right")
    for i, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
        for j in range(a, b):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    _, number = np.unique([find(i) for i in range(len(row))], return_inverse=True)
    out = np.zeros(mask.shape, np.int64)
    out[mask] = np.repeat(number + 1, stop - start)
    return out


def vectorize(df: DataFrame, key: str, threshold: float) -> DataFrame:
    """8-connected regions of values above the threshold: key, component, pixels, and their bounding box."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lab = label_components(_image(pdf) > threshold)
        r, k = np.nonzero(lab)
        found = pd.DataFrame({"component": lab[r, k], "r": r, "k": k}).groupby("component", as_index=False).agg(pixels=("r", "size"), min_row=("r", "min"), min_col=("k", "min"), max_row=("r", "max"), max_col=("k", "max"))
        found.insert(0, key, pdf[key].iloc[0])
        return found

    return df.groupBy(key).applyInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, component int, pixels int, min_row int, min_col int, max_row int, max_col int")


def trace_rings(mask: np.ndarray) -> list[list[tuple[int, int]]]:
    """Borders of the mask's regions as closed rings of pixel corners (x, y): outer ones counter-clockwise in image axes, holes the other way. Every unit edge
    between an inner and an outer pixel is used once; straight runs are joined."""
    p = np.pad(mask.astype(bool), 1)
    edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r, c in np.argwhere(p):
        y, x = r - 1, c - 1
        for other, a, b in ((p[r - 1, c], (x, y), (x + 1, y)), (p[r, c + 1], (x + 1, y), (x + 1, y + 1)), (p[r + 1, c], (x + 1, y + 1), (x, y + 1)), (p[r, c - 1], (x, y + 1), (x, y))):
            if not other:
                edges.setdefault(a, []).append(b)
    rings = []
    for start in [p for p in sorted(edges) for _ in edges[p]]:
        if start not in edges:
            continue
        ring, at, before = [], start, None
        while True:
            nexts = edges[at]
            # where two regions touch at a corner, turn so that they stay apart
            pick = 0 if len(nexts) == 1 or before is None else min(range(len(nexts)), key=lambda i: -((at[0] - before[0]) * (nexts[i][1] - at[1]) - (at[1] - before[1]) * (nexts[i][0] - at[0])))
            to = nexts.pop(pick)
            if not nexts:
                del edges[at]
            if before is None or (at[0] - before[0], at[1] - before[1]) != (to[0] - at[0], to[1] - at[1]):
                ring.append(at)
            before, at = at, to
            if at == start:
                break
        if len(ring) > 2 and (ring[0][0] - before[0], ring[0][1] - before[1]) == (ring[1][0] - ring[0][0] and np.sign(ring[1][0] - ring[0][0]), ring[1][1] - ring[0][1] and np.sign(ring[1][1] - ring[0][1])):
            ring = ring[1:]
        rings.append([(int(x), int(y)) for x, y in ring])
    return rings


def contours(df: DataFrame, keys: Sequence[str], threshold: float = 0.5, scale: int = 4, max_masked: float = 0.1) -> DataFrame:
    """Footprints of each image: frames with max_masked or more missing pixels give none; the image is upscaled, brought to 0..255, blurred, cut at the threshold,
    and its regions' borders traced. One row a ring: keys, ring (array of struct x, y in pixels of the original), area (negative: a hole)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for ring in _soft_rings(pdf, threshold, scale, max_masked):
            out.append((*[pdf[k].iloc[0] for k in keys], _points(ring, scale), shoelace(ring) / scale**2))
        return pd.DataFrame(out, columns=[*keys, "ring", "area"])

    return df.groupBy(*keys).applyInPandas(run, f"{_kinds(df, keys)}, ring array<struct<x: double, y: double>>, area double")


def _kinds(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)


def _soft_rings(pdf: pd.DataFrame, threshold: float, scale: int, max_masked: float) -> list[list[tuple[int, int]]]:
    """Rings of an image upscaled, brought to 0..255, blurred and cut, in pixels of the upscaled one."""
    if pdf["v"].isna().mean() >= max_masked:
        return []
    big = np.floor(np.clip(upscale(_image(pdf), scale), 0, 1) * 255)
    return trace_rings(np.floor(blur(big, 4 * scale, 4.0) + 0.5) > int(threshold * 255))


def _points(ring: list[tuple[int, int]], scale: int) -> list[dict]:
    return [{"x": x / scale, "y": y / scale} for x, y in ring]


def shoelace(ring: list[tuple[int, int]]) -> float:
    return sum(a * d - c * b for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1])) / 2


def polygons_of(rings: list[list[tuple[int, int]]]) -> list[list[list[tuple[int, int]]]]:
    """Rings of trace_rings as polygons, each an outer ring and its holes. A hole belongs to the smallest outer ring around it; an island in a hole is a polygon of its own."""
    outers = sorted((r for r in rings if shoelace(r) > 0), key=shoelace)
    out = [[r] for r in outers]
    edges = [(x := np.array(r, float), np.roll(x, -1, 0)) for r in outers]
    for hole in (r for r in rings if shoelace(r) < 0):
        (x0, y0), (x1, y1) = hole[0], hole[1]
        # half a pixel along its first edge: on no other ring
        x, y = x0 + np.sign(x1 - x0) / 2, y0 + np.sign(y1 - y0) / 2
        for polygon, (a, b) in zip(out, edges):
            crossed = (a[:, 1] > y) != (b[:, 1] > y)
            at = a[crossed, 0] + (y - a[crossed, 1]) * (b[crossed, 0] - a[crossed, 0]) / (b[crossed, 1] - a[crossed, 1])
            if (at > x).sum() % 2:
                polygon.append(hole)
                break
    return out


def footprints(df: DataFrame, keys: Sequence[str], threshold: float = 0.5, scale: int = 4, max_masked: float = 0.1) -> DataFrame:
    """The contours of each image as polygons with holes, one row a polygon, the smallest first: keys, polygon (number from 1), rings (the outer one first, each an array of struct x, y
    in pixels of the original), area (without the holes). All rows of an image are its MultiPolygon."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for i, rings in enumerate(polygons_of(_soft_rings(pdf, threshold, scale, max_masked)), 1):
            out.append((*[pdf[k].iloc[0] for k in keys], i, [_points(r, scale) for r in rings], sum(map(shoelace, rings)) / scale**2))
        return pd.DataFrame(out, columns=[*keys, "polygon", "rings", "area"])

    return df.groupBy(*keys).applyInPandas(run, f"{_kinds(df, keys)}, polygon int, rings array<array<struct<x: double, y: double>>>, area double")


def filter_scattered(rings: DataFrame, keys: Sequence[str], area: str = "area_m2", mean_km2: float = 0.003, least_m2: float = 100.0) -> DataFrame:
    """Sites and dates of three polygons or more that are small on average keep the polygons above least_m2 alone."""
    stats = rings.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), (F.sum(area) / 1e6).alias("_km2"))
    out = rings.join(stats, list(keys))
    scattered = (F.col("_n") >= 3) & (F.col("_km2") / F.col("_n") < mean_km2)
    return out.where(~scattered | (F.col(area) > least_m2)).drop("_n", "_km2")
