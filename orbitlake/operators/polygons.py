"""Polygons: overlay (union, intersection, difference), repair, overlap resolution between sites, dissolve.

A multipolygon is an array of polygons, a polygon an array of rings (array of struct x, y), the outer one first, then its holes. Overlays work on one pair of shapes
at a time, as column functions on Arrow batches; everything that brings shapes together is a join. Dissolve never gathers the polygons of a group: shared
edges cancel in an aggregation, and what is left is linked to rings by key, in rounds that double the distance they look ahead.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from . import spatial
from .merge import shared

POINT = "struct<x: double, y: double>"
RINGS, MULTI = f"array<array<{POINT}>>", f"array<array<array<{POINT}>>>"
#: Vertices are snapped to multiples of this, in the unit of the coordinates: a millimetre in degrees.
GRID = 1e-8
#: Largest coordinate on the grid: products of differences must fit 64 bits.
LARGEST = 1 << 29
_RULES: dict[str, Callable] = {"union": np.logical_or, "intersection": np.logical_and, "difference": lambda a, b: a & ~b, "symmetric_difference": np.logical_xor}


# --- one pair of shapes ----------------------------------------------------------------------------------------------------


def _meeting(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of intervals that meet, in order of a sweep over their lower ends."""
    order = np.argsort(low, kind="stable")
    stop = np.searchsorted(low[order], high[order], side="right")
    n = stop - np.arange(len(low)) - 1
    first = np.repeat(np.arange(len(low)), n)
    second = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first + 1
    return order[first], order[second]


def _cross(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Twice the area of the triangle a, b, c: positive if c lies on the left of the way from a to b."""
    return (b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])


def _noded(start: np.ndarray, end: np.ndarray, layer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Splits segments where they cross or touch, rounded to the grid, until they meet at ends alone."""
    while len(start):
        i, j = _meeting(np.minimum(start[:, 0], end[:, 0]), np.maximum(start[:, 0], end[:, 0]))
        low, high = np.minimum(start[:, 1], end[:, 1]), np.maximum(start[:, 1], end[:, 1])
        near = (low[i] <= high[j]) & (low[j] <= high[i])
        i, j = i[near], j[near]
        a, b, c, d = start[i], end[i], start[j], end[j]
        sides = [_cross(a, b, c), _cross(a, b, d), _cross(c, d, a), _cross(c, d, b)]
        at, whose = [], []
        crossing = (np.sign(sides[0]) * np.sign(sides[1]) < 0) & (np.sign(sides[2]) * np.sign(sides[3]) < 0)
        t = sides[2][crossing] / (sides[2][crossing] - sides[3][crossing])
        at += [np.rint(a[crossing] + t[:, None] * (b[crossing] - a[crossing])).astype(np.int64)] * 2
        whose += [i[crossing], j[crossing]]
        for side, point, k, p, q in ((sides[0], c, i, a, b), (sides[1], d, i, a, b), (sides[2], a, j, c, d), (sides[3], b, j, c, d)):
            on = (side == 0) & (np.minimum(p, q) <= point).all(axis=1) & (point <= np.maximum(p, q)).all(axis=1)
            at.append(point[on])
            whose.append(k[on])
        at, whose = np.concatenate(at), np.concatenate(whose)
        inner = (at != start[whose]).any(axis=1) & (at != end[whose]).any(axis=1)
        at, whose = at[inner], whose[inner]
        if not len(at):
            break
        # all stations of each segment in order of their way from its start
        every = np.arange(len(start))
        whose, at = np.concatenate((every, whose, every)), np.concatenate((start, at, end))
        way = ((at - start[whose]) * (end[whose] - start[whose])).astype(np.float64).sum(axis=1)
        way[: len(start)], way[-len(start) :] = -np.inf, np.inf
        order = np.lexsort((way, whose))
        whose, at = whose[order], at[order]
        same = whose[1:] == whose[:-1]
        start, end, layer = at[:-1][same], at[1:][same], layer[whose[1:][same]]
        moved = (start != end).any(axis=1)
        start, end, layer = start[moved], end[moved], layer[moved]
    return start, end, layer


def _edges(start: np.ndarray, end: np.ndarray, layer: np.ndarray, layers: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that differ, left to right (upwards if vertical), and for each layer how many more of its segments run that way than back; those that cancel are gone."""
    swap = (start[:, 0] > end[:, 0]) | (start[:, 0] == end[:, 0]) & (start[:, 1] > end[:, 1])
    both = np.where(swap[:, None], np.hstack((end, start)), np.hstack((start, end)))
    if not len(both):
        return both, np.zeros((0, layers), np.int64)
    edges, which = np.unique(both, axis=0, return_inverse=True)
    net = np.zeros((len(edges), layers), np.int64)
    np.add.at(net, (which.ravel(), layer), np.where(swap, -1, 1))
    some = net.any(axis=1)
    return edges[some], net[some]


def _below(edges: np.ndarray, net: np.ndarray) -> np.ndarray:
    """For each edge and layer, how often the layer winds around the place just below the edge's middle (left of it, if it is vertical): the sum over the edges beyond."""
    winding = np.zeros_like(net)
    upright = edges[:, 0] == edges[:, 2]
    for axis in (0, 1):
        # along the axis all edges run forward
        flip = edges[:, axis] > edges[:, axis + 2]
        e = np.where(flip[:, None], edges[:, [2, 3, 0, 1]], edges)
        forward = np.where((flip if axis == 0 else ~flip)[:, None], -net, net)
        mine = upright if axis else ~upright
        low, high, middle = e[:, axis], e[:, axis + 2], edges[:, axis] + edges[:, axis + 2]
        i, j = _meeting(2 * low, 2 * high)
        i, j = np.concatenate((i, j)), np.concatenate((j, i))
        own = mine[i] & (2 * low[j] <= middle[i]) & (middle[i] < 2 * high[j])
        i, j = i[own], j[own]
        other = 1 - axis
        height = edges[i, other] + edges[i, other + 2]
        above = (high[j] - low[j]) * (height - 2 * e[j, other]) > (e[j, other + 2] - e[j, other]) * (middle[i] - 2 * low[j])
        np.add.at(winding, i[above], forward[j[above]])
    return winding


def _rings(start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Rings of directed edges with the interior on their left: at a vertex the leftmost way goes on, and a ring that comes back to a vertex is closed there."""
    out, ahead = [], defaultdict(list)
    for p, q in zip(map(tuple, start.tolist()), map(tuple, end.tolist())):
        ahead[p].append(q)
    for first in map(tuple, start.tolist()):
        if not ahead[first]:
            continue
        path, place, at = [first], {first: 0}, first
        while True:
            ways = ahead[at]
            if not ways:
                break
            if len(ways) > 1 and len(path) > 1:
                dx, dy = at[0] - path[-2][0], at[1] - path[-2][1]
                ways.sort(key=lambda q: np.arctan2(float(dx * (q[1] - at[1]) - dy * (q[0] - at[0])), float(dx * (q[0] - at[0]) + dy * (q[1] - at[1]))))
            at = ways.pop()
            if at in place:
                loop = path[place[at] :]
                out.append(np.array(loop, np.int64))
                for p in loop[1:]:
                    del place[p]
                path = path[: place[at] + 1]
            else:
                place[at] = len(path)
                path.append(at)
    return [r for r in map(_straightened, out) if len(r) > 2]


def _straightened(ring: np.ndarray) -> np.ndarray:
    """Without points on straight stretches, beginning with its smallest point."""
    ring = ring[_cross(np.roll(ring, 1, 0), ring, np.roll(ring, -1, 0)) != 0]
    return np.roll(ring, -np.lexsort((ring[:, 1], ring[:, 0]))[0], 0) if len(ring) else ring


def _area2(ring: np.ndarray) -> int:
    nxt = np.roll(ring, -1, 0)
    return sum((ring[:, 0] * nxt[:, 1] - nxt[:, 0] * ring[:, 1]).tolist())


def _nested(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Polygons of rings: each hole with the smallest outer ring around it."""
    outers = sorted((r for r in rings if _area2(r) > 0), key=lambda r: (_area2(r), r[0].tolist()))
    out = [[r] for r in outers]
    for hole in sorted((r for r in rings if _area2(r) < 0), key=lambda r: r[0].tolist()):
        x, y = (hole[0] + hole[1]).tolist()  # twice the middle of an edge: on no other ring
        for polygon in out:
            a = 2 * polygon[0]
            b = np.roll(a, -1, 0)
            up = (a[:, 1] <= y) & (y < b[:, 1])
            down = (b[:, 1] <= y) & (y < a[:, 1])
            side = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (b[:, 1] - a[:, 1]) * (x - a[:, 0])
            if ((up & (side > 0)) | (down & (side < 0))).sum() % 2:
                polygon.append(hole)
                break
    return sorted(out, key=lambda p: p[0][0].tolist())


def _even_odd(windings: np.ndarray) -> np.ndarray:
    return windings % 2 == 1


def overlay(shapes: list[list], rule: Callable | None = None, grid: float = GRID, inside: Callable = _even_odd) -> list:
    """shapes: for each layer its rings (lists of dicts x, y, closed or not); inside tells from a layer's winding numbers which places it holds: by default what an odd number of its rings
    goes around. rule: of a boolean array a layer, which places the result holds (one layer: the layer itself). Polygons of the result, valid: rings simple, holes in their polygons."""
    rings = [(k, np.array([(p["x"], p["y"]) for p in r], float)) for k, shape in enumerate(shapes) for r in shape or [] if r and len(r) > 2]
    if not rings:
        return []
    every = np.concatenate([r for _, r in rings])
    origin = every.min(axis=0)
    grid = max(grid, float((every - origin).max()) / LARGEST)
    origin = np.floor(origin / grid)
    starts, ends, layers = [], [], []
    for k, r in rings:
        p = (np.rint(r / grid) - origin).astype(np.int64)
        q = np.roll(p, -1, 0)
        moved = (p != q).any(axis=1)
        starts.append(p[moved])
        ends.append(q[moved])
        layers.append(np.full(int(moved.sum()), k))
    edges, net = _edges(*_noded(np.concatenate(starts), np.concatenate(ends), np.concatenate(layers)), len(shapes))
    if not len(edges):
        return []
    low = _below(edges, net)
    upright = (edges[:, 0] == edges[:, 2])[:, None]
    left, right = inside(np.where(upright, low, low + net)), inside(np.where(upright, low - net, low))
    decide = (lambda x: x[:, 0]) if rule is None else lambda x: rule(*x.T)
    left, right = decide(left), decide(right)
    kept = left != right
    edges = np.where(left[:, None], edges, edges[:, [2, 3, 0, 1]])[kept]
    point = lambda p: {"x": float((p[0] + origin[0]) * grid), "y": float((p[1] + origin[1]) * grid)}
    return [[[point(p) for p in r.tolist()] for r in polygon] for polygon in _nested(_rings(edges[:, :2], edges[:, 2:]))]


#: Pairs of shapes lie so far apart that none meet, and so many in one sweep at most; pairs of segments of one sweep.
_APART, _PAIRS, _MEETINGS = 2 * LARGEST, 4096, 1_000_000


def _segments(shapes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shapes (arrays of rings) as the sides of their rings: number of the shape, start and end. What overlay leaves out is left out."""
    rings = pc.list_flatten(shapes)
    shape, ring = pc.list_parent_indices(shapes).to_numpy(), pc.list_parent_indices(rings).to_numpy()
    points = pc.list_flatten(rings)
    p = np.stack([pc.struct_field(points, c).to_numpy(zero_copy_only=False).astype(float) for c in "xy"], axis=1)
    size = np.bincount(ring, minlength=len(rings))
    last = np.cumsum(size)[ring] == np.arange(1, len(ring) + 1)
    ahead = np.arange(1, len(ring) + 1)
    ahead[last] -= size[ring[last]]
    kept = size[ring] > 2
    return shape[ring][kept], p[kept], p[ahead][kept]


def areas(a: pa.Array, b: pa.Array, grid: float = GRID) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of shapes the area of the first, of the second, and of what they have in common, as overlay has them; many pairs in one sweep, each far from the others."""
    parts = [_segments(x) for x in (a, b)]
    pair, start, end = (np.concatenate(x) for x in zip(*parts))
    layer = np.repeat([0, 1], [len(x[0]) for x in parts])
    n = len(a)
    origin, far = np.full((n, 2), np.inf), np.full((n, 2), -np.inf)
    np.minimum.at(origin, pair, start)
    np.maximum.at(far, pair, start)
    some = np.bincount(pair, minlength=n) > 0
    origin[~some] = far[~some] = 0.0
    grids = np.maximum(grid, (far - origin).max(axis=1) / LARGEST)
    first = np.floor(origin / grids[:, None])
    start, end = ((np.rint(p / grids[pair, None]) - first[pair]).astype(np.int64) for p in (start, end))
    order = np.argsort(pair, kind="stable")
    pair, start, end, layer = pair[order], start[order], end[order], layer[order]
    out = np.zeros((3, n))
    # pairs of one sweep: their segments may all meet
    begin, work = 0, np.bincount(pair, minlength=n) ** 2
    while begin < n:
        stop = begin + max(1, int(np.searchsorted(np.cumsum(work[begin : begin + _PAIRS]), _MEETINGS, "right")))
        lo, hi = np.searchsorted(pair, [begin, stop])
        place = ((pair[lo:hi] - begin) * _APART)[:, None]
        moved = (start[lo:hi] != end[lo:hi]).any(axis=1)
        edges, net = _edges(*_noded((start[lo:hi] + place)[moved], (end[lo:hi] + place)[moved], layer[lo:hi][moved]), 2)
        if len(edges):
            low = _below(edges, net)
            upright = (edges[:, 0] == edges[:, 2])[:, None]
            left, right = _even_odd(np.where(upright, low, low + net)), _even_odd(np.where(upright, low - net, low))
            whose = edges[:, 0] // _APART
            e = (edges - (whose * _APART)[:, None]).astype(float)
            cross = (e[:, 0] * e[:, 3] - e[:, 2] * e[:, 1]) / 2
            for k, (x, y) in enumerate(((left[:, 0], right[:, 0]), (left[:, 1], right[:, 1]), (left.all(axis=1), right.all(axis=1)))):
                out[k, begin:stop] = np.bincount(whose, (x.astype(int) - y) * cross, stop - begin)
        begin = stop
    return tuple(out * grids**2)


def _wide(rings: list, distance: float, quarter: int) -> list:
    """Rings that together cover all places within distance of the outlines, counter-clockwise each: a strip a side, a disc a vertex."""
    turns = np.arange(4 * quarter) * np.pi / (2 * quarter)
    disc = distance * np.stack((np.cos(turns), np.sin(turns)), axis=1)
    out = []
    for r in rings:
        p = np.array([(v["x"], v["y"]) for v in r], float)
        q = np.roll(p, -1, 0)
        along = np.hypot(*(q - p).T)
        for a, b, n in zip(p, q, along):
            out.append(a + disc)
            if n > 0:
                side = distance / n * np.array([b[1] - a[1], a[0] - b[0]])
                out.append(np.array([a + side, b + side, b - side, a - side]))
    return [[{"x": x, "y": y} for x, y in ring.tolist()] for ring in out]


def buffered(rings: list, distance: float, quarter: int = 8, grid: float = GRID) -> list:
    """All places within distance of a shape; with a negative distance, those of the shape that are at least so far from its outline. Round joins, a quarter of a circle in so many steps."""
    if not rings or not distance:
        return overlay([rings], None, grid)
    wide = _wide(rings, abs(distance), quarter)
    body = [r for polygon in overlay([rings], None, grid) for r in polygon]  # outer rings counter-clockwise, holes clockwise
    return overlay([body, wide], _RULES["union" if distance > 0 else "difference"], grid, lambda w: w > 0)


def simplified(ring: list, tolerance: float) -> list:
    """Douglas-Peucker: the points of a closed ring without which the outline would move by more than tolerance; from its first point and the one farthest from it."""
    p = np.array([(v["x"], v["y"]) for v in ring], float)
    if len(p) > 1 and (p[0] == p[-1]).all():
        p = p[:-1]
    if len(p) < 4:
        return [{"x": x, "y": y} for x, y in p.tolist()]
    far = int(np.hypot(*(p - p[0]).T).argmax())
    p = np.concatenate((p, p[:1]))
    kept, open_ = np.zeros(len(p), bool), [(0, far), (far, len(p) - 1)]
    kept[[0, far]] = True
    while open_:
        i, j = open_.pop()
        if j - i < 2:
            continue
        d, v = p[j] - p[i], p[i + 1 : j] - p[i]
        t = np.clip(v @ d / max(d @ d, 1e-300), 0, 1)
        away = np.hypot(*(v - t[:, None] * d).T)
        k = int(away.argmax())
        if away[k] > tolerance:
            kept[i + 1 + k] = True
            open_ += [(i, i + 1 + k), (i + 1 + k, j)]
    return [{"x": x, "y": y} for x, y in p[:-1][kept[:-1]].tolist()]


# --- column functions ------------------------------------------------------------------------------------------------------


def rings_of(polygons: Column) -> Column:
    """All rings of a multipolygon."""
    return F.flatten(polygons)


def _multi(run: Callable[..., list], *columns: Column) -> Column:
    """run on the values of each row, in Arrow batches: a multipolygon; NULL where any of them is NULL."""

    @F.arrow_udf(MULTI)
    def one(a: pa.Array) -> pa.Array:
        return pa.array([None if x is None else run(x) for x in a.to_pylist()], _KIND)

    @F.arrow_udf(MULTI)
    def two(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else run(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], _KIND)

    return (one if len(columns) == 1 else two)(*columns)


_KIND = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def union(a: Column, b: Column, grid: float = GRID) -> Column:
    """a, b: arrays of rings. A multipolygon; an empty array for an empty result, NULL where either is NULL. The same holds for intersection, difference and symmetric_difference."""
    return _multi(lambda x, y: overlay([x, y], _RULES["union"], grid), a, b)


def intersection(a: Column, b: Column, grid: float = GRID) -> Column:
    return _multi(lambda x, y: overlay([x, y], _RULES["intersection"], grid), a, b)


def difference(a: Column, b: Column, grid: float = GRID) -> Column:
    return _multi(lambda x, y: overlay([x, y], _RULES["difference"], grid), a, b)


def symmetric_difference(a: Column, b: Column, grid: float = GRID) -> Column:
    return _multi(lambda x, y: overlay([x, y], _RULES["symmetric_difference"], grid), a, b)


def overlap(a: Column, b: Column, grid: float = GRID) -> Column:
    """Areas of two arrays of rings and of what they have in common: a struct of first, second, common; NULL where either is NULL. Those of the difference, the union and the
    symmetric difference follow. Much faster than the areas of overlays: a batch of pairs is one sweep, and no rings are built."""

    @F.arrow_udf("first double, second double, common double")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        null = pc.or_(pc.is_null(x), pc.is_null(y))
        found = [pa.array(v) for v in areas(x, y, grid)]
        return pa.StructArray.from_arrays(found, ["first", "second", "common"], mask=null)

    return run(a, b)


def repair(rings: Column, grid: float = GRID) -> Column:
    """A valid multipolygon of rings that may cross or touch themselves and each other, repeat points or collapse: inside is what an odd number of rings holds."""
    return _multi(lambda x: overlay([x], None, grid), rings)


def buffer(rings: Column, distance: float, quarter: int = 8, grid: float = GRID) -> Column:
    """rings widened by distance, or narrowed by a negative one, with round joins."""
    return _multi(lambda x: buffered(x, distance, quarter, grid), rings)


def simplify(rings: Column, tolerance: float, grid: float = GRID) -> Column:
    """rings without the points that matter less than tolerance; what crosses itself then is repaired."""
    return _multi(lambda x: overlay([[simplified(r, tolerance) for r in x if r]], None, grid), rings)


def rings_area(rings: Column) -> Column:
    """Area of one polygon: its first ring without the others, however they turn."""
    sizes = F.transform(rings, lambda r: F.abs(geo.ring_area(r)))
    return F.aggregate(sizes, F.lit(0.0), lambda s, x: s - x) + 2 * F.coalesce(F.get(sizes, 0), F.lit(0.0))


def area(polygons: Column) -> Column:
    return F.aggregate(F.transform(polygons, rings_area), F.lit(0.0), lambda s, x: s + x)


def centroid(rings: Column) -> Column:
    """Area centroid of one polygon with holes."""
    weight = F.transform(rings, lambda r, i: F.when(i == 0, F.abs(geo.ring_area(r))).otherwise(-F.abs(geo.ring_area(r))))
    centres = F.transform(rings, geo.ring_centroid)
    part = lambda c: F.try_divide(F.aggregate(F.zip_with(weight, F.transform(centres, lambda p: p[c]), lambda w, x: w * x), F.lit(0.0), lambda s, x: s + x), F.aggregate(weight, F.lit(0.0), lambda s, x: s + x))
    return F.struct(part("x").alias("x"), part("y").alias("y"))


def bounds(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return geo.rect(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def tile_cover(regions: DataFrame, tilesize: int, pad: int, resolution: float, rings: str = "rings") -> DataFrame:
    """regions: rings of a region in degrees (one polygon with its holes). A row for each grid tile that shares some area with the region: the region's columns and key. The tiles of
    its bounding box are keys in an array (so cut very large regions first); each is held against the region by itself."""
    box = regions.where(F.size(rings) > 0).withColumn("key", F.explode(geo.tile_cover(bounds(F.get(rings, 0)), tilesize, pad, resolution)))
    common = area(intersection(F.col(rings), F.array(geo.tile_corners(F.col("key")))))
    return box.withColumn("_common", common).where("_common > 0").drop("_common")


# --- overlap resolution ----------------------------------------------------------------------------------------------------


def resolve_overlaps(contours: DataFrame, sites: DataFrame, height: float = 0.02, grid: float = GRID) -> DataFrame:
    """contours: name, date, polygons (multipolygon, one row a name and date); sites: name, lon, lat. Adds lost: how many polygons the site lost.

    Where the rectangles of two sites overlap (partly, not one within the other) and both have a contour of a date, a polygon that partly overlaps one of the other site's goes, if its centroid is farther from its own
    site than the other polygon's centroid from the other site; all comparisons are between the contours as they came. What goes is cut out of the contour; ties keep both.
    A contour without polygons, or NULL, stays as it is."""
    rect = sites.select("name", geo.rect_around(F.col("lon"), F.col("lat"), height).alias("rect_a"), "lon", "lat")
    other = rect.select(F.col("name").alias("name2"), F.col("rect_a").alias("rect_b"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    parts = shared(contours.select("name", "date", F.posexplode("polygons").alias("part", "rings")).where(F.size("rings") > 0).select("*", centroid(F.col("rings")).alias("centre"), bounds(F.get("rings", 0)).alias("box")))
    theirs = parts.select(*[F.col(c).alias(f"{c}2") for c in ("name", "date", "rings", "centre", "box")])
    # polygons of one date meet where their boxes do, not by way of all pairs of sites
    meet = lambda p, q: geo.rects_intersect(p, q) & (F.col("date") == F.col("date2")) & (F.col("name") != F.col("name2")) & geo.rects_overlap(F.col("rect_a"), F.col("rect_b"))
    near = spatial.rect_pairs(parts.join(rect, "name"), theirs.join(other, "name2"), height, meet, "box", "box2", spread=True)
    own, foreign = geo.distance(F.col("centre.x"), F.col("centre.y"), F.col("lon"), F.col("lat")), geo.distance(F.col("centre2.x"), F.col("centre2.y"), F.col("lon2"), F.col("lat2"))
    common = overlap(F.col("rings"), F.col("rings2"), grid)["common"]
    partly = near.where(own > foreign).withColumn("_common", common).where((F.col("_common") > 0) & (F.col("_common") < F.least(rings_area(F.col("rings")), rings_area(F.col("rings2"))) * (1 - 1e-9)))
    lost = partly.select("name", "date", "part").distinct().join(parts.select("name", "date", "part", "rings"), ["name", "date", "part"])
    lost = lost.groupBy("name", "date").agg(F.collect_list("rings").alias("_lost"))
    out = contours.join(lost, ["name", "date"], "left")
    cut = out.where(F.col("_lost").isNotNull()).withColumn("polygons", difference(rings_of(F.col("polygons")), rings_of(F.col("_lost")), grid))
    return out.where(F.col("_lost").isNull()).unionByName(cut).withColumn("lost", F.coalesce(F.size("_lost"), F.lit(0))).withColumn("lost", F.greatest("lost", F.lit(0))).drop("_lost")


# --- dissolve --------------------------------------------------------------------------------------------------------------


def boundary(polygons: DataFrame, keys: Sequence[str], rings: str = "rings", cell: float = 1.0, grid: float = GRID) -> DataFrame:
    """polygons: keys, rings. Directed edges of the outline of each key's union, on the grid: keys, ax, ay, bx, by (long), the interior on the left.

    Edges are split where a vertex of the same key lies on them (found by cells of that size, so make it no smaller than most edges), then edges that run both ways cancel."""
    snap = lambda v: F.round(v / grid).cast("long")
    one = polygons.select(*keys, F.posexplode(rings).alias("_hole", "_ring"))
    # outer rings counter-clockwise, holes clockwise
    turned = F.when((geo.ring_area(F.col("_ring")) > 0) == (F.col("_hole") == 0), F.col("_ring")).otherwise(F.reverse("_ring"))
    one = one.select(*keys, F.transform(turned, lambda p: F.struct(snap(p["x"]).alias("x"), snap(p["y"]).alias("y"))).alias("_ring"))
    pair = F.transform("_ring", lambda p, i: F.struct(p.alias("a"), F.get("_ring", (i + 1) % F.size("_ring")).alias("b")))
    edges = one.select(*keys, F.explode(pair).alias("_e")).where("_e.a <> _e.b").select(*keys, F.col("_e.a.x").alias("ax"), F.col("_e.a.y").alias("ay"), F.col("_e.b.x").alias("bx"), F.col("_e.b.y").alias("by"))
    edges = shared(_cancelled(edges, keys))
    step = max(1, round(cell / grid))
    cells = lambda a, b: F.sequence(F.floor(F.least(a, b) / step), F.floor(F.greatest(a, b) / step))
    spread = edges.withColumn("_cx", F.explode(cells(F.col("ax"), F.col("bx")))).withColumn("_cy", F.explode(cells(F.col("ay"), F.col("by"))))
    points = edges.select(*keys, F.col("ax").alias("px"), F.col("ay").alias("py")).distinct().withColumn("_cx", F.floor(F.col("px") / step)).withColumn("_cy", F.floor(F.col("py") / step))
    within = lambda p, a, b: F.col(p).between(F.least(a, b), F.greatest(a, b))
    wide = lambda c: c.cast("decimal(19,0)")
    cross = wide(F.col("bx") - F.col("ax")) * wide(F.col("py") - F.col("ay")) == wide(F.col("by") - F.col("ay")) * wide(F.col("px") - F.col("ax"))
    inner = ~((F.col("px") == F.col("ax")) & (F.col("py") == F.col("ay"))) & ~((F.col("px") == F.col("bx")) & (F.col("py") == F.col("by")))
    on = spread.join(points, [*keys, "_cx", "_cy"]).where(within("px", "ax", "bx") & within("py", "ay", "by") & inner & cross)
    way = (F.abs(F.col("px") - F.col("ax")) + F.abs(F.col("py") - F.col("ay"))).alias("way")
    ends = ["ax", "ay", "bx", "by"]
    stops = on.groupBy(*keys, *ends).agg(F.sort_array(F.collect_set(F.struct(way, "px", "py"))).alias("_s"))
    same = [edges[c].eqNullSafe(stops[c]) for c in (*keys, *ends)]
    split = edges.join(stops, [*keys, *ends], "left") if not any(edges.schema[k].nullable for k in keys) else edges.join(stops, same, "left").select(edges["*"], "_s")
    chain = F.concat(F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"))), F.transform(F.coalesce("_s", F.array().cast("array<struct<way: bigint, px: bigint, py: bigint>>")), lambda s: F.struct(s["px"].alias("x"), s["py"].alias("y"))), F.array(F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))))
    pieces = F.transform(F.slice(chain, 1, F.size(chain) - 1), lambda p, i: F.struct(p.alias("a"), F.get(chain, i + 1).alias("b")))
    parts = split.select(*keys, F.explode(pieces).alias("_e")).select(*keys, F.col("_e.a.x").alias("ax"), F.col("_e.a.y").alias("ay"), F.col("_e.b.x").alias("bx"), F.col("_e.b.y").alias("by"))
    return _cancelled(parts, keys)


def _cancelled(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Edges without those that run both ways equally often; repeated ones are one."""
    back = F.struct("ax", "ay") > F.struct("bx", "by")
    low, high = F.least(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))), F.greatest(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))
    net = edges.select(*keys, low.alias("_l"), high.alias("_h"), F.when(back, -1).otherwise(1).alias("_d")).groupBy(*keys, "_l", "_h").agg(F.sum("_d").alias("_n")).where("_n <> 0")
    end = lambda first, c: F.when((F.col("_n") > 0) == F.lit(first), F.col(f"_l.{c}")).otherwise(F.col(f"_h.{c}"))
    return net.select(*keys, end(True, "x").alias("ax"), end(True, "y").alias("ay"), end(False, "x").alias("bx"), end(False, "y").alias("by"))


def dissolve(polygons: DataFrame, keys: Sequence[str], rings: str = "rings", cell: float = 1.0, grid: float = GRID) -> DataFrame:
    """polygons: keys, rings of polygons that do not overlap within a key (they may share edges, in part too, touch, or repeat). The outline of each key's union, one row a ring: keys, ring,
    area (negative: a hole), points. Places that touch at a corner alone stay apart: their outer rings are separate. Empty arrays and NULL rings give nothing."""
    edges = shared(boundary(polygons, keys, rings, cell, grid).withColumn("_id", F.monotonically_increasing_id()))
    # the next edge of a ring: of those that leave its end, the leftmost
    ahead = edges.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("ax").alias("bx"), F.col("ay").alias("by"), F.col("bx").alias("cx"), F.col("by").alias("cy"), F.col("_id").alias("_next"))
    dx, dy, ex, ey = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"), F.col("cx") - F.col("bx"), F.col("cy") - F.col("by")
    real = lambda c: c.cast("double")
    turn = F.atan2(real(dx) * real(ey) - real(dy) * real(ex), real(dx) * real(ex) + real(dy) * real(ey))
    met = edges.join(ahead, ["bx", "by"]).where(_all([F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]))
    links = shared(met.groupBy("_id").agg(F.max_by("_next", turn).alias("_next")))
    # the least edge of each ring, looking twice as far ahead in each round
    now = shared(links.select("_id", F.col("_next").alias("_far"), F.least("_id", "_next").alias("_low")))
    while True:
        there = now.select(F.col("_id").alias("_i"), F.col("_far").alias("_far2"), F.col("_low").alias("_low2"))
        after = shared(now.join(there, F.col("_far") == F.col("_i")).select("_id", F.col("_far2").alias("_far"), F.least("_low", "_low2").alias("_low"), (F.col("_low2") < F.col("_low")).alias("_moved")))
        now = after.drop("_moved")
        if not after.where("_moved").limit(1).count():
            break
    # how many edges come before a ring's least edge comes again
    heads = now.select("_id", "_low")
    now = shared(links.join(heads, "_id").select("_id", "_low", F.when(F.col("_next") != F.col("_low"), F.col("_next")).alias("_far"), F.lit(1).cast("long").alias("_left")))
    while now.where("_far IS NOT NULL").limit(1).count():
        there = now.select(F.col("_id").alias("_i"), F.col("_far").alias("_far2"), F.col("_left").alias("_left2"))
        now = shared(now.join(there, F.col("_far") == F.col("_i"), "left").select("_id", "_low", F.col("_far2").alias("_far"), (F.col("_left") + F.coalesce("_left2", F.lit(0))).alias("_left")))
    whole = edges.join(now.select("_id", "_low", "_left"), "_id")
    listed = whole.groupBy(*keys, "_low").agg(F.sort_array(F.collect_list(F.struct((-F.col("_left")).alias("o"), "ax", "ay"))).alias("_p"))
    n = F.size("_p")
    bend = lambda p, i: (F.get("_p", (i + n - 1) % n)["ax"] - p["ax"]) * (F.get("_p", (i + 1) % n)["ay"] - p["ay"]) != (F.get("_p", (i + n - 1) % n)["ay"] - p["ay"]) * (F.get("_p", (i + 1) % n)["ax"] - p["ax"])
    ring = F.transform(F.filter("_p", bend), lambda p: F.struct((p["ax"] * F.lit(grid)).alias("x"), (p["ay"] * F.lit(grid)).alias("y")))
    return listed.select(*keys, ring.alias("ring")).select(*keys, "ring", geo.ring_area(F.col("ring")).alias("area"), F.size("ring").alias("points"))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
