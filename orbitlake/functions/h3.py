"""Site ids: H3 cell indexes of points, from the published specification of the grid.

The globe is projected on the 20 faces of an icosahedron; each face has a lattice of hexagons with axes i, j and k 120 degrees apart, every resolution
with seven times as many cells as the one before and turned by some 19 degrees, to and fro. An index names one of 122 base cells and a
digit a resolution, the direction from a parent's centre to its child. Neighbouring faces are laid flat side by side to find the base cell of a place
near an edge, and how far the directions are turned there.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESOLUTION = 15

# Fixed values of the specification: latitude and longitude of the centre of each face, and the azimuth of its i axis, in radians.
FACES = (
    (0.803582649718989942, 1.248397419617396099, 5.619958268523939882),
    (1.307747883455638156, 2.536945009877921159, 5.760339081714187279),
    (1.054751253523952054, -1.347517358900396623, 0.780213654393430055),
    (0.600191595538186799, -0.450603909469755746, 0.430469363979999913),
    (0.491715428198773866, 0.401988202911306943, 6.130269123335111400),
    (0.172745327415618701, 1.678146885280433686, 2.692877706530642877),
    (0.605929321571350690, 2.953923329812411617, 2.982963003477243874),
    (0.427370518328979641, -1.888876200336285401, 3.532912002790141181),
    (-0.079066118549212831, -0.733429513380867741, 3.494305004259568154),
    (-0.230961644455383637, 0.506495587332349035, 3.003214169499538391),
    (0.079066118549212831, 2.408163140208925497, 5.930472956509811562),
    (0.230961644455383637, -2.635097066257444203, 0.138378484090254847),
    (-0.172745327415618701, -1.463445768309359553, 0.448714947059150361),
    (-0.605929321571350690, -0.187669323777381622, 0.158629650112549365),
    (-0.427370518328979641, 1.252716453253507838, 5.891865957979238535),
    (-0.600191595538186799, 2.690988744120037492, 2.711123289609793325),
    (-0.491715428198773866, -2.739604450678486295, 3.294508837434268316),
    (-0.803582649718989942, -1.893195233972397139, 3.804819692245439833),
    (-1.307747883455638156, -0.604647643711872080, 3.664438879055192436),
    (-1.054751253523952054, 1.794075294689396615, 2.361378999196363184),
)
# Fixed values of the specification: the home of each base cell, a face and a place on it (i, j, k).
HOMES = (
    (1, 1, 0, 0), (2, 1, 1, 0), (1, 0, 0, 0), (2, 1, 0, 0), (0, 2, 0, 0), (1, 1, 1, 0), (1, 0, 0, 1), (2, 0, 0, 0), (0, 1, 0, 0), (2, 0, 1, 0), (1, 0, 1, 0), (1, 0, 1, 1), (3, 1, 0, 0),
    (3, 1, 1, 0), (11, 2, 0, 0), (4, 1, 0, 0), (0, 0, 0, 0), (6, 0, 1, 0), (0, 0, 0, 1), (2, 0, 1, 1), (7, 0, 0, 1), (2, 0, 0, 1), (0, 1, 1, 0), (6, 0, 0, 1), (10, 2, 0, 0), (6, 0, 0, 0),
    (3, 0, 0, 0), (11, 1, 0, 0), (4, 1, 1, 0), (3, 0, 1, 0), (0, 0, 1, 1), (4, 0, 0, 0), (5, 0, 1, 0), (0, 0, 1, 0), (7, 0, 1, 0), (11, 1, 1, 0), (7, 0, 0, 0), (10, 1, 0, 0), (12, 2, 0, 0),
    (6, 1, 0, 1), (7, 1, 0, 1), (4, 0, 0, 1), (3, 0, 0, 1), (3, 0, 1, 1), (4, 0, 1, 0), (6, 1, 0, 0), (11, 0, 0, 0), (8, 0, 0, 1), (5, 0, 0, 1), (14, 2, 0, 0), (5, 0, 0, 0), (12, 1, 0, 0),
    (10, 1, 1, 0), (4, 0, 1, 1), (12, 1, 1, 0), (7, 1, 0, 0), (11, 0, 1, 0), (10, 0, 0, 0), (13, 2, 0, 0), (10, 0, 0, 1), (11, 0, 0, 1), (9, 0, 1, 0), (8, 0, 1, 0), (6, 2, 0, 0), (8, 0, 0, 0),
    (9, 0, 0, 1), (14, 1, 0, 0), (5, 1, 0, 1), (16, 0, 1, 1), (8, 1, 0, 1), (5, 1, 0, 0), (12, 0, 0, 0), (7, 2, 0, 0), (12, 0, 1, 0), (10, 0, 1, 0), (9, 0, 0, 0), (13, 1, 0, 0), (16, 0, 0, 1),
    (15, 0, 1, 1), (15, 0, 1, 0), (16, 0, 1, 0), (14, 1, 1, 0), (13, 1, 1, 0), (5, 2, 0, 0), (8, 1, 0, 0), (14, 0, 0, 0), (9, 1, 0, 1), (14, 0, 0, 1), (17, 0, 0, 1), (12, 0, 0, 1), (16, 0, 0, 0),
    (17, 0, 1, 1), (15, 0, 0, 1), (16, 1, 0, 1), (9, 1, 0, 0), (15, 0, 0, 0), (13, 0, 0, 0), (8, 2, 0, 0), (13, 0, 1, 0), (17, 1, 0, 1), (19, 0, 1, 0), (14, 0, 1, 0), (19, 0, 1, 1), (17, 0, 1, 0),
    (13, 0, 0, 1), (17, 0, 0, 0), (16, 1, 0, 0), (9, 2, 0, 0), (15, 1, 0, 1), (15, 1, 0, 0), (18, 0, 1, 1), (18, 0, 0, 1), (19, 0, 0, 1), (17, 1, 0, 0), (19, 0, 0, 0), (18, 0, 1, 0), (18, 1, 0, 1),
    (19, 2, 0, 0), (19, 1, 0, 0), (18, 0, 0, 0), (19, 1, 0, 1), (18, 1, 0, 0),
)
# Fixed values of the specification: of the twelve base cells at the corners, pentagons, the faces that are offset clockwise.
PENTAGONS = {4: (), 14: (2, 6), 24: (1, 5), 38: (3, 7), 49: (0, 9), 58: (4, 8), 63: (11, 15), 72: (12, 16), 83: (10, 19), 97: (13, 17), 107: (14, 18), 117: ()}
#: Length of a cell's step at resolution 0 on the plane of a face, and the turn of every second resolution.
UNIT, TURN = 0.381966011250105, math.asin(math.sqrt(3 / 28))
#: Digit of a step (i, j, k): k, j, j + k, i, i + k, i + j from 1 on; and each digit turned by 60 degrees.
K = 1
CCW = np.array([0, 5, 3, 1, 6, 4, 2, 7])


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    return np.stack((np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)), axis=-1)


def _plain(ijk) -> tuple[int, int]:
    """Steps along i and j alone: one along all three axes leads nowhere."""
    return ijk[0] - ijk[2], ijk[1] - ijk[2]


def _turned(p: tuple[int, int], times: int) -> tuple[int, int]:
    for _ in range(times % 6):
        p = (p[0] - p[1], p[0])
    return p


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors of the faces' centres; and by face and place (i, j, k up to 2): the base cell, and the turns from the face's directions to those of the base cell's home."""
    faces = np.array(FACES)
    centres = _unit(faces[:, 0], faces[:, 1])
    corners = [(2, 0), (0, 2), (-2, -2)]
    apart = math.atan(2 * UNIT)
    azimuth = faces[:, 2, None] - np.arange(3) * 2 * math.pi / 3
    lat = np.arcsin(np.sin(faces[:, :1]) * math.cos(apart) + np.cos(faces[:, :1]) * math.sin(apart) * np.cos(azimuth))
    lon = faces[:, 1:2] + np.arctan2(np.sin(azimuth) * math.sin(apart) * np.cos(faces[:, :1]), math.cos(apart) - np.sin(faces[:, :1]) * np.sin(lat))
    points = _unit(lat, lon)
    beside: dict[int, list] = {f: [] for f in range(20)}
    for f in range(20):
        for g in range(20):
            same = [(a, b) for a in range(3) for b in range(3) if points[f, a] @ points[g, b] > 0.999]
            if f != g and len(same) == 2:
                (a, x), (b, y) = [(corners[p], corners[q]) for p, q in same]
                turns = next(m for m in range(6) if _turned((b[0] - a[0], b[1] - a[1]), m) == (y[0] - x[0], y[1] - x[1]))
                moved = _turned(a, turns)
                beside[f].append((g, turns, (x[0] - moved[0], x[1] - moved[1])))
    home = {(f, _plain(ijk)): n for n, (f, *ijk) in enumerate(HOMES)}
    base, turn = np.full((20, 3, 3, 3), -1), np.zeros((20, 3, 3, 3), int)
    for f in range(20):
        for i, j, k in np.ndindex(3, 3, 3):
            # the place on this face, laid over to its neighbours and to theirs, until it is a home
            seen, ways = {f}, [(f, _plain((i, j, k)), 0)]
            while ways and base[f, i, j, k] < 0:
                g, p, m = ways.pop(0)
                if (g, p) in home:
                    base[f, i, j, k], turn[f, i, j, k] = home[g, p], m % 6
                for to, turns, shift in beside[g]:
                    if to not in seen:
                        seen.add(to)
                        q = _turned(p, turns)
                        ways.append((to, (q[0] + shift[0], q[1] + shift[1]), m + turns))
    # around a corner lie five faces where a plane has room for six: counter-clockwise from the home, they take the directions j + k, i + k, i, i + j and j of the home
    for n in PENTAGONS:
        corner = points[HOMES[n][0], 0]
        round_it = [(f, c) for f in range(20) for c in range(3) if points[f, c] @ corner > 0.999]
        east = centres[HOMES[n][0]] - (centres[HOMES[n][0]] @ corner) * corner
        north = np.cross(corner, east)
        round_it.sort(key=lambda fc: (math.atan2(centres[fc[0]] @ north, centres[fc[0]] @ east) + 0.1) % (2 * math.pi))  # the home first
        for q, (f, c) in enumerate(round_it):
            # a face sees itself from its corner on i, j or k in the direction j + k, i + k or i + j
            turn[f][tuple(2 * (a == c) for a in range(3))] = (q - (0, 1, 3)[c]) % 5
    return centres, base, turn


def _rounded(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lattice place (steps along i and j) whose hexagon holds a point of the plane."""
    j = y / math.sin(math.pi / 3)
    a, b = x + j / 2, -j
    c = -a - b
    ra, rb, rc = np.rint(a), np.rint(b), np.rint(c)
    da, db, dc = np.abs(ra - a), np.abs(rb - b), np.abs(rc - c)
    ra = np.where((da > db) & (da > dc), -rb - rc, ra)
    rb = np.where((db >= da) & (db > dc), -ra - rc, rb)
    return ra.astype(np.int64), -rb.astype(np.int64)


def cells(lat: np.ndarray, lon: np.ndarray, resolution: int = RESOLUTION) -> np.ndarray:
    """Indexes of points in degrees, as integers."""
    centres, bases, turns = _tables()
    lat, lon = np.radians(np.asarray(lat, float)), np.radians(np.asarray(lon, float))
    v = _unit(lat, lon)
    face = (v @ centres.T).argmax(axis=1)
    near = np.clip(((v - centres[face]) ** 2).sum(axis=1), 0, 4)
    apart = np.arccos(1 - near / 2)
    f_lat, f_lon, f_az = np.array(FACES)[face].T
    azimuth = np.arctan2(np.cos(lat) * np.sin(lon - f_lon), np.cos(f_lat) * np.sin(lat) - np.sin(f_lat) * np.cos(lat) * np.cos(lon - f_lon))
    angle = f_az - azimuth - (TURN if resolution % 2 else 0)
    r = np.tan(apart) / UNIT * math.sqrt(7) ** resolution
    i, j = _rounded(r * np.cos(angle), r * np.sin(angle))
    digits = np.full((len(lat), 16), 7)
    for level in range(resolution, 0, -1):
        if level % 2:
            pi, pj = np.rint((3 * i - j) / 7).astype(np.int64), np.rint((i + 2 * j) / 7).astype(np.int64)
            di, dj = i - (2 * pi + pj), j - (3 * pj - pi)
        else:
            pi, pj = np.rint((2 * i + j) / 7).astype(np.int64), np.rint((3 * j - i) / 7).astype(np.int64)
            di, dj = i - (3 * pi - pj), j - (pi + 2 * pj)
        low = np.minimum(np.minimum(di, dj), 0)
        digits[:, level] = 4 * (di - low) + 2 * (dj - low) - low
        i, j = pi, pj
    low = np.minimum(np.minimum(i, j), 0)
    at = (face, np.clip(i - low, 0, 2), np.clip(j - low, 0, 2), np.clip(-low, 0, 2))
    base, turn = bases[at], turns[at]
    used = slice(1, resolution + 1)
    for m in range(1, 6):
        rows = (turn >= m) & ~np.isin(base, list(PENTAGONS))
        digits[rows, used] = CCW[digits[rows, used]]
    for row in np.flatnonzero(np.isin(base, list(PENTAGONS))):
        digits[row, used] = _pentagon(digits[row, used], int(base[row]), int(face[row]), int(turn[row]))
    out = np.full(len(lat), 1 << 59, np.int64) | resolution << 52 | base << 45
    for level in range(1, 16):
        out |= digits[:, level] << 3 * (15 - level)
    return out


def _leading(digits: np.ndarray) -> int:
    found = digits[digits > 0]
    return int(found[0]) if len(found) else 0


def _pentagon(digits: np.ndarray, base: int, face: int, turns: int) -> np.ndarray:
    """A pentagon has no cells along k: those that would lie there are turned away, counter-clockwise unless the face is offset."""
    if _leading(digits) == K:
        digits = CCW[CCW[CCW[CCW[CCW[digits]]]]] if face in PENTAGONS[base] else CCW[digits]
    for _ in range(turns):
        digits = CCW[digits]
        if _leading(digits) == K:
            digits = CCW[digits]
    return digits


def h3_cell(lat: Column, lon: Column, resolution: int = RESOLUTION) -> Column:
    """The H3 index (15 hexadecimal digits) of a point in degrees; NULL for missing or non-finite coordinates. Points in one of the twelve pentagons and their children
    follow the specification's rules, but no reference values were at hand for them."""

    @F.pandas_udf(T.StringType())
    def index(y: pd.Series, x: pd.Series) -> pd.Series:
        y, x = y.astype(float), x.astype(float)
        good = np.isfinite(y) & np.isfinite(x)
        out = pd.Series([None] * len(y), dtype=object)
        out[good.to_numpy()] = [format(c, "x") for c in cells(y[good].to_numpy(), x[good].to_numpy(), resolution).tolist()]
        return out

    return index(lat.cast("double"), lon.cast("double"))
