"""Borders of binary images by border following (Suzuki and Abe 1985): on pixel centres, outer borders and holes, each with the border around it, in one pass and in time
linear in the length of the borders."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .raster import _kinds, blur, upscale
from .raster import _image as image_of

#: Neighbours in clockwise order (rows grow downwards), from the right one on: row, column.
AROUND = ((0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1))
_PLACE = {step: k for k, step in enumerate(AROUND)}


class Border(NamedTuple):
    points: list[tuple[int, int]]  # x, y; straight runs by their ends
    hole: bool
    parent: int  # number of the border around it from 1; 0 is the frame


def follow(mask: np.ndarray) -> list[Border]:
    """The borders of the 8-connected regions of a mask, in order of their first pixels, row by row."""
    f = np.pad(mask.astype(np.int64), 1)
    rim = (f > 0) & ((np.roll(f, -1, 1) == 0) | (np.roll(f, 1, 1) == 0) | (np.roll(f, 1, 0) == 0) | (np.roll(f, -1, 0) == 0))
    f = f.tolist()
    out: list[Border] = []
    row, last = -1, 0
    for i, j in np.argwhere(rim).tolist():
        if i != row:
            row, last = i, 0  # each row begins at the frame
        here = f[i][j]
        if here == 1 and f[i][j - 1] == 0:
            start, hole = (0, -1), False
        elif here >= 1 and f[i][j + 1] == 0:
            start, hole = (0, 1), True
            last = here - 1 if here > 1 else last
        else:
            last = abs(here) - 1 if here != 1 else last
            continue
        # last: number of the border met last in this row; marks in the image are one more
        around = out[last - 1] if last else Border([], True, 0)
        parent = last if around.hole != hole else around.parent
        number = len(out) + 1
        out.append(Border(_trace(f, i, j, _PLACE[start], number + 1), hole, parent))
        here = f[i][j]
        last = abs(here) - 1 if here != 1 else last
    return out


def _trace(f: list[list[int]], i: int, j: int, start: int, mark: int) -> list[tuple[int, int]]:
    """Follows one border from its first pixel, marks its pixels, and gives its corners."""
    first = next((k % 8 for k in range(start, start + 8) if f[i + AROUND[k % 8][0]][j + AROUND[k % 8][1]]), None)
    if first is None:
        f[i][j] = -mark
        return [(j - 1, i - 1)]
    stop = (i + AROUND[first][0], j + AROUND[first][1])
    y, x, back, points, came = i, j, first, [], None
    while True:
        right_is_empty = False
        k = back
        while True:
            k = (k - 1) % 8  # counter-clockwise, from behind
            if f[y + AROUND[k][0]][x + AROUND[k][1]]:
                break
            right_is_empty |= k == 0
        if right_is_empty:
            f[y][x] = -mark
        elif f[y][x] == 1:
            f[y][x] = mark
        if came != k:
            points.append((x - 1, y - 1))
        ny, nx = y + AROUND[k][0], x + AROUND[k][1]
        if (ny, nx) == (i, j) and (y, x) == stop:
            # the way into the first pixel may go straight on
            return points[1:] if len(points) > 2 and _step(points[0], points[1]) == AROUND[k] else points
        y, x, back, came = ny, nx, (k + 4) % 8, k


def _step(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
    return int(np.sign(b[1] - a[1])), int(np.sign(b[0] - a[0]))


def polygons_of(borders: Sequence[Border], least: int = 3) -> list[list[list[tuple[int, int]]]]:
    """Outer borders with the holes right inside them, as polygons. Borders of fewer than `least` corners are left out, with all that lies inside."""
    kept: list[bool] = []
    for b in borders:
        kept.append(len(b.points) >= least and (not b.parent or kept[b.parent - 1]))
    out, at = [], {}
    for n, b in enumerate(borders, 1):
        if kept[n - 1] and not b.hole:
            at[n] = len(out)
            out.append([b.points])
    for n, b in enumerate(borders, 1):
        if kept[n - 1] and b.hole:
            out[at[b.parent]].append(b.points)
    return out


def traced(df: DataFrame, keys: Sequence[str], threshold: float = 0.5, scale: int = 4, max_masked: float = 0.1, soft: bool = True) -> DataFrame:
    """Borders of each image (row, col, v): keys, border (number from 1), parent (0: none), hole, ring (array of struct x, y: pixel centres of the original), as they are followed.

    soft: the image is upscaled, brought to 0..255, blurred and cut at the threshold; else it is cut at the threshold as it is, and scale does not count. Images with max_masked or more missing
    pixels give nothing."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if pdf["v"].isna().mean() < max_masked:
            image, size = image_of(pdf), scale if soft else 1
            if soft:
                big = np.floor(np.clip(upscale(image, scale), 0, 1) * 255)
                mask = np.floor(blur(big, 4 * scale, 4.0) + 0.5) > int(threshold * 255)
            else:
                mask = image > threshold
            for n, b in enumerate(follow(mask), 1):
                rows.append((*[pdf[k].iloc[0] for k in keys], n, b.parent, b.hole, [{"x": (x + 0.5) / size, "y": (y + 0.5) / size} for x, y in b.points]))
        return pd.DataFrame(rows, columns=[*keys, "border", "parent", "hole", "ring"])

    return df.groupBy(*keys).applyInPandas(run, f"{_kinds(df, keys)}, border int, parent int, hole boolean, ring array<struct<x: double, y: double>>")
