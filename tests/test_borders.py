"""Border following on hand-made masks and against the counts of regions and holes; labels against flood fill."""

import collections
import time

import numpy as np

from orbitlake.operators import borders, raster


def mask(text):
    return np.array([[c == "#" for c in line] for line in text.split()])


def flood(m, diagonal):
    """Number of connected regions, by filling."""
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (diagonal or not (a and b))]
    label, n = np.zeros(m.shape, int), 0
    for r, c in np.argwhere(m):
        if not label[r, c]:
            n += 1
            todo = collections.deque([(r, c)])
            label[r, c] = n
            while todo:
                y, x = todo.popleft()
                for a, b in steps:
                    if 0 <= y + a < m.shape[0] and 0 <= x + b < m.shape[1] and m[y + a, x + b] and not label[y + a, x + b]:
                        label[y + a, x + b] = n
                        todo.append((y + a, x + b))
    return label, n


NESTED = """
###########.#
#.........#.#
#.#####.#.#..
#.#...#...#.#
#.#.#.#...#.#
#.#...#...#..
#.#####...#..
#.........#..
###########..
"""


def test_hierarchy_of_nested_holes():
    found = borders.follow(mask(NESTED))
    kind = [(b.hole, b.parent) for b in found]
    # the frame's outline; the bar beside it; the hole of the frame; the inner frame and a dot in that hole; the inner hole; the other bar; the inner hole's dot
    assert kind == [(False, 0), (False, 0), (True, 1), (False, 3), (False, 3), (True, 4), (False, 0), (False, 6)]
    # corners: a rectangle's four; a hole runs along the pixels around it, diagonally at the corners; a bar has two ends, a dot one point
    assert [len(b.points) for b in found] == [4, 2, 8, 4, 1, 8, 2, 1] and found[0].points == [(0, 0), (0, 8), (10, 8), (10, 0)]
    assert [len(p) for p in borders.polygons_of(found)] == [2, 2]


def test_thin_and_touching_shapes():
    assert borders.follow(np.zeros((3, 3), bool)) == [] and borders.polygons_of([]) == []
    assert borders.follow(np.ones((1, 1), bool)) == [borders.Border([(0, 0)], False, 0)]
    assert borders.follow(np.ones((3, 4), bool)) == [borders.Border([(0, 0), (0, 2), (3, 2), (3, 0)], False, 0)]
    assert borders.follow(mask("#.. .#. ..#")) == [borders.Border([(0, 0), (2, 2)], False, 0)]
    # diagonal neighbours are one region, so their hole is closed by corners
    found = borders.follow(mask(".#. #.# .#."))
    assert [(b.hole, b.parent) for b in found] == [(False, 0), (True, 1)]


def test_counts_of_random_masks():
    rng = np.random.default_rng(11)
    for k in range(200):
        m = rng.random((int(rng.integers(1, 20)), int(rng.integers(1, 20)))) < rng.random()
        found = borders.follow(m)
        label, n = flood(m, True)
        assert sum(not b.hole for b in found) == n and sum(b.hole for b in found) == flood(np.pad(~m, 1, constant_values=True), False)[1] - 1
        # every border lies on pixels of one region, a hole on those of its parent; borders in a hole lie inside it
        for b in found:
            assert len({label[y, x] for x, y in b.points}) == 1
            if b.hole:
                x, y = found[b.parent - 1].points[0]
                assert not found[b.parent - 1].hole and label[y, x] == label[b.points[0][1], b.points[0][0]]
            elif b.parent:
                assert found[b.parent - 1].hole
        assert (raster.label_components(m) == label).all()


def test_time_follows_the_border():
    m = np.zeros((1500, 1500), bool)
    m[10:1490, 10:1490] = True
    m[::3, 700:800] = False  # many borders
    began = time.perf_counter()
    found = borders.follow(m)
    raster.label_components(m)
    rings = raster.trace_rings(m[:600, 600:900])
    assert len(found) > 480 and len(rings) > 190 and time.perf_counter() - began < 20


def test_traced_images(spark):
    rows = [("a", r, c, 0.9 if 4 <= r < 12 and 4 <= c < 12 else 0.0) for r in range(16) for c in range(16)] + [("b", r, c, None) for r in range(4) for c in range(4)]
    df = spark.createDataFrame(rows, "k string, row int, col int, v double")
    got = borders.traced(df, ["k"]).collect()
    assert [(r["k"], r["border"], r["parent"], r["hole"]) for r in got] == [("a", 1, 0, False)]
    xs = [p["x"] for p in got[0]["ring"]]
    assert 3 < min(xs) < 6 and 10 < max(xs) < 13
    hard = borders.traced(df, ["k"], soft=False).collect()
    assert [[(p["x"], p["y"]) for p in r["ring"]] for r in hard] == [[(4.5, 4.5), (4.5, 11.5), (11.5, 11.5), (11.5, 4.5)]]
