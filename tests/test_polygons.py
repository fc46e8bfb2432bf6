"""Polygons: identities of areas on random shapes, places inside against ray casting, repair, buffers, overlap resolution, dissolve."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orbitlake.operators import polygons as P

RULES = P._RULES


def square(x, y, w=1.0, h=None):
    h = w if h is None else h
    return [{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]


def star(rng, x, y, r, n):
    turns, far = np.sort(rng.random(n)) * 2 * np.pi, r * (0.3 + 0.7 * rng.random(n))
    return [{"x": float(x + k * np.cos(t)), "y": float(y + k * np.sin(t))} for t, k in zip(turns, far)]


def shape(rng):
    x, y = rng.random(2) * 2
    return [star(rng, x, y, 1.0, int(rng.integers(3, 24))), star(rng, x, y, 0.25, int(rng.integers(3, 9)))]


def area(polygons):
    shoelace = lambda r: sum(p["x"] * q["y"] - q["x"] * p["y"] for p, q in zip(r, r[1:] + r[:1])) / 2
    assert all(shoelace(p[0]) > 0 and all(shoelace(h) < 0 for h in p[1:]) for p in polygons)
    return sum(shoelace(r) for p in polygons for r in p)


def holds(rings, x, y):
    odd = np.zeros(len(x), bool)
    for r in rings:
        for p, q in zip(r, r[1:] + r[:1]):
            crossed = (p["y"] > y) != (q["y"] > y)
            with np.errstate(all="ignore"):
                odd ^= crossed & (x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"])
    return odd


def test_areas_of_a_thousand_pairs_add_up():
    rng = np.random.default_rng(1)
    for k in range(1000):
        a, b = shape(rng), shape(rng)
        common, only, other, either, one = (area(P.overlay([x, y], RULES[r])) for x, y, r in ((a, b, "intersection"), (a, b, "difference"), (b, a, "difference"), (a, b, "union"), (a, b, "symmetric_difference")))
        assert np.allclose([area(P.overlay([a])), area(P.overlay([b])), either, one], [common + only, common + other, common + only + other, only + other], atol=1e-7)
        if k < 60:
            x, y = rng.random(1500) * 5 - 1.5, rng.random(1500) * 5 - 1.5
            in_a, in_b = holds(a, x, y), holds(b, x, y)
            for rule, f in RULES.items():
                assert (holds([r for p in P.overlay([a, b], f) for r in p], x, y) == f(in_a, in_b)).all()


def test_touching_repeated_and_damaged_rings_become_valid():
    bow = [{"x": a, "y": b} for a, b in ((0, 0), (2, 2), (2, 0), (0, 2))]
    assert [len(p) for p in P.overlay([[bow]])] == [1, 1] and area(P.overlay([[bow]])) == pytest.approx(2)
    # two squares that touch at a corner are two polygons; a hole that touches its ring at a corner stays a hole
    assert len(P.overlay([[square(0, 0), square(1, 1)]])) == 2
    pinched = P.overlay([[square(0, 0, 4), [{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 1.0}, {"x": 1.0, "y": 2.0}]]])
    assert len(pinched) == 1 and len(pinched[0]) == 2 and area(pinched) == pytest.approx(16 - 1.5)
    # an island in a hole is a polygon of its own
    nested = P.overlay([[square(0, 0, 9), square(2, 2, 5), square(3, 3, 1)]])
    assert sorted(len(p) for p in nested) == [1, 2] and area(nested) == pytest.approx(81 - 25 + 1)
    spiky = square(0, 0)[:3] + [{"x": 1.0, "y": 5.0}, {"x": 1.0, "y": 1.0}, {"x": 1.0, "y": 1.0}] + square(0, 0)[3:] + square(0, 0)[:1]
    assert P.overlay([[spiky]]) == [[square(0, 0)]]
    assert P.overlay([[]]) == P.overlay([[[], square(0, 0)[:2]]]) == P.overlay([[square(0, 0)[:1] * 5]]) == P.overlay([[square(0, 0)] * 2]) == []
    # a neighbour is joined without a seam, the same shape leaves nothing
    assert P.overlay([[square(0, 0)], [square(1, 0)]], RULES["union"]) == [[square(0, 0, 2, 1)]]
    assert P.overlay([[square(0, 0)], [square(0, 0)]], RULES["difference"]) == []


@pytest.mark.parametrize("origin", [0.0, 179.9, -1e6])
def test_large_and_far_coordinates(origin):
    a, b = [square(origin, origin, 2)], [square(origin + 1, origin + 1, 2)]
    assert area([[[{"x": p["x"] - origin, "y": p["y"] - origin} for p in r] for r in q] for q in P.overlay([a, b], RULES["union"])]) == pytest.approx(7, rel=1e-5)


def test_buffers_follow_the_formula_for_convex_shapes():
    for ring, size, length in ((square(0, 0, 2), 4, 8), ([{"x": 0, "y": 0}, {"x": 3, "y": 0}, {"x": 0, "y": 4}], 6, 12)):
        for d in (0.1, 0.7, 3.0):
            assert area(P.buffered([ring], d, 64)) == pytest.approx(size + length * d + np.pi * d * d, rel=1e-3)
    assert P.buffered([square(0, 0, 2)], -0.5) == [[square(0.5, 0.5, 1)]] and P.buffered([square(0, 0)], -0.6) == [] and P.buffered([], 1.0) == []
    ring = [square(0, 0, 5), square(2, 2, 1)]
    assert area(P.buffered(ring, 0.25, 64)) == pytest.approx(25 + 5 + np.pi / 16 - 0.25, rel=1e-3)
    assert [len(p) for p in P.buffered(ring, 0.6)] == [1]  # the hole is filled


def test_simplified_outlines_stay_within_the_tolerance():
    rng = np.random.default_rng(3)
    for _ in range(50):
        ring = star(rng, 0, 0, 1, 200)
        for tolerance in (0.0, 0.05, 0.4):
            kept = P.simplified(ring, tolerance)
            assert len(kept) >= 2 and all(p in ring for p in kept)
            a, b = np.array([(p["x"], p["y"]) for p in kept]), np.array([(p["x"], p["y"]) for p in kept[1:] + kept[:1]])
            d = b - a
            for p in ring:
                v = np.array([p["x"], p["y"]]) - a
                t = np.clip((v * d).sum(axis=1) / np.maximum((d * d).sum(axis=1), 1e-300), 0, 1)
                assert np.hypot(*(v - t[:, None] * d).T).min() <= tolerance + 1e-12
    assert len(P.simplified(square(0, 0), 9.0)) >= 2 and P.simplified([], 1.0) == []


def test_column_functions(spark):
    rows = [(1, [square(0, 0, 2)], [square(1, 1, 2)]), (2, [square(0, 0)], None), (3, [], [square(0, 0)]), (4, None, None)]
    df = spark.createDataFrame(rows, f"id int, a {P.RINGS}, b {P.RINGS}")
    a, b = F.col("a"), F.col("b")
    got = {r["id"]: r.asDict() for r in df.select("id", P.area(P.union(a, b)).alias("u"), P.area(P.difference(a, b)).alias("d"), F.size(P.repair(a)).alias("n"), P.area(P.buffer(a, 1.0, 32)).alias("w"), F.size(P.simplify(a, 0.1)).alias("s"), P.centroid(a).alias("c")).collect()}
    assert got[1]["u"] == pytest.approx(7) and got[1]["d"] == pytest.approx(3) and got[1]["w"] == pytest.approx(12 + np.pi, rel=1e-2) and got[1]["n"] == got[1]["s"] == 1 and tuple(got[1]["c"]) == (1, 1)
    assert got[2]["u"] is None and got[3]["u"] == pytest.approx(1) and got[3]["d"] == got[3]["n"] == 0 and got[4]["d"] is None


def test_the_farther_site_loses_its_polygon(spark):
    sites = spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.012, 0.0), ("c", 5.0, 5.0)], "name string, lon double, lat double")
    # on day 1, a's polygon lies near b and overlaps b's own; on day 2 each has its own; c is alone and has none on day 2
    far, near, own = square(0.008, -0.002, 0.004), square(0.010, -0.001, 0.004), square(-0.001, -0.001, 0.002)
    rows = [("a", 1, [[far], [own]]), ("b", 1, [[near]]), ("a", 2, [[own]]), ("b", 2, [[near]]), ("c", 1, [[square(5, 5, 0.001)]]), ("c", 2, None), ("b", 3, [])]
    contours = spark.createDataFrame(rows, f"name string, date int, polygons {P.MULTI}")
    got = {(r["name"], r["date"]): (r["lost"], r["polygons"] and len(r["polygons"])) for r in P.resolve_overlaps(contours, sites).collect()}
    assert got == {("a", 1): (1, 1), ("b", 1): (0, 1), ("a", 2): (0, 1), ("b", 2): (0, 1), ("c", 1): (0, 1), ("c", 2): (0, None), ("b", 3): (0, [])}


def rings(df):
    return sorted((r["k"], len(r["ring"]), round(r["area"], 6)) for r in df.collect())


def test_dissolve_of_tiles(spark):
    kind = f"k string, rings {P.RINGS}"
    make = lambda shapes: spark.createDataFrame([(k, s) for k, s in shapes], kind)
    # tiles of unequal size meet along parts of their edges; one of another key stays apart
    tiles = [("a", [square(0, 0, 4)]), ("a", [square(4, 0, 2)]), ("a", [square(4, 2, 1)]), ("a", [square(5, 2, 1)]), ("a", [square(4, 3, 2, 1)]), ("b", [square(0, 0, 1)]), ("b", [square(0, 0, 1)]), ("c", []), ("c", None)]
    assert rings(P.dissolve(make(tiles), ["k"], cell=2.0)) == [("a", 4, 24.0), ("b", 4, 1.0)]
    # a ring of tiles has a hole; tiles at a corner are two rings; a tile's own hole is filled by another tile
    frame = [("r", [square(x, y)]) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    corner = [("t", [square(0, 0)]), ("t", [square(1, 1)])]
    filled = [("f", [square(0, 0, 3), square(1, 1)[::-1]]), ("f", [square(1, 1)]), ("h", [square(0, 0, 3)[::-1], square(1, 1)])]
    got = rings(P.dissolve(make(frame + corner + filled), ["k"]))
    assert got == [("f", 4, 9.0), ("h", 4, -1.0), ("h", 4, 9.0), ("r", 4, -1.0), ("r", 4, 9.0), ("t", 4, 1.0), ("t", 4, 1.0)]
    # a long comb: one ring of many points
    comb = [("z", [square(x, 0, 1, 1 + x % 2)]) for x in range(150)]
    assert [(k, a) for k, n, a in rings(P.dissolve(make(comb), ["k"])) if n > 300] == [("z", 225.0)]
    assert P.dissolve(make([("a", [])]), ["k"]).count() == 0


def test_tiles_of_a_region(spark):
    from orbitlake.functions import geo

    # a triangle with a hole, across two zones
    outer = [{"x": 5.9, "y": 0.1}, {"x": 6.2, "y": 0.1}, {"x": 6.0, "y": 0.5}]
    hole = [{"x": 5.98, "y": 0.15}, {"x": 6.06, "y": 0.15}, {"x": 6.02, "y": 0.3}]
    regions = spark.createDataFrame([("r", [outer, hole]), ("none", []), ("null", None)], f"name string, rings {P.RINGS}")
    got = P.tile_cover(regions, 64, 0, 20.0).select("name", "key", geo.tile_corners(F.col("key")).alias("c")).collect()
    boxes = len(regions.where("name = 'r'").select(geo.tile_cover(P.bounds(F.get("rings", 0)), 64, 0, 20.0).alias("k")).first()["k"])
    assert {r["name"] for r in got} == {"r"} and len(got) == len({r["key"] for r in got}) < 0.75 * boxes
    # every place of the region lies in a tile that was kept
    rng = np.random.default_rng(5)
    x, y = 5.9 + 0.3 * rng.random(3000), 0.1 + 0.4 * rng.random(3000)
    inside = holds([outer, hole], x, y)
    covered = np.zeros(3000, bool)
    for r in got:
        covered |= holds([[{"x": p["x"], "y": p["y"]} for p in r["c"]]], x, y)
    assert inside.sum() > 500 and covered[inside].mean() > 0.999


def test_areas_of_many_pairs_in_one_sweep(monkeypatch):
    """Those of the overlays of each pair, also where shapes are missing, damaged, equal or of very different size; no overlay is run."""
    rng = np.random.default_rng(3)
    a, b = [shape(rng) for _ in range(300)], [shape(rng) for _ in range(300)]
    bow = [{"x": u, "y": v} for u, v in ((0, 0), (2, 2), (2, 0), (0, 2))]
    a += [[], None, [bow, None, []], [square(0, 0)], [square(0, 0)] * 2, [square(0, 0, 1e3)], [square(-5, -5, 9), square(-4, -4, 2)], [square(0, 0)[:2]]]
    b += [[square(0, 0)], [square(0, 0)], [square(1, 0)], [square(0, 0)], [square(0, 0)], [square(3, 3)], [square(-4, -4, 3)], [square(0, 0)]]
    want = np.array([[area(P.overlay([x])), area(P.overlay([y])), area(P.overlay([x, y], RULES["intersection"]))] for x, y in zip(a, b)])
    monkeypatch.setattr(P, "overlay", None)
    kind = P._KIND.value_type
    for most, meetings in ((4096, 1_000_000), (7, 3_000), (1, 1)):
        monkeypatch.setattr(P, "_PAIRS", most)
        monkeypatch.setattr(P, "_MEETINGS", meetings)
        got = np.array(P.areas(pa.array(a, kind), pa.array(b, kind))).T
        assert np.allclose(got, want, rtol=1e-5, atol=1e-7)
    assert [len(x) for x in P.areas(pa.array([], kind), pa.array([], kind))] == [0, 0, 0]


@pytest.mark.parametrize("name", ["j13_polygon_overlay", "j13_resolved_contours"])
def test_pairs_build_no_rings(spark, sf, name):
    """Pairs grow with the square of the table: a task may sweep over many at once, but not overlay them one by one."""
    from orbitlake.plans.queries import QUERIES

    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rings2") and not [x for x in plan.split("\n") if "two(rings" in x and "rings2" in x]
