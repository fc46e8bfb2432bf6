"""The flows on planted scenes: what was put in comes out."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitlake.operators import flows

FIRST = datetime.date(2020, 1, 1)


def test_scenes_to_predictions(spark):
    rng = np.random.default_rng(2)
    rows, low = [], {}
    for month in range(15):
        for day in (3, 12, 20):
            date = datetime.date(2020 + month // 12, month % 12 + 1, day)
            for r, c in ((0, 0), (0, 1)):
                if month in (6, 7, 8) and c == 1:
                    continue  # this pixel has no third composite
                bands, valid = rng.integers(300, 3000, 2).astype(float).tolist(), bool(rng.random() < 0.7)
                rows.append(("t", r, c, date, bands, valid))
                if valid:
                    k = (c, month // 3)
                    low[k] = np.minimum(low.get(k, np.inf), bands)
    df = spark.createDataFrame(rows, "tile_id string, row int, col int, date date, bands array<double>, valid boolean")
    got = {(r["col"], r["band"]): r["p"] for r in flows.predict_region(df, "2020-01-01", "2021-04-01", lambda x: x.sum(axis=1)).collect()}
    starts = ["2020-01-01", "2020-04-01", "2020-07-01"]
    for c in (0, 1):
        want = []
        for i, s in enumerate(starts):
            if (c, i) in low and (c, i + 2) in low:
                want.append((low[c, i].sum() + low[c, i + 2].sum()) / 3000)
                assert got[c, s] == pytest.approx(want[-1])
            else:
                assert got[c, s] is None
        assert got[c, "median"] == pytest.approx(np.median(want))


def disc(r0, c0, n=60, radius=9):
    r, c = np.mgrid[:n, :n]
    return np.where((r - r0) ** 2 + (c - c0) ** 2 <= radius**2, 0.95, 0.0)


def pixels(name, image):
    return [(name, int(r), int(c), float(v)) for (r, c), v in np.ndenumerate(image)]


def test_predictions_to_candidates(spark):
    # one site seen from two tiles that share an edge region, one of its own, and a tile without any
    step = 0.0001
    rows = pixels("a", disc(30, 30)) + pixels("b", disc(31, 20)) + pixels("c", disc(25, 25)) + pixels("d", np.zeros((60, 60)))
    grid = [("a", 10.0, 5.0, step), ("b", 10.0 + 10 * step, 5.0 + step, step), ("c", 11.0, 5.0, step), ("d", 12.0, 5.0, step)]
    preds = spark.createDataFrame(rows, "tile_id string, row int, col int, v double")
    tiles = spark.createDataFrame(grid, "tile_id string, lon double, lat double, step double")
    got = sorted(flows.find_candidates(preds, tiles).collect(), key=lambda r: r["lon"])
    # a disc is found at several scales; the site in two tiles has the detections of both
    assert len(got) == 2 and got[0]["members"] == 2 * got[1]["members"] and all(len(r["id"]) == 15 and r["id"].startswith("8f") for r in got)
    assert np.allclose([(r["lon"], r["lat"]) for r in got], [(10.003, 4.997), (11.0025, 4.9975)], atol=3 * step)
    patches = spark.createDataFrame([(11.0, 4.99, 11.01, 5.0, 0.5), (10.0, 4.99, 10.01, 5.0, 0.3)], "a double, b double, c double, d double, mean double")
    patches = patches.select(F.struct(F.col("a").alias("minx"), F.col("b").alias("miny"), F.col("c").alias("maxx"), F.col("d").alias("maxy")).alias("rect"), "mean")
    assert [r["id"] for r in flows.find_candidates(preds, tiles, patches=patches).collect()] == [got[1]["id"]]


def test_images_to_footprints(spark):
    n, rows = 40, []
    for k in range(4):
        date = datetime.date(2020, 3 * k + 1, 1)
        for name, image in (("s", disc(20, 20, n, 10)), ("u", np.zeros((n, n)))):
            masked = name == "s" and k == 3
            rows += [(name, date, r, c, None if masked and r < 20 else v) for _, r, c, v in pixels(name, image)]
    images = spark.createDataFrame(rows, "name string, date date, row int, col int, v double")
    sites = spark.createDataFrame([("s", 100.0, 0.5), ("u", 101.0, 0.5)], "name string, lon double, lat double")
    got = flows.monitor_sites(images, sites).collect()
    # the empty site and the date that is half masked have none
    assert sorted(str(r["date"]) for r in got) == ["2020-01-01", "2020-04-01", "2020-07-01"] and {r["name"] for r in got} == {"s"}
    side = 0.02 * 111.32
    for r in got:
        assert r["area_km2"] == pytest.approx(np.pi * (10.5 / n * side) ** 2, rel=0.15) and r["lost"] == 0 and len(r["polygons"]) == 1
        xs, ys = [p["x"] for p in r["polygons"][0][0]], [p["y"] for p in r["polygons"][0][0]]
        assert np.mean((min(xs), max(xs))) == pytest.approx(100.0, abs=5e-4) and np.mean((min(ys), max(ys))) == pytest.approx(0.5, abs=5e-4)
