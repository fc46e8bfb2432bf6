"""Operators on small hand-made inputs, and properties that hold for any input."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitlake.functions import geo, spectral, values
from orbitlake.operators import composite as C
from orbitlake.operators import merge, raster, scoring, spatial
from orbitlake.sources import files


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_masked_composites_and_order(spark):
    px = frame(spark, [(1, 0, 5.0, True), (1, 0, 3.0, True), (1, 0, 1.0, False), (1, 1, 9.0, False)], "t int, c int, v double, valid boolean").withColumn("v", F.when(F.col("valid"), F.col("v")))
    got = {m: {r.c: r.v for r in C.composite(px, ["t", "c"], m).collect()} for m in ("min", "median", "mean", "max")}
    assert got["min"] == {0: 3.0, 1: None} and got["median"] == {0: 4.0, 1: None}
    assert got["min"][0] <= got["median"][0] <= got["max"][0]


def test_least_masked_takes_the_earliest_of_equals(spark):
    rows = [("a", s, i, ok) for s, i, ok in (("s2", 0, True), ("s2", 1, False), ("s1", 0, False), ("s1", 1, True), ("s3", 0, False), ("s3", 1, False))]
    df = frame(spark, rows, "g string, scene string, i int, valid boolean").withColumn("d", F.substring("scene", 2, 1))
    assert {r.scene for r in C.least_masked(df, ["g"], "scene", ["d"]).collect()} == {"s1"}


def test_boundary_dates_lie_in_two_windows(spark):
    df = frame(spark, [(dt.date(2020, 4, 1),), (dt.date(2020, 2, 2),), (dt.date(2021, 3, 1),), (dt.date(2021, 5, 1),)], "date date")
    inc = sorted((r.date, r.window_start) for r in C.windows(df, "2020-01-01", "2021-01-01", 3).collect())
    assert [w for d, w in inc if d == dt.date(2020, 4, 1)] == [dt.date(2020, 1, 1), dt.date(2020, 4, 1)]
    assert [w for d, w in inc if d == dt.date(2021, 3, 1)] == [dt.date(2021, 1, 1)]  # one window past the end
    assert not [w for d, w in inc if d == dt.date(2021, 5, 1)]
    assert [r.window_start for r in C.windows(df, "2020-01-01", "2021-01-01", 3, mode="half_open").where("date = '2020-04-01'").collect()] == [dt.date(2020, 4, 1)]


def test_missing_month_shifts_positions_not_dates(spark):
    months = [1, 2, 4, 5]
    df = frame(spark, [("t", dt.date(2020, m, 1), float(m)) for m in months], "k string, window_start date, v double")
    by_date = {(r.v0, r.v1) for r in C.date_pairs(df, ["k"], 2, 1).collect()}
    by_place = {(r.v0, r.v1) for r in C.positional_pairs(df, ["k"], 2).collect()}
    assert by_date == {(2.0, 4.0)}
    assert by_place == {(1.0, 4.0), (2.0, 5.0)}


@pytest.mark.parametrize("n", [1, 2, 6, 9])
def test_trailing_mask_equals_numpy(spark, n):
    x = [0.05, 0.1, 0.9, 0.02, 0.3, 0.0, 0.1, 0.2, 0.7][:n]
    w = max(2, min(6, n))
    pad = [float(np.mean(x[: w - 1]))] * (w - 1)
    want = []
    for i in range(n):
        m = float(np.median((pad + x)[i : i + w]))
        want.append(x[i] * (0 if m < 0.1 else 1 if m > 0.1 else m))
    df = frame(spark, [("s", i, v) for i, v in enumerate(x)], "s string, i int, v double")
    got = [r.masked for r in C.trailing_mask(df, ["s"], "i").orderBy("i").collect()]
    assert np.allclose(got, want)


def test_grid_joins_equal_theta_joins(spark):
    rng = random.Random(3)
    pts = [(i, rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(120)] + [(900, -0.5, -0.5), (901, 0.5, 0.5), (902, -0.5, 0.1)]
    left = frame(spark, pts, "id int, lon double, lat double")
    r = frame(spark, [(0,)], "rid int").select("rid", F.struct(F.lit(-0.5).alias("minx"), F.lit(-0.5).alias("miny"), F.lit(0.5).alias("maxx"), F.lit(0.5).alias("maxy")).alias("rect"))
    want = {i for i, x, y in pts if -0.5 <= x <= 0.5 and -0.5 <= y <= 0.5}
    assert {r.id for r in spatial.points_in_rects(left, r, 0.3, "left_semi").collect()} == want
    right = left.select(F.col("id").alias("id2"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    near = {(r.id, r.id2) for r in spatial.within_radius(left, right, 0.2).collect()}
    assert near == {(a[0], b[0]) for a in pts for b in pts if np.hypot(a[1] - b[1], a[2] - b[2]) <= 0.2}


def mean_shift(p, r):
    near = lambda c: np.flatnonzero(np.hypot(*(p - c).T) <= r)
    means, n = np.array([p[near(c)].mean(0) for c in p]), len(p)
    while True:
        means = np.array([p[list(s)].mean(0) for s in {tuple(near(c)) for c in means}])
        if len(means) == n:
            return means
        n = len(means)


def test_merge_sites_equals_numpy(spark):
    rng = np.random.default_rng(5)
    p = np.concatenate([rng.normal(c, 0.3, (6, 2)) for c in ((0, 0), (3, 3), (9, -4))] + [[[20.0, 20.0]], [[0.9 * i - 50, 0] for i in range(5)]])
    got = merge.merge_sites(frame(spark, [tuple(map(float, x)) for x in p], "lon double, lat double"), 1.0).toPandas()
    assert np.allclose(sorted(map(tuple, got[["lon", "lat"]].to_numpy().round(9))), sorted(map(tuple, mean_shift(p, 1.0).round(9))))
    assert len(got) <= len(p)


def test_connected_chain(spark):
    e = frame(spark, [(i, i + 1) for i in range(20)] + [(100, 101)], "a long, b long")
    assert {r.node: r.root for r in merge.connected(e).collect()} == {**{i: 0 for i in range(21)}, 100: 100, 101: 100}


def test_monthly_streams_give_a_month_once(spark, tmp_path):
    """Daily values of January and February: one mean a month, in append mode once the watermark has passed."""
    import datetime as dt

    from orbitlake.streaming import composites

    day = lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(days=i)
    for k, days in enumerate((range(31), range(31, 60), [150], [200])):
        frame(spark, [("a", day(i), float(day(i).day)) for i in days], "k string, ts timestamp, v double").coalesce(1).write.parquet(str(tmp_path / "in" / f"part={k}"))
    files = spark.readStream.schema("k string, ts timestamp, v double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "part=*"))
    q = composites.monthly(files, ["k"], value="v", method="mean").writeStream.outputMode("append").format("memory").queryName("months").start()
    q.processAllAvailable()
    q.stop()
    got = [(r.month.month, r.v) for r in spark.sql("select month, v from months order by month").collect()]
    assert got[:2] == [(1, 16.0), (2, 15.0)]


def test_peaks_are_local_maxima(spark):
    row = [0.9, 0.0, 0.8, 0.0, 0.7]
    df = frame(spark, [(0, 0, c, v) for c, v in enumerate(row)], "id int, row int, col int, v double")
    assert [r.v for r in raster.detect_peaks(df, threshold=0.5, distance=2, border=0).collect()] == [0.9]
    rng = np.random.default_rng(3)
    image, d = rng.random((40, 30)).round(3), 3
    df = frame(spark, [(1, r, c, float(image[r, c])) for r in range(40) for c in range(30)], "id int, row int, col int, v double")
    want, taken = set(), []
    for r, c in sorted(np.ndindex(40, 30), key=lambda p: (-image[p], p)):
        near = image[max(0, r - d) : r + d + 1, max(0, c - d) : c + d + 1]
        if d <= r < 40 - d and d <= c < 30 - d and image[r, c] > 0.5 and image[r, c] == near.max() and all(max(abs(r - a), abs(c - b)) > d for a, b in taken):
            taken.append((r, c))
            want.add((r, c))
    assert {(r.row, r.col) for r in raster.detect_peaks(df, threshold=0.5, distance=d).collect()} == want and len(want) > 5


def test_padding_reflects_to_and_fro(spark):
    for h, w, to in ((2, 3, 8), (1, 4, 5), (3, 1, 7)):
        image = np.arange(h * w).reshape(h, w)
        df = frame(spark, [(0, r, c, float(image[r, c])) for r in range(h) for c in range(w)], "id int, row int, col int, v double")
        out = raster.pad_or_crop(df, to, to).toPandas()
        assert len(out) == to * to
        assert (out.pivot(index="row", columns="col", values="v").to_numpy() == np.pad(image, ((0, to - h), (0, to - w)), "reflect")).all()


def test_greedy_match_takes_each_once(spark):
    left = frame(spark, [("a", 0, 0.0, 0.0), ("b", 1, 0.1, 0.0), ("c", 2, 5.0, 5.0)], "id string, seq long, lon double, lat double")
    right = frame(spark, [("x", 0, 0.05, 0.0), ("y", 1, 0.06, 0.0)], "id2 string, seq2 long, lon2 double, lat2 double")
    assert {(r.id, r.id2) for r in spatial.greedy_match(left, right, 0.2).collect()} == {("a", "x"), ("b", "y")}


def test_pad_crop_and_patches(spark):
    image = np.arange(45).reshape(5, 9)
    df = frame(spark, [(0, r, c, float(image[r, c])) for r in range(5) for c in range(9)], "id int, row int, col int, v double")
    out = raster.pad_or_crop(df, 7, 7).toPandas().pivot(index="row", columns="col", values="v").to_numpy()
    assert (out == np.pad(image[:, 1:8], ((0, 2), (0, 0)), "reflect")).all()
    tile = frame(spark, [(0, r, c, 0.0) for r in range(20) for c in range(20)], "id int, row int, col int, v double")
    for stride, n in ((3, 4), (4, 3)):
        g = raster.patches(tile, 8, stride).groupBy("wrow", "wcol").count().collect()
        assert len(g) == n * n and {r["count"] for r in g} == {64}


def test_contours_of_a_square_with_a_hole():
    m = np.zeros((6, 6), bool)
    m[1:5, 1:5] = True
    m[2:4, 2:4] = False
    area = lambda ring: sum(a * d - c * b for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1])) / 2
    assert sorted(area(r) for r in raster.trace_rings(m)) == [-4.0, 16.0]
    two = np.eye(2, dtype=bool)
    assert sorted(area(r) for r in raster.trace_rings(two)) == [1.0, 1.0]


def test_holes_and_islands_become_polygons(spark):
    m = np.zeros((12, 14), bool)
    m[1:10, 1:10] = True
    m[3:8, 3:8] = False
    m[4:7, 4:7] = True  # an island in the hole, with a hole of its own
    m[5, 5] = False
    m[1:3, 11:13] = True
    got = raster.polygons_of(raster.trace_rings(m))
    assert sorted((len(p), sum(map(raster.shoelace, p))) for p in got) == [(1, 4.0), (2, 8.0), (2, 56.0)]
    for density in (0.3, 0.5, 0.7):
        noise = np.random.default_rng(int(10 * density)).random((30, 30)) < density
        got = raster.polygons_of(raster.trace_rings(noise))
        assert sum(raster.shoelace(r) for p in got for r in p) == noise.sum()
        assert all(raster.shoelace(p[0]) > 0 > max([raster.shoelace(r) for r in p[1:]], default=-1) for p in got)
    pixels = frame(spark, [(7, r, c, float(2 <= r < 18 and 2 <= c < 18 and not (6 <= r < 14 and 6 <= c < 14))) for r in range(20) for c in range(20)], "id int, row int, col int, v double")
    found = raster.footprints(pixels, ["id"])
    (one,) = found.collect()
    assert len(one.rings) == 2 and one.polygon == 1 and abs(one.area - 192) < 24
    pts = frame(spark, [("in", 4.0, 10.0), ("hole", 10.0, 10.0), ("out", 19.5, 1.0)], "name string, lon double, lat double")
    assert [r.name for r in spatial.points_in_polygons(pts, found, 8.0, "rings").collect()] == ["in"]


def tiff(pixels, order="<", tile=None, deflate=False, nodata=None, rows=3):
    """A small TIFF file: pixels (height, width, band), in strips of some rows or in tiles."""
    import struct
    import zlib

    h, w, n = pixels.shape
    if tile:
        padded = np.pad(pixels, ((0, -h % tile), (0, -w % tile), (0, 0)))
        parts = [padded[r : r + tile, c : c + tile] for r in range(0, h, tile) for c in range(0, w, tile)]
    else:
        parts = [pixels[r : r + rows] for r in range(0, h, rows)]
    data = [zlib.compress(p.tobytes()) if deflate else p.tobytes() for p in parts]
    out = bytearray(struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 0))
    offsets = []
    for d in data:
        offsets.append(len(out))
        out += d
    kind = {"u": 1, "i": 2, "f": 3}[pixels.dtype.kind]
    tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [8 * pixels.dtype.itemsize] * n), (259, 3, [8 if deflate else 1]), (277, 3, [n]), (339, 3, [kind] * n)]
    tags += [(322, 4, [tile]), (323, 4, [tile]), (324, 4, offsets), (325, 4, [*map(len, data)])] if tile else [(273, 4, offsets), (278, 4, [rows]), (279, 4, [*map(len, data)])]
    if nodata is not None:
        tags.append((42113, 2, list(str(nodata).encode() + b"\0")))
    entries = []
    for tag, code, values_ in sorted(tags):
        raw = struct.pack(f"{order}{len(values_)}{ {2: 'B', 3: 'H', 4: 'I'}[code]}", *values_)
        if len(raw) > 4:
            at = len(out)
            out += raw
            raw = struct.pack(order + "I", at)
        entries.append(struct.pack(order + "HHI", tag, code, len(values_)) + raw.ljust(4, b"\0"))
    struct.pack_into(order + "I", out, 4, len(out))
    return bytes(out + struct.pack(order + "H", len(entries)) + b"".join(entries) + bytes(4))


def test_tiff_files(spark, tmp_path):
    rng = np.random.default_rng(8)
    for order, dtype, options in (("<", "u2", {}), (">", "f4", {"deflate": True}), ("<", "i2", {"tile": 16, "deflate": True}), (">", "u1", {"tile": 16}), ("<", "f8", {"rows": 50})):
        image = rng.integers(0, 100, (21, 19, 2)).astype(np.dtype(dtype).newbyteorder(order))
        got = np.full(image.shape[:2], -1.0)
        for row, col, block in files.tiff_blocks(tiff(image, order, **options), 1):
            got[row : row + block.shape[0], col : col + block.shape[1]] = block
        assert (got == image[:, :, 1]).all()
    image = rng.integers(0, 5, (7, 4, 1)).astype("<i2")
    (tmp_path / "a.tif").write_bytes(tiff(image, nodata=3))
    rows = files.read_geotiff(spark, str(tmp_path)).collect()
    assert len(rows) == 28 and all(r.v == (None if image[r.row, r.col, 0] == 3 else image[r.row, r.col, 0]) and r.file == "a.tif" for r in rows)
    for bad in (b"", b"GIF89a..", tiff(image)[:2] + b"+" + tiff(image)[3:]):
        with pytest.raises(ValueError):
            next(files.tiff_blocks(bad))


def test_polygon_files_and_cache(spark, tmp_path):
    import json

    square = lambda a, b: [{"x": float(x), "y": float(y)} for x, y in ((a, a), (b, a), (b, b), (a, b))]
    df = frame(spark, [("s", [square(0, 9), square(2, 3)])], "name string, rings array<array<struct<x: double, y: double>>>")
    files.write_polygons(df, str(tmp_path / "poly"))
    lines = [json.loads(x) for f in (tmp_path / "poly").glob("part*") for x in f.open()]
    assert lines[0]["properties"] == {"name": "s"} and [len(r) for r in lines[0]["geometry"]["coordinates"]] == [5, 5] and lines[0]["geometry"]["coordinates"][0][0] == lines[0]["geometry"]["coordinates"][0][4]
    texts = frame(spark, [(json.dumps(lines[0]["geometry"]),), ('{"type": "Point", "coordinates": [1, 2]}',), (None,), ("",)], "geo string")
    got = [r[0] for r in texts.select(files.polygon_rings("geo")).collect()]
    assert got == [df.first().rings, None, None, None]
    calls = []
    compute = lambda: (calls.append(1), frame(spark, [("k",)], "key string"))[1]
    for _ in range(2):
        assert files.read_or_compute(spark, str(tmp_path / "keys"), compute).first().key == "k"
    assert calls == [1]


def test_blobs_find_a_bright_disc():
    y, x = np.mgrid[:60, :60]
    image = np.exp(-((y - 30) ** 2 + (x - 22) ** 2) / (2 * 6.0**2))
    found = raster.find_blobs(image, 3.5, 12, 0.0025)
    assert any(abs(r - 30) <= 1 and abs(c - 22) <= 1 for r, c, _ in found)
    assert not raster.find_blobs(np.zeros((20, 20)), 3.5, 10, 0.0025)


def test_upscale_and_blur_keep_constants():
    image = np.full((7, 5), 0.4)
    assert np.allclose(raster.upscale(image, 4), 0.4) and np.allclose(raster.blur(raster.upscale(image, 4), 16, 4.0), 0.4)


def test_indices_and_division_by_zero(spark):
    df = frame(spark, [(0.0, 0.0), (3.0, 1.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(spectral.normalized_difference(F.col("a"), F.col("b"))).collect()] == [None, 0.5, None]
    assert df.select(spectral.normalized_difference(F.col("a"), F.col("b"), 0)).first()[0] == 0.0


def test_areas_centroids_and_tiles(spark):
    df = spark.range(1).select(geo.ring_of(geo.rect(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(3.0))).alias("ring"))
    row = df.select(geo.ring_area(F.col("ring")).alias("a"), geo.ring_centroid(F.col("ring")).alias("c"), geo.point_in_ring(F.col("ring"), F.lit(1.0), F.lit(1.0)).alias("i"), geo.point_in_ring(F.col("ring"), F.lit(3.0), F.lit(1.0)).alias("o")).first()
    assert row.a == 6.0 and tuple(row.c) == (1.0, 1.5) and row.i and not row.o
    # the central meridian of zone 31 is 3 degrees east, and the equator's northing is 0
    lon, lat = spark.range(1).select(*geo.utm_to_lonlat(F.lit(500_000.0), F.lit(0.0), F.lit(31))).first()
    assert abs(lon - 3) < 1e-12 and abs(lat) < 1e-12
    corners = spark.range(1).select(geo.tile_corners(F.lit("900:20:10.0:33:-7:440"))).first()[0]
    assert len(corners) == 4 and 13 < corners[0].x < 16 and 35 < corners[0].y < 37


def test_utm_round_trip_and_tile_cover(spark):
    df = frame(spark, [(14.35, 35.8, 33), (-70.2, -12.5, 19), (3.0, 0.0, 31)], "lon double, lat double, z int")
    e, n = geo.lonlat_to_utm(F.col("lon"), F.col("lat"), F.col("z"))
    for r in df.withColumn("e", e).withColumn("n", n).select("*", *[c.alias(k) for k, c in zip(("x", "y"), geo.utm_to_lonlat(F.col("e"), F.col("n"), F.col("z")))]).collect():
        assert abs(r.x - r.lon) < 1e-8 and abs(r.y - r.lat) < 1e-8
    box = geo.rect(F.lit(14.30), F.lit(35.79), F.lit(14.50), F.lit(35.99))
    keys = spark.range(1).select(F.explode(geo.tile_cover(box, 900, 20, 10.0)).alias("key"))
    inside = keys.withColumn("ring", geo.tile_corners(F.col("key"))).where(geo.point_in_ring(F.col("ring"), F.lit(14.4), F.lit(35.9)))
    assert inside.count() >= 1 and all(k.key.startswith("900:20:10.0:33:") for k in keys.collect())


def test_report_supports_sum(spark):
    df = frame(spark, [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (0, 0.95), (1, 0.2), (0, 0.4), (1, 0.6)], "label int, p double")
    rep = {r["class"]: r for r in scoring.classification_report(df, 0.5).collect()}
    assert rep["0"].support + rep["1"].support == 8 == rep["accuracy"].support
    assert rep["1"].precision == 2 / 3 and rep["1"].recall == 0.5  # p > threshold is strict
    w = {r.label: r.weight for r in scoring.class_weights(df).collect()}
    assert w == {0: 1.0, 1: 1.0}


def test_scorer_passes_missing_through(spark):
    df = frame(spark, [([1.0, 2.0],), ([None, 1.0],), (None,)], "x array<double>")
    got = [r.p for r in scoring.score(df, F.col("x"), scoring.logistic([1.0, -1.0])).collect()]
    assert got[1:] == [None, None] and abs(got[0] - 1 / (1 + np.e)) < 1e-12


def test_coercion_is_all_or_nothing(spark):
    df = frame(spark, [("1", "x"), ("2.5", "3"), (None, None)], "a string, b string")
    assert [t for _, t in values.coerce_columns(df, "a", "b").dtypes] == ["double", "string"]


def test_files_round_trip(spark, tmp_path):
    doc = '{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"Point","coordinates":[1.5,2.5]},"properties":{"name":"a","dump":true}},{"type":"Feature","geometry":null,"properties":{"name":"b"}}]}'
    (tmp_path / "in.geojson").write_text(doc)
    rows = files.read_geojson(spark, str(tmp_path / "in.geojson"), "name: string, dump: string").collect()
    assert [(r.coordinates, r.name, r.dump) for r in rows] == [([1.5, 2.5], "a", "true"), (None, "b", None)]
    df = frame(spark, [(1.0, 2.0, "x y"), (3.0, 4.0, None)], "lon double, lat double, `odd name (km^2)` string")
    files.write_geojson(df, str(tmp_path / "out"))
    assert sum(1 for f in (tmp_path / "out").glob("part*") for _ in f.open()) == 2
    assert '"FeatureCollection"' in files.feature_collection(df).first()[0]
    (tmp_path / "a.csv").write_text('name,lon,coords\nq,1.0,"[1.0, 2.0]"\n')
    assert files.read_csv(spark, str(tmp_path / "a.csv"), "name string, lon double, coords string", {"coords": "double"}).first().coords == [1.0, 2.0]
    (tmp_path / "keys.txt").write_text("900:20:10.0:33:-7:440  \n\n900:20:10.0:33:-7:441\n")
    keys = files.read_keys(spark, str(tmp_path / "keys.txt"))
    assert keys.count() == 2
    done = frame(spark, [("900_20_10.0_33_-7_440",)], "key string")
    assert [r.key for r in files.missing_keys(keys, done).collect()] == ["900:20:10.0:33:-7:441"]
    np.save(tmp_path / "v.npy", np.arange(6.0).reshape(3, 2))
    assert [r.vector for r in files.read_arrays(spark, str(tmp_path)).orderBy("ordinal").collect()] == [[0.0, 1.0], [2.0, 3.0], [4.0, 5.0]]
    files.write_document(frame(spark, [("BGR", 3, 1.5)], "code string, n int, ha double"), str(tmp_path / "doc"), "code", ["n", "ha"])
    assert next((tmp_path / "doc").glob("part*")).read_text().strip() == '{"BGR":{"n":3,"ha":1.5}}'


def test_streaming_composites(spark, sf, tmp_path):
    from orbitlake.streaming import composites

    e = spark.read.parquet(f"{sf}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "value")
    e.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    q = composites.monthly(stream, ["user_id"], value="value").writeStream.outputMode("complete").format("memory").queryName("monthly").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.user_id, r.month): r.value for r in spark.sql("select user_id, month, min(value) as value from monthly group by 1, 2").collect()}
    want = {(r.user_id, r.month): r.value for r in e.groupBy("user_id", F.date_trunc("month", "ts").alias("month")).agg(F.min("value").alias("value")).collect()}
    assert got == want
