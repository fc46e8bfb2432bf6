"""Projections, column construction and scalar functions."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo, h3, spectral, values
from ..operators import scoring as S
from .analogues import PIXELS, POINTS, SCORED, SITES, VECTORS, pixels, points, scored, sites, table, vectors
from .registry import query

R = lambda c, n=6: F.round(c, n)
SIDES = ("minx", "miny", "maxx", "maxy")


def rects(df, r):
    return df.withColumn("r", r).select("id", *[R(f"r.{s}").alias(s) for s in SIDES])


def rect_sql(x0, y0, x1, y1):
    return f"SELECT id, round({x0}, 6) AS minx, round({y0}, 6) AS miny, round({x1}, 6) AS maxx, round({y1}, 6) AS maxy FROM {POINTS}"


query("p1_rect_from_point", rect_sql("lon - 0.005 / cos(radians(lat))", "lat - 0.005", "lon + 0.005 / cos(radians(lat))", "lat + 0.005"))(lambda s, d: rects(points(s, d), geo.rect_around(F.col("lon"), F.col("lat"), 0.01)))
query("p2_square", rect_sql("lon - 0.01", "lat - 0.01", "lon + 0.01", "lat + 0.01"))(lambda s, d: rects(points(s, d), geo.square(F.col("lon"), F.col("lat"), 0.02)))
query("p3_half_width_box", rect_sql("lon - 0.03", "lat - 0.03", "lon + 0.03", "lat + 0.03"))(lambda s, d: rects(points(s, d), geo.box(F.col("lon"), F.col("lat"), 0.03)))
query("p4_buffer_envelope", rect_sql("lon - 0.1", "lat - 0.1", "lon + 0.1", "lat + 0.1"))(lambda s, d: rects(points(s, d), geo.box(F.col("lon"), F.col("lat"), 0.1)))
query("p5_square_cap_bounds", rect_sql("lon - 0.01", "lat - 0.01", "lon + 0.01", "lat + 0.01"))(lambda s, d: rects(points(s, d), geo.box(F.col("lon"), F.col("lat"), 0.01)))


@query("p6_adjacent_points", f"""SELECT id, round(lon + CASE WHEN contains(dir, 'E') THEN 0.02 WHEN contains(dir, 'W') THEN -0.02 ELSE 0 END, 6) AS lon, round(lat + CASE WHEN contains(dir, 'N') THEN 0.02 WHEN contains(dir, 'S') THEN -0.02 ELSE 0 END, 6) AS lat
FROM (SELECT *, ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][1 + id % 8] AS dir FROM {POINTS})""")
def p6(spark, sf):
    names = F.array(*[F.lit(x) for x in ("N", "NE", "E", "SE", "S", "SW", "W", "NW")])
    x, y = geo.adjacent(F.col("lon"), F.col("lat"), F.get(names, (F.col("id") % 8).cast("int")), 0.02)
    return points(spark, sf).select("id", R(x).alias("lon"), R(y).alias("lat"))


query("p7_point_fields", f"SELECT id, lon, lat FROM {POINTS}")(lambda s, d: points(s, d).withColumn("geometry", F.struct("lon", "lat")).select("id", "geometry.lon", "geometry.lat"))


@query("p8_centroid", f"SELECT id, round(lon + 0.02, 6) AS cx, round(lat + 0.03, 6) AS cy, round(lon + 0.02, 6) AS mx, round(lat + 0.03, 6) AS my FROM {POINTS}")
def p8(spark, sf):
    ring = geo.ring_of(geo.rect(F.col("lon"), F.col("lat"), F.col("lon") + 0.04, F.col("lat") + 0.06))
    p = points(spark, sf).withColumn("ring", ring)
    # centred first: the shoelace terms of tiny rings far from the origin cancel
    moved = F.transform("ring", lambda q: F.struct((q["x"] - F.col("lon")).alias("x"), (q["y"] - F.col("lat")).alias("y")))
    c = geo.ring_centroid(moved)
    mean = lambda k: spectral.array_mean(F.transform("ring", lambda q: q[k]))
    return p.withColumn("c", c).select("id", R(F.col("c.x") + F.col("lon")).alias("cx"), R(F.col("c.y") + F.col("lat")).alias("cy"), R(mean("x")).alias("mx"), R(mean("y")).alias("my"))


query("p9_total_bounds", f"SELECT min(lon) AS minx, min(lat) AS miny, max(lon) AS maxx, max(lat) AS maxy FROM {POINTS}")(lambda s, d: points(s, d).agg(F.min("lon").alias("minx"), F.min("lat").alias("miny"), F.max("lon").alias("maxx"), F.max("lat").alias("maxy")))


@query("p10_h3_cell")
def p10(spark, sf):
    """H3 index at resolution 15 of each point, in degrees a hundred times as far apart; no SQL twin, tests hold the function against indexes of real sites."""
    return points(spark, sf).select("id", h3.h3_cell(F.col("lat") * 100, F.col("lon") * 100).alias("h3"))


query("p11_numbered_names", "SELECT c_custkey, 'site_' || row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS name FROM customer")(
    lambda s, d: table(s, d, "customer").select("c_custkey", F.concat(F.lit("site_"), F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey"))).alias("name")))
query("p12_feature", f"""SELECT id, '{{"type":"Point","coordinates":[' || id || ',' || id % 7 || ']}}' AS geometry FROM {POINTS}""")(
    lambda s, d: points(s, d).select("id", F.to_json(F.struct(F.lit("Point").alias("type"), F.array(F.col("id"), F.col("id") % 7).alias("coordinates"))).alias("geometry")))
query("p13_units", f"SELECT id, round(area_km2 * 100, 6) AS ha, round(area_km2 * 1e6, 2) AS m2, round(pop / 100, 6) AS share FROM {SITES} WHERE area_km2 > 0")(lambda s, d: sites(s, d).where("area_km2 > 0").select("id", R(F.col("area_km2") * 100, 6).alias("ha"), R(F.col("area_km2") * 1e6, 2).alias("m2"), R(F.col("pop") / 100, 6).alias("share")))
query("p14_select_drop", "SELECT n_nationkey, n_name FROM nation")(lambda s, d: table(s, d, "nation").drop("n_regionkey"))


@query("p15_coerce_columns", "SELECT event_id, CAST(event_id AS DOUBLE) AS a, event_type AS b FROM events")
def p15(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("event_id").cast("string").alias("a"), F.col("event_type").alias("b"))
    return values.coerce_columns(e, "a", "b")


query("p16_to_numeric", "SELECT p_partkey, TRY_CAST(CASE WHEN p_partkey % 3 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS x FROM part")(
    lambda s, d: table(s, d, "part").select("p_partkey", values.numeric(F.when(F.col("p_partkey") % 3 == 0, "n/a").otherwise(F.col("p_size").cast("string"))).alias("x")))
_case = lambda m, c: "CASE " + c + " " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in m.items()) + " END"
query("p17_decode", f"SELECT p_partkey, {_case(values.LANDFORMS, 'p_size')} AS landform, {_case(values.DIRECTIONS, 'p_size')} AS direction FROM part")(
    lambda s, d: table(s, d, "part").select("p_partkey", values.decode(F.col("p_size"), values.LANDFORMS).alias("landform"), values.decode(F.col("p_size"), values.DIRECTIONS).alias("direction")))


@query("p18_water_type", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'river' WHEN event_id % 3 = 0 THEN 'lake' WHEN event_id % 5 = 0 THEN 'wood' WHEN event_id % 7 = 0 THEN 'basin' ELSE '{}' END AS kind FROM events")
def p18(spark, sf):
    i = F.col("event_id")
    tag = lambda n, k, v: F.when(i % n == 0, F.create_map(F.lit(k), F.lit(v))).otherwise(F.create_map().cast("map<string,string>"))
    tags = F.map_concat(tag(2, "waterway", "river"), tag(3, "water", "lake"), tag(5, "natural", "wood"), tag(7, "landuse", "basin"))
    return table(spark, sf, "events").select("event_id", values.water_type(tags).alias("kind"))


query("p19_output_names", "SELECT n_nationkey, n_name || '_threshold_' || printf('%.1f', n_nationkey / 10.0) || '.geojson' AS name FROM nation")(lambda s, d: table(s, d, "nation").select("n_nationkey", F.format_string("%s_threshold_%.1f.geojson", "n_name", F.col("n_nationkey") / F.lit(10.0)).alias("name")))
query("p20_sentinels", f"SELECT id, CASE WHEN dist_water_m = -1 THEN 10000 ELSE dist_water_m END AS far, nullif(area_km2, -1) AS area FROM {SITES}")(
    lambda s, d: sites(s, d).select("id", values.sentinel(values.nullify(F.col("dist_water_m")), 10_000.0).alias("far"), values.nullify(F.col("area_km2")).alias("area")))
query("p21_verdict_flags", "SELECT doc_id, quality = 1 AND toxic = 0 AS yes, quality = 0 AND toxic = 0 AS no, toxic = 1 AS maybe FROM labels")(
    lambda s, d: table(s, d, "labels").withColumn("v", F.when(F.col("toxic") == 1, "maybe").when(F.col("quality") == 1, "yes").otherwise("no")).select("doc_id", *[(F.col("v") == k).alias(k) for k in ("yes", "no", "maybe")]))
query("p22_band_subset", f"SELECT id, round(bands[4], 4) AS r, round(bands[3], 4) AS g, round(bands[2], 4) AS b FROM {VECTORS}")(
    lambda s, d: vectors(s, d).withColumn("c", F.transform(F.array(F.lit(3), F.lit(2), F.lit(1)), lambda i: F.get("bands", i))).select("id", *[R(F.get("c", i), 4).alias(n) for i, n in enumerate("rgb")]))
query("p23_transfer", "SELECT c_custkey, coalesce(CASE WHEN o.k IS NOT NULL THEN 'old' END, c_mktsegment) AS segment FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') o ON k = c_custkey")(
    lambda s, d: table(s, d, "customer").join(table(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), F.lit("old").alias("old")).distinct(), "c_custkey", "left").select("c_custkey", F.coalesce("old", "c_mktsegment").alias("segment")))


@query("p24_merge_properties", "SELECT c_custkey, coalesce(o.p, o.n, CAST(c_nationkey AS VARCHAR)) AS status FROM (SELECT c_custkey, c_nationkey, max(o_orderstatus) AS p, NULL AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL) o")
def p24(spark, sf):
    """Row properties win over the feature's."""
    last = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderstatus").alias("s"))
    c = table(spark, sf, "customer").join(last, "c_custkey", "left")
    feature, row = F.array(F.struct(F.lit("status").alias("key"), F.col("c_nationkey").cast("string").alias("value"))), F.when(F.col("s").isNotNull(), F.array(F.struct(F.lit("status").alias("key"), F.col("s").alias("value"))))
    merged = F.map_from_entries(F.coalesce(row, feature))
    return c.select("c_custkey", F.element_at(merged, "status").alias("status"))


# --- scalar functions ------------------------------------------------------------------------------------------------------

query("m1_normalize", f"SELECT id, round(bands[1] / 3000, 6) AS x FROM {VECTORS}")(lambda s, d: vectors(s, d).select("id", R(spectral.normalize(F.get("bands", 0))).alias("x")))
_z = lambda i: f"(bands[{i + 1}] - {spectral.BAND_MEAN[i]}::DOUBLE) / {spectral.BAND_STD[i]}::DOUBLE"
query("m2_unit_norm", f"SELECT id, {', '.join(f'round({_z(i)}, 6) AS b{i}' for i in range(12))} FROM {VECTORS}")(
    lambda s, d: vectors(s, d).withColumn("z", spectral.unit_norm(F.col("bands"))).select("id", *[R(F.get("z", i)).alias(f"b{i}") for i in range(12)]))
query("m4_inverse_unit_norm", f"SELECT id, round(bands[1] / 3000, 6) AS b0, round(bands[12] / 3000, 6) AS b11 FROM {VECTORS}")(
    lambda s, d: vectors(s, d).withColumn("z", spectral.inverse_unit_norm(spectral.unit_norm(F.col("bands")))).select("id", R(F.get("z", 0)).alias("b0"), R(F.get("z", 11)).alias("b11")))
query("m5_ndvi", f"SELECT id, round((bands[8] - bands[4]) / nullif(bands[8] + bands[4], 0), 6) AS ndvi FROM {VECTORS}")(lambda s, d: vectors(s, d).select("id", R(spectral.normalized_difference(F.get("bands", 7), F.get("bands", 3))).alias("ndvi")))
query("m6_moisture", f"SELECT id, round((bands[8] - bands[11]) / nullif(bands[8] + bands[11], 0), 6) AS x FROM {VECTORS}")(lambda s, d: vectors(s, d).select("id", R(spectral.normalized_difference(F.get("bands", 7), F.get("bands", 10))).alias("x")))
query("m7_contrast", f"SELECT id, round(list_avg(bands[7:10]) - list_avg(bands[1:4]), 4) AS x FROM {VECTORS}")(lambda s, d: vectors(s, d).select("id", R(spectral.contrast(F.col("bands")), 4).alias("x")))
query("m8_stretch", f"SELECT id, round((greatest(least(bands[1] / 3000, 0.75::DOUBLE), 0.1::DOUBLE) - 0.1::DOUBLE) / pow(0.65::DOUBLE, 1.2::DOUBLE), 6) AS x FROM {VECTORS}")(lambda s, d: vectors(s, d).select("id", R(spectral.stretch(F.get("bands", 0) / 3000)).alias("x")))


@query("m9_percentile_rescale", f"WITH q AS (SELECT quantile_cont(bands[1], 0.02) AS a, quantile_cont(bands[1], 0.98) AS b FROM {VECTORS}) SELECT id, round(greatest(0, least(1, (bands[1] - a) / nullif(b - a, 0))), 6) AS x FROM {VECTORS}, q")
def m9(spark, sf):
    v = vectors(spark, sf).select("id", F.get("bands", 0).alias("x"))
    low, high = v.agg(F.percentile("x", F.array(F.lit(0.02), F.lit(0.98)))).first()[0]
    return v.select("id", R(spectral.clip((F.col("x") - low) / (high - low), 0, 1)).alias("x"))


query("m10_min_max", f"SELECT tile_id, band, round((v - min(v) OVER w) / nullif(max(v) OVER w - min(v) OVER w, 0), 6) AS x FROM (SELECT tile_id, band, avg(v) AS v FROM {PIXELS} GROUP BY 1, 2) WINDOW w AS (PARTITION BY tile_id)")(
    lambda s, d: pixels(s, d).groupBy("tile_id", "band").agg(F.avg("v").alias("v")).select("tile_id", "band", R(spectral.min_max(F.col("v"), "tile_id")).alias("x")))
query("m11_logs", f"SELECT id, round(ln(pop + 10), 6) AS p, round(ln(abs(area_km2) * 1e6 + 0.1), 6) AS a FROM {SITES}")(lambda s, d: sites(s, d).select("id", R(F.ln(F.col("pop") + 10)).alias("p"), R(F.ln(F.abs("area_km2") * 1e6 + 0.1)).alias("a")))
_rz = lambda x, k: f"(({x}) - ({values.RISK[k][0]})::DOUBLE) / ({values.RISK[k][1]})::DOUBLE"
_risk = f"""CASE WHEN area <> 0 AND water <> -1 THEN (61 * {_rz('ln(area + 0.1)', 'area')} + 21 * {_rz('ln(pop + 10)', 'population')} - 69 * {_rz('ln(water + 0.01)', 'water')} - 41 * {_rz('clay', 'clay')}) / 192 END"""


@query("m12_risk", f"""WITH s AS (SELECT id, CASE WHEN area_km2 = -1 THEN 0 ELSE area_km2 * 1e6 END AS area, dist_water_m AS water, pop, clay FROM {SITES}), r AS (SELECT id, {_risk} AS z FROM s)
SELECT id, round((z - (SELECT min(z) FROM r)) / nullif((SELECT max(z) - min(z) FROM r), 0), 6) AS risk FROM r""")
def m12(spark, sf):
    area = F.when(F.col("area_km2") == -1, 0.0).otherwise(F.col("area_km2") * 1e6)
    r = sites(spark, sf).select("id", values.risk(area, F.col("pop"), F.col("dist_water_m"), F.col("clay")).alias("z"))
    low, high = r.agg(F.min("z"), F.max("z")).first()  # one row: a window over all rows would run in one task
    return r.select("id", R(F.try_divide(F.col("z") - F.lit(low), F.lit(high) - F.lit(low))).alias("risk"))


query("m13_clip", f"SELECT id, round(greatest(-3, least(3, (bands[2] - 2000) / 200)), 6) AS x FROM {VECTORS}")(lambda s, d: vectors(s, d).select("id", R(spectral.clip((F.get("bands", 1) - 2000) / 200, -3, 3)).alias("x")))
_n = lambda i: f"bands[{i + 1}] / 3000"
query("m14_fire", f"SELECT id, (coalesce({_n(11)} / nullif({_n(7)}, 0) > 1.5, false) AND {_n(11)} > 0.5) AS hot, (({_n(11)} / nullif({_n(7)}, 0) > 2.5 AND {_n(11)} - {_n(7)} > 0.3 AND {_n(11)} > 0.5) OR ({_n(10)} > 0.8 AND {_n(0)} < 0.2 AND ({_n(7)} > 0.4 OR {_n(11)} < 0.1))) AS fire FROM {VECTORS}")(
    lambda s, d: (lambda b: vectors(s, d).select("id", (F.coalesce(F.try_divide(b(11), b(7)) > 1.5, F.lit(False)) & (b(11) > 0.5)).alias("hot"), spectral.fire(b(0), b(7), b(10), b(11)).alias("fire")))(lambda i: F.get("bands", i) / 3000))
query("m15_cosine", "SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS c FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")(
    lambda s, d: (lambda e: e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("o")), "vec_id").select("vec_id", R(spectral.cosine(F.col("embedding"), F.col("o"))).alias("c")))(table(s, d, "embeddings")))
query("m16_norm", f"SELECT id, round(sqrt(list_dot_product(bands, bands)), 4) AS n FROM {VECTORS}")(lambda s, d: vectors(s, d).select("id", R(spectral.norm(F.col("bands")), 4).alias("n")))
query("m17_pixel_centers", "SELECT l_orderkey, l_linenumber, round(10 + 0.001 * (l_linenumber + 0.5), 6) AS lon, round(50 - 0.001 * (l_orderkey % 100 + 0.5), 6) AS lat FROM lineitem")(
    lambda s, d: table(s, d, "lineitem").select("l_orderkey", "l_linenumber", R(geo.pixel_center(F.lit(10.0), 0.001, F.col("l_linenumber"))).alias("lon"), R(geo.pixel_center(F.lit(50.0), 0.001, F.col("l_orderkey") % 100, -1)).alias("lat")))
query("m18_rounding", f"SELECT id, round(bands[1], 4) AS r4, CAST(trunc(bands[1]) AS INT) AS t, CAST(floor(bands[1] / 7) AS BIGINT) AS f FROM {VECTORS}")(lambda s, d: vectors(s, d).select("id", R(F.get("bands", 0), 4).alias("r4"), F.get("bands", 0).cast("int").alias("t"), F.floor(F.get("bands", 0) / 7).alias("f")))
query("m19_width", "SELECT p_partkey, round(p_size / 100 / 111.1::DOUBLE, 4) AS deg FROM part")(lambda s, d: table(s, d, "part").select("p_partkey", geo.metres_per_pixel_width(F.col("p_size")).alias("deg")))
_b = lambda prior, pos, se, sp: f"(CASE WHEN {pos} THEN {se}::DOUBLE * ({prior}) / ({se}::DOUBLE * ({prior}) + (1 - {sp}::DOUBLE) * (1 - ({prior}))) ELSE (1 - {se}::DOUBLE) * ({prior}) / ((1 - {se}::DOUBLE) * ({prior}) + {sp}::DOUBLE * (1 - ({prior}))) END)"
query("m20_bayes", f"SELECT id, round({_b(_b('p * 0.8::DOUBLE', 'id % 2 = 0', 0.83, 0.89), 'id % 3 = 0', 0.78, 0.90)}, 6) AS soft_label FROM {SCORED}")(
    lambda s, d: S.weak_labels(scored(s, d), F.col("p"), F.lit(0.1), F.col("id") % 2 == 0, F.col("id") % 3 == 0).select("id", R("soft_label").alias("soft_label")))
query("m21_soft_label", f"SELECT id, round((3 * p + 2 * label + 1 * (id % 2)) / 6, 6) AS x FROM {SCORED}")(lambda s, d: scored(s, d).select("id", R(spectral.soft_label((3, 2, 1), F.col("p"), F.col("label"), F.col("id") % 2)).alias("x")))
query("m22_one_hot", f"SELECT id, (label = 0)::INT AS c0, (label = 3)::INT AS c3, label AS back FROM {VECTORS}")(
    lambda s, d: vectors(s, d).withColumn("h", spectral.one_hot(F.col("label"), 10)).select("id", F.get("h", 0).alias("c0"), F.get("h", 3).alias("c3"), spectral.argmax(F.col("h")).alias("back")))
query("m23_height", f"SELECT id, lon + lat AS height FROM {POINTS}")(lambda s, d: points(s, d).select("id", (F.col("lon") + F.col("lat")).alias("height")))
query("crs_areas", f"""SELECT id, round(6378137.0 * radians(0.01) * (6378137.0 * ln(tan(pi() / 4 + radians(y + 0.01) / 2)) - 6378137.0 * ln(tan(pi() / 4 + radians(y) / 2))), 0) AS m2 FROM (SELECT id, lat * 100 AS y FROM {POINTS})""")(
    lambda s, d: points(s, d).select("id", R(geo.rect_area(geo.rect(F.col("lon") * 100, F.col("lat") * 100, F.col("lon") * 100 + 0.01, F.col("lat") * 100 + 0.01), ellipsoid=False), 0).alias("m2")))
query("tile_keys", "SELECT o_orderkey, '900:20:10.0:' || (1 + o_orderkey % 60) || ':' || (o_custkey % 40 - 20) || ':' || o_orderkey % 500 AS key, CAST(o_custkey % 40 - 20 AS INT) AS i, 500000 + (o_custkey % 40 - 20) * 9000.0::DOUBLE - 200 AS minx, (o_orderkey % 500) * 9000.0::DOUBLE - 200 AS miny FROM orders")(
    lambda s, d: table(s, d, "orders").withColumn("key", geo.format_tile_key(F.lit(900), F.lit(20), F.lit(10.0), 1 + F.col("o_orderkey") % 60, F.col("o_custkey") % 40 - 20, F.col("o_orderkey") % 500)).withColumn("t", geo.parse_tile_key(F.col("key"))).withColumn("r", geo.tile_extent(F.col("t"))).select("o_orderkey", "key", "t.i", "r.minx", "r.miny"))
query("string_functions", "SELECT c_custkey, lower(c_mktsegment) AS low, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS cap, replace(c_name, '#', '_') AS rep, string_split(c_name, '#')[2] AS part, starts_with(c_name, 'Customer') AS st, contains(c_name, '00') AS co, rtrim(c_name || '  ') AS rt, printf('%.2f', c_acctbal) AS f2 FROM customer")(
    lambda s, d: table(s, d, "customer").select("c_custkey", F.lower("c_mktsegment").alias("low"), F.initcap("c_mktsegment").alias("cap"), F.replace("c_name", F.lit("#"), F.lit("_")).alias("rep"), F.get(F.split("c_name", "#"), 1).alias("part"), F.startswith("c_name", F.lit("Customer")).alias("st"), F.contains("c_name", F.lit("00")).alias("co"), F.rtrim(F.concat("c_name", F.lit("  "))).alias("rt"), F.format_string("%.2f", "c_acctbal").alias("f2")))
query("melt_bands", f"SELECT tile_id, name, round(v, 4) AS v FROM (UNPIVOT (SELECT tile_id, avg(v) FILTER (band = 'AF') AS af, avg(v) FILTER (band = 'NO') AS no FROM {PIXELS} GROUP BY 1) ON af, no INTO NAME name VALUE v)")(
    lambda s, d: pixels(s, d).groupBy("tile_id").agg(F.avg(F.when(F.col("band") == "AF", F.col("v"))).alias("af"), F.avg(F.when(F.col("band") == "NO", F.col("v"))).alias("no")).unpivot("tile_id", ["af", "no"], "name", "v").where("v is not null").withColumn("v", R("v", 4)))
