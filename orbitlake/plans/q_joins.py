"""Joins: equi, temporal, spatial by grid cells, nearest, greedy; point merging."""

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import merge, position, spatial
from ..sources import catalog
from .analogues import OTHER_POINTS, PIXELS, POINTS, SITES, other_points, pixels, points, sites, table
from .registry import query

R = lambda c, n=6: F.round(c, n)
RECTS = f"(SELECT id AS rid, lon - 0.03 AS minx, lat - 0.03 AS miny, lon + 0.03 AS maxx, lat + 0.03 AS maxy FROM {OTHER_POINTS})"


def rects(s, d):
    return other_points(s, d).select(F.col("id").alias("rid"), geo.box(F.col("lon"), F.col("lat"), 0.03).alias("rect"))


@query("j1_semi_both_ways", "SELECT o_orderkey AS k, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_discount > 0.05 AND o_totalprice > 100000 GROUP BY 1")
def j1(spark, sf):
    scenes = table(spark, sf, "orders").where("o_totalprice > 100000").select(F.col("o_orderkey").alias("k"))
    clouds = table(spark, sf, "lineitem").where("l_discount > 0.05").select(F.col("l_orderkey").alias("k"))
    return clouds.join(scenes, "k", "left_semi").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("j2_save_first", "SELECT o_orderkey, q FROM orders JOIN (SELECT l_orderkey, min(struct_pack(a := l_shipdate, b := l_partkey, c := l_suppkey, q := l_quantity)).q AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def j2(spark, sf):
    first = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min(F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity"))["l_quantity"].alias("q"))
    return table(spark, sf, "orders").select("o_orderkey").join(first, "o_orderkey")


_IN = "p.lon BETWEEN r.minx AND r.maxx AND p.lat BETWEEN r.miny AND r.maxy"
query("j5_point_rect_semi", f"SELECT id FROM {POINTS} p WHERE EXISTS (SELECT 1 FROM {RECTS} r WHERE {_IN})")(lambda s, d: spatial.points_in_rects(points(s, d), rects(s, d), 0.06, "left_semi").select("id"))
query("j14_point_rect_inner", f"SELECT id, rid FROM {POINTS} p JOIN {RECTS} r ON {_IN}")(lambda s, d: spatial.points_in_rects(points(s, d), rects(s, d), 0.06).select("id", "rid"))
query("j9_first_bbox_hit", f"SELECT id, min(rid) AS rid FROM {POINTS} p JOIN {RECTS} r ON {_IN} GROUP BY 1")(lambda s, d: spatial.first_match(spatial.points_in_rects(points(s, d), rects(s, d), 0.06), ["id"], ["rid"]).select("id", "rid"))
query("s12_region_scan", f"SELECT id, rid FROM {POINTS} p JOIN {RECTS} r ON {_IN}")(lambda s, d: spatial.points_in_rects(points(s, d), rects(s, d), 0.06).select("id", "rid"))


@query("j7_point_in_polygon", f"SELECT id, max(rid) AS country FROM {POINTS} p JOIN (SELECT id AS rid, lon AS x, lat AS y FROM {OTHER_POINTS}) r ON abs(p.lon - r.x) + abs(p.lat - r.y) < 0.08 GROUP BY 1")
def j7(spark, sf):
    """The last of the polygons (diamonds here) that hold the point wins."""
    p = lambda dx, dy: F.struct((F.col("lon") + dx).alias("x"), (F.col("lat") + dy).alias("y"))
    polygons = other_points(spark, sf).select(F.col("id").alias("rid"), F.array(p(0.08, 0.0), p(0.0, 0.08), p(-0.08, 0.0), p(0.0, -0.08)).alias("ring"))
    return spatial.last_polygon(points(spark, sf), polygons, 0.16).withColumnRenamed("rid", "country")


_SEG = f"(SELECT id AS way, lon AS ax, lat AS ay, lon + 0.05 AS bx, lat + 0.02 AS ey FROM {OTHER_POINTS})"


@query("j8_nearest_segment", f"""
WITH a AS (SELECT p.id, p.lon, p.lat, s.way, ax, ay, bx, ey, greatest(0, least(1, ((lon - ax) * (bx - ax) + (lat - ay) * (ey - ay)) / ((bx - ax) * (bx - ax) + (ey - ay) * (ey - ay)))) AS t FROM {POINTS} p, {_SEG} s),
d AS (SELECT id, way, sqrt(pow(lon - (ax + t * (bx - ax)), 2) + pow(lat - (ay + t * (ey - ay)), 2)) AS dist FROM a),
b AS (SELECT id, arg_min(way, dist) AS way, min(dist) AS dist FROM d WHERE dist <= 0.05 GROUP BY 1)
SELECT p.id, coalesce(round(dist * 111100, 2), -1) AS metres, coalesce(b.way, -1) AS way FROM {POINTS} p LEFT JOIN b USING (id)""")
def j8(spark, sf):
    segments = other_points(spark, sf).select(F.col("id").alias("way"), F.col("lon").alias("ax"), F.col("lat").alias("ay"), (F.col("lon") + 0.05).alias("bx"), (F.col("lat") + 0.02).alias("by"))
    out = spatial.nearest_segment(points(spark, sf), segments, 0.05)
    return out.select("id", F.coalesce(R(F.col("distance") * 111_100, 2), F.lit(-1.0)).alias("metres"), F.coalesce("way", F.lit(-1)).alias("way"))


_PAIRS = f"(SELECT a.id, b.id AS id2, sqrt((a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat)) AS distance FROM {POINTS} a, {POINTS} b)"


def second(df):
    return df.select(F.col("id").alias("id2"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))


query("j11_radius_self_join", f"SELECT id, id2, round(distance, 6) AS distance FROM {_PAIRS} WHERE distance <= 0.02")(lambda s, d: spatial.within_radius(points(s, d), second(points(s, d)), 0.02).select("id", "id2", R("distance").alias("distance")))
_BOX = f"(SELECT id, lon - 0.01 - 0.01 * (id % 3) AS minx, lon + 0.01 + 0.01 * (id % 3) AS maxx, lat - 0.01 - 0.01 * (id % 3) AS miny, lat + 0.01 + 0.01 * (id % 3) AS maxy FROM {POINTS})"


@query("j12_rect_overlap", f"""SELECT a.id, b.id AS id2 FROM {_BOX} a JOIN {_BOX} b ON a.id < b.id AND a.minx < b.maxx AND b.minx < a.maxx AND a.miny < b.maxy AND b.miny < a.maxy
  AND NOT (a.minx >= b.minx AND a.maxx <= b.maxx AND a.miny >= b.miny AND a.maxy <= b.maxy) AND NOT (b.minx >= a.minx AND b.maxx <= a.maxx AND b.miny >= a.miny AND b.maxy <= a.maxy)""")
def j12(spark, sf):
    h = 0.01 + 0.01 * (F.col("id") % 3)
    r = points(spark, sf).select("id", geo.rect(F.col("lon") - h, F.col("lat") - h, F.col("lon") + h, F.col("lat") + h).alias("rect_a"))
    other = r.select(F.col("id").alias("id2"), F.col("rect_a").alias("rect_b"))
    return spatial.rect_pairs(r, other, 0.06, geo.rects_overlap).where("id < id2").select("id", "id2")


@query("j6_tile_intersects", f"SELECT DISTINCT a.id FROM {_BOX} a JOIN {RECTS} r ON a.minx <= r.maxx AND r.minx <= a.maxx AND a.miny <= r.maxy AND r.miny <= a.maxy")
def j6(spark, sf):
    h = 0.01 + 0.01 * (F.col("id") % 3)
    tiles = points(spark, sf).select("id", geo.rect(F.col("lon") - h, F.col("lat") - h, F.col("lon") + h, F.col("lat") + h).alias("rect_a"))
    return spatial.rect_pairs(tiles, rects(spark, sf).withColumnRenamed("rect", "rect_b"), 0.06).select("id").distinct()


@query("j10_greedy_match", f"""WITH RECURSIVE p AS (SELECT a.id, b.id AS id2 FROM {POINTS} a JOIN {OTHER_POINTS} b ON sqrt((a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat)) < 0.02),
c AS (SELECT row_number() OVER (ORDER BY id) AS k, id, list(id2 ORDER BY id2) AS choices FROM p GROUP BY id),
g AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS taken, NULL::BIGINT AS id, NULL::BIGINT AS id2
  UNION ALL SELECT k, CASE WHEN m IS NULL THEN taken ELSE list_append(taken, m) END, id, m FROM (SELECT c.k, taken, c.id, list_filter(choices, lambda x: NOT list_contains(taken, x))[1] AS m FROM g JOIN c ON c.k = g.k + 1))
SELECT id, id2 FROM g WHERE id2 IS NOT NULL""")
def j10(spark, sf):
    left = points(spark, sf).select("id", F.col("id").alias("seq"), "lon", "lat")
    right = other_points(spark, sf).select(F.col("id").alias("id2"), F.col("id").alias("seq2"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"))
    return spatial.greedy_match(left, right, 0.02)


@query("j10_mutual_nearest", f"""WITH p AS (SELECT a.id, b.id AS id2, sqrt((a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat)) AS d FROM {POINTS} a, {OTHER_POINTS} b),
q AS (SELECT * FROM p WHERE d <= 0.05), r AS (SELECT id, id2, row_number() OVER (PARTITION BY id ORDER BY d, id2) AS i, row_number() OVER (PARTITION BY id2 ORDER BY d, id) AS j FROM q) SELECT id, id2 FROM r WHERE i = 1 AND j = 1""")
def j10b(spark, sf):
    return spatial.mutual_nearest(points(spark, sf), second(other_points(spark, sf)), 0.05).select("id", "id2")


@query("j13_overlap_resolution", f"""WITH m AS (SELECT a.id, b.id AS id2, a.lon + 0.001 * (a.id % 5) AS cx, a.lat AS cy, a.lon AS x1, a.lat AS y1, b.lon AS x2, b.lat AS y2 FROM {POINTS} a JOIN {POINTS} b ON a.id <> b.id AND sqrt((a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat)) <= 0.005)
SELECT id, bool_or(sqrt((cx - x1) * (cx - x1) + (cy - y1) * (cy - y1)) > sqrt((cx - x2) * (cx - x2) + (cy - y2) * (cy - y2))) AS dropped FROM m GROUP BY 1""")
def j13(spark, sf):
    """A site loses its polygon if another overlapping site is nearer to the polygon's centroid; ties keep both."""
    cx = F.col("lon") + 0.001 * (F.col("id") % 5)
    near = spatial.within_radius(points(spark, sf), second(points(spark, sf)), 0.005).where("id <> id2")
    own, other = geo.distance(cx, F.col("lat"), F.col("lon"), F.col("lat")), geo.distance(cx, F.col("lat"), F.col("lon2"), F.col("lat2"))
    return near.groupBy("id").agg(F.bool_or(own > other).alias("dropped"))


query("j15_buffered_contains", f"SELECT a.id, b.rid FROM {POINTS} a JOIN {RECTS} b ON sqrt(pow(greatest(b.minx - a.lon, 0, a.lon - b.maxx), 2) + pow(greatest(b.miny - a.lat, 0, a.lat - b.maxy), 2)) < 0.002")(
    lambda s, d: (lambda r: spatial.points_in_rects(points(s, d), r, 0.06, rect="wide").where(F.sqrt(F.pow(F.greatest(F.col("rect.minx") - F.col("lon"), F.lit(0.0), F.col("lon") - F.col("rect.maxx")), 2) + F.pow(F.greatest(F.col("rect.miny") - F.col("lat"), F.lit(0.0), F.col("lat") - F.col("rect.maxy")), 2)) < 0.002).select("id", "rid"))(
        rects(s, d).withColumn("wide", geo.rect(F.col("rect.minx") - 0.002, F.col("rect.miny") - 0.002, F.col("rect.maxx") + 0.002, F.col("rect.maxy") + 0.002))))
query("j16_name_semi", "SELECT c_custkey FROM customer WHERE c_name IN (SELECT c_name FROM customer WHERE c_acctbal BETWEEN 100 AND 900)")(lambda s, d: (lambda c: c.join(c.where("c_acctbal between 100 and 900").select("c_name"), "c_name", "left_semi").select("c_custkey"))(table(s, d, "customer")))
query("j17_anti", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 20)")(lambda s, d: table(s, d, "orders").select("o_orderkey").join(table(s, d, "lineitem").where("l_quantity > 20").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti"))
query("j18_join_by_id", f"SELECT a.id, a.country, b.pop FROM {SITES} a JOIN {SITES} b USING (id) WHERE b.area_km2 > 0.02")(lambda s, d: (lambda t: t.select("id", "country").join(t.where("area_km2 > 0.02").select("id", "pop"), "id"))(sites(s, d)))
query("j20_left_with_sentinel", "SELECT c_custkey, coalesce(max(o_totalprice), -1) AS best FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")(
    lambda s, d: table(s, d, "customer").select("c_custkey").join(table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("best")), "c_custkey", "left").select("c_custkey", F.coalesce("best", F.lit(-1.0)).alias("best")))
query("a28_zonal_mean", f"SELECT rid, round(avg(id), 6) AS mean, count(*) AS n FROM {POINTS} p JOIN {RECTS} r ON {_IN} GROUP BY 1")(lambda s, d: spatial.points_in_rects(points(s, d), rects(s, d), 0.06).groupBy("rid").agg(R(F.avg("id")).alias("mean"), F.count(F.lit(1)).alias("n")))
query("a29_sum_within", f"SELECT p.id, coalesce(CAST(sum(o.id) AS BIGINT), 0) AS pop FROM {POINTS} p LEFT JOIN {OTHER_POINTS} o ON sqrt((p.lon - o.lon) * (p.lon - o.lon) + (p.lat - o.lat) * (p.lat - o.lat)) <= 0.05 GROUP BY 1")(
    lambda s, d: spatial.sum_within(points(s, d), second(other_points(s, d)).withColumn("pop", F.col("id2")), 0.05, "pop").select("id", "pop"))
query("k5_band_catalog", "SELECT n_name AS name, 4 + row_number() OVER (ORDER BY n_name) AS index FROM nation WHERE n_name NOT IN (SELECT r_name FROM region)")(
    lambda s, d: catalog.create_missing(table(s, d, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("index")), table(s, d, "nation").select(F.col("n_name").alias("name")), "name"))


_EVENTS = "(SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS position FROM events)"
_ORDERS = "(SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position FROM orders)"


def zipped(s, d, how):
    return position.zipped(table(s, d, "orders").select("o_orderkey", "o_totalprice"), table(s, d, "events").select("event_id", "ts"), [F.desc("o_totalprice"), F.asc("o_orderkey")], [F.asc("ts"), F.asc("event_id")], how).select("position", F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey"), F.coalesce("event_id", F.lit(-1)).alias("event_id"))


query("j21_zip", f"SELECT position, o_orderkey, event_id FROM {_ORDERS} JOIN {_EVENTS} USING (position)")(lambda s, d: zipped(s, d, "inner"))
query("j21_zip_longest", f"SELECT position, coalesce(o_orderkey, -1) AS o_orderkey, coalesce(event_id, -1) AS event_id FROM {_ORDERS} FULL JOIN {_EVENTS} USING (position)")(lambda s, d: zipped(s, d, "full"))


@query("c1_merge_sites")
def c1(spark, sf):
    return merge.merge_sites(points(spark, sf), 0.01).select(R("lon", 8).alias("lon"), R("lat", 8).alias("lat"), "members")
