"""Scans with predicates, filters, sorting, sampling, set operations."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import spectral
from ..functions.values import portable_hash
from ..operators import scoring as S
from ..sources import catalog
from .analogues import OTHER_POINTS, PIXELS, POINTS, RASTERS, SITES, VECTORS, other_points, pixels, points, rasters, sites, table, vectors
from .registry import query

R = lambda c, n=6: F.round(c, n)
LI = lambda s, d: table(s, d, "lineitem")

# --- scans -----------------------------------------------------------------------------------------------------------------


def scenes(s, d):
    o = table(s, d, "orders")
    box = F.struct((F.col("o_custkey") % 100).cast("double").alias("minx"), (F.col("o_orderkey") % 50).cast("double").alias("miny"), (F.col("o_custkey") % 100 + 2).cast("double").alias("maxx"), (F.col("o_orderkey") % 50 + 2).cast("double").alias("maxy"))
    return o.select(F.col("o_orderkey").alias("scene_key"), F.col("o_orderpriority").alias("product"), F.to_date("o_orderdate").alias("acquired"), (F.col("o_totalprice") / 500_000).alias("cloud_fraction"), box.alias("rect"))


query("s10_scene_search", """SELECT o_orderkey AS scene_key, CAST(o_orderdate AS DATE) AS acquired FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-06-30'
  AND o_totalprice / 500000 <= 0.3 AND o_custkey % 100 <= 40 AND o_custkey % 100 + 2 >= 10 AND o_orderkey % 50 <= 30 AND o_orderkey % 50 + 2 >= 5""")(
    lambda s, d: catalog.search_scenes(scenes(s, d), ["1-URGENT", "2-HIGH"], "1996-01-01", "1998-06-30", 0.3, (10, 5, 40, 30)).select("scene_key", "acquired"))
query("s11_collection_scan", "SELECT o_orderkey AS scene_key FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1997-01-01' AND CAST(o_orderdate AS DATE) < DATE '1997-07-01' AND o_totalprice / 5000 <= 30")(
    lambda s, d: scenes(s, d).where((F.col("acquired") >= F.lit("1997-01-01").cast("date")) & (F.col("acquired") < F.lit("1997-07-01").cast("date")) & (F.col("cloud_fraction") * 100 <= 30)).select("scene_key"))
query("s13_catalog_lookup", "SELECT n_name AS id FROM nation WHERE contains(n_name, 'N') ORDER BY n_name LIMIT 1")(lambda s, d: catalog.first_containing(table(s, d, "nation").select(F.col("n_name").alias("id")), "N"))
query("s20_sample_raster", f"SELECT p.c_custkey, coalesce(r.v, -1) AS v FROM customer p LEFT JOIN {RASTERS} r ON r.id = p.c_custkey AND r.row = p.c_nationkey % 8 AND r.col = 3")(
    lambda s, d: catalog.sample_raster(table(s, d, "customer").select("c_custkey", F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 8).alias("row"), F.lit(3).alias("col")), rasters(s, d)).select("c_custkey", F.coalesce("v", F.lit(-1.0)).alias("v")))
query("s22_lookup_cache", "SELECT l_orderkey, l_linenumber, l_shipdate, p_name AS place FROM lineitem JOIN part ON p_partkey = l_partkey")(
    lambda s, d: catalog.cached_lookup(LI(s, d).select("l_orderkey", "l_linenumber", "l_shipdate", F.col("l_partkey").alias("key")), ["key"], lambda k: k.join(table(s, d, "part"), F.col("key") == F.col("p_partkey")).select("key", F.col("p_name").alias("place"))).drop("key"))
query("s23_sweep", "SELECT * FROM (VALUES (1.0::DOUBLE, 10.0::DOUBLE), (2.0, 20.0), (3.0, 30.0)) t(lat, lon)")(lambda s, d: s.createDataFrame(list(zip([1.0, 2.0, 3.0], [10.0, 20.0, 30.0])), "lat double, lon double"))

# --- filters ---------------------------------------------------------------------------------------------------------------

query("f1_cloud_coverage", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_discount <= 0.03 AND l_tax > 0.05")(lambda s, d: LI(s, d).where("l_discount <= 0.03 and l_tax > 0.05").select("l_orderkey", "l_linenumber", "l_partkey"))
query("f2_drop_masked_scenes", f"SELECT scene, band, v FROM {PIXELS} WHERE scene IN (SELECT scene FROM {PIXELS} GROUP BY 1 HAVING sum(CASE WHEN valid THEN v END) > 0)")(
    lambda s, d: (lambda p: p.join(p.groupBy("scene").agg(F.sum(F.when(F.col("valid"), F.col("v"))).alias("t")).where("t > 0").select("scene"), "scene", "left_semi").select("scene", "band", "v"))(pixels(s, d)))
query("f3_cloud_mask", f"SELECT scene, band, CASE WHEN valid THEN v END AS v FROM {PIXELS}")(lambda s, d: pixels(s, d).select("scene", "band", F.when(F.col("valid"), F.col("v")).alias("v")))
query("f4_cloud_or_shadow", "SELECT l_orderkey, CASE WHEN NOT (l_discount > 0.07 OR l_tax > 0.06) THEN l_extendedprice END AS v FROM lineitem")(lambda s, d: LI(s, d).select("l_orderkey", F.when(~((F.col("l_discount") > 0.07) | (F.col("l_tax") > 0.06)), F.col("l_extendedprice")).alias("v")))
query("f5_cloud_probability", "SELECT count(*) AS n FROM lineitem WHERE l_quantity > 30")(lambda s, d: LI(s, d).where("l_quantity > 30").agg(F.count(F.lit(1)).alias("n")))
query("f6_dark_pixels", f"SELECT id FROM {VECTORS} WHERE bands[8] < 0.15 * 10000 AND label <> 6")(lambda s, d: vectors(s, d).where((F.get("bands", 7) < 0.15 * 1e4) & (F.col("label") != 6)).select("id"))
_frac = f"(SELECT tile_id, band, date_trunc('quarter', date)::DATE AS q, avg((NOT valid)::INT) AS c FROM {PIXELS} GROUP BY ALL)"


@query("f7_pair_cloudiness", f"WITH f AS {_frac} SELECT a.tile_id, a.band, a.q AS q0, b.q AS q1 FROM f a JOIN f b ON a.tile_id = b.tile_id AND a.band = b.band AND b.q = CAST(a.q + INTERVAL 6 MONTH AS DATE) WHERE a.c < 0.4 AND b.c < 0.4")
def f7(spark, sf):
    clear = pixels(spark, sf).groupBy("tile_id", "band", F.trunc("date", "quarter").alias("q")).agg(F.avg((~F.col("valid")).cast("double")).alias("c")).where("c < 0.4")
    later = clear.select("tile_id", "band", F.add_months("q", -6).alias("q0"), F.col("q").alias("q1"))
    return clear.select("tile_id", "band", F.col("q").alias("q0")).join(later, ["tile_id", "band", "q0"])


query("f8_image_cloud_filter", f"SELECT scene, count(*) AS n FROM {PIXELS} GROUP BY 1 HAVING avg((NOT valid)::INT) < 0.2")(lambda s, d: pixels(s, d).groupBy("scene").agg(F.count(F.lit(1)).alias("n"), F.avg((~F.col("valid")).cast("double")).alias("c")).where("c < 0.2").drop("c"))
_ndvi = "(bands[8] - bands[4]) / nullif(bands[8] + bands[4], 0)"
query("f9_ndvi_range", f"SELECT id FROM {VECTORS} WHERE {_ndvi} > 0 AND {_ndvi} < 0.4")(lambda s, d: vectors(s, d).withColumn("n", spectral.normalized_difference(F.get("bands", 7), F.get("bands", 3))).where("n > 0 and n < 0.4").select("id"))
query("f10_all_steps", f"SELECT id FROM {VECTORS} WHERE list_min(bands) > 900 AND list_max(bands) < 3100")(lambda s, d: vectors(s, d).where(spectral.all_within(F.col("bands"), 900, 3100)).select("id"))
query("f11_brightness", f"SELECT id FROM {VECTORS} WHERE list_avg(bands) < 2050")(lambda s, d: vectors(s, d).where(spectral.array_mean(F.col("bands")) < 2050).select("id"))
query("f12_not_black", f"SELECT id FROM {VECTORS} WHERE list_avg(bands) > 1900 AND list_avg(bands[1:6]) > 1900")(lambda s, d: vectors(s, d).where((spectral.array_mean(F.col("bands")) > 1900) & (spectral.array_mean(F.slice("bands", 1, 6)) > 1900)).select("id"))
query("f13_nodata", "SELECT vec_id FROM embeddings WHERE NOT list_contains(list_transform(embedding, lambda x: CAST(floor(x * 10) AS INT)), 3)")(lambda s, d: table(s, d, "embeddings").where(~F.array_contains(F.transform("embedding", lambda x: F.floor(x * 10).cast("int")), 3)).select("vec_id"))
query("f14_threshold", f"SELECT id, row, col, CASE WHEN v < 0.1 THEN 0 ELSE v END AS v FROM {RASTERS}")(lambda s, d: rasters(s, d).withColumn("v", F.when(F.col("v") < 0.1, 0.0).otherwise(F.col("v"))))
query("f15_mean_above", f"SELECT id FROM {RASTERS} GROUP BY 1 HAVING avg(v) > 0.01")(lambda s, d: rasters(s, d).groupBy("id").agg(F.avg("v").alias("m")).where("m > 0.01").select("id"))
query("f16_pred_or_missing", f"SELECT id, area_km2 FROM {SITES} WHERE area_km2 > 0.03 OR area_km2 = -1")(lambda s, d: sites(s, d).where("area_km2 > 0.03 or area_km2 = -1").select("id", "area_km2"))
query("f17_populated_tiles", "SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING bool_or(l_quantity > 49)")(lambda s, d: LI(s, d).groupBy("l_suppkey").agg(F.bool_or(F.col("l_quantity") > 49).alias("k")).where("k").select("l_suppkey"))
query("f18_positive_area", "SELECT event_id FROM events WHERE TRY_CAST(props::JSON ->> 'k' AS DOUBLE) > 0")(lambda s, d: table(s, d, "events").where(F.get_json_object("props", "$.k").try_cast("double") > 0).select("event_id"))
query("f19_lidar_quality", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber <> 0 AND l_returnflag <> 'R' AND l_tax > 0.03")(lambda s, d: LI(s, d).select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_tax").where("l_linenumber <> 0 and l_returnflag <> 'R' and l_tax > 0.03").na.drop("any").select("l_orderkey", "l_partkey"))
query("f20_height_outlier", "SELECT c_custkey, CASE WHEN c_acctbal > 1000 THEN 0 ELSE c_acctbal END AS h FROM customer")(lambda s, d: table(s, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 1000, 0.0).otherwise(F.col("c_acctbal")).alias("h")))
query("f21_substring", "SELECT p_partkey FROM part WHERE contains(p_type, 'BRASS') OR contains(p_name, 'a')")(lambda s, d: table(s, d, "part").where(F.contains("p_type", F.lit("BRASS")) | F.contains("p_name", F.lit("a"))).select("p_partkey"))
query("f22_membership", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey <> 3")(lambda s, d: table(s, d, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_nationkey") != 3)).select("c_custkey"))
query("f23_color_match", f"SELECT id FROM {VECTORS} WHERE abs(bands[1] - 2000) < 400 AND abs(bands[2] - 2100) < 400 AND abs(bands[3] - 1900) < 400")(lambda s, d: vectors(s, d).where(spectral.color_match(F.slice("bands", 1, 3), (2000, 2100, 1900), 400)).select("id"))
query("f24_confidence", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'")(lambda s, d: table(s, d, "orders").where("o_orderstatus = 'O'").select("o_orderkey"))
query("f25_water_distance", f"SELECT id FROM {SITES} WHERE dist_water_m <> -1 AND dist_water_m < 250")(lambda s, d: sites(s, d).where("dist_water_m <> -1 and dist_water_m < 250").select("id"))
query("f26_manual_duplicates", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (3, 5, 8, 13)")(lambda s, d: table(s, d, "customer").join(F.broadcast(s.createDataFrame([(x,) for x in (3, 5, 8, 13)], "c_custkey long")), "c_custkey", "left_anti").select("c_custkey"))
query("f27_frame_gate", f"SELECT id FROM {RASTERS} GROUP BY 1 HAVING median(v) > 0.01")(lambda s, d: rasters(s, d).groupBy("id").agg(F.median("v").alias("m")).where("m > 0.01").select("id"))
query("f28_masked_gate", f"SELECT tile_id, date FROM {PIXELS} GROUP BY 1, 2 HAVING avg((NOT valid)::INT) < 0.1")(lambda s, d: pixels(s, d).groupBy("tile_id", "date").agg(F.avg((~F.col("valid")).cast("double")).alias("c")).where("c < 0.1").select("tile_id", "date"))
query("f29_area_gate", f"SELECT id, count(*) AS n FROM {RASTERS} WHERE v > 0.05 GROUP BY 1 HAVING count(*) > 25")(lambda s, d: rasters(s, d).where("v > 0.05").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 25"))

# --- sort, limit, sample ----------------------------------------------------------------------------------------------------

query("o1_sort", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey")(lambda s, d: table(s, d, "customer").select("c_custkey", "c_acctbal").orderBy("c_acctbal", "c_custkey"))
query("o2_second_best", "SELECT a.vec_id, round(max(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])), 6) AS best FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id < 20 GROUP BY 1")(
    lambda s, d: (lambda e: e.where("vec_id < 20").join(e.select(F.col("vec_id").alias("o"), F.col("embedding").alias("oe"), "label"), "label").where("vec_id <> o").groupBy("vec_id").agg(R(F.max(spectral.cosine(F.col("embedding"), F.col("oe")))).alias("best")))(table(s, d, "embeddings")))
query("o2_second_best_all", "SELECT a.vec_id, round(max(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])), 6) AS best FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id GROUP BY 1")(
    lambda s, d: S.best_match(table(s, d, "embeddings"), "vec_id", "embedding", "label").withColumn("best", R("best")))
query("o3_slices", "SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i FROM customer) WHERE i >= 3 AND i % 4 = 0")(
    lambda s, d: table(s, d, "customer").withColumn("i", F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) - 1).where("i >= 3 and i % 4 = 0").select("c_nationkey", "c_custkey"))


_hash = lambda text: f"CAST('0x' || md5({text})[1:8] AS BIGINT)"


@query("o4_hash_sample", f"SELECT c_custkey FROM customer WHERE {_hash('CAST(c_custkey AS VARCHAR)')} % 10 = 0")
def o4(spark, sf):
    """A tenth of the rows by a hash of the key: repeatable, without a shuffle."""
    return table(spark, sf, "customer").where(portable_hash("c_custkey") % 10 == 0).select("c_custkey")


@query("o5_stable_split", f"SELECT {_hash("'42:' || doc_id")} % 10000 < 2000 AS is_test, count(*) AS n FROM labels GROUP BY 1")
def o5(spark, sf):
    return S.stable_split(table(spark, sf, "labels").withColumnRenamed("doc_id", "id")).groupBy("is_test").agg(F.count(F.lit(1)).alias("n"))


@query("o6_random_crop", f"""SELECT id, CAST(row - r0 AS INT) AS row, CAST(col - c0 AS INT) AS col, v FROM (SELECT *, {_hash("'1:' || id")} % 5 AS r0, {_hash("'2:' || id")} % 5 AS c0 FROM {RASTERS})
WHERE row BETWEEN r0 AND r0 + 3 AND col BETWEEN c0 AND c0 + 3""")
def o6(spark, sf):
    """A 4 x 4 crop of each image at a place that its id decides."""
    place = lambda seed: (portable_hash(F.lit(seed), "id") % 5).cast("int")
    r = rasters(spark, sf).withColumn("r0", place(1)).withColumn("c0", place(2))
    return r.where("row between r0 and r0 + 3 and col between c0 and c0 + 3").select("id", (F.col("row") - F.col("r0")).alias("row"), (F.col("col") - F.col("c0")).alias("col"), "v")


# --- sets ------------------------------------------------------------------------------------------------------------------

query("u1_intersect", "SELECT l_orderkey AS k FROM lineitem WHERE l_quantity > 45 INTERSECT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")(
    lambda s, d: LI(s, d).where("l_quantity > 45").select(F.col("l_orderkey").alias("k")).intersect(table(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))))
query("u2_union_by_name", "SELECT c_custkey AS k, c_name AS name, NULL::DOUBLE AS bal FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier")(
    lambda s, d: table(s, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")).unionByName(table(s, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal")), allowMissingColumns=True))
query("u3_distinct_sets", "SELECT count(*) AS n FROM (SELECT DISTINCT list_sort(list_distinct(list(l_returnflag || l_linestatus))) FROM lineitem GROUP BY l_partkey)")(
    lambda s, d: LI(s, d).groupBy("l_partkey").agg(F.sort_array(F.collect_set(F.concat("l_returnflag", "l_linestatus"))).alias("m")).dropDuplicates(["m"]).agg(F.count(F.lit(1)).alias("n")))
query("u4_difference", "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 200000")(lambda s, d: table(s, d, "customer").select("c_custkey").subtract(table(s, d, "orders").where("o_totalprice > 200000").select("o_custkey")))
query("u5_distinct_indices", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")(lambda s, d: LI(s, d).select("l_partkey", "l_suppkey").distinct())
query("j19_parameter_sweep", "SELECT r_name, t FROM region, (VALUES (0.3::DOUBLE), (0.6::DOUBLE), (0.9::DOUBLE)) v(t)")(lambda s, d: table(s, d, "region").select("r_name", F.explode(F.array(F.lit(0.3), F.lit(0.6), F.lit(0.9))).alias("t")))
