"""Composites, pairs and aggregates."""

from pyspark.sql import functions as F

from ..functions import spectral, values
from ..operators import composite as C
from ..operators import scoring as S
from .analogues import PIXELS, SCORED, SITES, VECTORS, pixels, scored, sites, table, vectors
from .registry import query

R = lambda c, n=4: F.round(c, n)

#: Windows of three months from 1995-01-01; both ends belong.
WINDOWS = """(SELECT CAST(DATE '1995-01-01' + to_months(CAST(3 * k AS INT)) AS DATE) AS window_start, CAST(DATE '1995-01-01' + to_months(CAST(3 * k + 3 AS INT)) AS DATE) AS e
  FROM range(0, 60) t(k))"""
SEEN = f"(SELECT p.*, w.window_start FROM {PIXELS} p JOIN {WINDOWS} w ON p.date >= w.window_start AND p.date <= w.e AND w.e <= DATE '1997-04-01')"
KEYS = ["tile_id", "band", "window_start"]


def seen(spark, sf):
    """Pixels in three-month windows to 1997-01-01, one window past the end."""
    px = pixels(spark, sf).withColumn("v", C.mask(F.col("v"), ~F.col("valid")))
    return C.windows(px, "1995-01-01", "1997-01-01", 3)


def composite_sql(agg: str, seen: str = SEEN) -> str:
    return f"SELECT tile_id, band, window_start, round({agg}(CASE WHEN valid THEN v END), 4) AS v FROM {seen} GROUP BY ALL"


for _name, _method, _sql in (("a1_median_composite", "median", "median"), ("a2_min_composite", "min", "min"), ("a5_mean_composite", "mean", "avg")):
    query(_name, composite_sql(_sql))(lambda s, d, m=_method: C.composite(seen(s, d), KEYS, m).withColumn("v", R("v")))


@query("a3_least_masked_composite", f"""
WITH s AS {SEEN}, c AS (SELECT tile_id, window_start, scene, count(*) FILTER (NOT valid) AS n, min(date) AS d FROM s GROUP BY ALL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, window_start ORDER BY n, d, scene) AS r FROM c) WHERE r = 1)
SELECT s.tile_id, s.window_start, s.scene, s.date, s.band, s.v FROM s JOIN b USING (tile_id, window_start, scene)""")
def a3(spark, sf):
    px = C.windows(pixels(spark, sf), "1995-01-01", "1997-01-01", 3)
    return C.least_masked(px, ["tile_id", "window_start"], "scene", ["date"]).select("tile_id", "window_start", "scene", "date", "band", "v")


@query("a4_argmax_composite", f"""
SELECT label, round(b[1], 4) AS b0, round(b[12], 4) AS b11 FROM (SELECT label, arg_max(bands, bands[12] / bands[8]) AS b FROM {VECTORS} GROUP BY label)""")
def a4(spark, sf):
    out = C.argmax_composite(vectors(spark, sf), ["label"], F.col("bands"), F.try_divide(F.get("bands", 11), F.get("bands", 7)))
    return out.select("label", R(F.get("bands", 0)).alias("b0"), R(F.get("bands", 11)).alias("b11"))


STATS = "coalesce(round(avg({v}), 8), -1) AS mean, coalesce(round(median({v}), 8), -1) AS median, coalesce(round(min({v}), 8), -1) AS min, coalesce(round(max({v}), 8), -1) AS max, coalesce(round(stddev_pop({v}), 8), -1) AS std"


@query("a6_patch_stats", f"SELECT tile_id, {STATS.format(v='round(x, 4)')}, count(x) AS count FROM (SELECT tile_id, CASE WHEN valid THEN sqrt(v) / 300 END AS x FROM {PIXELS}) GROUP BY tile_id")
def a6(spark, sf):
    px = pixels(spark, sf).withColumn("p", F.when(F.col("valid"), F.sqrt("v") / 300))
    return C.patch_stats(px, ["tile_id"]).withColumns({k: R(k, 8) for k in ("mean", "median", "min", "max", "std")})


@query("a7_site_stats", f"SELECT tile_id, {STATS.format(v='round(x, 6)')}, coalesce(round(var_pop(round(x, 6)), 8), -1) AS var, count(x) AS count FROM (SELECT tile_id, CASE WHEN valid THEN v / 1000 END AS x FROM {PIXELS}) GROUP BY tile_id")
def a7(spark, sf):
    px = pixels(spark, sf).withColumn("p", F.when(F.col("valid"), F.col("v") / 1000))
    return C.patch_stats(px, ["tile_id"], places=6, variance=True).withColumns({k: R(k, 8) for k in ("mean", "median", "min", "max", "std", "var")})


@query("a8_ensemble", "SELECT l_partkey AS pixel, round(median(l_discount + l_tax), 8) AS median, round(avg(l_discount + l_tax), 8) AS mean FROM lineitem GROUP BY 1")
def a8(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("pixel"), (F.col("l_discount") + F.col("l_tax")).alias("p"))
    both = S.ensemble(rows, ["pixel"], "median").withColumnRenamed("p", "median").join(S.ensemble(rows, ["pixel"], "mean").withColumnRenamed("p", "mean"), "pixel")
    return both.select("pixel", R("median", 8).alias("median"), R("mean", 8).alias("mean"))


@query("a9_country_rollup", f"""
SELECT country, count(*) AS total_sites, round(sum(CASE WHEN area_km2 <> -1 THEN area_km2 END) * 100, 4) AS total_ha, count(*) FILTER (area_km2 * 100 > 1) AS above_1_ha, count(*) FILTER (area_km2 * 100 > 2) AS above_2_ha,
  count(*) FILTER (dist_water_m <> -1 AND dist_water_m < 500) AS under_500_m, count(*) FILTER (dist_water_m <> -1 AND dist_water_m < 1000) AS under_1000_m, count(*) FILTER (dist_water_m <> -1 AND dist_water_m < 2000) AS under_2000_m,
  round(sum(pop), 2) AS population FROM {SITES} WHERE country <> '' GROUP BY country""")
def a9(spark, sf):
    s = sites(spark, sf).where("country <> ''").withColumn("ha", values.nullify(F.col("area_km2")) * 100).withColumn("w", values.nullify(F.col("dist_water_m")))
    return s.groupBy("country").agg(F.count(F.lit(1)).alias("total_sites"), R(F.sum("ha")).alias("total_ha"), F.count_if(F.col("ha") > 1).alias("above_1_ha"), F.count_if(F.col("ha") > 2).alias("above_2_ha"), *[F.count_if(F.col("w") < m).alias(f"under_{m}_m") for m in (500, 1000, 2000)], R(F.sum("pop"), 2).alias("population"))


query("a10_value_counts", "SELECT l_shipdate::DATE AS d, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC")(lambda s, d: table(s, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")))
query("a11_distinct", "SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem")(lambda s, d: table(s, d, "lineitem").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers")))
query("a12_ratio", "SELECT l_suppkey, round(avg((l_discount > 0.05)::INT), 6) AS ratio FROM lineitem GROUP BY 1")(lambda s, d: table(s, d, "lineitem").groupBy("l_suppkey").agg(R(F.avg((F.col("l_discount") > 0.05).cast("double")), 6).alias("ratio")))


@query("a13_log_stats", f"SELECT round(avg(ln(dist_water_m + 0.01)), 6) AS mean, round(stddev_pop(ln(dist_water_m + 0.01)), 6) AS std, count(*) AS n FROM {SITES} WHERE dist_water_m <> -1")
def a13(spark, sf):
    x = F.ln(F.col("dist_water_m") + 0.01)
    return sites(spark, sf).where("dist_water_m <> -1").agg(R(F.avg(x), 6).alias("mean"), R(F.stddev_pop(x), 6).alias("std"), F.count(F.lit(1)).alias("n"))


CONFUSION = f"(SELECT count(*) FILTER (p > 0.6 AND label = 1) AS tp, count(*) FILTER (p <= 0.6 AND label = 0) AS tn, count(*) FILTER (p > 0.6 AND label = 0) AS fp, count(*) FILTER (p <= 0.6 AND label = 1) AS fn FROM {SCORED})"


@query("a14_classification_report", f"""
WITH c AS {CONFUSION}, k AS (
  SELECT '0' AS class, tn / nullif(tn + fn, 0) AS precision, tn / nullif(tn + fp, 0) AS recall, tn + fp AS support FROM c UNION ALL SELECT '1', tp / nullif(tp + fp, 0), tp / nullif(tp + fn, 0), tp + fn FROM c),
f AS (SELECT class, coalesce(precision, 0) AS precision, coalesce(recall, 0) AS recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1, support FROM k)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
  FROM f UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM c
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM f)""")
def a14(spark, sf):
    return S.classification_report(scored(spark, sf), 0.6).withColumns({c: R(c, 6) for c in ("precision", "recall", "f1")})


@query("a15_confusion", f"SELECT tp, tn, fp, fn, round(tp / nullif(tp + fn, 0), 6) AS tpr, round(tn / nullif(tn + fp, 0), 6) AS tnr FROM {CONFUSION}")
def a15(spark, sf):
    return S.confusion(scored(spark, sf), 0.6).withColumn("tpr", R("tpr", 6)).withColumn("tnr", R("tnr", 6))


query("a15_outcomes", f"SELECT CASE WHEN p > 0.6 AND label = 1 THEN 'TP' WHEN p > 0.6 THEN 'FP' WHEN label = 1 THEN 'FN' ELSE 'TN' END AS outcome, count(*) AS n FROM {SCORED} GROUP BY 1")(
    lambda s, d: scored(s, d).groupBy(S.outcome(F.col("label"), F.col("p"), 0.6).alias("outcome")).agg(F.count(F.lit(1)).alias("n")))


@query("a16_mean_of_means", "SELECT l_returnflag AS class, round(avg(m), 4) AS mean, round(median(m), 4) AS median, round(stddev_pop(m), 4) AS std FROM (SELECT l_returnflag, l_suppkey, avg(l_extendedprice) AS m FROM lineitem GROUP BY ALL) GROUP BY 1")
def a16(spark, sf):
    per_site = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("class"), "l_suppkey").agg(F.avg("l_extendedprice").alias("m"))
    return per_site.groupBy("class").agg(R(F.avg("m")).alias("mean"), R(F.median("m")).alias("median"), R(F.stddev_pop("m")).alias("std"))


BANDS = ["AF", "NF", "NO", "RF", "AO", "RO"]


@query("a17_band_means", f"SELECT tile_id, date_trunc('month', date)::DATE AS month, {', '.join(f'''round(avg(v) FILTER (band = '{b}'), 4) AS {b}''' for b in BANDS)} FROM {PIXELS} GROUP BY 1, 2")
def a17(spark, sf):
    px = pixels(spark, sf).withColumn("month", F.trunc("date", "month"))
    return px.groupBy("tile_id", "month").agg(*[R(F.avg(F.when(F.col("band") == b, F.col("v")))).alias(b) for b in BANDS])


@query("a18_stack_mean", f"SELECT tile_id, band, round(avg(CASE WHEN v >= 20000 THEN v END), 4) AS mean, round(avg((v < 20000)::INT), 6) AS masked FROM {PIXELS} GROUP BY 1, 2 HAVING avg((v < 20000)::INT) < 0.4")
def a18(spark, sf):
    g = pixels(spark, sf).groupBy("tile_id", "band").agg(F.avg(F.when(F.col("v") >= 20_000, F.col("v"))).alias("mean"), F.avg((F.col("v") < 20_000).cast("double")).alias("masked"))
    return g.where("masked < 0.4").select("tile_id", "band", R("mean").alias("mean"), R("masked", 6).alias("masked"))


@query("a19_correlation", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS qp, round(corr(l_quantity, l_discount), 6) AS qd, round(corr(l_extendedprice, l_tax), 6) AS pt FROM lineitem")
def a19(spark, sf):
    pairs = {"qp": ("l_quantity", "l_extendedprice"), "qd": ("l_quantity", "l_discount"), "pt": ("l_extendedprice", "l_tax")}
    return table(spark, sf, "lineitem").agg(*[R(F.corr(*p), 6).alias(k) for k, p in pairs.items()])


@query("a20_majority", "SELECT l_partkey, (avg((l_discount > 0.05)::INT) > 0.5)::INT AS vote, round(stddev_pop((l_discount > 0.05)::INT), 6) AS disagreement FROM lineitem GROUP BY 1")
def a20(spark, sf):
    votes = table(spark, sf, "lineitem").select("l_partkey", (F.col("l_discount") > 0.05).cast("int").alias("vote"))
    return S.majority(votes, ["l_partkey"]).withColumn("disagreement", R("disagreement", 6))


query("a21_patch_vote", "SELECT l_suppkey, avg(l_tax) > 0.02 AS vote FROM lineitem GROUP BY 1")(lambda s, d: table(s, d, "lineitem").groupBy("l_suppkey").agg((F.avg("l_tax") > 0.02).alias("vote")))
query("a22_modal_size", "SELECT p_brand, min(p_size) AS size FROM (SELECT p_brand, p_size, rank() OVER (PARTITION BY p_brand ORDER BY count(*) DESC) AS r FROM part GROUP BY 1, 2) WHERE r = 1 GROUP BY 1")(
    lambda s, d: table(s, d, "part").groupBy("p_brand").agg(F.mode("p_size", True).alias("size")))
query("a23_min_max", f"SELECT min(v) AS low, max(v) AS high FROM {PIXELS}")(lambda s, d: pixels(s, d).agg(F.min("v").alias("low"), F.max("v").alias("high")))
query("a24_tile_area", f"SELECT country, count(*) AS tiles, round(sum(area_km2), 4) AS km2, round(100.0 * count(*) / (SELECT count(*) FROM {SITES} WHERE area_km2 > 0), 4) AS pct FROM {SITES} WHERE area_km2 > 0 GROUP BY 1")(
    lambda s, d: (lambda t: t.groupBy("country").agg(F.count(F.lit(1)).alias("tiles"), R(F.sum("area_km2")).alias("km2")).withColumn("pct", R(100.0 * F.col("tiles") / F.lit(t.count()))))(sites(s, d).where("area_km2 > 0")))


@query("a25_ecdf", f"SELECT bin, n, round(sum(n) OVER (ORDER BY bin) / sum(n) OVER (), 6) AS cdf FROM (SELECT least(100, 1 + CAST(floor(v / 1100) AS INT)) AS bin, count(*) AS n FROM {PIXELS} GROUP BY 1)")
def a25(spark, sf):
    from pyspark.sql import Window as W

    # the window runs over at most 100 bins
    h = pixels(spark, sf).groupBy(F.least(F.lit(100), 1 + F.floor(F.col("v") / 1100).cast("int")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return h.select("bin", "n", R(F.sum("n").over(W.orderBy("bin")) / F.sum("n").over(W.partitionBy(F.lit(0))), 6).alias("cdf"))


query("a26_binned_median", f"SELECT CAST(floor(v / 5000) AS BIGINT) AS bin, round(median(v), 4) AS median FROM {PIXELS} GROUP BY 1")(lambda s, d: pixels(s, d).groupBy(F.floor(F.col("v") / 5000).alias("bin")).agg(R(F.median("v")).alias("median")))
query("a27_percentiles", f"SELECT band, round(quantile_cont(v, 0.02), 4) AS p2, round(quantile_cont(v, 0.98), 4) AS p98 FROM {PIXELS} GROUP BY 1")(
    lambda s, d: pixels(s, d).groupBy("band").agg(F.percentile("v", F.array(F.lit(0.02), F.lit(0.98))).alias("q")).select("band", R(F.get("q", 0)).alias("p2"), R(F.get("q", 1)).alias("p98")))


@query("a30_first_of_group", "SELECT c_nationkey, c_custkey, c_name FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer) WHERE r = 1")
def a30(spark, sf):
    # min_by keeps one row a group on the map side, where a ranking window would shuffle all rows
    c = table(spark, sf, "customer")
    return c.groupBy("c_nationkey").agg(F.min(F.struct("c_custkey", "c_name")).alias("m")).select("c_nationkey", "m.c_custkey", "m.c_name")


query("a31_class_weights", f"SELECT label, count(*) AS n, round((SELECT count(*) FROM {SCORED}) / (2.0 * count(*)), 6) AS weight FROM {SCORED} GROUP BY 1")(lambda s, d: S.class_weights(scored(s, d)).withColumn("weight", R("weight", 6)))


@query("a32_cost", f"SELECT count(DISTINCT tile_id) AS tiles, CAST(12 * (year(max(date)) - year(min(date))) + month(max(date)) - month(min(date)) + 3 AS BIGINT) AS steps, round(0.0007706 * count(DISTINCT tile_id) * (12 * (year(max(date)) - year(min(date))) + month(max(date)) - month(min(date)) + 3), 6) AS cost FROM {PIXELS}")
def a32(spark, sf):
    g = pixels(spark, sf).agg(F.count_distinct("tile_id").alias("tiles"), F.max("date").alias("b"), F.min("date").alias("a"))
    steps = (12 * (F.year("b") - F.year("a")) + F.month("b") - F.month("a") + 3).cast("long")
    return g.select("tiles", steps.alias("steps"), R(F.lit(0.0007706) * F.col("tiles") * steps, 6).alias("cost"))


query("a34_temporal_majority", f"SELECT tile_id, band, median((v > 30000)::INT::DOUBLE) AS share FROM {PIXELS} GROUP BY 1, 2")(lambda s, d: pixels(s, d).groupBy("tile_id", "band").agg(F.median((F.col("v") > 30_000).cast("double")).alias("share")))
query("a35_mean_sum", f"SELECT tile_id, round(avg(v), 4) AS mean, round(sum(v), 2) AS total FROM {PIXELS} GROUP BY 1")(lambda s, d: pixels(s, d).groupBy("tile_id").agg(R(F.avg("v")).alias("mean"), R(F.sum("v"), 2).alias("total")))
query("a36_median_spectrogram", f"SELECT month(date) AS month, {', '.join(f'''round(median(v) FILTER (band = '{b}'), 4) AS {b}''' for b in BANDS)} FROM {PIXELS} GROUP BY 1")(
    lambda s, d: pixels(s, d).groupBy(F.month("date").cast("long").alias("month")).agg(*[R(F.median(F.when(F.col("band") == b, F.col("v")))).alias(b) for b in BANDS]))
query("a37_offset_weights", f"SELECT label, round(1 - (count(*) + CASE label WHEN 1 THEN 20 ELSE -20 END) / (SELECT count(*) FROM {SCORED})::DOUBLE, 6) AS weight FROM {SCORED} GROUP BY 1")(
    lambda s, d: (lambda t: t.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select("label", R(1 - (F.col("n") + F.when(F.col("label") == 1, 20).otherwise(-20)) / F.lit(float(t.count())), 6).alias("weight")))(scored(s, d)))
query("a38_accuracy", f"SELECT round(avg(((p > 0.6) = (label = 1))::INT), 6) AS accuracy FROM {SCORED}")(lambda s, d: scored(s, d).agg(R(F.avg(((F.col("p") > 0.6) == (F.col("label") == 1)).cast("double")), 6).alias("accuracy")))

# --- pairs ---------------------------------------------------------------------------------------------------------------

COMP = f"(SELECT tile_id, band, window_start, min(CASE WHEN valid THEN v END) AS v FROM {SEEN} GROUP BY ALL)"


@query("j3_date_pairs", f"""
WITH c AS {COMP} SELECT tile_id, band, pair_start, pair_end, v0, v1 FROM (
  SELECT a.tile_id, a.band, a.window_start AS pair_start, b.window_start AS pair_end, a.v AS v0, b.v AS v1, row_number() OVER (PARTITION BY a.tile_id, a.band, a.window_start ORDER BY b.window_start) AS r
  FROM c a JOIN c b ON a.tile_id = b.tile_id AND a.band = b.band AND b.window_start >= CAST(a.window_start + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE)
    AND b.window_start < CAST(CAST(a.window_start + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)) WHERE r = 1""")
def j3(spark, sf):
    return C.date_pairs(C.composite(seen(spark, sf), KEYS, "min"), ["tile_id", "band"], 6, 3)


@query("j4_positional_pairs", f"""
WITH c AS {COMP} SELECT * FROM (SELECT tile_id, band, window_start AS pair_start, lead(window_start, 2) OVER w AS pair_end, v AS v0, lead(v, 2) OVER w AS v1 FROM c WINDOW w AS (PARTITION BY tile_id, band ORDER BY window_start)) WHERE pair_end IS NOT NULL""")
def j4(spark, sf):
    return C.positional_pairs(C.composite(seen(spark, sf), KEYS, "min"), ["tile_id", "band"], 2)


@query("slice1_site_ratio_stats", f"""
WITH c AS {COMP}, p AS (SELECT tile_id, window_start, max(v) FILTER (band = 'NO') / 3000 AS nir, max(v) FILTER (band = 'AF') / 3000 AS red FROM c GROUP BY ALL),
r AS (SELECT tile_id, coalesce(round((nir - red) / nullif(nir + red, 0), 4), 0) AS p FROM p WHERE nir IS NOT NULL AND red IS NOT NULL)
SELECT tile_id, {STATS.format(v='p')}, count(p) AS count FROM r GROUP BY tile_id""")
def slice1(spark, sf):
    """Mask, quarterly minimum composites, normalise, ratio, statistics a site."""
    return ratio_stats(C.composite(seen(spark, sf), KEYS, "min"))


def ratio_stats(c):
    """Normalise, ratio, statistics a site of composites."""
    band = lambda b: spectral.normalize(F.max(F.when(F.col("band") == b, F.col("v"))))
    p = c.groupBy("tile_id", "window_start").agg(band("NO").alias("nir"), band("AF").alias("red")).where("nir is not null and red is not null")
    ratio = p.withColumn("p", spectral.normalized_difference(F.col("nir"), F.col("red"), 0))
    return C.patch_stats(ratio, ["tile_id"]).withColumns({k: R(k, 8) for k in ("mean", "median", "min", "max", "std")})
