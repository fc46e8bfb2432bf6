"""Ordered sequences, calendar windows, dates."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import values
from ..operators import composite as C
from ..operators import merge, position
from . import q_history
from .analogues import PIXELS, VECTORS, pixels, table, vectors
from .registry import query

R = lambda c, n=4: F.round(c, n)


def series(s, d):
    """user, day, v: one frame a user and day, between 0 and 1."""
    e = table(s, d, "events").groupBy(F.col("user_id").alias("site"), F.to_date("ts").alias("day")).agg((F.count_if(F.col("event_type") == "click") / F.count(F.lit(1))).alias("v"))
    return e


SERIES = "(SELECT user_id AS site, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'click') / count(*) AS v FROM events GROUP BY ALL)"


@query("w1_rolling_median_mask", f"""
WITH s AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY day) AS i, greatest(2, least(6, count(*) OVER (PARTITION BY site))) AS w FROM {SERIES}),
p AS (SELECT site, max(w) AS w, avg(v) FILTER (i <= w - 1) AS pad FROM s GROUP BY 1),
f AS (SELECT site, CAST(k - 10 AS BIGINT) AS i, pad AS v FROM p, range(0, 11) r(k) WHERE k - 10 > -(w - 1) AND k - 10 <= 0 UNION ALL SELECT site, i, v FROM s),
m AS (SELECT a.site, a.i, median(b.v) AS med FROM s a JOIN f b ON a.site = b.site AND b.i > a.i - a.w AND b.i <= a.i GROUP BY 1, 2)
SELECT s.site, s.day, round(s.v * CASE WHEN med < 0.1 THEN 0 WHEN med > 0.1 THEN 1 ELSE med END, 6) AS masked FROM s JOIN m USING (site, i)""")
def w1(spark, sf):
    return C.trailing_mask(series(spark, sf), ["site"], "day").select("site", "day", R("masked", 6).alias("masked"))


query("w2_forward_median", f"SELECT site, day, round(median(v) OVER (PARTITION BY site ORDER BY day ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), 6) AS m FROM {SERIES} QUALIFY row_number() OVER (PARTITION BY site ORDER BY day DESC) > 3")(
    lambda s, d: series(s, d).withColumn("m", F.percentile("v", 0.5).over(W.partitionBy("site").orderBy("day").rowsBetween(0, 2))).withColumn("r", F.row_number().over(W.partitionBy("site").orderBy(F.desc("day")))).where("r > 3").select("site", "day", R("m", 6).alias("m")))
query("w4_nearest_per_group", "SELECT o_custkey, arg_min(o_orderkey, struct_pack(a := o_totalprice, b := o_orderkey)) AS k FROM orders GROUP BY 1")(lambda s, d: table(s, d, "orders").groupBy("o_custkey").agg(F.min(F.struct("o_totalprice", "o_orderkey"))["o_orderkey"].alias("k")))
query("w5_site_number", "SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS number FROM customer")(lambda s, d: table(s, d, "customer").select("c_custkey", F.row_number().over(W.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")).cast("long").alias("number")))


@query("w7_sem_outliers", """WITH s AS (SELECT l_suppkey AS site, l_orderkey, l_linenumber, l_extendedprice AS v, avg(l_extendedprice) OVER w AS m, stddev_pop(l_extendedprice) OVER w AS sd, count(*) OVER w AS n FROM lineitem WINDOW w AS (PARTITION BY l_suppkey))
SELECT site, count(*) AS n FROM s WHERE n > 1 AND abs(v - m) / nullif(sd / sqrt(n), 0) > 18 GROUP BY 1""")
def w7(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("site"), F.col("l_extendedprice").alias("v"))
    return rows.withColumn("out", values.sem_outlier(F.col("v"), "site", limit=18)).where("out").groupBy("site").agg(F.count(F.lit(1)).alias("n"))


@query("w7_sem_fixpoint")
def w7b(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("site"), F.col("l_extendedprice").alias("v"))
    return merge.drop_outliers(rows, "site", "v", 25.0).groupBy("site").agg(F.count(F.lit(1)).alias("n"))


@query("w8_gap_fill", f"""SELECT site, day, round(CASE WHEN v > 0 THEN v WHEN p IS NULL THEN n WHEN n IS NULL THEN p ELSE (p + n) / 2 END, 6) AS v FROM (SELECT *, lag(v) OVER w AS p, lead(v) OVER w AS n FROM {SERIES} WINDOW w AS (PARTITION BY site ORDER BY day))""")
def w8(spark, sf):
    w = W.partitionBy("site").orderBy("day")
    s = series(spark, sf).withColumn("p", F.lag("v").over(w)).withColumn("n", F.lead("v").over(w))
    filled = F.when(F.col("v") > 0, F.col("v")).when(F.col("p").isNull(), F.col("n")).when(F.col("n").isNull(), F.col("p")).otherwise((F.col("p") + F.col("n")) / 2)
    return s.select("site", "day", R(filled, 6).alias("v"))


query("w9_fill_with_mean", f"SELECT site, day, round(CASE WHEN v = 0 THEN avg(v) OVER (PARTITION BY site) ELSE v END, 6) AS v FROM {SERIES}")(lambda s, d: series(s, d).select("site", "day", R(F.when(F.col("v") == 0, F.avg("v").over(W.partitionBy("site"))).otherwise(F.col("v")), 6).alias("v")))


@query("w11_monthly_series", f"""WITH m AS (SELECT tile_id, date_trunc('month', date)::DATE AS month, avg(v) AS v FROM {PIXELS} WHERE band = 'NO' GROUP BY 1, 2), t AS (SELECT DISTINCT tile_id FROM m),
c AS (SELECT CAST(DATE '1995-01-01' + to_months(CAST(k AS INT)) AS DATE) AS month FROM range(0, 84) r(k)) SELECT tile_id, month, round(v, 4) AS v FROM t CROSS JOIN c LEFT JOIN m USING (tile_id, month)""")
def w11(spark, sf):
    m = pixels(spark, sf).where("band = 'NO'").groupBy("tile_id", F.trunc("date", "month").alias("month")).agg(F.avg("v").alias("v"))
    months = F.sequence(F.lit("1995-01-01").cast("date"), F.lit("2001-12-01").cast("date"), F.expr("interval 1 month"))
    every = m.select("tile_id").distinct().withColumn("month", F.explode(months))
    return every.join(m, ["tile_id", "month"], "left").withColumn("v", R("v"))


@query("w12_missing_starts", f"""WITH c AS (SELECT tile_id, band, window_start, min(CASE WHEN valid THEN v END) AS v FROM {q_history.SEEN} GROUP BY ALL), k AS (SELECT DISTINCT tile_id, band FROM c),
b AS (SELECT date_trunc('month', min(date))::DATE AS first, max(date) AS last FROM {PIXELS}),
s AS (SELECT CAST(first + to_months(CAST(3 * i AS INT)) AS DATE) AS window_start FROM (SELECT first, unnest(range(0, datediff('month', first, last) // 3 + 1)) AS i FROM b)) SELECT tile_id, band, window_start, v FROM k CROSS JOIN s LEFT JOIN c USING (tile_id, band, window_start)""")
def w12(spark, sf):
    """Every window from the least date's month to the greatest date."""
    first, last = q_history.span(pixels(spark, sf))
    return C.complete_starts(q_history.minima(spark, sf), C.starts(spark, first, last, 3, 0), ["tile_id", "band"])


def windowed(months: int, step: int, mode: str, start: str = "1995-01-01", end: str = "1997-01-01"):
    return lambda s, d: C.windows(pixels(s, d), start, end, months, step, mode).groupBy("tile_id", "window_start").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("v"))


def windowed_sql(months: int, step: int, low: str, limit: str) -> str:
    return f"""WITH w AS (SELECT CAST(DATE '1995-01-01' + to_months(CAST({step} * k AS INT)) AS DATE) AS window_start, CAST(DATE '1995-01-01' + to_months(CAST({step} * k + {months} AS INT)) AS DATE) AS e FROM range(0, 60) t(k))
    SELECT tile_id, window_start, count(*) AS n, min(v) AS v FROM {PIXELS} p JOIN w ON p.date >= w.window_start AND p.date {low} w.e AND w.e <= DATE '{limit}' GROUP BY 1, 2"""


query("t1_tumbling_inclusive", windowed_sql(3, 3, "<=", "1997-04-01"))(windowed(3, 3, "inclusive"))
query("t2_whole_batches", windowed_sql(6, 6, "<=", "1997-01-01"))(windowed(6, 6, "whole"))
query("t3_spectrogram_starts", "SELECT CAST(DATE '1995-01-01' + to_months(CAST(3 * k AS INT)) AS DATE) AS window_start FROM range(0, 5) t(k)")(lambda s, d: C.starts(s, "1995-01-01", "1997-01-01", 3, 4))
query("t4_sliding", windowed_sql(4, 2, "<=", "1997-01-01"))(windowed(4, 2, "whole"))
query("t5_monthly_history", windowed_sql(1, 1, "<", "1997-02-01"))(windowed(1, 1, "half_open"))
query("t6_gram_months", "SELECT 9 AS a, 14 AS b")(lambda s, d: s.range(1).select(F.lit(C.gram_months(3, 2, 2)).alias("a"), F.lit(C.gram_months(2, 3, 3)).alias("b")))
query("t7_month_difference", "SELECT o_orderkey, CAST(datediff('month', DATE '1992-01-01', date_trunc('month', o_orderdate)::DATE) + 3 AS BIGINT) AS months FROM orders")(
    lambda s, d: table(s, d, "orders").select("o_orderkey", (F.floor(F.months_between(F.trunc("o_orderdate", "month"), F.lit("1992-01-01").cast("date"))) + 3).alias("months")))
query("t8_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d10, strftime(o_orderdate, '%Y-%m') AS d7, CAST(strptime(strftime(o_orderdate, '%Y%m%dT%H%M%S'), '%Y%m%dT%H%M%S') AS DATE) AS parsed FROM orders")(
    lambda s, d: table(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d10"), F.substring(F.date_format("o_orderdate", "yyyy-MM-dd"), 1, 7).alias("d7"), F.to_date(F.to_timestamp(F.element_at(F.split(F.concat(F.lit("S2_"), F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss"), F.lit("_x")), "_"), -2), "yyyyMMdd'T'HHmmss")).alias("parsed")))
query("t9_epoch_shift", "SELECT event_id, CAST(ts + INTERVAL 1 DAY AS DATE) AS day FROM events")(lambda s, d: table(s, d, "events").select("event_id", F.to_date(F.timestamp_seconds(F.floor(F.unix_millis(F.col("ts").cast("timestamp")) / 1000) + 86_400)).alias("day")))
query("t10_holdout_months", f"SELECT tile_id, date, v FROM (SELECT *, dense_rank() OVER (PARTITION BY tile_id ORDER BY date_trunc('month', date) DESC) AS r FROM {PIXELS}) WHERE r <= 3")(
    lambda s, d: pixels(s, d).withColumn("r", F.dense_rank().over(W.partitionBy("tile_id").orderBy(F.desc(F.trunc("date", "month"))))).where("r <= 3").select("tile_id", "date", "v"))
query("t11_year_slices", f"SELECT tile_id, CAST(floor((datediff('month', DATE '1995-01-01', date_trunc('month', date)::DATE) - 4) / 12) AS BIGINT) AS slice, count(*) AS n FROM {PIXELS} WHERE datediff('month', DATE '1995-01-01', date_trunc('month', date)::DATE) >= 4 GROUP BY 1, 2")(
    lambda s, d: pixels(s, d).withColumn("m", F.floor(F.months_between(F.trunc("date", "month"), F.lit("1995-01-01").cast("date")))).where("m >= 4").groupBy("tile_id", F.floor((F.col("m") - 4) / 12).alias("slice")).agg(F.count(F.lit(1)).alias("n")))


@query("w10_brightness_order", f"SELECT id, row_number() OVER (ORDER BY norm DESC, id) - 1 AS position FROM (SELECT id, round(sqrt(list_sum(list_transform(bands, lambda x: x * x))), 3) AS norm FROM {VECTORS})")
def w10(spark, sf):
    """All vectors in order of brightness, numbered over the whole table without one task that sorts it."""
    norm = F.round(F.sqrt(F.aggregate("bands", F.lit(0.0), lambda s, x: s + x * x)), 3)
    return position.numbered(vectors(spark, sf).select("id", norm.alias("norm")), [F.desc("norm"), F.asc("id")]).select("id", "position")
