"""Composites, pairs and windows over the table's whole range of dates: the queries of q_aggregates and q_windows that stop in 1997, without that end (name_all)."""

from pyspark.sql import functions as F

from ..operators import composite as C
from .analogues import PIXELS, pixels
from .q_aggregates import KEYS, STATS, composite_sql, ratio_stats
from .registry import query

R = lambda c, n=4: F.round(c, n)


def span(px, after: int = 0):
    """First of the month of the least date, and the greatest date, so many months later."""
    b = px.agg(F.trunc(F.min("date"), "month").cast("string").alias("first"), F.add_months(F.max("date"), after).cast("string").alias("last")).first()
    return b["first"], b["last"]


def history(px, months: int = 3, step: int | None = None, mode: str = "inclusive"):
    """Pixels in all windows that hold their date, from the month of the least date on; the greatest date is the end. Whole batches are asked for up to the end of the one that begins last, so each date lies in one."""
    first, last = span(px, months if mode == "whole" else 0)
    return C.windows(px, first, last, months, step, mode)


def all_windows(months: int, step: int, low: str = "<=", limit: str = "true") -> str:
    """Pixels with window_start, for every window from the least date's month to the greatest date that the limit allows (k: number of the window, e: its end, before: that of the one before, last: greatest date)."""
    return f"""(WITH b AS (SELECT date_trunc('month', min(date))::DATE AS first, max(date) AS last FROM {PIXELS}),
    k AS (SELECT first, unnest(range(0, datediff('month', first, last) // {step} + 1)) AS k FROM b),
    w AS (SELECT k, last, CAST(first + to_months(CAST({step} * k AS INT)) AS DATE) AS window_start, CAST(first + to_months(CAST({step} * k + {months} AS INT)) AS DATE) AS e,
      CAST(first + to_months(CAST({step} * (k - 1) + {months} AS INT)) AS DATE) AS before FROM (SELECT *, (SELECT last FROM b) AS last FROM k))
    SELECT p.*, w.window_start FROM {PIXELS} p JOIN w ON p.date >= w.window_start AND p.date {low} w.e AND {limit})"""


SEEN = all_windows(3, 3)
COMP = f"(SELECT tile_id, band, window_start, min(CASE WHEN valid THEN v END) AS v FROM {SEEN} GROUP BY ALL)"


def seen(spark, sf):
    px = pixels(spark, sf).withColumn("v", C.mask(F.col("v"), ~F.col("valid")))
    return history(px)


def minima(spark, sf):
    return C.composite(seen(spark, sf), KEYS, "min")


for _name, _method, _sql in (("a1_median_composite_all", "median", "median"), ("a2_min_composite_all", "min", "min"), ("a5_mean_composite_all", "mean", "avg")):
    query(_name, composite_sql(_sql, SEEN))(lambda s, d, m=_method: C.composite(seen(s, d), KEYS, m).withColumn("v", R("v")))


@query("a3_least_masked_composite_all", f"""
WITH s AS {SEEN}, c AS (SELECT tile_id, window_start, scene, count(*) FILTER (NOT valid) AS n, min(date) AS d FROM s GROUP BY ALL),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile_id, window_start ORDER BY n, d, scene) AS r FROM c) WHERE r = 1)
SELECT s.tile_id, s.window_start, s.scene, s.date, s.band, s.v FROM s JOIN b USING (tile_id, window_start, scene)""")
def a3(spark, sf):
    px = history(pixels(spark, sf))
    return C.least_masked(px, ["tile_id", "window_start"], "scene", ["date"]).select("tile_id", "window_start", "scene", "date", "band", "v")


@query("j3_date_pairs_all", f"""
WITH c AS {COMP} SELECT tile_id, band, pair_start, pair_end, v0, v1 FROM (
  SELECT a.tile_id, a.band, a.window_start AS pair_start, b.window_start AS pair_end, a.v AS v0, b.v AS v1, row_number() OVER (PARTITION BY a.tile_id, a.band, a.window_start ORDER BY b.window_start) AS r
  FROM c a JOIN c b ON a.tile_id = b.tile_id AND a.band = b.band AND b.window_start >= CAST(a.window_start + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE)
    AND b.window_start < CAST(CAST(a.window_start + INTERVAL 6 MONTH - INTERVAL 1 DAY AS DATE) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)) WHERE r = 1""")
def j3(spark, sf):
    return C.date_pairs(minima(spark, sf), ["tile_id", "band"], 6, 3)


@query("j4_positional_pairs_all", f"""
WITH c AS {COMP} SELECT * FROM (SELECT tile_id, band, window_start AS pair_start, lead(window_start, 2) OVER w AS pair_end, v AS v0, lead(v, 2) OVER w AS v1 FROM c WINDOW w AS (PARTITION BY tile_id, band ORDER BY window_start)) WHERE pair_end IS NOT NULL""")
def j4(spark, sf):
    return C.positional_pairs(minima(spark, sf), ["tile_id", "band"], 2)


@query("slice1_site_ratio_stats_all", f"""
WITH c AS {COMP}, p AS (SELECT tile_id, window_start, max(v) FILTER (band = 'NO') / 3000 AS nir, max(v) FILTER (band = 'AF') / 3000 AS red FROM c GROUP BY ALL),
r AS (SELECT tile_id, coalesce(round((nir - red) / nullif(nir + red, 0), 4), 0) AS p FROM p WHERE nir IS NOT NULL AND red IS NOT NULL)
SELECT tile_id, {STATS.format(v='p')}, count(p) AS count FROM r GROUP BY tile_id""")
def slice1(spark, sf):
    return ratio_stats(minima(spark, sf))


def windowed(months: int, step: int, mode: str):
    return lambda s, d: history(pixels(s, d), months, step, mode).groupBy("tile_id", "window_start").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("v"))


def windowed_sql(months: int, step: int, low: str, limit: str = "true") -> str:
    return f"SELECT tile_id, window_start, count(*) AS n, min(v) AS v FROM {all_windows(months, step, low, limit)} GROUP BY 1, 2"


query("t1_tumbling_inclusive_all", windowed_sql(3, 3, "<="))(windowed(3, 3, "inclusive"))
query("t2_whole_batches_all", windowed_sql(6, 6, "<="))(windowed(6, 6, "whole"))
query("t4_sliding_all", windowed_sql(4, 2, "<=", "(k = 0 OR before < last)"))(windowed(4, 2, "until"))
query("t5_monthly_history_all", windowed_sql(1, 1, "<"))(windowed(1, 1, "half_open"))
