"""Masked temporal compositing: calendar windows, compositors, pairs of composites."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: name -> aggregate over the valid values of a group; new ones by register_compositor.
COMPOSITORS: dict[str, Callable[[Column], Column]] = {"min": F.min, "median": F.median, "mean": F.avg, "max": F.max}


def register_compositor(name: str, aggregate: Callable[[Column], Column]) -> None:
    COMPOSITORS[name] = aggregate


def mask(v: Column, *clouded: Column) -> Column:
    """The value where no flag is set, else NULL."""
    keep = F.lit(True)
    for c in clouded:
        keep = keep & ~F.coalesce(c, F.lit(False))
    return F.when(keep, v)


def windows(df: DataFrame, start: str, end: str, months: int, step: int | None = None, mode: str = "inclusive") -> DataFrame:
    """One row per (row, window that holds its date), with window_start. Windows begin every step months (default: months) from start.

    inclusive: both ends belong, so a boundary date lies in two windows, and windows go on until one ends at or after end + months. whole: both ends
    belong, only windows that end by end. until: both ends belong, and the last window is the first one that ends at or after end. half_open: [start, start + months).
    The rows are exploded to their own one or two windows: no range join."""
    step = step or months
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    limit = last if mode == "whole" else F.add_months(last, months)
    ordinal = F.floor(F.months_between(F.trunc("date", "month"), F.trunc(first, "month")) / step).cast("int")
    back = -(-months // step) + 1
    near = F.sequence(F.greatest(F.lit(0), ordinal - back), F.greatest(F.lit(0), ordinal + 1))
    out = df.withColumn("_k", F.explode(near)).withColumn("window_start", F.add_months(first, F.col("_k") * step)).withColumn("_e", F.add_months(first, F.col("_k") * step + months))
    inside = (F.col("date") >= F.col("window_start")) & ((F.col("date") < F.col("_e")) if mode == "half_open" else (F.col("date") <= F.col("_e")))
    if mode == "until":
        allowed = (F.col("_k") == 0) | (F.add_months(first, (F.col("_k") - 1) * step + months) < last)
    else:
        allowed = F.col("_e") <= limit
    return out.where(inside & allowed).drop("_k", "_e")


def starts(spark, start: str, end: str, months: int, length: int = 1) -> DataFrame:
    """window_start of every window whose length periods of that many months end by end (length 0: that begins by end)."""
    n = F.floor(F.months_between(F.to_date(F.lit(end)), F.to_date(F.lit(start))) / months).cast("int") - length
    days = F.transform(F.sequence(F.lit(0), n), lambda k: F.add_months(F.to_date(F.lit(start)), k * months))
    return spark.range(1).select(F.explode(F.when(n >= 0, days)).alias("window_start"))


def gram_months(period: int, interval: int, n: int) -> int:
    """Months that a spectrogram of n composites of period months, interval periods apart, spans."""
    return period * interval * (n - 1) + period


def composite(df: DataFrame, keys: Sequence[str], method: str = "min", value: str = "v") -> DataFrame:
    """Reduces each group's valid values; masked values are NULL and count nothing, a group without any gives NULL."""
    return df.groupBy(*keys).agg(COMPOSITORS[method](F.col(value)).alias(value))


def least_masked(df: DataFrame, group: Sequence[str], scene: str, order: Sequence[str], valid: str = "valid") -> DataFrame:
    """The rows of each group's scene with the fewest masked rows; ties go to the first by order."""
    counts = df.groupBy(*group, scene).agg(F.count_if(~F.col(valid)).alias("_masked"), *[F.min(c).alias(f"_o{i}") for i, c in enumerate(order)])
    w = W.partitionBy(*group).orderBy("_masked", *[f"_o{i}" for i in range(len(order))], scene)
    best = counts.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").select(*group, scene)
    return df.join(best, [*group, scene], "left_semi")


def argmax_composite(df: DataFrame, keys: Sequence[str], bands: Column, score: Column) -> DataFrame:
    """The whole band vector where the score is largest."""
    return df.groupBy(*keys).agg(F.max_by(bands, score).alias("bands"))


def date_pairs(df: DataFrame, keys: Sequence[str], months: int, period: int, value: str = "v") -> DataFrame:
    """A composite at t with the first one in [t + months - 1 day, t + months + period months - 2 days): by date, so a missing month never shifts pairs."""
    right = df.select(*keys, F.col("window_start").alias("_t1"), F.col(value).alias(f"{value}1"))
    low = F.date_sub(F.add_months("window_start", months), 1)
    high = F.date_sub(F.add_months(low, period), 1)
    both = df.withColumnRenamed(value, f"{value}0").join(right, list(keys)).where((F.col("_t1") >= low) & (F.col("_t1") < high))
    first = W.partitionBy(*keys, "window_start").orderBy("_t1")
    return both.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(*keys, F.col("window_start").alias("pair_start"), F.col("_t1").alias("pair_end"), f"{value}0", f"{value}1")


def positional_pairs(df: DataFrame, keys: Sequence[str], interval: int, value: str = "v") -> DataFrame:
    """The i-th composite that exists with the one interval places later."""
    w = W.partitionBy(*keys).orderBy("window_start")
    out = df.withColumn("pair_end", F.lead("window_start", interval).over(w)).withColumn(f"{value}1", F.lead(value, interval).over(w))
    return out.where(F.col("pair_end").isNotNull()).select(*keys, F.col("window_start").alias("pair_start"), "pair_end", F.col(value).alias(f"{value}0"), f"{value}1")


def complete_starts(df: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every expected window of every key; those without data have NULL values. expected holds a window a row, so it is small: each key gets the starts as an array."""
    starts = [r["window_start"] for r in expected.select("window_start").distinct().orderBy("window_start").collect()]  # one a window
    every = df.select(*keys).distinct().select("*", F.explode(F.array(*map(F.lit, starts)).cast(f"array<{expected.schema['window_start'].dataType.simpleString()}>")).alias("window_start"))
    return every.join(df, [*keys, "window_start"], "left")


def patch_stats(df: DataFrame, keys: Sequence[str], value: str = "p", places: int = 4, variance: bool = False) -> DataFrame:
    """mean, median, min, max, std (population), count of the values rounded to places; a group without any value gives -1 in all but count."""
    v = F.round(F.col(value), places)
    aggs = {"mean": F.avg(v), "median": F.median(v), "min": F.min(v), "max": F.max(v), "std": F.stddev_pop(v)} | ({"var": F.var_pop(v)} if variance else {})
    out = df.groupBy(*keys).agg(*[a.alias(k) for k, a in aggs.items()], F.count(v).alias("count"))
    return out.select(*keys, *[F.coalesce(k, F.lit(-1.0)).alias(k) for k in aggs], "count")


def trailing_mask(df: DataFrame, keys: Sequence[str], order: str, value: str = "v", window: int = 6, threshold: float = 0.1) -> DataFrame:
    """Multiplies each value by its mask: the median of the window frames that end with it, 0 below the threshold, 1 above, left alone at it. The
    first frames see window - 1 copies of the mean of the first window - 1 frames before them; short series shrink the window (2 at least)."""
    every, w = W.partitionBy(*keys), W.partitionBy(*keys).orderBy(order)
    numbered = df.withColumn("_i", F.row_number().over(w)).withColumn("_w", F.greatest(F.lit(2), F.least(F.lit(window), F.count(F.lit(1)).over(every).cast("int"))))
    pad = F.avg(F.when(F.col("_i") <= F.col("_w") - 1, F.col(value))).over(every)
    seen = numbered.withColumn("_pad", pad).withColumn("_l", F.collect_list(F.coalesce(value, F.lit(float("nan")))).over(w.rowsBetween(-(window - 1), 0)))
    own = F.filter(F.slice("_l", F.greatest(F.lit(1), F.size("_l") - F.col("_w") + 1), F.col("_w")), lambda x: ~F.isnan(x))
    full = F.sort_array(F.concat(own, F.array_repeat("_pad", F.greatest(F.lit(0), F.col("_w") - F.col("_i")).cast("int"))))
    n = F.size(full)
    median = F.when(n > 0, (F.get(full, F.floor((n - 1) / 2).cast("int")) + F.get(full, F.floor(n / 2).cast("int"))) / 2)
    factor = F.when(median < threshold, 0.0).when(median > threshold, 1.0).otherwise(median)
    return seen.withColumn("masked", F.col(value) * factor).drop("_i", "_w", "_pad", "_l")
