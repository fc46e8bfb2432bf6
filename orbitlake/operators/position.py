"""Rows by position: ordinals over a whole table, and tables zipped by them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .merge import shared

_SHIFT = 33  # monotonically_increasing_id: the partition above this bit, the row within it below


def numbered(df: DataFrame, order: Sequence, name: str = "position") -> DataFrame:
    """df with its rows' ordinals from 0 in that order. Sorted by ranges and numbered within each partition; the partitions' counts, one row each, give where each begins: no
    task sees the whole table. Rows that tie may come either way."""
    at = F.monotonically_increasing_id()
    rows = shared(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", at))
    rows = rows.withColumn("_part", F.shiftright("_m", _SHIFT))
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).alias("_before"))
    out = rows.join(F.broadcast(before), "_part")  # a row a partition
    return out.withColumn(name, F.col("_before") + F.col("_m").bitwiseAND((1 << _SHIFT) - 1)).drop("_m", "_part", "_before")


def zipped(left: DataFrame, right: DataFrame, left_order: Sequence, right_order: Sequence, how: str = "inner", name: str = "position") -> DataFrame:
    """Rows of two tables that have the same ordinal. how: inner stops with the shorter table, full goes on with NULLs. Column names of both sides differ."""
    return numbered(left, left_order, name).join(numbered(right, right_order, name), name, how)
