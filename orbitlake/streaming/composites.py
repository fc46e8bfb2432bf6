"""Structured Streaming twins of the compositors: monthly composites of late scenes, re-delivered scenes dropped within the watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.composite import COMPOSITORS


def monthly(stream: DataFrame, keys: Sequence[str], time: str = "ts", value: str = "v", method: str = "min", late: str = "10 days") -> DataFrame:
    """Composites a calendar month, one row a month and key. The month's first instant is the event time; as a month's scenes are up to 31 days younger
    than it, the watermark waits for that long beyond late."""
    months = stream.withColumn("month", F.date_trunc("month", time)).withWatermark("month", f"31 days {late}")
    return months.groupBy("month", *keys).agg(COMPOSITORS[method](F.col(value)).alias(value))


def deduplicated(stream: DataFrame, keys: Sequence[str], time: str = "ts", late: str = "10 days") -> DataFrame:
    """Scenes that are delivered again within the watermark count once."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))
