"""Scene and feature catalogues as tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def search_scenes(scenes: DataFrame, products: Sequence[str], start: str, end: str, max_cloud: float = 0.3, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """scenes: product, acquired, cloud_fraction, rect. All bounds belong; all predicates but the rectangle's reach the scan."""
    out = scenes.where(F.col("product").isin(*products) & F.col("acquired").between(F.lit(start).cast("date"), F.lit(end).cast("date")) & (F.col("cloud_fraction") <= max_cloud))
    if bbox:
        x0, y0, x1, y1 = bbox
        out = out.where((F.col("rect.minx") <= x1) & (F.col("rect.maxx") >= x0) & (F.col("rect.miny") <= y1) & (F.col("rect.maxy") >= y0))
    return out


def first_containing(catalog: DataFrame, part: str, column: str = "id") -> DataFrame:
    """The first id, in order, that contains the text."""
    return catalog.where(F.contains(F.col(column), F.lit(part))).orderBy(column).limit(1)


def sample_raster(points: DataFrame, raster: DataFrame, keys: Sequence[str] = ("id", "row", "col")) -> DataFrame:
    """Values at points that know their pixel; NULL where there is none."""
    return points.join(raster, list(keys), "left")


def cached_lookup(df: DataFrame, keys: Sequence[str], lookup: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Looks each distinct key up once and joins the answers back."""
    return df.join(lookup(df.select(*keys).distinct()), list(keys))


def kept_lookup(df: DataFrame, keys: Sequence[str], lookup: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """As cached_lookup, with answers kept as Parquet at path from one run to the next: only keys without an answer there are looked up. lookup gives one row for each key that it knows; one
    that it does not know is asked for again. One run at a time may write."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    wanted = df.select(*keys).distinct()
    if there:
        wanted = wanted.join(spark.read.parquet(path).select(*keys), list(keys), "left_anti")
    lookup(wanted).write.mode("append").parquet(path)
    return df.join(spark.read.parquet(path), list(keys))


def create_missing(existing: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Catalogue entries to add: those wanted whose key is not there, numbered on from the largest index."""
    from pyspark.sql import Window as W

    last = existing.agg(F.coalesce(F.max("index"), F.lit(-1))).first()[0]  # one row
    new = wanted.join(existing.select(key), key, "left_anti").dropDuplicates([key])
    return new.withColumn("index", F.lit(last) + F.row_number().over(W.orderBy(key)))
