"""The driver's tables in the roles of this library's inputs: each role as a DataFrame and as SQL.

pixels: lineitem as masked scenes (tile: supplier, band: return flag and line status); rasters: embeddings as 8 x 8 images; points: the
first two components of embeddings; sites: customers with nation as country.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tile_id, scene, date, band, v, valid."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").alias("tile_id"), F.col("l_orderkey").alias("scene"), F.to_date("l_shipdate").alias("date"), F.concat("l_returnflag", "l_linestatus").alias("band"), F.col("l_extendedprice").alias("v"), (F.col("l_discount") <= 0.05).alias("valid"))


PIXELS = "(SELECT l_suppkey AS tile_id, l_orderkey AS scene, CAST(l_shipdate AS DATE) AS date, l_returnflag || l_linestatus AS band, l_extendedprice AS v, l_discount <= 0.05 AS valid FROM lineitem)"


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, row, col, v: 8 x 8."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.posexplode("embedding").alias("i", "v")).select("id", F.floor(F.col("i") / 8).cast("int").alias("row"), (F.col("i") % 8).cast("int").alias("col"), F.col("v").cast("double").alias("v"))


RASTERS = "(SELECT id, CAST(i // 8 AS INT) AS row, CAST(i % 8 AS INT) AS col, CAST(e[i + 1] AS DOUBLE) AS v FROM (SELECT vec_id AS id, embedding AS e, unnest(generate_series(0, 63)) AS i FROM embeddings))"


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, label, bands: the first twelve components, as reflectances of 1000 to 3000 or so."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), "label", F.transform(F.slice("embedding", 1, 12), lambda x: 2000 + 4000 * x.cast("double")).alias("bands"))


VECTORS = "(SELECT vec_id AS id, label, list_transform(embedding[1:12], lambda x: 2000 + 4000 * CAST(x AS DOUBLE)) AS bands FROM embeddings)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, lon, lat."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.element_at("embedding", 1).cast("double").alias("lon"), F.element_at("embedding", 2).cast("double").alias("lat"))


POINTS = "(SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS lon, CAST(embedding[2] AS DOUBLE) AS lat FROM embeddings)"


def other_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second slice of the embeddings as points."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.element_at("embedding", 3).cast("double").alias("lon"), F.element_at("embedding", 4).cast("double").alias("lat"))


OTHER_POINTS = "(SELECT vec_id AS id, CAST(embedding[3] AS DOUBLE) AS lon, CAST(embedding[4] AS DOUBLE) AS lat FROM embeddings)"


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, country, area_km2 (-1 unknown), dist_water_m (-1 unknown), pop, clay."""
    c = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # nation has 25 rows
    return c.select(F.col("c_custkey").alias("id"), F.col("n_name").alias("country"), F.when(F.col("c_custkey") % 11 == 0, -1.0).otherwise(F.abs("c_acctbal") / 200_000).alias("area_km2"), F.when(F.col("c_custkey") % 7 == 0, -1.0).otherwise(F.abs("c_acctbal") / 2).alias("dist_water_m"), (F.abs("c_acctbal") * 3).alias("pop"), (F.col("c_custkey") % 100 / 100).alias("clay"))


SITES = """(SELECT c_custkey AS id, n_name AS country, CASE WHEN c_custkey % 11 = 0 THEN -1.0::DOUBLE ELSE abs(c_acctbal) / 200000 END AS area_km2,
  CASE WHEN c_custkey % 7 = 0 THEN -1.0::DOUBLE ELSE abs(c_acctbal) / 2 END AS dist_water_m, abs(c_acctbal) * 3 AS pop, (c_custkey % 100) / 100::DOUBLE AS clay FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, label, p: truth and a prediction between 0 and 1."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"), ((F.col("doc_id") * 37 % 100 + 40 * F.col("quality")) / 140).alias("p"))


SCORED = "(SELECT doc_id AS id, quality AS label, (doc_id * 37 % 100 + 40 * quality) / 140::DOUBLE AS p FROM labels)"
