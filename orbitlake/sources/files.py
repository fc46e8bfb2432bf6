"""Readers and writers: GeoJSON, CSV with embedded lists, tile key lists, JSON records, binary arrays, nested documents.

All readers go through Spark's own, so that any store it reaches works.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tiff import Layout

POINT = "array<double>"
POLYGON = "array<array<array<double>>>"
MULTIPOLYGON = "array<array<array<array<double>>>>"


def read_geojson(spark: SparkSession, path: str, properties: str, coordinates: str = POINT) -> DataFrame:
    """One row a feature: kind, coordinates, and the properties of that DDL schema; a missing property or geometry is NULL. The file may hold features or bare
    geometries. The text is parsed with a declared schema, one pass; a property whose type drifts between files is best declared a string."""
    feature = f"struct<id: string, geometry: struct<type: string, coordinates: {coordinates}>, properties: struct<{properties}>>"
    doc = f"features array<{feature}>, geometries array<struct<type: string, coordinates: {coordinates}>>"
    raw = spark.read.schema(doc).json(path, multiLine=True)
    bare = F.transform("geometries", lambda g: F.struct(F.lit(None).cast("string").alias("id"), g.alias("geometry"), F.lit(None).cast(f"struct<{properties}>").alias("properties")))
    out = raw.select(F.explode(F.coalesce("features", bare)).alias("f"))
    return out.select(F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"), "f.properties.*")


def write_geojson(df: DataFrame, path: str, lon: str = "lon", lat: str = "lat") -> None:
    """One feature a line, in as many files as there are tasks; all other columns become properties."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (lon, lat)]
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), F.struct(*rest).alias("properties"))
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def feature_collection(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The whole table as one FeatureCollection document: for small exports alone, its row holds all features."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (lon, lat)]
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), F.struct(*rest).alias("properties"))
    return df.agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("value"))


def write_polygons(df: DataFrame, path: str, rings: str = "rings") -> None:
    """One Polygon feature a line; rings: array of rings (arrays of struct x, y), the outer one first, closed here; all other columns become properties."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != rings]
    closed = F.transform(rings, lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), lambda p: F.array(p["x"], p["y"])))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Polygon").alias("type"), closed.alias("coordinates")).alias("geometry"), F.struct(*rest).alias("properties"))
    df.select(F.to_json(feature).alias("value")).write.mode("overwrite").text(path)


def polygon_rings(geometry: str) -> Column:
    """The rings of a text column that holds a Polygon geometry as JSON (a .geo column, say), as write_polygons takes them: closing points left out. Other geometries give NULL."""
    g = F.from_json(geometry, f"type string, coordinates {POLYGON}")
    rings = F.transform(g["coordinates"], lambda r: F.transform(F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))), lambda p: F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))))
    return F.when(g["type"] == "Polygon", rings)


def read_csv(spark: SparkSession, path: str, schema: str, lists: dict[str, str] | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """CSV with a header. lists: text columns that hold JSON lists, with their element types. drop: columns to leave out (an unnamed index column, say)."""
    df = spark.read.schema(schema).csv(path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=True).drop(*drop)
    return df.withColumns({c: F.from_json(c, f"array<{t}>") for c, t in (lists or {}).items()})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """One tile key a line, white space at its end removed, empty lines left out."""
    return spark.read.text(path).select(F.rtrim("value").alias("key")).where("key <> ''")


def write_keys(df: DataFrame, path: str, key: str = "key") -> None:
    df.select(key).write.mode("overwrite").text(path)


def read_folder(spark: SparkSession, path: str, schema: str, glob: str = "*.parquet", contains: str | None = None) -> DataFrame:
    """All files of a folder and those below it whose name matches; hidden ones are left out. Adds file."""
    df = spark.read.schema(schema).parquet(path, pathGlobFilter=glob, recursiveFileLookup=True).withColumn("file", F.col("_metadata.file_name"))
    return df.where(F.contains("file", F.lit(contains))) if contains else df


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array of records."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_labelled(spark: SparkSession, data: str, labels: str, data_schema: str) -> DataFrame:
    """Parallel data and label files as one table: joined on (source, ordinal), which both hold."""
    return spark.read.schema(data_schema).parquet(data).join(spark.read.schema("source string, ordinal long, label int").parquet(labels), ["source", "ordinal"])


def read_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Binary .npy files as file, ordinal, vector (float64, the array's later axes flattened)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                a = np.load(io.BytesIO(content), allow_pickle=False)
                a = a.reshape(len(a), -1).astype(float)
                yield pd.DataFrame({"file": name.rsplit("/", 1)[-1], "ordinal": np.arange(len(a)), "vector": list(a)})

    return spark.read.format("binaryFile").load(path, pathGlobFilter="*.npy").select("path", "content").mapInPandas(run, "file string, ordinal long, vector array<double>")


def read_raster_window(rasters: DataFrame, window: int) -> DataFrame:
    """Pixel tables by blocks of window pixels a side: adds block_row, block_col."""
    return rasters.withColumn("block_row", F.floor(F.col("row") / window).cast("int")).withColumn("block_col", F.floor(F.col("col") / window).cast("int"))


def tiff_blocks(content: bytes, band: int = 0) -> Iterator[tuple[int, int, np.ndarray]]:
    """Row and column of the first pixel, and values (float64, no data as NaN), of each strip or tile of a band of the file's first image."""
    read = lambda at, size: content[at : at + size]
    layout = Layout(read)
    for k in range(layout.blocks(band)):
        yield layout.block(read, k, band)


def read_geotiff(spark: SparkSession, path: str, band: int = 0, glob: str = "*.tif") -> DataFrame:
    """Pixels of a band of all TIFF files: file, row, col, v (NULL for no data). A file is one row of a scan (2 GB at most) and is decoded strip by strip or tile by tile."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                for row, col, block in tiff_blocks(content, band):
                    r, c = np.indices(block.shape)
                    v = pd.Series(block.ravel()).astype(object).where(~np.isnan(block.ravel()), None) if np.isnan(block).any() else block.ravel()
                    yield pd.DataFrame({"file": name.rsplit("/", 1)[-1], "row": r.ravel() + row, "col": c.ravel() + col, "v": v})

    return spark.read.format("binaryFile").load(path, pathGlobFilter=glob).select("path", "content").mapInPandas(run, "file string, row int, col int, v double")


def read_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The Parquet table at path if it was written whole, else that of compute, which is written there first."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_bands(df: DataFrame, path: str, nodata: float = -1.0, value: str = "v") -> None:
    """A multi-band raster as Parquet by tile and band; NULL becomes nodata at this boundary."""
    df.withColumn(value, F.coalesce(value, F.lit(nodata))).write.mode("overwrite").partitionBy("tile_id", "band").parquet(path)


def append_features(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def reset(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Empties a product and leaves its schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_document(df: DataFrame, path: str, key: str, fields: list[str]) -> None:
    """One nested JSON object, key to struct of fields: for roll-ups of a few hundred keys."""
    doc = df.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.struct(*fields))))).alias("value"))
    doc.write.mode("overwrite").text(path)


def missing_keys(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Keys that were asked for and are not among the outputs, whose names have _ for : in them."""
    return wanted.join(done.select(F.replace("key", F.lit("_"), F.lit(":")).alias("key")), "key", "left_anti")


def write_labelled(df: DataFrame, path: str, label: int, mode: str = "append") -> None:
    """Arrays with one label for all rows, as Parquet."""
    df.withColumn("label", F.lit(label)).write.mode(mode).parquet(path)


def create_or_get(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The product at path; an empty one of that schema is created where there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        reset(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


#: Columns of a report's lines.
METRICS = ("precision", "recall", "f1", "support")


def write_report(report: DataFrame, path: str, config: dict[str, object]) -> None:
    """A model's settings, `name: value` a line, then its report: class and METRICS, a line a class. Reports have a few rows."""
    lines = [f"{k}: {v}" for k, v in config.items()] + ["", "class " + " ".join(METRICS)]
    head = report.sparkSession.createDataFrame([(i, v) for i, v in enumerate(lines)], "_n int, value string")
    shown = F.concat_ws(" ", F.regexp_replace(F.col("class").cast("string"), r"\s+", "_"), *[F.format_string("%.4f", F.col(m).cast("double")) for m in METRICS[:3]], F.col("support").cast("long").cast("string"))
    body = report.select((F.row_number().over(W.orderBy("class")) + len(lines)).alias("_n"), shown.alias("value"))
    head.unionByName(body).coalesce(1).sortWithinPartitions("_n").select("value").write.mode("overwrite").text(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """The report lines of all text files at path: file, class, and METRICS as numbers. Lines of another form are left out; names of several words keep their blanks."""
    number = r"(\d+(?:\.\d+)?)"
    pattern = rf"^\s*(\S.*?)\s+{number}\s+{number}\s+{number}\s+(\d+)\s*$"
    part = lambda i: F.regexp_extract("value", pattern, i)
    lines = spark.read.text(path).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), "value").where(F.col("value").rlike(pattern))
    return lines.select("file", part(1).alias("class"), *[part(i + 2).cast("double").alias(m) for i, m in enumerate(METRICS[:3])], part(5).cast("long").alias("support"))
