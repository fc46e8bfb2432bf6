"""Column functions on values: sentinels, coercion, dictionaries, risk."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Landform classes and drainage directions by code, and the frozen statistics of the risk score (mean, standard deviation).
LANDFORMS = {
    11: "Peak/ridge (warm)", 12: "Peak/ridge", 13: "Peak/ridge (cool)", 14: "Mountain/divide", 15: "Cliff", 21: "Upper slope (warm)", 22: "Upper slope", 23: "Upper slope (cool)",
    24: "Upper slope (flat)", 31: "Lower slope (warm)", 32: "Lower slope", 33: "Lower slope (cool)", 34: "Lower slope (flat)", 41: "Valley", 42: "Valley (narrow)",
}
DIRECTIONS = {1: "east", 2: "southeast", 4: "south", 8: "southwest", 16: "west", 32: "northwest", 64: "north", 128: "northeast", 0: "river mouth", -1: "inland depression"}
RISK = {"population": (7.417273534217326, 1.7791091219232005), "clay": (-0.885915538147242, 0.15838979230699146), "water": (6.390775048206517, 1.179343111730756), "area": (7.154989549277127, 1.9026796861924273)}


def nullify(x: Column, sentinel=-1) -> Column:
    """A sentinel to NULL."""
    return F.when(x != F.lit(sentinel), x)


def sentinel(x: Column, value=-1) -> Column:
    """NULL to a sentinel, at the output boundary only."""
    return F.coalesce(x, F.lit(value))


def decode(code: Column, names: Mapping, default: str | None = None) -> Column:
    """Dictionary lookup with literals."""
    found = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(found, code), F.lit(default))


def coerce_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Casts each of the columns to double if all of its values parse, and leaves it alone if one does not. One pass over the table."""
    bad = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in columns]).first()
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns if not bad[c]})


def numeric(x: Column) -> Column:
    """The number that a text holds, else NULL."""
    return x.try_cast("double")


def water_type(tags: Column) -> Column:
    """Precedence of the tags that name a water body."""
    return F.coalesce(*[F.try_element_at(tags, F.lit(k)) for k in ("waterway", "water", "natural", "landuse")], F.to_json(tags))


def z_score(x: Column, stats: tuple[float, float]) -> Column:
    return (x - F.lit(stats[0])) / F.lit(stats[1])


def risk(area: Column, population: Column, water: Column, clay: Column) -> Column:
    """Weighted z-scores of log area (m2), log population, log distance to water (m) and clay fraction; NULL where the area is 0 or the distance unknown (-1).
    Not yet scaled: put min_max over it."""
    score = (61 * z_score(F.ln(area + 0.1), RISK["area"]) + 21 * z_score(F.ln(population + 10), RISK["population"]) - 69 * z_score(F.ln(water + 0.01), RISK["water"]) - 41 * z_score(clay, RISK["clay"])) / 192
    return F.when((area != 0) & (water != -1), score)


def sem_outlier(x: Column, *partition: str, limit: float = 18.0) -> Column:
    """abs(x - mean) above limit standard errors of the partition's mean; partitions of one row have none."""
    w = W.partitionBy(*partition)
    n = F.count(x).over(w)
    z = F.try_divide(F.abs(x - F.avg(x).over(w)), F.stddev_pop(x).over(w) / F.sqrt(n))
    return F.coalesce((z > limit) & (n > 1), F.lit(False))


def portable_hash(*cols: Column | str) -> Column:
    """A number of 32 bits by the MD5 of the values' text joined by colons: the same in every engine that has MD5. A null counts as nothing."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])), 1, 8), 16, 10).cast("long")
