"""End-to-end flows: scenes to predictions, predictions to candidate sites, site images to footprints. Each is a chain of this library's operators on tables; nothing runs until a sink reads it, but for
the tables that the iterative steps write."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.h3 import h3_cell
from . import borders, composite, merge, polygons, raster, scoring, spatial

PIXEL = ("tile_id", "row", "col")


def predict_region(
    pixels: DataFrame, start: str, end: str, scorer: str | Callable[[np.ndarray], np.ndarray], months: int = 3, apart: int = 6, method: str = "min", scale: float = 3000.0
) -> DataFrame:
    """pixels: tile_id, row, col, date, bands (array), valid. Predictions: tile_id, row, col, band, p. band is the first date of each pair of composites, every start between start and end (p is NULL where a
    composite is missing), and `median`, over the dates that a pixel has.

    Composites of valid pixels by windows of months; a composite meets the first one `apart` months later or a little after; the scorer gets both composites' bands, divided by scale."""
    bands = pixels.select(*PIXEL, "date", "valid", F.posexplode("bands").alias("_b", "v")).withColumn("v", composite.mask(F.col("v"), ~F.col("valid")))
    seen = composite.windows(bands, start, end, months)
    reduced = composite.composite(seen, [*PIXEL, "window_start", "_b"], method)
    # as many elements a pixel as the image has bands
    stacked = reduced.groupBy(*PIXEL, "window_start").agg(F.transform(F.sort_array(F.collect_list(F.struct("_b", "v"))), lambda x: x["v"] / scale).alias("v"))
    pairs = composite.date_pairs(stacked, PIXEL, apart, months)
    scored = scoring.score(pairs, F.concat("v0", "v1"), scorer).select(*PIXEL, F.col("pair_start").alias("window_start"), "p")
    scored = merge.shared(scored)
    span = max(1, -(-apart // months) + 1)
    dated = composite.complete_starts(scored, composite.starts(pixels.sparkSession, start, end, months, span), PIXEL)
    middle = scoring.ensemble(scored, PIXEL, "median")
    return dated.select(*PIXEL, F.col("window_start").cast("string").alias("band"), "p").unionByName(middle.select(*PIXEL, F.lit("median").alias("band"), "p"))


def find_candidates(
    predictions: DataFrame, grid: DataFrame, threshold: float = 0.75, min_sigma: float = 3.5, max_sigma: float = 100.0, area: float = 0.0025, radius: float = 0.01,
    patches: DataFrame | None = None, patch_mean: float = 0.3,
) -> DataFrame:
    """predictions: tile_id, row, col, v; grid: tile_id, lon, lat (the tile's upper left corner), step (degrees a pixel). Sites: id (H3), lon, lat, members (detections behind it).

    Blobs of each tile's values from threshold on, at their pixels' corner; detections within radius are merged. With patches (rect, mean), only sites in the rectangle of one above patch_mean stay. A tile without blobs gives nothing."""
    blobs = raster.detect_blobs(predictions, "tile_id", min_sigma, max_sigma, area, threshold)
    placed = blobs.join(grid, "tile_id").select((F.col("lon") + F.col("col") * F.col("step")).alias("lon"), (F.col("lat") - F.col("row") * F.col("step")).alias("lat"))
    sites = merge.merge_sites(placed, radius)
    if patches is not None:
        sites = spatial.points_in_rects(sites, patches.where(F.col("mean") > patch_mean).select("rect"), 0.05, "left_semi")
    return sites.select(h3_cell(F.col("lat"), F.col("lon")).alias("id"), "lon", "lat", "members")


def monitor_sites(
    images: DataFrame, sites: DataFrame, height: float = 0.02, threshold: float = 0.5, frames: int = 6, steady: float = 0.1, scale: int = 4, max_masked: float = 0.1, scattered: Sequence[float] = (0.003, 100.0),
) -> DataFrame:
    """images: name, date, row, col, v (a site's rectangle of that height, square on the ground; NULL: masked); sites: name, lon, lat. Footprints: name, date, polygons (multipolygon in degrees), area_km2 (EPSG:3395), lost (polygons that went to a nearer site).

    Values below threshold count 0; each pixel is then held against the frames before it; borders are followed on the upscaled, blurred image and put on the ground; broken polygons are repaired; where
    sites overlap, the nearer one keeps a polygon; of scattered contours (three polygons or more, on average below scattered[0] square kilometres) only polygons above scattered[1] square metres
    stay. A site and date without a border has no row."""
    strong = images.withColumn("v", F.when(F.col("v") < threshold, 0.0).otherwise(F.col("v")))
    held = composite.trailing_mask(strong, ["name", "row", "col"], "date", "v", frames, steady).select("name", "date", "row", "col", F.col("masked").alias("v"))
    rings = borders.traced(held, ["name", "date"], threshold, scale, max_masked).where(F.size("ring") >= 3)
    size = images.groupBy("name").agg((F.max("row") + 1).alias("_rows"), (F.max("col") + 1).alias("_cols"))
    box = sites.select("name", geo.rect_around(F.col("lon"), F.col("lat"), height).alias("_box"))
    around = rings.join(size, "name").join(box, "name")
    ring = F.transform("ring", lambda p: F.struct((F.col("_box.minx") + p["x"] / F.col("_cols") * (F.col("_box.maxx") - F.col("_box.minx"))).alias("x"), (F.col("_box.maxy") - p["y"] / F.col("_rows") * (F.col("_box.maxy") - F.col("_box.miny"))).alias("y")))
    # the rings of one image
    contours = around.select("name", "date", ring.alias("ring")).groupBy("name", "date").agg(F.collect_list("ring").alias("_r")).select("name", "date", polygons.repair(F.col("_r")).alias("polygons"))
    resolved = polygons.resolve_overlaps(merge.shared(contours), sites, height)
    ground = lambda p: F.transform(p, lambda r: geo.project_ring(r))
    metres = F.transform("polygons", lambda p: polygons.rings_area(ground(p)))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    sized = resolved.withColumn("_m", metres)
    few = (F.size("polygons") >= 3) & (total(F.col("_m")) / 1e6 / F.size("polygons") < scattered[0])
    kept = F.filter("polygons", lambda p: polygons.rings_area(F.transform(p, lambda r: geo.project_ring(r, False))) > scattered[1])
    out = sized.withColumn("polygons", F.when(few, kept).otherwise(F.col("polygons")))
    return out.withColumn("area_km2", total(metres) / 1e6).select("name", "date", "polygons", "area_km2", "lost")
