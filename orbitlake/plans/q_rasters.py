"""Raster neighbourhoods, image kernels, scorers."""

from pyspark.sql import functions as F

from ..functions import geo, spectral
from ..operators import borders, learning
from ..operators import raster as G
from ..operators import scoring as S
from ..operators import tolerant
from .analogues import RASTERS, VECTORS, rasters, table, vectors
from .registry import query

R = lambda c, n=6: F.round(c, n)
query("g1_pad", f"SELECT r.id, t.r AS row, t.c AS col, r.v FROM {RASTERS} r JOIN (SELECT a.i AS r, b.i AS c, CASE WHEN a.i < 8 THEN a.i ELSE 14 - a.i END AS sr, CASE WHEN b.i < 8 THEN b.i ELSE 14 - b.i END AS sc FROM range(0, 11) a(i), range(0, 11) b(i)) t ON r.row = t.sr AND r.col = t.sc")(lambda s, d: G.pad_or_crop(rasters(s, d), 11, 11))
query("g1_crop", f"SELECT id, CAST(row - 1 AS INT) AS row, CAST(col - 2 AS INT) AS col, v FROM {RASTERS} WHERE row BETWEEN 1 AND 5 AND col BETWEEN 2 AND 5")(lambda s, d: G.pad_or_crop(rasters(s, d), 5, 4))
query("g2_modal_size", "SELECT 8 AS height, 8 AS width")(lambda s, d: G.modal_size(rasters(s, d)))
query("g3_patches", f"SELECT id, CAST(a.i AS INT) AS wrow, CAST(b.i AS INT) AS wcol, count(*) AS n, round(avg(v), 6) AS mean FROM {RASTERS} r, range(0, 2) a(i), range(0, 2) b(i) WHERE row BETWEEN 3 * a.i AND 3 * a.i + 3 AND col BETWEEN 3 * b.i AND 3 * b.i + 3 GROUP BY 1, 2, 3")(
    lambda s, d: G.patches(rasters(s, d), 4, 3).groupBy("id", "wrow", "wcol").agg(F.count(F.lit(1)).alias("n"), R(F.avg("v")).alias("mean")))
_nb = lambda agg, k: f"SELECT a.id, a.row, a.col, {agg}(b.v) AS v FROM {RASTERS} a JOIN {RASTERS} b ON a.id = b.id AND abs(a.row - b.row) <= {k} AND abs(a.col - b.col) <= {k} GROUP BY ALL"
query("g6_dilate", _nb("max", 1))(lambda s, d: G.dilate(rasters(s, d)))
query("g6_erode", _nb("min", 1))(lambda s, d: G.erode(rasters(s, d)))


@query("g6_close_open", f"""WITH a AS ({_nb('max', 1)}), c AS (SELECT a.id, a.row, a.col, min(b.v) AS v FROM a JOIN a b ON a.id = b.id AND abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 GROUP BY ALL),
e AS (SELECT a.id, a.row, a.col, min(b.v) AS v FROM c a JOIN c b ON a.id = b.id AND b.row - a.row BETWEEN -1 AND 0 AND b.col - a.col BETWEEN -1 AND 0 GROUP BY ALL)
SELECT a.id, a.row, a.col, max(b.v) AS v FROM e a JOIN e b ON a.id = b.id AND b.row - a.row BETWEEN 0 AND 1 AND b.col - a.col BETWEEN 0 AND 1 GROUP BY ALL""")
def close_open(spark, sf):
    return G.close_open(rasters(spark, sf), close=1)


query("g7_shadows", f"SELECT DISTINCT b.id, b.row, b.col FROM {RASTERS} a JOIN {RASTERS} b ON a.id = b.id AND a.v > 0.2 AND b.v < 0 AND a.row = b.row AND a.col - b.col BETWEEN 1 AND 3")(
    lambda s, d: (lambda r: G.shadows(r.where("v > 0.2"), r.where("v < 0").select("id", "row", "col"), 90.0, 3))(rasters(s, d)))
query("g8_center_crop", f"SELECT id, row, col, v FROM {RASTERS} WHERE row BETWEEN 2 AND 5 AND col BETWEEN 2 AND 5")(lambda s, d: rasters(s, d).where("row between 2 and 5 and col between 2 and 5"))
query("g11_threshold_to_zero", f"SELECT id, row, col, CASE WHEN x > 127 THEN x ELSE 0 END AS v FROM (SELECT id, row, col, CAST(floor((v + 0.5) * 255) AS BIGINT) AS x FROM {RASTERS})")(lambda s, d: rasters(s, d).withColumn("x", F.floor((F.col("v") + 0.5) * 255)).select("id", "row", "col", G.threshold_to_zero(F.col("x"), 0.5).alias("v")))
query("k4_overview", f"SELECT id, l.level, CAST(row // (1 << l.level) AS INT) AS row, CAST(col // (1 << l.level) AS INT) AS col, round(avg(v), 6) AS v FROM {RASTERS}, (VALUES (1), (2), (3)) l(level) GROUP BY ALL")(lambda s, d: G.overview(rasters(s, d), (1, 2, 3)).withColumn("v", R("v")))
query("k13_merge_tiles", f"SELECT row, col, arg_min(v, id) AS v FROM {RASTERS} WHERE v > 0 GROUP BY 1, 2")(lambda s, d: G.merge_tiles(rasters(s, d).withColumn("v", F.when(F.col("v") > 0, F.col("v"))), "id"))
query("g16_scattered", f"""WITH p AS (SELECT id, row, col, abs(v) * 2000 AS m2 FROM {RASTERS} WHERE v > 0.1), s AS (SELECT id, count(*) AS n, sum(m2) / 1e6 AS km2 FROM p GROUP BY 1) SELECT id, row, col FROM p JOIN s USING (id) WHERE NOT (n >= 3 AND km2 / n < 0.003) OR m2 > 300""")(
    lambda s, d: G.filter_scattered(rasters(s, d).where("v > 0.1").withColumn("area_m2", F.abs("v") * 2000), ["id"], least_m2=300).select("id", "row", "col"))
query("g15_polygon_area", f"SELECT id, round(0.01 * (0.02 + v / 10), 8) AS area FROM {RASTERS} WHERE row = 0 AND col = 0")(
    lambda s, d: rasters(s, d).where("row = 0 and col = 0").select("id", R(geo.ring_area(geo.ring_of(geo.rect(F.lit(0.0), F.lit(0.0), F.lit(0.01), 0.02 + F.col("v") / 10))), 8).alias("area")))
query("g4_blobs")(lambda s, d: G.detect_blobs(rasters(s, d), min_sigma=1.0, max_sigma=3.0, threshold=1e-4, prediction=0.1))
query("g5_peaks", f"""SELECT a.id, a.row, a.col, a.v FROM {RASTERS} a JOIN {RASTERS} b ON a.id = b.id AND abs(a.row - b.row) <= 2 AND abs(a.col - b.col) <= 2
WHERE a.row BETWEEN 2 AND 5 AND a.col BETWEEN 2 AND 5 AND a.v > 0.2 GROUP BY ALL HAVING a.v >= max(b.v)""")(lambda s, d: G.detect_peaks(rasters(s, d), threshold=0.2, distance=2))
query("g12_contours")(lambda s, d: G.contours(rasters(s, d).withColumn("v", F.col("v") + 0.5), ["id"]))
query("g12_footprints")(lambda s, d: G.footprints(rasters(s, d).withColumn("v", F.col("v") + 0.5), ["id"]))
query("g17_regions", f"""WITH RECURSIVE m AS (SELECT id, row, col FROM {RASTERS} WHERE v > 0.1),
reach AS (SELECT id, row, col, 8 * row + col AS root FROM m UNION SELECT m.id, m.row, m.col, r.root FROM reach r JOIN m ON m.id = r.id AND abs(m.row - r.row) <= 1 AND abs(m.col - r.col) <= 1),
c AS (SELECT id, row, col, min(root) AS root FROM reach GROUP BY ALL)
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY root) AS INT) AS component, CAST(count(*) AS INT) AS pixels, min(row) AS min_row, min(col) AS min_col, max(row) AS max_row, max(col) AS max_col
FROM c GROUP BY id, root""")(lambda s, d: G.vectorize(rasters(s, d), "id", 0.1))

_W = (0.4, -0.3, 0.2, -0.1, 0.05, 0.1, -0.2, 0.3, 0.0, 0.1, -0.05, 0.15)
_zsum = " + ".join(f"(bands[{i + 1}] / 3000) * {w}::DOUBLE" for i, w in enumerate(_W))
query("l1_pixel_scorer", f"SELECT id, round(1 / (1 + exp(-({_zsum} - 0.5::DOUBLE))), 6) AS p FROM {VECTORS}")(lambda s, d: S.score(vectors(s, d), F.transform("bands", lambda x: x / 3000), S.logistic(_W, -0.5)).select("id", R("p").alias("p")))
query("l2_expression_scorer", f"SELECT id, round(1 / (1 + exp(-({_zsum} - 0.5::DOUBLE))), 6) AS p FROM {VECTORS}")(lambda s, d: vectors(s, d).select("id", R(S.score_logistic(F.transform("bands", lambda x: x / 3000), _W, -0.5)).alias("p")))


@query("l3_patch_scorer", f"SELECT id, round(1 / (1 + exp(-sum(v))), 6) AS p FROM {RASTERS} GROUP BY id")
def l3(spark, sf):
    """Pixels gathered in order to one vector a patch of fixed size, then scored in Arrow batches."""
    patches = rasters(spark, sf).groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("row", "col", "v"))), lambda x: x["v"]).alias("x"))
    return S.score(patches, F.col("x"), S.logistic([1.0] * 64)).select("id", R("p").alias("p"))


@query("l4_ensemble_scores", f"SELECT id, round(avg(p), 6) AS p FROM (SELECT id, 1 / (1 + exp(-({_zsum} + b))) AS p FROM {VECTORS}, (VALUES (-0.5::DOUBLE), (0.0::DOUBLE), (0.25::DOUBLE)) m(b)) GROUP BY id")
def l4(spark, sf):
    models = F.explode(F.array(F.lit(-0.5), F.lit(0.0), F.lit(0.25)))
    each = vectors(spark, sf).withColumn("bias", models).withColumn("p", S.score_logistic(F.array_append(F.transform("bands", lambda x: x / 3000), F.col("bias")), (*_W, 1.0)))
    return S.ensemble(each, ["id"], "mean").withColumn("p", R("p"))


query("l11_flips", f"SELECT id, row, CAST(7 - col AS INT) AS col, v FROM {RASTERS}")(lambda s, d: rasters(s, d).withColumn("col", 7 - F.col("col")))
query("l13_compare_models", f"SELECT m, count(*) FILTER (p > 0.5) AS n FROM (SELECT b AS m, 1 / (1 + exp(-({_zsum} + b))) AS p FROM {VECTORS}, (VALUES (-0.5::DOUBLE), (0.25::DOUBLE)) t(b)) GROUP BY m")(
    lambda s, d: vectors(s, d).withColumn("m", F.explode(F.array(F.lit(-0.5), F.lit(0.25)))).withColumn("p", S.score_logistic(F.array_append(F.transform("bands", lambda x: x / 3000), F.col("m")), (*_W, 1.0))).groupBy("m").agg(F.count_if(F.col("p") > 0.5).alias("n")))
query("l15_sliding_dot", f"SELECT id, round(bands[1] - 2 * bands[2] + bands[3], 4) AS d0, round(bands[10] - 2 * bands[11] + bands[12], 4) AS d9 FROM {VECTORS}")(
    lambda s, d: vectors(s, d).withColumn("k", spectral.sliding_dot(F.col("bands"), (1, -2, 1))).select("id", R(F.get("k", 0), 4).alias("d0"), R(F.get("k", 9), 4).alias("d9")))


@query("l8_principal_components")
def l8(spark, sf):
    """Scores on two components of the centred vectors; the signs are arbitrary."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = vectors(spark, sf).select("id", array_to_vector("bands").alias("x"))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="x", outputCol="c").fit(v).transform(v)
    out = PCA(k=2, inputCol="c", outputCol="pc").fit(centred).transform(centred)
    return out.select("id", vector_to_array("pc").alias("pc"))


@query("l6_random_forest")
def l6(spark, sf):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    v = S.stable_split(vectors(spark, sf).select("id", (F.col("label") < 5).cast("int").alias("label"), array_to_vector("bands").alias("features")))
    model = RandomForestClassifier(numTrees=10, maxDepth=4, seed=7).fit(v.where("not is_test"))
    return model.transform(v.where("is_test")).select("id", "label", F.col("prediction").cast("int").alias("prediction"))


@query("x6_failed_tiles", f"""SELECT id, CASE WHEN max(v) <= 0.25 THEN round(sum(v), 6) END AS total, CASE WHEN max(v) > 0.25 THEN 'ValueError: saturated' END AS error FROM {RASTERS} GROUP BY id""")
def x6(spark, sf):
    """A kernel that raises on saturated tiles: their rows have the reason."""

    def total(pdf):
        if pdf["v"].max() > 0.25:
            raise ValueError("saturated")
        return pdf.groupby("id", as_index=False)["v"].sum().rename(columns={"v": "total"})

    return tolerant.apply_groups(rasters(spark, sf), ["id"], total, "id bigint, total double").withColumn("total", R("total"))


@query("g12_border_hierarchy", f"""WITH RECURSIVE m AS (SELECT id, row, col FROM {RASTERS} WHERE v > 0.05),
near AS (SELECT id, row, col, 8 * row + col AS root FROM m UNION SELECT m.id, m.row, m.col, n.root FROM near n JOIN m ON m.id = n.id AND abs(m.row - n.row) <= 1 AND abs(m.col - n.col) <= 1),
regions AS (SELECT id, count(*) FILTER (root = 8 * row + col) AS regions FROM (SELECT id, row, col, min(root) AS root FROM near GROUP BY ALL) GROUP BY 1),
b AS (SELECT i.id, r.i AS row, c.i AS col FROM (SELECT DISTINCT id FROM m) i, range(-1, 9) r(i), range(-1, 9) c(i) ANTI JOIN m ON m.id = i.id AND m.row = r.i AND m.col = c.i),
far AS (SELECT id, row, col, 10 * row + col AS root FROM b UNION SELECT b.id, b.row, b.col, f.root FROM far f JOIN b ON b.id = f.id AND abs(b.row - f.row) + abs(b.col - f.col) = 1),
holes AS (SELECT id, count(*) FILTER (root = 10 * row + col) - 1 AS holes FROM (SELECT id, row, col, min(root) AS root FROM far GROUP BY ALL) GROUP BY 1)
SELECT id, regions, holes FROM regions JOIN holes USING (id)""")
def hierarchy(spark, sf):
    """Outer borders and holes of each raster's pixels above a threshold."""
    found = borders.traced(rasters(spark, sf), ["id"], 0.05, soft=False)
    return found.groupBy("id").agg(F.count_if(~F.col("hole")).alias("regions"), F.count_if("hole").alias("holes"))


query("g12_soft_borders")(lambda s, d: borders.traced(rasters(s, d).withColumn("v", F.col("v") + 0.5), ["id"]))


@query("l10_nmf")
def factors(spark, sf):
    """Weights of two non-negative components; no SQL twin, tests hold the operator against numpy from the same start."""
    got, _, _ = learning.nmf(vectors(spark, sf).select("id", F.transform("bands", lambda x: F.greatest(x / 3000, F.lit(0.0))).alias("x")), k=2, rounds=30)
    return got.select("id", R(F.get("weights", 0)).alias("w0"), R(F.get("weights", 1)).alias("w1"))


@query("l7_radial_machine")
def machine(spark, sf):
    """Decisions of a support vector machine with a radial kernel; no SQL twin, tests hold the operator against an exact dual solution."""
    rows = vectors(spark, sf).select("id", F.transform("bands", lambda x: x / 3000).alias("x"), (F.col("label") < 5).cast("int").alias("label"))
    return learning.fit_radial_machine(rows, landmarks=100, rounds=10).score(rows.select("id", "label", "x")).select("id", "label", (F.col("decision") > 0).cast("int").alias("prediction"))
