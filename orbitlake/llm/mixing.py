"""Mixing sources to target weights by hash-threshold histograms (native).

Sizes are summed by (source, leading bits of the document's hash). The running sum over a source's buckets crosses the
budget in one bucket; only the rows of that bucket are looked at again, by the next bits, until a bucket holds a
handful of hashes. What comes out is one threshold a source, and the mix is a filter `hash < threshold`: nothing is
sorted, and a hot source is summed on the map side before it is shuffled. A larger budget only raises the threshold,
so mixes of growing budgets are nested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import materialize, n_words, read, text_or_empty

#: Bits of the hash, and of each level of the histogram.
BITS, LEVEL_BITS, LEVELS = 60, 10, 3


def hash60(name: str = "doc_id"):
    """60 bits of MD5 of the id as text (null: of the empty text), a function of the id alone, so that reruns agree."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def targets(totals: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """totals: source, source_size. Adds target: shares of all sizes by weight (the weights repeat over the sources in code point
    order, null last), none above most times its source's size; what is above is shared anew by weight. In closed form: target =
    min(most * size, weight * level), where the level is found by walking the sources in order of most * size / weight."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("_k", (F.row_number().over(order) - 1) % len(weights))
    ranked = ranked.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_k") + 1).cast("int")))
    ranked = ranked.withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    ranked = ranked.withColumn("_at", F.col("_cap") / F.col("_w"))
    walk, every = W.orderBy("_at", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1), W.partitionBy(F.lit(0))
    ranked = ranked.withColumn("_caps", F.coalesce(F.sum("_cap").over(walk), F.lit(0.0))).withColumn("_ws", F.coalesce(F.sum("_w").over(walk), F.lit(0.0)))
    ranked = ranked.withColumn("_level", (F.sum("source_size").over(every) - F.col("_caps")) / (F.sum("_w").over(every) - F.col("_ws")))
    level = F.max(F.when(F.col("_level") <= F.col("_at"), F.col("_level"))).over(every)
    return ranked.withColumn("_x", level).select("source", "source_size", F.least("_cap", F.coalesce(F.col("_w") * F.col("_x"), F.col("_cap"))).alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """sized: source, h, size. budgets: source, budget. Adds threshold: the rows of the source with h below it come nearest to the
    budget among all thresholds at the crossing. A source whose sizes never exceed the budget gets 2**60, all of it."""
    rows, base = sized, budgets.withColumn("_base", F.lit(0).cast("long"))
    for level in [*range(LEVELS), None]:
        shift = 0 if level is None else BITS - LEVEL_BITS * (level + 1)
        key = F.col("h") if level is None else F.shiftright("h", shift)
        # the bucket is named by all leading bits, so that one join key leads to the rows of the boundary bucket alone
        hist = rows.groupBy("source", key.alias("bucket")).agg(F.sum("size").alias("s"))
        b = base.select(F.col("source").alias("_src"), "budget", "_base")
        cum = hist.join(b, hist["source"].eqNullSafe(b["_src"])).drop("_src")
        cum = cum.withColumn("_cum", F.col("_base") + F.sum("s").over(W.partitionBy("source").orderBy("bucket")))
        crossed = cum.where(F.col("_cum") > F.col("budget"))
        first = crossed.groupBy("source", "budget").agg(F.min(F.struct("bucket", "_cum", "s")).alias("m")).select("source", "budget", F.col("m.bucket").alias("bucket"), F.col("m._cum").alias("_cum"), F.col("m.s").alias("s"))
        first = materialize(first.withColumn("_base", F.col("_cum") - F.col("s")), "mix-level")
        if level is None:
            near = F.col("_cum") - F.col("budget") <= F.col("budget") - F.col("_base")
            found = first.select(F.col("source").alias("_src"), F.when(near, F.col("bucket") + 1).otherwise(F.col("bucket")).alias("_t"))
            out = budgets.join(found, budgets["source"].eqNullSafe(found["_src"]), "left")
            return out.select("source", "budget", F.coalesce("_t", F.lit(1 << BITS)).cast("long").alias("threshold"))
        base = first.select("source", "budget", "_base")
        at = first.select(F.col("source").alias("_src"), F.col("bucket").alias("_bucket"))
        rows = rows.join(at, rows["source"].eqNullSafe(at["_src"]) & (F.shiftright(rows["h"], shift) == at["_bucket"])).drop("_src", "_bucket")
    raise AssertionError


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """docs: doc_id, source, text; further columns are ignored unless named in keep. One row per input row: doc_id, source, size (words;
    null text 0), source_size, target, copies (times the mix takes the row, at most `most`), taken (words) and those of keep.

    Every row is taken floor(target / source_size) times; the rest of the target goes to the rows whose hash is below the source's threshold.
    A null source is a source of its own, last in order. Repeated ids share a hash and so are taken or left together. An empty table gives none.
    A source of size 0 has target 0."""
    measured = lambda *cols: docs.select("doc_id", "source", *cols, n_words(text_or_empty(text)).alias("size"), hash60().alias("h"))
    sized = materialize(measured(), "mix-sized")
    plan = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    plan = plan.withColumn("_whole", F.least(F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))), F.lit(int(most))).cast("long"))
    plan = plan.withColumn("budget", F.when(F.col("_whole") >= int(most), F.lit(0.0)).otherwise(F.col("target") - F.col("_whole") * F.col("source_size")))
    plan = materialize(plan, "mix-plan")
    cut = thresholds(sized.select("source", "h", "size"), plan.select("source", "budget")).select(F.col("source").alias("_s1"), "threshold")
    plan = plan.join(cut, plan["source"].eqNullSafe(cut["_s1"])).drop("_s1", "budget").withColumnRenamed("source", "_src")
    plan = materialize(plan, "mix-thresholds")  # its size is known then: where sources are few, the rows stay where they are
    rows = measured(*keep) if keep else sized  # columns to keep are not written, the sizes are computed again with them
    out = rows.join(plan, rows["source"].eqNullSafe(plan["_src"]))
    copies = F.col("_whole") + F.when((F.col("h") < F.col("threshold")) & (F.col("_whole") < int(most)), 1).otherwise(0)
    return out.select("doc_id", "source", *keep, "size", "source_size", "target", copies.cast("long").alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         source_size * 3.0::DOUBLE AS cap FROM totals),
walked AS (
  SELECT *, cap / w AS edge, CAST(sum(source_size) OVER () AS DOUBLE) AS t, sum(w) OVER () AS ws,
         coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
         coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ranked),
leveled AS (SELECT *, max(CASE WHEN (t - caps) / (ws - before) <= edge THEN (t - caps) / (ws - before) END) OVER () AS x FROM walked),
plan AS (SELECT source, source_size, least(cap, coalesce(w * x, cap)) AS target FROM leveled),
parts AS (SELECT *, least(CAST(floor(coalesce(target / nullif(source_size, 0), 0)) AS BIGINT), 3) AS whole FROM plan),
budgets AS (SELECT *, CASE WHEN whole >= 3 THEN 0 ELSE target - whole * source_size END AS budget FROM parts),
ordered AS (
  SELECT s.*, b.source_size, b.target, b.whole, b.budget, CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS BIGINT) AS cum,
         CAST(sum(s.size) OVER (PARTITION BY s.source, s.h) AS BIGINT) AS same
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       size * (whole + CASE WHEN whole < 3 AND (cum <= budget OR (cum - same <= budget AND cum - budget <= budget - (cum - same))) THEN 1 ELSE 0 END) AS taken
FROM ordered
"""
