"""Quality by importance resampling: hashed n-gram models of target text and of all text, their ratio as a document's weight, and a sample
without replacement by Gumbel top-k.

Both models are bags of hashed words and word pairs, each one array of counts; a task adds its texts to one array, so
what moves is one array a task. The k largest perturbed weights are found by histograms of the key's leading bits,
refined in the one bucket that holds the k-th, never by sorting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import chunks, materialize, mix64, read, runs_hash, small_batches, texts_words

#: Buckets that words and word pairs are hashed to, together.
BUCKETS = 16_384
#: Share of all rows that is sampled.
SHARE = 0.85
_LEVELS = (52, 40, 28, 16, 4, 0)


def _buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each text's words, then of its word pairs, and the text that each belongs to."""
    h, bounds = texts_words(texts, lower=True)
    of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    pairs = runs_hash(h, 2)
    inside = of[1:] == of[:-1] if len(of) > 1 else np.zeros(0, bool)
    pairs = pairs[: len(inside)][inside]
    return (np.concatenate([mix64(h), pairs]) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([of, of[:-1][inside] if len(of) else of])


def count_model(docs: DataFrame, text: str) -> np.ndarray:
    """Counts by bucket over all texts of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(0).to_pylist()]
            for a, b in chunks(texts):
                total += np.bincount(_buckets(texts[a:b])[0], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(BUCKETS)
    for r in docs.select(text).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gumbel(seed: int, id_col: str = "doc_id"):
    """Standard Gumbel noise, a function of the id and the seed alone."""
    u = (F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 11).cast("double") + 0.5) * F.lit(2.0**-53)
    return -F.log(-F.log(u))


def top_k_threshold(keys: DataFrame, k: int) -> tuple[int, int]:
    """keys: key (long). The k-th largest key, and how many of the rows that have it belong to the k largest. Each level collects 4,096 rows at most
    (the first: the 4,096 leading values)."""
    base = keys
    for shift, above in zip(_LEVELS, (64, *_LEVELS)):
        hist = sorted(((r["b"], r["n"]) for r in base.groupBy(F.shiftright("key", shift).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
        for b, n in hist:
            if k <= n:
                break
            k -= n
        base = base.where(F.shiftright("key", shift) == b)
    return b, k


def weigh(docs: DataFrame, target: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_grams, log_weight: the log ratio of the target's and all text's probability of the document's n-grams. target: text."""
    small_batches(docs.sparkSession)
    models = [count_model(target.select(F.col(text)), text), count_model(docs, text)]
    logs = [np.log((m + 1) / (m.sum() + BUCKETS)) for m in models]
    ratio = docs.sparkSession.sparkContext.broadcast(logs[0] - logs[1] if models[0].sum() else np.zeros(BUCKETS))  # BUCKETS numbers
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                bucket, of = _buckets(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(np.bincount(of, minlength=b - a)), pa.array(np.bincount(of, ratio.value[bucket], b - a).astype(float))], names=["doc_id", "n_grams", "log_weight"])

    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, n_grams bigint, log_weight double")


def resample(docs: DataFrame, target: DataFrame, share: float = SHARE, seed: int = 11, text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_grams, log_weight, gumbel_key, kept (is among the share's largest keys).

    Nulls: a null or empty text has no n-grams and weight 0; a null id has noise of its own like any id. Repeated rows share their key. Rows that tie with the last one
    kept are all kept. An empty table gives no rows; an empty target makes all weights 0, that is a plain sample. Other columns are not read."""
    rows = weigh(docs, target, text).withColumn("gumbel_key", F.col("log_weight") + gumbel(seed))
    # the key's order as a long: sign and magnitude to two's complement, at 2 ** -20 steps
    rows = materialize(rows.withColumn("key", F.round(F.col("gumbel_key") * (1 << 20)).cast("long")), "importance")
    total = rows.count()
    k = int(np.ceil(share * total))
    least, _ = top_k_threshold(rows.select("key"), k) if k else (1 << 62, 0)
    return rows.withColumn("kept", F.col("key") >= least).drop("key")


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: all documents labelled as good."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    return resample(docs, docs.join(good.hint("merge"), "doc_id", "left_semi").select("text"))
