"""A training-data pipeline over documents: toxicity, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Between
stages the rows are written as Parquet and read again; a stage's tables, and the rows it was given, go once its rows are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlake.llm import jaccard, mixing, packing, secrets, toxicity
from orbitlake.llm._common import bit_map, forget, mapped, materialize, read, scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; null and empty texts have the score of a text in which no voter finds anything."""
    scored = toxicity.score(docs, read(spark, sf_dir, "labels"), keep=COLUMNS[1:])
    return scored.where("predicted = 0").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the smallest id stays, once if its row repeats. Rows of one id with different texts stay together; a component of
    null ids alone keeps one row of each text. Texts are compared among rows of one id only."""
    with scratch(spark) as outside:
        ids = jaccard.similar(docs).groupBy(F.col("doc_id").alias("_id")).agg(F.count_if(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("_n"))
        some = materialize(ids.where("_n <> 1"), "pipeline-first", outside)
    # most ids stay, with all their rows: a bit map tells nearly all of them, so that their texts are not moved
    told = mapped(docs.select(*COLUMNS), "doc_id", bit_map(some, "_id"))
    met = told.where("_mapped").join(some, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    once = told.where("NOT _mapped").select(*COLUMNS).unionByName(met.where("_n IS NULL").select(*COLUMNS))
    return once.unionByName(met.where("_n > 1").select(*COLUMNS).dropDuplicates(["doc_id", "text"]))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the spans of live-looking secrets that are no widely copied examples are masked. n_chars follows; a null text stays null."""
    found = secrets.scan(docs, keep=COLUMNS[1:])
    hit = F.size("masks") > 0
    out = found.withColumn("text", F.when(hit, secrets.masked_text(F.col("text"), F.col("masks"))).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; documents without words are taken no time."""
    mixed = mixing.mix(docs, keep=("text", "lang", "n_chars")).where("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows; a null text is the end mark alone."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't express the learned classifier and the tokenizer; tests hold each stage against a brute-force version on the small tables, the classifier against labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as outside:
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", outside)
        if last is not None:
            forget(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
