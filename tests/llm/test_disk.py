"""What the operators leave on disk while they run."""

import collections
import os
import time

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from orbitlake.llm import _common, jaccard


@pytest.fixture
def shared(monkeypatch, tmp_path):
    """A shared folder of the test's own."""
    monkeypatch.setattr(_common, "shared_dir", lambda spark: str(tmp_path))
    return tmp_path


def tables(folder):
    """Bytes of the tables in a folder, by tag."""
    out = collections.Counter()
    for d, _, files in os.walk(folder):
        for f in files:
            if f.endswith(".parquet"):
                out[os.path.basename(d)[:-33]] += os.path.getsize(f"{d}/{f}")
    return out


def shuffle_files(spark):
    return spark._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().mkString("\n").count("shuffle_")


def test_a_written_table_leaves_no_shuffle_files(spark, shared):
    before = shuffle_files(spark)
    counted = spark.range(1000).groupBy(F.xxhash64("id")).agg(F.count(F.lit(1)).alias("n"))
    out = _common.materialize(counted.withColumnRenamed("xxhash64(id)", "h"), "test-tidy")
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before and out.count() == 1000
    assert spark.conf.get(_common.TIDY, None) is None  # other executions keep theirs


def test_jaccard_keeps_no_large_table(spark, corpus, shared):
    """Sets, signatures and texts are gone once the links are known; what is left has a few numbers a row."""
    found = jaccard.similar(corpus)
    left = tables(shared)
    assert not {"jaccard-sets", "jaccard-signed", "jaccard-tokens", "jaccard-posts", "jaccard-groups", "jaccard-full"} & set(left)
    assert sum(left.values()) < corpus.agg(F.sum(F.octet_length("text"))).first()[0] / 4
    assert found.count() == corpus.count()


def test_only_shared_tokens_have_posts(spark, shared):
    rows = [(t, n) for t, nodes in {1: [5], 2: [5, 6], 3: [7], -4: [5, 6, 7]}.items() for n in nodes]
    out = jaccard._shared(spark.createDataFrame(rows, "token long, node long"), len(rows))
    assert sorted(map(tuple, out.collect())) == [(-4, 5), (-4, 6), (-4, 7), (2, 5), (2, 6)] and set(tables(shared)) == {"jaccard-posts"}


def test_pipeline_keeps_one_stage_at_a_time(spark, sf, shared, monkeypatch):
    """A stage's tables and the rows that it was given go once its own are written."""
    seen = []

    def told(stage):
        return lambda spark, docs, sf_dir: seen.append(set(tables(shared))) or stage(spark, docs, sf_dir)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, told(stage)) for name, stage in corpus_pipeline.STAGES])
    assert corpus_pipeline.run(spark, sf).count() > 0
    assert seen == [set(), *({f"pipeline-{name}"} for name, _ in corpus_pipeline.STAGES[:-1])]


def test_near_duplicates_keep_only_what_their_result_reads(spark, corpus, shared):
    out = corpus_pipeline.near_duplicate_stage(spark, corpus.select(*corpus_pipeline.COLUMNS), "")
    assert set(tables(shared)) == {"pipeline-first"} and 0 < out.count() < corpus.count()


def moved(spark):
    """Bytes shuffled so far."""
    sc = spark._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    found = sc.statusStore().executorList(True)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


@pytest.fixture
def no_small_table(spark):
    """What Spark broadcasts by size on small inputs, it shuffles on large ones."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_toxicity_writes_no_texts(spark, sf, corpus, shared):
    out = corpus_pipeline.toxicity_stage(spark, corpus, sf)
    size = out.agg(F.sum(F.octet_length("text"))).first()[0]
    assert "toxicity-seen" in tables(shared) and sum(tables(shared).values()) < size / 8


def test_near_duplicates_move_few_texts(spark, corpus, shared, tmp_path_factory, monkeypatch, no_small_table):
    """Neither to get the whole sets nor to drop copies."""
    by_tag, real = {}, jaccard.materialize

    def told(df, tag, *more):
        before = moved(spark)
        out = real(df, tag, *more)
        by_tag[tag] = moved(spark) - before
        return out

    monkeypatch.setattr(jaccard, "materialize", told)
    docs = corpus.select(*corpus_pipeline.COLUMNS)
    before = moved(spark)
    docs.repartition(4, "doc_id").write.parquet(f"{tmp_path_factory.mktemp('moved')}/all")
    every = moved(spark) - before
    out = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    before = moved(spark)
    out.write.parquet(f"{tmp_path_factory.mktemp('moved')}/kept")
    assert moved(spark) - before < every / 2 and by_tag["jaccard-full"] < every / 2


def test_mixing_moves_no_texts(spark, corpus, shared, tmp_path):
    out = corpus_pipeline.mixing_stage(spark, corpus, "")
    before = moved(spark)
    out.write.parquet(f"{tmp_path}/mixed")
    assert moved(spark) == before


def test_a_bit_map_misses_no_key(spark, monkeypatch):
    keys = spark.createDataFrame([(None,), *((i,) for i in range(0, 4000, 40))], "k long")
    rows = spark.range(4000).withColumnRenamed("id", "k").unionByName(spark.createDataFrame([(None,)], "k long"))
    for bits, most in ((24, 102), (7, 4001)):
        monkeypatch.setattr(_common, "MAP_BITS", bits)
        got = {r.k: r._mapped for r in _common.mapped(rows, "k", _common.bit_map(keys, "k")).collect()}
        assert len(got) == 4001 and got[None] and all(got[k] for k in range(0, 4000, 40)) and sum(got.values()) <= most
    assert not any(r._mapped for r in _common.mapped(rows, "k", _common.bit_map(keys.limit(0), "k")).collect())


def test_families_hang_together_by_pairs_not_by_groups(spark, docs_of, shared, monkeypatch):
    """Pairs of near copies, each with half of its words in common with the next pair: their groups have members in common, but a family is a pair."""
    texts = []
    for i in range(40):
        words = [f"w{j}" for j in range(60 * i, 60 * i + 120)]
        texts += [" ".join(words), " ".join([*words, "end"])]
    seen = []
    monkeypatch.setattr(jaccard, "materialize", lambda df, tag, *a: seen.append((tag, out := _common.materialize(df, tag, *a))) or out)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar(docs_of(texts)).collect()}
    assert got == {i: i - i % 2 for i in range(80)}
    family = [df for tag, df in seen if tag == "jaccard-families"][-1]
    assert sorted(r["n"] for r in family.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()) == [2] * 40
