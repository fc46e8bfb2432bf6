"""Greedy matching in rounds, zips by position, failed groups."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orbitlake.operators import position, spatial, tolerant


def sequential(a, b, radius):
    taken, out = set(), {}
    for i in range(len(a)):
        near = np.flatnonzero(np.hypot(*(b - a[i]).T) < radius)
        free = [j for j in near.tolist() if j not in taken]
        if free:
            out[i] = free[0]
            taken.add(free[0])
    return out


def points(spark, xy, names):
    pdf = pd.DataFrame({names[0]: np.arange(len(xy)), names[1]: np.arange(len(xy)), names[2]: xy[:, 0], names[3]: xy[:, 1]})
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("last", [0, 40, 100_000])
def test_rounds_equal_the_sequential_rule(spark, last):
    rng = np.random.default_rng(6)
    a, b = rng.random((400, 2)), rng.random((300, 2))  # radius of several neighbours: one component
    got = spatial.greedy_match(points(spark, a, ["id", "seq", "lon", "lat"]), points(spark, b, ["id2", "seq2", "lon2", "lat2"]), 0.08, last)
    assert {r["id"]: r["id2"] for r in got.collect()} == sequential(a, b, 0.08)


def test_many_points_of_one_component(spark):
    rng = np.random.default_rng(9)
    a, b = rng.random((20_000, 2)), rng.random((20_000, 2))
    left, right = points(spark, a, ["id", "seq", "lon", "lat"]), points(spark, b, ["id2", "seq2", "lon2", "lat2"])
    got = spatial.greedy_match(left, right, 0.012, 2_000)
    assert {r["id"]: r["id2"] for r in got.collect()} == sequential(a, b, 0.012)


@pytest.mark.parametrize("last", [0, 100_000])
def test_points_in_one_place_take_few_rounds(spark, monkeypatch, last):
    """All pairs are within reach: as many as the square of the points, and each waits for the one before."""
    from orbitlake.operators import merge

    seen = []
    write = merge.shared
    monkeypatch.setattr(merge, "shared", lambda df: seen.append(1) or write(df))
    a = np.full((1500, 2), 0.3)
    got = spatial.greedy_match(points(spark, a, ["id", "seq", "lon", "lat"]), points(spark, a[:1400], ["id2", "seq2", "lon2", "lat2"]), 0.08, last)
    assert {r["id"]: r["id2"] for r in got.collect()} == {i: i for i in range(1400)} and len(seen) < 10


def test_no_pairs(spark):
    a = points(spark, np.zeros((1, 2)), ["id", "seq", "lon", "lat"])
    b = points(spark, np.ones((1, 2)), ["id2", "seq2", "lon2", "lat2"])
    assert spatial.greedy_match(a, b, 0.5).count() == 0


def test_positions(spark):
    left = spark.range(1000, numPartitions=7).select(((F.col("id") * 37) % 1000).alias("a"), F.lit("x").alias("x"))
    right = spark.range(600, numPartitions=3).select((-F.col("id")).alias("b"))
    got = sorted((r["position"], r["a"], r["b"]) for r in position.zipped(left, right, [F.asc("a")], [F.desc("b")]).collect())
    assert got == [(i, i, -i) for i in range(600)]
    longest = position.zipped(left, right, ["a"], [F.desc("b")], "full")
    assert longest.count() == 1000 and longest.where("b IS NULL").count() == 400
    assert position.numbered(left.limit(0), ["a"]).count() == 0
    ties = position.numbered(left, ["x"]).select("position").collect()
    assert sorted(r["position"] for r in ties) == list(range(1000))


def test_one_poisoned_group_of_a_hundred(spark):
    tries = spark.sparkContext.accumulator(0)

    def kernel(pdf):
        tries.add(1)
        if pdf["k"].iloc[0] == 13:
            raise RuntimeError("bad tile")
        if pdf["k"].iloc[0] == 14:
            return pdf[["k"]]
        return pdf.groupby("k", as_index=False)["v"].sum()

    df = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").cast("double").alias("v"))
    good, bad = tolerant.parted(tolerant.apply_groups(df, ["k"], kernel, "k bigint, v double", attempts=3))
    assert {r["k"]: r["error"] for r in bad.collect()} == {13: "RuntimeError: bad tile", 14: "KeyError: 'no column v in the result'"}
    assert tries.value == 98 + 2 * 3
    rows = good.collect()
    assert len(rows) == 98 and all(r["v"] == sum(range(r["k"], 1000, 100)) for r in rows) and good.columns == ["k", "v"]
