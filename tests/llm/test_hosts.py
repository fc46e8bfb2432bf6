"""The host prior: equal hosts stay unjudged, bad ones are found at few and at many rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitlake.llm import hostrules


def verdicts(spark, hosts):
    """hosts: (rows, failures) each. Rows as the operator's measures: a failing one has too many symbols."""
    rows = [(f"h{i}", 100, 400, 90 if bad else 0, 1, 0, 0, n) for i, (size, failed) in enumerate(hosts) for bad, n in ((True, failed), (False, size - failed))]
    one = spark.createDataFrame(rows, "host string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, times int").where("times > 0")
    return {r["host"]: r for r in hostrules.host_verdicts(one.withColumn("x", F.explode(F.sequence(F.lit(1), "times")))).collect()}


@pytest.mark.parametrize("size", [50, 500, 5000])
def test_equal_hosts_stay_unjudged(spark, size):
    rng = np.random.default_rng(size)
    judged = 0
    for _ in range(5):
        judged += sum(r["suspect"] for r in verdicts(spark, [(size, int(k)) for k in rng.binomial(size, 0.15, 20)]).values())
    assert judged < 0.05 * 5 * 20


@pytest.mark.parametrize("size", [50, 5000])
def test_a_bad_host_is_found(spark, size):
    rng = np.random.default_rng(1)
    got = verdicts(spark, [(size, int(k)) for k in rng.binomial(size, 0.15, 19)] + [(size, int(0.6 * size))])
    assert [h for h, r in got.items() if r["suspect"]] == ["h19"] and got["h19"]["rejected"]
    # few rows say little
    assert not verdicts(spark, [(size, int(k)) for k in rng.binomial(size, 0.15, 19)] + [(2, 2)])["h19"]["rejected"]


def test_single_and_uniform_hosts(spark):
    assert not verdicts(spark, [(10, 9)])["h0"]["suspect"]
    same = verdicts(spark, [(40, 8)] * 5)
    assert not any(r["suspect"] or r["rejected"] for r in same.values()) and {r["rate"] for r in same.values()} == {0.2}
