"""Recall of the collision-counting search on tables of one block, for equal and unequal norms."""

import numpy as np
import pytest

from orbitlake.llm import ann


@pytest.mark.parametrize("low,high", [(1.0, 1.0), (0.5, 1.5)])
@pytest.mark.parametrize("n", [200, 1000, 3000, 8192])
def test_recall_of_a_single_block(spark, n, low, high):
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 64))
    x *= rng.uniform(low, high, (n, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    index = ann.Index(df)
    assert index.n_blocks == 1
    step = max(1, n // 60)
    got: dict[int, set] = {}
    for r in index.search(index.valid.where(f"vec_id % {step} = 0")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    shares = []
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        shares.append(len(found & set(np.argsort(-s)[:20].tolist())) / 20)
    assert len(shares) >= 60 and np.mean(shares) >= 0.9 and np.quantile(shares, 0.1) >= 0.75


def test_parts_of_a_block_have_like_norms():
    rng = np.random.default_rng(1)
    for norms in (np.sort(rng.uniform(0.5, 1.5, 8000)), np.ones(9000), np.geomspace(1, 1e9, 3000), np.ones(3), np.array([1e-200, 1.0]), np.ones(70_000), np.empty(0)):
        parts = list(ann.cuts(norms))
        assert [i for i, _ in parts] == [0, *[j for _, j in parts]][: len(parts)] and (not len(norms) or parts[-1][1] == len(norms))
        assert all(j - i <= 1 << 15 for i, j in parts)
        assert all(j - i < 2 * ann.LEAST or norms[j - 1] <= norms[i] * ann.LIKE or norms[j - ann.LEAST - 1] <= norms[i] * ann.LIKE for i, j in parts)
    assert len(list(ann.cuts(np.ones(9000)))) == 1
