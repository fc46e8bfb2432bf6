"""Operators that must not lose rows to caps."""

import numpy as np
import pandas as pd

from orbitlake.llm import ann, importance


def test_repeated_rows_take_no_places(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(100, 16)).round(3)
    rows = [(i, x[i].tolist()) for i in range(100)]
    once = {(r.query_id, r.rank): (r.vec_id, r.score) for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert len(once) == 5 * 20
    for more in (rows, [rows[7]] * 60):
        got = ann.nearest(spark.createDataFrame(rows + more, "vec_id long, embedding array<double>")).collect()
        assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got} == once
    several = [(21, (x[20] * (2 + i / 100)).tolist()) for i in range(60)] + [(20, (x[20] * (3 + i / 100)).tolist()) for i in range(60)]
    got = ann.nearest(spark.createDataFrame(rows[:20] + rows[20:21] + several + rows[22:], "vec_id long, embedding array<double>")).where("query_id = 0").collect()
    assert len(got) == 20


def test_target_model_counts_every_good_label(spark, tmp_path):
    n = 20_600
    ids = np.arange(n)
    pd.DataFrame({"doc_id": ids, "text": [f"word{i % 7}" for i in ids]}).to_parquet(tmp_path / "documents.parquet")
    pd.DataFrame({"doc_id": ids, "quality": 1}).to_parquet(tmp_path / "labels.parquet")
    # all rows are the target, so both models are the same
    assert {r.log_weight for r in importance.op7_importance(spark, str(tmp_path)).select("log_weight").distinct().collect()} == {0.0}
