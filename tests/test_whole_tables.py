"""Queries read their whole tables: hand-made tables that reach beyond the ids and dates of the test data."""

import numpy as np
import pandas as pd

from orbitlake.plans.queries import QUERIES


def test_fixpoint_takes_every_site(spark, tmp_path):
    rng = np.random.default_rng(5)
    site = np.repeat(np.arange(1, 61), 40)
    v = rng.normal(1000, 100, len(site)).round(2)
    v[::40] = 90_000.0
    pd.DataFrame({"l_suppkey": site, "l_extendedprice": v}).to_parquet(tmp_path / "lineitem.parquet")
    want = {}
    for s in range(1, 61):
        x = v[site == s]
        while len(x) > 1 and (out := np.abs(x - x.mean()) / (x.std() / np.sqrt(len(x))) > 25).any():
            x = x[~out]
        want[s] = len(x)
    assert {r.site: r.n for r in QUERIES["w7_sem_fixpoint"](spark, str(tmp_path)).collect()} == want and set(want.values()) == {39}


def test_every_vector_has_its_second_best(spark, tmp_path):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 8)).astype(np.float32)
    label = np.arange(90) % 3
    pd.DataFrame({"vec_id": np.arange(90), "embedding": list(x), "label": label}).to_parquet(tmp_path / "embeddings.parquet")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = np.where((label[:, None] == label) & ~np.eye(90, dtype=bool), u @ u.T, -1)
    got = {r.vec_id: r.best for r in QUERIES["o2_second_best_all"](spark, str(tmp_path)).collect()}
    assert len(got) == 90 and np.allclose([got[i] for i in range(90)], s.max(1), atol=1e-6)


def test_entry_and_composites_reach_the_last_date(spark, sf, tmp_path):
    import __spark_entry__ as entry

    li = pd.read_parquet(f"{sf}/lineitem.parquet")
    ok = li[li.l_discount <= 0.05]
    day, band = pd.to_datetime(ok.l_shipdate), ok.l_returnflag + ok.l_linestatus
    quarter = (day.dt.year - 1995) * 4 + (day.dt.month - 1) // 3
    both = day.dt.is_quarter_start & (quarter > 0)  # a boundary date lies in two windows
    at = pd.concat([pd.DataFrame({"t": ok.l_suppkey, "b": band, "q": quarter}), pd.DataFrame({"t": ok.l_suppkey, "b": band, "q": quarter - 1})[both]])
    has = lambda b: set(map(tuple, at[at.b == b][["t", "q"]].drop_duplicates().itertuples(index=False)))
    assert sum(r["count"] for r in entry.entry(spark).collect()) == len(has("NO") & has("AF"))
    for name in ("t1_tumbling_inclusive_all", "t2_whole_batches_all", "t4_sliding_all", "t5_monthly_history_all"):
        assert QUERIES[name](spark, sf).agg({"window_start": "max"}).first()[0].year == 2001
    pd.DataFrame({"l_suppkey": [1, 1], "l_orderkey": [1, 2], "l_shipdate": pd.to_datetime(["1980-05-17", "2031-02-03"]), "l_returnflag": "N", "l_linestatus": "O", "l_extendedprice": [5.0, 7.0], "l_discount": 0.0}).to_parquet(tmp_path / "lineitem.parquet", coerce_timestamps="us")
    assert [str(r.window_start) for r in QUERIES["a2_min_composite_all"](spark, str(tmp_path)).orderBy("window_start").collect()] == ["1980-05-01", "2031-02-01"]


def test_every_row_lies_in_a_batch(spark, tmp_path):
    """Also those after the last batch that ends by the greatest date; a boundary date lies in two."""
    days = ["1995-01-02", "1995-07-01", "1995-12-31", "1996-01-01", "1996-03-31"]
    pd.DataFrame({"l_suppkey": 1, "l_orderkey": range(5), "l_shipdate": pd.to_datetime(days), "l_returnflag": "N", "l_linestatus": "O", "l_extendedprice": 5.0, "l_discount": 0.0}).to_parquet(tmp_path / "lineitem.parquet", coerce_timestamps="us")
    rows = QUERIES["t2_whole_batches"](spark, str(tmp_path)).collect()
    assert {str(r.window_start): r.n for r in rows} == {"1995-01-01": 2, "1995-07-01": 3, "1996-01-01": 2}
