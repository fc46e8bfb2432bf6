"""Every registered query of the library against its SQL twin on the same tables."""

import datetime
import glob
import math
import os

import duckdb
import pytest

from orbitlake.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x) or str(x) == "NaT":
        return None
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, (datetime.datetime, datetime.date)):
        return x.isoformat()[:10]
    return f"{float(x):.5g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(repr([plain(v) for v in r]) for r in df[cols].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    got = QUERIES[name](spark, sf).toPandas()
    if name in ORACLES:
        assert rows(got) == rows(duck.sql(ORACLES[name]).df())
    else:
        assert len(got)


def test_entry_works_without_optional_parts(spark, sf):
    import __spark_entry__ as entry

    assert set(ORACLES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())
    assert entry.entry(spark).columns[:2] == ["tile_id", "mean"]
