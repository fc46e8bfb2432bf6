"""Vector codes against brute force in whole numbers and against SQL."""

import glob
import hashlib
import math
import os

import duckdb
import numpy as np
import pytest

from orbitlake.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, vector int"


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * float(c)) for c in v], lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w : p * w + w]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda x, e: sum((a - b) ** 2 for a, b in zip(x, e))
    choose = lambda v: [min((far(cut(v, p), e), j) for j, e in enumerate(books[p])) for p in range(parts)]
    for _ in range(rounds):
        chosen = [choose(v) for _, v, _ in kept]
        for p in range(parts):
            for j in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), c in zip(kept, chosen) if c[p][1] == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own)]
    named = [(i, choose(v), lab) for i, v, lab in kept]
    out = [(i, "".join(f"{j:02x}" for _, j in c), sum(d for d, _ in c), lab) for i, c, lab in named]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((repr(i), code, e, sum(f for *_, f, other in out if other == lab), sha) for i, code, e, lab in out)


def rows(df):
    return sorted((repr(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect())


def test_query_equals_sql(spark, sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/embeddings.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    want = c.sql(codes.ORACLE).fetchall()
    assert rows(codes.op13_codes(spark, sf)) == sorted((repr(r[0]), *r[1:]) for r in want)


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 7) for i, v, lab in rows], SCHEMA)


def test_odd_rows_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 32)).astype("f4").round(1)  # rounded: ties abound
    odd = [(i if i % 9 else None, x[i].tolist(), [None, 1, 2][i % 3]) for i in range(150)]
    odd += [odd[5]] * 30 + [(500, None, 1), (501, [None] * 32, 1), (502, [float("nan")] * 32, None), (503, [float("inf")] + [0.0] * 31, 2)]
    assert rows(codes.compress(table(spark, odd))) == brute(odd)
    few = odd[1:6]
    assert rows(codes.compress(table(spark, few))) == brute(few)
    assert codes.compress(table(spark, odd).limit(0)).count() == 0 and codes.compress(table(spark, odd[-4:])).count() == 0


def test_lengths_and_large_components(spark):
    got = codes.compress(table(spark, [(1, [1.0] * 20, 1), (2, [2.0] * 20, 1), (3, [1.0] * 16, 1), (4, [3e38] * 20, 1)])).collect()
    assert sorted(r["vec_id"] for r in got) == [1, 2, 4] and all(len(r["code"]) == 32 and r["error"] == 0 for r in got)
    assert [r["error"] for r in codes.compress(table(spark, [(1, [], None), (2, [], None)])).collect()] == [0, 0]


@pytest.mark.parametrize("width", [1, 2, 3, 4, 7, 16])
def test_bounds_lose_no_nearest_entry(width):
    rng = np.random.default_rng(width)
    for most in (2, 40, codes.limit(16 * width)):
        x, c = rng.integers(-most, most + 1, (400, width)), rng.integers(-most, most + 1, (64, width))
        at, apart, _ = codes.nearest(x, codes.Blocks(c))
        every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (at == every.argmin(axis=1)).all() and (apart == every.min(axis=1)).all()
        for a, b in zip(codes.Blocks(x).levels, codes.Blocks(c).levels):
            assert (codes.bound(a, b, np.arange(400)[:, None], np.arange(64)[None, :]) <= every).all()


def test_few_entries_receive_exact_distances():
    rng = np.random.default_rng(0)
    x, c = rng.normal(0, 100, (3000, 16)).cumsum(axis=1).astype(np.int64), rng.normal(0, 100, (64, 16)).cumsum(axis=1).astype(np.int64)
    assert codes.nearest(x, codes.Blocks(c))[2] < 0.2 * 3000 * 64
