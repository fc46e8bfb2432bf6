"""Non-negative factors against numpy from the same start; the radial machine against an exact dual solution."""

import numpy as np
import pytest

from orbitlake.operators import learning


def table(spark, x, label=None):
    return spark.createDataFrame([(i, [float(v) for v in r], None if label is None else int(label[i])) for i, r in enumerate(x)], "id long, x array<double>, label int")


def test_factors_equal_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.random((120, 3)) @ rng.random((3, 10)) + 0.01 * rng.random((120, 10))
    got, h, errors = learning.nmf(table(spark, x).repartition(5), k=2, rounds=24, tolerance=0.0, keep_every=7)
    w, g, k = learning.start_weights(np.arange(120), 2), (0.1 + np.random.default_rng(0).random((2, 10))) * x.mean(axis=0) / 2, 2
    want = []
    for n in range(24):
        w = w * (x @ g.T) / (w @ g @ g.T + 1e-12)
        want.append(((x - w @ g) ** 2).sum())
        g = g * (w.T @ x) / (w.T @ w @ g + 1e-12)
    w = w * (x @ g.T) / (w @ g @ g.T + 1e-12)
    assert np.allclose(h, g, rtol=1e-6) and np.allclose(errors, want, rtol=1e-6) and all(b <= a for a, b in zip(errors, errors[1:]))
    rows = {r["id"]: r["weights"] for r in got.collect()}
    assert np.allclose([rows[i] for i in range(120)], w, rtol=1e-5)


def test_factors_of_odd_tables(spark):
    df = table(spark, np.zeros((4, 3)))
    got, h, errors = learning.nmf(df.union(df.selectExpr("id + 9", "CAST(NULL AS array<double>)", "label")), rounds=3)
    assert got.count() == 4 and np.isfinite(h).all() and errors[0] == 0
    got, h, errors = learning.nmf(df.limit(0))
    assert got.count() == 0 and h.shape == (2, 0) and errors == []


def exact(x, y, cost, gamma, rounds=400):
    """Dual coordinate descent on the full kernel, with the offset as one more feature."""
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(axis=2)) + 1
    q, a = k * np.outer(y, y), np.zeros(len(y))
    g = -np.ones(len(y))
    for _ in range(rounds):
        moved = 0.0
        for i in np.random.default_rng(_).permutation(len(y)):
            new = min(max(a[i] - g[i] / q[i, i], 0), cost)
            if new != a[i]:
                g += q[:, i] * (new - a[i])
                moved, a[i] = max(moved, abs(new - a[i])), new
        if moved < 1e-6:
            break
    return k @ (a * y), 0.5 * a @ q @ a + cost * np.maximum(0, 1 - y * (k @ (a * y))).sum()


def test_machine_is_near_the_exact_solution(spark):
    rng = np.random.default_rng(3)
    turn = rng.random(600) * np.pi
    side = np.arange(600) % 2
    x = np.stack((np.cos(turn) + side, np.sin(turn) * (1 - 2 * side) + 0.4 * side), axis=1) + rng.normal(0, 0.25, (600, 2))
    machine = learning.fit_radial_machine(table(spark, x, side).repartition(3), cost=1.0, gamma=1.0, landmarks=200)
    y = 2 * side - 1.0
    f = machine.decision(x)
    value = 0.5 * (machine.plane**2).sum() + np.maximum(0, 1 - y * f).sum()
    decisions, best = exact(x, y, 1.0, 1.0)
    assert value <= best * 1.01 and (np.sign(f) == np.sign(decisions)).mean() > 0.98 and ((f > 0) == side).mean() > 0.9
    got = machine.score(table(spark, x[:20], side[:20]).selectExpr("id", "x").union(spark.sql("SELECT 99L, CAST(NULL AS array<double>)"))).collect()
    assert [r["decision"] for r in got if r["id"] == 99] == [None] and np.allclose([r["decision"] for r in got if r["id"] < 20], f[:20])


def test_machine_needs_rows(spark):
    with pytest.raises(ValueError):
        learning.fit_radial_machine(table(spark, np.zeros((0, 2))))
