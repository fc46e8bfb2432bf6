"""Models that Spark does not bring: non-negative factors and a support vector machine with a radial kernel. Each round is one pass over the rows; what
travels between tasks and driver has the size of the model (components x factors, or landmarks squared), whatever the number of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .merge import shared

TINY = 1e-12


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _sum(rows: DataFrame, make: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray | None:
    """Sum over all rows of arrays of one fixed size, made batch by batch: a task adds up its own, Spark adds the tasks' by position. None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                part = make(b)
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.float64())], ["i", "v"])

    found = rows.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
    return np.array([r["v"] for r in found]) if found else None


# --- non-negative factors --------------------------------------------------------------------------------------------------


def start_weights(keys: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Positive weights that depend on a row's key alone."""
    x = (keys.astype(np.uint64)[:, None] + np.uint64(seed * k + 1)) * np.uint64(0x9E3779B97F4A7C15) + np.arange(k, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return 0.1 + (x >> np.uint64(11)).astype(float) / 2**53


def _weights(x: np.ndarray, w: np.ndarray, history: list[np.ndarray]) -> np.ndarray:
    for h in history:
        w = w * (x @ h.T) / (w @ (h @ h.T) + TINY)
    return w


def nmf(rows: DataFrame, k: int = 2, rounds: int = 100, tolerance: float = 1e-6, seed: int = 0, key: str = "id", vector: str = "x", keep_every: int = 16) -> tuple[DataFrame, np.ndarray, list[float]]:
    """rows: key (a whole number), vector (non-negative components, one length). The rows with weights (array of k), the components (k, length), and the squared error before each round: it never grows.

    Multiplicative updates: rows update their weights by the components; the components then follow from two sums over all rows, weights by vectors and weights by weights. Weights are no
    table of their own: a row computes them anew from its last kept ones and the components since, and every keep_every rounds they are written. Null vectors are left out; a table without rows has no components."""
    now = shared(rows.select(F.col(key).cast("long").alias("_key"), F.col(vector).alias("_x"), F.lit(None).cast("array<double>").alias("_w")).where(F.col(vector).isNotNull()))
    total = _sum(now, lambda b: np.concatenate(([b.num_rows], _matrix(b["_x"]).sum(axis=0))))
    if total is None:
        return rows.withColumn("weights", F.lit(None).cast("array<double>")).limit(0), np.empty((k, 0)), []
    d = len(total) - 1
    h = (0.1 + np.random.default_rng(seed).random((k, d))) * (total[1:] / total[0] + TINY) / k
    history, errors = [h], []

    def of(b: pa.RecordBatch, history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        x = _matrix(b["_x"])
        w = start_weights(np.asarray(b["_key"]), k, seed) if b["_w"].null_count else _matrix(b["_w"])
        return x, _weights(x, w, history)

    for _ in range(rounds):

        def sums(b: pa.RecordBatch, history: list[np.ndarray] = history) -> np.ndarray:
            x, w = of(b, history)
            return np.concatenate((((x - w @ history[-1]) ** 2).sum(keepdims=True).ravel(), (w.T @ x).ravel(), (w.T @ w).ravel()))

        total = _sum(now, sums)
        errors.append(float(total[0]))
        if len(errors) > 1 and errors[-2] - errors[-1] <= tolerance * errors[0]:
            break
        by_x, by_w = total[1 : 1 + k * d].reshape(k, d), total[1 + k * d :].reshape(k, k)
        if len(history) >= keep_every:
            now, history = shared(_with_weights(now, history, of)), []
        h = h * by_x / (by_w @ h + TINY)
        history = [*history, h]
    done = _with_weights(now, history, of).select(F.col("_key").alias(key), F.col("_w").alias("weights"))
    return done, h, errors


def _with_weights(now: DataFrame, history: list[np.ndarray], of: Callable) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, w = of(b, history)
            yield pa.record_batch([b["_key"], b["_x"], pa.array(list(w), pa.list_(pa.float64()))], ["_key", "_x", "_w"])

    return now.mapInArrow(run, now.schema)


# --- support vector machine ------------------------------------------------------------------------------------------------


class RadialMachine:
    """Features by landmarks and a hyperplane in them: decision > 0 is the class 1."""

    def __init__(self, landmarks: np.ndarray, gamma: float):
        self.landmarks, self.gamma = landmarks, gamma
        values, vectors = np.linalg.eigh(self._kernel(landmarks))
        keep = values > 1e-10 * values.max()
        self.root = vectors[:, keep] / np.sqrt(values[keep])
        self.plane = np.zeros(self.root.shape[1] + 1)

    def _kernel(self, x: np.ndarray) -> np.ndarray:
        d = (x**2).sum(axis=1)[:, None] - 2 * x @ self.landmarks.T + (self.landmarks**2).sum(axis=1)
        return np.exp(-self.gamma * np.maximum(d, 0))

    def features(self, x: np.ndarray) -> np.ndarray:
        f = self._kernel(x) @ self.root
        return np.concatenate((f, np.ones((len(f), 1))), axis=1)

    def decision(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.plane

    def score(self, df: DataFrame, vector: str = "x", name: str = "decision") -> DataFrame:
        """df with the decision; NULL for null vectors."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                some = np.asarray(b[vector].is_valid())
                out = np.full(b.num_rows, np.nan)
                if some.any():
                    out[some] = self.decision(_matrix(b[vector].filter(pa.array(some))))
                yield pa.record_batch([*b.columns, pa.array(out, from_pandas=True)], [*b.schema.names, name])

        return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))


def fit_radial_machine(rows: DataFrame, cost: float = 1.0, gamma: float | None = None, landmarks: int = 200, rounds: int = 40, width: float = 1e-2, key: str = "id", vector: str = "x", label: str = "label") -> RadialMachine:
    """rows: key, vector, label (0 or 1). A support vector machine with the kernel exp(-gamma |x - y|^2) and hinge loss.

    The kernel is that of Nystroem: `landmarks` rows (those of the smallest hash of the key; a documented sample, the training sees every row) span the features. Newton's
    method on the sum over all rows: gradient and second derivatives are sums of landmarks squared; the step is the best of several that one more pass tries. The corner of the hinge is rounded over `width`; the offset is a weight like the others.
    gamma: by default 1 / (components x variance). Null vectors or labels are left out."""
    data = rows.select(F.col(vector).alias("_x"), F.col(label).cast("double").alias("_y"), F.xxhash64(key).alias("_h")).where(F.col(vector).isNotNull() & F.col(label).isNotNull())
    chosen = np.array([r["_x"] for r in data.orderBy("_h").limit(landmarks).collect()], float)
    if not len(chosen):
        raise ValueError("no rows to learn from")
    if gamma is None:
        n, s, q = _sum(data, lambda b: np.array([(x := _matrix(b["_x"])).size, x.sum(), (x**2).sum()]))
        gamma = 1 / (chosen.shape[1] * max(q / n - (s / n) ** 2, TINY))
    machine = RadialMachine(chosen, gamma)
    size = len(machine.plane)
    steps = 2.0 ** -np.arange(10)

    def hinge(margin: np.ndarray) -> np.ndarray:
        z = 1 - margin
        return np.where(z >= width, z - width / 2, np.where(z > 0, z * z / (2 * width), 0))

    for _ in range(rounds):
        plane = machine.plane

        def slopes(b: pa.RecordBatch, plane: np.ndarray = plane) -> np.ndarray:
            f, y = machine.features(_matrix(b["_x"])), 2 * np.asarray(b["_y"]) - 1
            z = 1 - y * (f @ plane)
            first, second = np.clip(z / width, 0, 1), ((z > 0) & (z < width)) / width
            return np.concatenate((-(f.T @ (first * y)), ((f.T * second) @ f).ravel()))

        total = _sum(data, slopes)
        gradient = plane + cost * total[:size]
        curve = np.eye(size) + cost * total[size:].reshape(size, size)
        way = -np.linalg.solve(curve, gradient)
        tried = plane + steps[:, None] * way
        losses = _sum(data, lambda b, tried=tried: hinge((2 * np.asarray(b["_y"]) - 1)[:, None] * (machine.features(_matrix(b["_x"])) @ np.vstack((tried, plane)).T)).sum(axis=0))
        value = cost * losses + 0.5 * (np.vstack((tried, plane)) ** 2).sum(axis=1)
        best = int(value[:-1].argmin())
        if value[best] >= value[-1] * (1 - 1e-7):
            break
        machine.plane = tried[best]
    return machine
