"""Compression of vectors to short codes, exact in whole numbers, with segment-mean lower bounds.

A vector of integers is cut into equal parts; each part is named by the nearest entry of its codebook. The nearest entry
is searched coarse to fine: of a part and an entry, the means of one block, then of two, four and so on, and the norms of
what the means leave over, bound their distance from below. Entries whose bound is above the distance to the entry that
looks best are left out, which never loses the nearest one; the survivors receive their exact integer distance.

Codebooks have a fixed size (entries x components), so they travel to the tasks, and what a task adds up for a round has
that size too. Vectors are read in each round and never moved; only a last join by label shuffles codes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import join_skewed, materialize, read

#: Parts of a vector, entries of a codebook (256 at most: two hex digits), rounds of assignment and replacement, and units to 1.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Parts that are compared with all entries at a time.
BLOCK = 4096
#: Relative rounding error of a residual norm, with much to spare.
SLACK = 1e-12


def complete(x: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    return x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def limit(length: int) -> int:
    """Largest component for which squared distances of whole vectors fit 64 bits."""
    return math.isqrt((1 << 62) // max(length, 1)) // 2


def to_parts(vectors: list, parts: int) -> np.ndarray:
    """Vectors of one length as integers, cut: (vectors, parts, width). Zeros fill the last part where parts do not divide the length."""
    x = np.asarray(vectors, np.float64).reshape(len(vectors), len(vectors[0]) if vectors else 0)
    most = limit(x.shape[1])
    x = np.clip(np.floor(x * SCALE), -most, most).astype(np.int64)
    width = max(1, -(-x.shape[1] // parts))
    return np.pad(x, ((0, 0), (0, parts * width - x.shape[1]))).reshape(len(x), parts, width)


class Blocks:
    """Sums of equal blocks of points, and the norms of what the block means leave over, for one block, two, four and so on up to half the width."""

    def __init__(self, points: np.ndarray):
        self.points = points
        width, n = points.shape[1], 1
        self.levels = []
        while n == 1 or n < width:
            bounds = np.arange(n) * width // n
            size = np.diff(np.append(bounds, width))
            sums = np.add.reduceat(points, bounds, axis=1)
            over = sum((k * (points[:, a : a + k] ** 2).sum(axis=1) - sums[:, i] ** 2) / k for i, (a, k) in enumerate(zip(bounds, size)))
            self.levels.append((sums, size, np.sqrt(np.maximum(over, 0))))
            n *= 2


def bound(x: tuple, c: tuple, rows, columns) -> np.ndarray:
    """At most the squared distance of the points rows of x and columns of c, of one level."""
    (a, size, r), (b, _, s) = x, c
    apart = np.maximum(np.abs(r[rows] - s[columns]) - SLACK * (r[rows] + s[columns]), 0) ** 2
    for i, k in enumerate(size):
        apart = apart + (a[rows, i] - b[columns, i]).astype(np.float64) ** 2 / k
    return apart * (1 - SLACK)


def nearest(points: np.ndarray, entries: Blocks) -> tuple[np.ndarray, np.ndarray, int]:
    """For each point (n, width) the index of its nearest entry, the smaller one of equals, and their squared distance, exactly; and how many exact distances that took."""
    x, n, m = Blocks(points), len(points), len(entries.points)
    exact = lambda rows, columns: ((points[rows] - entries.points[columns]) ** 2).sum(axis=1)
    low = bound(x.levels[0], entries.levels[0], np.arange(n)[:, None], np.arange(m)[None, :])
    most = exact(np.arange(n), low.argmin(axis=1))
    rows, columns = np.nonzero(low <= most[:, None])
    for a, b in zip(x.levels[1:], entries.levels[1:]):
        stay = bound(a, b, rows, columns) <= most[rows]
        rows, columns = rows[stay], columns[stay]
    apart = exact(rows, columns)
    first = np.searchsorted(rows, np.arange(n))  # the best looking entry stays, so every point has a survivor
    best = np.minimum.reduceat(apart, first) if n else apart
    at = np.flatnonzero(apart == best[rows])
    return columns[at[np.searchsorted(rows[at], np.arange(n))]], best, len(rows) + n


def assign(x: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x: (vectors, parts, width); codebooks: (parts, entries, width). Index and squared distance for each part of each vector."""
    code, error = np.empty(x.shape[:2], np.int64), np.empty(x.shape[:2], np.int64)
    for p in range(x.shape[1]):
        entries = Blocks(codebooks[p])
        for i in range(0, len(x), BLOCK):
            code[i : i + BLOCK, p], error[i : i + BLOCK, p], _ = nearest(x[i : i + BLOCK, p], entries)
    return code, error


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", keep: tuple[str, ...] = ()) -> DataFrame:
    """vec_id, vector and those of keep: complete vectors, of the length that the one of the smallest id has."""
    kept = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), *keep).where(complete(F.col("vector")))
    length = kept.agg(F.min_by(F.size("vector"), F.struct(F.col("vec_id").isNull(), "vec_id", "vector"))).first()[0]
    return kept.where(F.size("vector") == F.lit(length or 0))


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """kept: what usable gives. Codebooks (parts, entries, width); None without rows. They start as the vectors of the smallest ids, nulls last, repeated ids by their components;
    there are fewer entries where there are fewer rows."""
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not start:
        return None
    books = to_parts([r["vector"] for r in start], parts).swapaxes(0, 1)
    sums = "part int, entry int, position int, n long, total long"
    for _ in range(rounds):

        def add(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            n, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
            for b in batches:
                x = to_parts(b["vector"].to_pylist(), parts)
                code, _ = assign(x, books)
                for p in range(parts):
                    n[p] += np.bincount(code[:, p], minlength=books.shape[1])
                    np.add.at(total[p], code[:, p], x[:, p])
            p, e, i = np.nonzero(np.broadcast_to(n[:, :, None] > 0, total.shape))
            yield pa.record_batch([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(i, pa.int32()), pa.array(n[p, e]), pa.array(total[p, e, i])], ["part", "entry", "position", "n", "total"])

        books = books.copy()
        # one row an entry's component: the size of the codebooks
        for r in kept.select("vector").mapInArrow(add, sums).groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            books[r["part"], r["entry"], r["position"]] = r["total"] // r["n"]
    return books


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """Adds code (two hex digits a part) and error (squared distance from the entries, summed over the parts); vector goes."""
    parts = books.shape[0]
    digits = np.array([f"{i:02x}" for i in range(books.shape[1])])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, error = assign(to_parts(b["vector"].to_pylist(), parts), books)
            rest = b.drop_columns(["vector"])
            yield pa.record_batch([*rest.columns, pa.array(["".join(r) for r in digits[at].tolist()], pa.string()), pa.array(error.sum(axis=1))], [*rest.schema.names, "code", "error"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "vector")
    return kept.mapInArrow(code, f"{kinds}, code string, error long")


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components in order, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vectors: vec_id, embedding, label; further columns are ignored, whatever their names. vec_id, code, error, label_error (error summed over equal labels, nulls are equal),
    codebooks_sha256.

    Vectors that are null or hold null or non-finite components are dropped, and those whose length is not that of the smallest vec_id's vector. Every other row is coded: repeated
    rows and null ids too. Components count in steps of 1 / SCALE up to limit(length) (524,288 at 64 components); larger ones are taken as that. An empty vector
    counts as zeros. A table without usable rows gives none."""
    kept = usable(vectors.withColumnRenamed(label, "label") if label != "label" else vectors, vec_id, vector, ("label",))
    books = train(kept, parts, entries, rounds)
    if books is None:
        kind = vectors.schema[vec_id].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    coded = materialize(encode(kept, books), "codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n"))
    out = join_skewed(coded, materialize(sums, "codes-labels"), "label", "_label", "_n", coded.count())
    return out.select("vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(read(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """For vectors of 64 components: parts of four."""
    apart = " + ".join(f"(x{i} - y{i}) * (x{i} - y{i})" for i in range(1, 5))
    ctes = []
    for k in range(ROUNDS + 1):
        ctes.append(f"a{k} AS (SELECT r, part, min(struct_pack(d := {apart}, entry := entry)) AS m FROM x JOIN b{k} USING (part) GROUP BY 1, 2)")
        if k < ROUNDS:
            floors = ", ".join(f"coalesce((s{i} - ((s{i} % n) + n) % n) // n, y{i}) AS y{i}" for i in range(1, 5))
            sums = ", ".join(f"CAST(sum(x{i}) AS BIGINT) AS s{i}" for i in range(1, 5))
            ctes.append(f"s{k} AS (SELECT part, m.entry AS entry, count(*) AS n, {sums} FROM a{k} JOIN x USING (r, part) GROUP BY 1, 2)")
            ctes.append(f"b{k + 1} AS (SELECT part, entry, {floors} FROM b{k} LEFT JOIN s{k} USING (part, entry))")
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS (SELECT r, part, {", ".join(f"v[4 * part + {i}] AS x{i}" for i in range(1, 5))} FROM kept, range(0, 16) t(part)),
b0 AS (SELECT part, r - 1 AS entry, {", ".join(f"x{i} AS y{i}" for i in range(1, 5))} FROM x WHERE r <= 64),
{", ".join(ctes)},
hash AS (SELECT sha256(string_agg(concat_ws(',', y1, y2, y3, y4), ',' ORDER BY part, entry)) AS h FROM b{ROUNDS}),
coded AS (SELECT r, string_agg(lpad(lower(to_hex(m.entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM kept JOIN coded USING (r), hash"""


ORACLE = _oracle()
