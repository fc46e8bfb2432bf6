"""Largest inner products by collision counting on query-aware hashes.

Each hash is one projection; a block of vectors keeps the sorted values of each. A query opens a window centred on its
own projection in every sorted array; a vector in the window collides. Windows grow or shrink by a constant ratio (virtual
rehashing: no other index is needed for another radius), and only the rings between two radii are counted. The smallest
radius at which enough vectors reach the threshold of collisions decides: those of them with the most collisions are
verified with the exact inner product. Inner products become distances by one more coordinate that gives all vectors the same norm; so that it stays small, a block
is searched in parts of like norms, each lifted to its own largest one.

Blocks are independent and of fixed size: any number of executors builds and searches them. Each block is moved to its
task once; a stated query set comes to it in parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import materialize, read, small_batches

#: Projections, collisions that make a candidate (share of them), first radius (in norms), growth of the radius.
PROJECTIONS, THRESHOLD, RADIUS, RATIO = 160, 0.85, 1.5, 1.15
#: Where more than so many times the wanted vectors tie, so many radii between two are tried.
MANY, FINER = 4, 5
#: Vectors that a query verifies in a part of a block: so many for each of the k nearest that is to be expected there, and so many besides; more where the last ones have equally many collisions.
PER_NEAREST, BESIDES = 6, 24
#: Vectors of a block, which moves as one; queries that come to it together.
BLOCK, QUERY_PART = 8192, 8192
#: A part of a block is searched as one: its largest norm is so many times its smallest at most, but for parts of fewer than LEAST vectors.
LIKE, LEAST = 1.5, 1024


def projections(dim: int, n: int, seed: int = 7) -> np.ndarray:
    """n rows of norm sqrt(dim); each dim of them are orthogonal, which spreads collisions less than independent ones."""
    rng, rows = np.random.default_rng(seed), []
    while sum(map(len, rows)) < n:
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        rows.append((q * np.sign(np.diag(r))).T)
    return np.concatenate(rows)[:n] * np.sqrt(dim)


def _lift(x: np.ndarray, norm: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(0.0, norm * norm - (x * x).sum(1, keepdims=True)))])


def build_block(ids: np.ndarray, x: np.ndarray, scale: float, norm: float, a: np.ndarray, k: int) -> tuple[bytes, ...]:
    """ids and vectors (float64) of a block, each pair once: distinct vectors (float32 where that loses nothing), the k + 1 smallest ids of each (no more can be among k
    nearest), sorted projections. scale: the largest component of the table, norm: the largest norm of the vectors in that scale."""
    distinct, inverse = np.unique(x, axis=0, return_inverse=True)
    order = np.lexsort((ids, inverse.ravel()))
    group = inverse.ravel()[order]
    start = np.searchsorted(group, np.arange(len(distinct)))
    keep = np.arange(len(order)) - start[group] <= k
    values = (_lift(distinct / scale, norm) @ a.T).T.astype(np.float32)
    by_value = np.argsort(values, axis=1, kind="stable")
    with np.errstate(over="ignore"):
        short = distinct.astype(np.float32)
    kept = short if (short == distinct).all() else distinct
    return kept.tobytes(), ids[order][keep].tobytes(), group[keep].astype(np.int32).tobytes(), np.take_along_axis(values, by_value, 1).tobytes(), by_value.astype(np.uint16).tobytes()


def search_block(queries: np.ndarray, n: int, values: np.ndarray, order: np.ndarray, norm: float, a: np.ndarray, enough: int) -> list[np.ndarray]:
    """Candidates (places among the n distinct vectors) of each query: those of the smallest radius that has enough of them, or all."""
    m, misses = len(a), len(a) - int(np.ceil(THRESHOLD * len(a)))
    if n <= enough:
        return [np.arange(n)] * len(queries)
    queries = queries / np.abs(queries).max(axis=1, keepdims=True)
    at = (np.hstack([queries * (norm / np.linalg.norm(queries, axis=1, keepdims=True)), np.zeros((len(queries), 1))]) @ a.T).astype(np.float32)

    def edges(active: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = np.empty((m, len(active)), np.int64), np.empty((m, len(active)), np.int64)
        for i in range(m):
            lo[i] = np.searchsorted(values[i], at[active, i] - radius, "left")
            hi[i] = np.searchsorted(values[i], at[active, i] + radius, "right")
        return lo, hi

    def ring(j: int, lo: np.ndarray, hi: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Collisions between the outer edges lo, hi and the inner ones low, high."""
        parts = [p for i in range(m) for p in (order[i, lo[i, j] : low[i, j]], order[i, high[i, j] : hi[i, j]])]
        return np.bincount(np.concatenate(parts), minlength=n).astype(np.int16)

    def best(missed: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Those of the hits with the most collisions."""
        c = missed[hits]
        return hits[c <= np.partition(c, enough - 1)[enough - 1]] if len(hits) > enough else hits

    def most(q: int, hits: np.ndarray) -> np.ndarray:
        return best(outside[q], hits)

    def refined(q: int, low: float, high: float) -> np.ndarray:
        """Where many tie at a radius that has enough hits (high), and the one before (low) has not: radii between them."""
        hits = found[q]
        for _ in range(FINER):
            if len(hits) <= MANY * enough:
                break
            middle = (low * high) ** 0.5
            missed = ring(0, zero[:, :1], whole[:, :1], *edges(np.array([q]), middle))
            some = np.flatnonzero(missed <= misses)
            if len(some) >= enough:
                hits, high = best(missed, some), middle
            else:
                low = middle
        return hits

    found: list = [None] * len(queries)
    order = order.astype(np.intp)
    outside = np.empty((len(queries), n), np.int16)  # what is outside is counted, it is less
    every = np.arange(len(queries))
    first = edges(every, RADIUS * norm)
    zero, whole = np.zeros_like(first[0]), np.full_like(first[0], n)
    grow, shrink = [], []
    for q in every:
        outside[q] = ring(q, zero, whole, *first)
        hits = np.flatnonzero(outside[q] <= misses)
        found[q] = most(q, hits)
        (shrink if len(hits) >= enough else grow).append(q)
    for active, ratio in ((np.array(grow, np.int64), RATIO), (np.array(shrink, np.int64), 1 / RATIO)):
        radius, (low, high) = RADIUS * norm, (e[:, active] for e in first)
        while len(active):
            radius *= ratio
            lo, hi = edges(active, radius)
            rest = []
            for j, q in enumerate(active):
                outside[q] += ring(j, lo, hi, low, high) * np.int16(-1) if ratio > 1 else ring(j, low, high, lo, hi)
                hits = np.flatnonzero(outside[q] <= misses)
                if ratio > 1:
                    found[q] = most(q, hits)
                    done = len(hits) >= enough or (lo[:, j] == 0).all() and (hi[:, j] == n).all()
                else:
                    done = len(hits) < enough
                    found[q] = found[q] if done else most(q, hits)
                    done = done or bool((lo[:, j] >= hi[:, j]).all()) or radius < 1e-6 * norm
                if not done:
                    rest.append(j)
                elif len(found[q]) > MANY * enough:
                    found[q] = refined(q, radius / ratio if ratio > 1 else radius, radius if ratio > 1 else radius / ratio)
            active, low, high = active[rest], lo[:, rest], hi[:, rest]
    return found


def cuts(norms: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of parts of like norms; norms ascend."""
    i = 0
    while i < len(norms):
        j = max(int(np.searchsorted(norms, norms[i] * LIKE, side="right")), i + LEAST)
        j = len(norms) if len(norms) - j < LEAST else j
        while j - i > 1 << 15:  # places are uint16
            yield i, i + (1 << 15)
            i += 1 << 15
        yield i, j
        i = j


def beyond(product: float, norm, dim: int):
    """Share of vectors of that norm, in random directions, whose inner product with a vector of norm 1 is above product."""
    return 0.5 * np.vectorize(math.erfc, otypes=[float])(product * math.sqrt(dim / 2) / np.maximum(norm, 1e-300))


def expected_product(norms: np.ndarray, counts: np.ndarray, k: int, dim: int) -> float:
    """The inner product above which k of the vectors are to be expected, in random directions: counts of vectors by norm."""
    low, high = -float(norms.max(initial=0.0)) * 40, float(norms.max(initial=0.0)) * 40
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if (counts * beyond(middle, norms, dim)).sum() > k else (low, middle)
    return high


class Index:
    """Blocks of an index over all valid rows: those whose vector is not null, not zero, of the table's commonest length, and finite in each component."""

    def __init__(self, table: DataFrame, k: int = 20, id_col: str = "vec_id", vector: str = "embedding", n_projections: int = PROJECTIONS):
        spark = table.sparkSession
        small_batches(spark)
        v = F.transform(F.col(vector), lambda x: x.cast("double"))
        rows = table.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & F.col("vec_id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        # norms are taken in the scale of the largest component, so that no square overflows
        rows = rows.withColumn("_most", F.array_max(F.transform("v", lambda x: F.abs(x)))).where("_most > 0")
        sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max("_most").alias("most")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
        self.k = k
        self.dim, self.rows, self.scale = (sizes[0]["d"], sizes[0]["n"], sizes[0]["most"]) if sizes else (1, 0, 1.0)
        self.valid = rows.where(F.size("v") == self.dim).select("vec_id", "v")
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / self.scale) * (x / self.scale)))
        steps = self.valid.groupBy(F.floor(F.log2(F.greatest(norm, F.lit(2.0**-500))) * 64).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()  # norms within one per cent are one row
        self.product = expected_product(2.0 ** (np.array([r["step"] for r in steps]) / 64), np.array([r["n"] for r in steps], float), k, self.dim)
        self.n_blocks = max(1, -(-self.rows // BLOCK))
        dim, scale, a = self.dim, self.scale, projections(self.dim + 1, n_projections)
        self.a = a

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, ids, x in _gathered(batches, dim):
                norms = np.linalg.norm(x / scale, axis=1)
                by_norm = np.argsort(norms, kind="stable")
                parts = [by_norm[i:j] for i, j in cuts(norms[by_norm])]
                cols = zip(*[build_block(ids[own], x[own], scale, float(norms[own].max()), a, k) for own in parts])
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([[float(norms[own].max()) for own in parts]]), *(pa.array([list(c)], pa.list_(pa.binary())) for c in cols)], names=["block", "norm", "distinct", "ids", "groups", "sorted", "places"])

        dealt = self.valid.distinct().withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(self.n_blocks)).cast("int")).repartition(self.n_blocks, "block").select("block", "vec_id", "v")
        self.blocks = materialize(dealt.mapInArrow(build, "block int, norm array<double>, distinct array<binary>, ids array<binary>, groups array<binary>, sorted array<binary>, places array<binary>"), "ann-index")

    def search(self, queries: DataFrame) -> DataFrame:
        """queries: rows of valid (vec_id, v). Each query's k nearest found: query_id, rank (from 1), vec_id, score; its own id is no candidate."""
        found = self.verified(queries).select("query_id", F.explode("hits").alias("h")).select("query_id", "h.*").distinct()
        found = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= self.k)
        return found.select("query_id", "rank", "vec_id", "score")

    def verified(self, queries: DataFrame) -> DataFrame:
        """Per query and block: query_id, n_verified (distinct vectors whose product was taken), hits: the k best as structs of vec_id and score."""
        dim, a, k, product = self.dim, self.a, self.k, self.product
        n = max(1, -(-queries.count() // QUERY_PART))

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, ids, x in _gathered(batches, dim):
                for i in range(0, len(ids), QUERY_PART):
                    yield pa.RecordBatch.from_arrays([pa.array([ids[i : i + QUERY_PART].tobytes()], pa.binary()), pa.array([x[i : i + QUERY_PART].tobytes()], pa.binary())], names=["query_ids", "query_vectors"])

        asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(n)).cast("int")).repartition(n, "block").select("block", "vec_id", "v").mapInArrow(gather, "query_ids binary, query_vectors binary")
        asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(self.n_blocks - 1))))
        # a block goes to its task once, the queries' parts come to it; more partitions than blocks, so that few blocks share one
        tasks = 2 * self.n_blocks
        pairs = self.blocks.repartition(tasks, "block").join(asked.repartition(tasks, "block").hint("shuffle_hash"), "block")

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    column = lambda c: batch.column(batch.schema.get_field_index(c))[row]
                    query_ids = np.frombuffer(column("query_ids").as_buffer(), np.int64)
                    x = np.frombuffer(column("query_vectors").as_buffer(), np.float64).reshape(-1, dim)
                    looked, best = np.zeros(len(x), np.int64), [[] for _ in x]
                    for part, norm in enumerate(column("norm").as_py()):
                        get = lambda c, kind: np.frombuffer(column(c)[part].as_buffer(), kind)  # noqa: B023, E731
                        ids, groups = get("ids", np.int64), get("groups", np.int32)
                        values, places = get("sorted", np.float32).reshape(len(a), -1), get("places", np.uint16).reshape(len(a), -1)
                        short = len(column("distinct")[part].as_buffer()) == 4 * dim * values.shape[1]
                        distinct = get("distinct", np.float32 if short else np.float64).reshape(-1, dim)
                        begin = np.searchsorted(groups, np.arange(len(distinct) + 1))
                        enough = int(np.ceil(PER_NEAREST * len(ids) * float(beyond(product, norm, dim)))) + BESIDES
                        for i in range(0, len(x), 256):
                            for j, hits in enumerate(search_block(x[i : i + 256], len(distinct), values, places, norm, a, enough), i):
                                with np.errstate(over="ignore", invalid="ignore"):
                                    score = (distinct[hits].astype(np.float64) * x[j]).sum(1)
                                best[j].append(_best(query_ids[j], hits, score, ids, begin, k))
                                looked[j] += len(hits)
                    merged = [_merged(b, k) for b in best]
                    hits = pa.StructArray.from_arrays([pa.array(np.concatenate([m[i] for m in merged])) for i in (0, 1)], names=["vec_id", "score"])
                    ends = pa.array(np.cumsum([0, *(len(m[0]) for m in merged)]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(query_ids), pa.array(looked, pa.int32()), pa.ListArray.from_arrays(ends, hits)], names=["query_id", "n_verified", "hits"])

        return pairs.mapInArrow(search, "query_id bigint, n_verified int, hits array<struct<vec_id: bigint, score: double>>")


def _best(own: int, hits: np.ndarray, score: np.ndarray, ids: np.ndarray, begin: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best ids and scores of the distinct vectors hits; vector h has the ids ids[begin[h]:begin[h + 1]]."""
    # the best distinct vectors and all that tie with the last; more of them, while own and repeated (id, score) leave fewer than k
    need = k + 1
    while True:
        some, value = hits, score
        if len(hits) > need:
            best = score >= np.partition(score, len(score) - need)[len(score) - need]
            some, value = hits[best], score[best]
        member = np.concatenate([ids[begin[h] : begin[h + 1]] for h in some]) if len(some) else ids[:0]
        value = np.repeat(value, begin[some + 1] - begin[some])
        member, value = member[member != own], value[member != own]
        top = np.lexsort((member, -value))
        fresh = np.ones(len(top), bool)
        fresh[1:] = (member[top][1:] != member[top][:-1]) | (value[top][1:] != value[top][:-1])
        top = top[fresh][:k]
        if len(top) == k or len(some) == len(hits):
            return member[top], value[top]
        need *= 2


def _merged(parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of several lists of ids and scores; the same (id, score) counts once."""
    if len(parts) == 1:
        return parts[0]
    member, score = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    top = np.lexsort((member, -score))
    fresh = np.ones(len(top), bool)
    fresh[1:] = (member[top][1:] != member[top][:-1]) | (score[top][1:] != score[top][:-1])
    top = top[fresh][:k]
    return member[top], score[top]


def _gathered(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """block, ids and vectors of each block in a partition; columns: block, id, vector."""
    held: dict[int, list] = {}
    for batch in batches:
        block, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        x = batch.column(2).flatten().to_numpy().reshape(-1, dim)
        for b in np.unique(block):
            held.setdefault(int(b), []).append((ids[block == b], x[block == b]))
    for b, parts in held.items():
        ids, x = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((*x.T[:1], ids))
        yield b, ids[order].astype(np.int64), x[order]


def nearest(table: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Queries: the valid rows whose id is divisible by every. query_id, rank, vec_id, score (inner product, double), ties to the smaller id.

    Null ids, and vectors that are null, zero, not finite throughout or of another length than most, take no part. Rows that repeat one id with several vectors are
    candidates each; the same (id, score) counts once. Fewer than k candidates: all are returned. An empty table gives no rows. Other columns are not read."""
    index = Index(table, k, id_col, vector)
    return index.search(index.valid.where(F.col("vec_id") % every == 0))


def op4_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))
