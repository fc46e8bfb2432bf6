"""Helpers shared by the training-data operators: table reading, shared storage, byte-level word hashing."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters that are neither a space nor one of the five ASCII control characters TAB to CR.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset (tests, local runs)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = tempfile.mkdtemp(prefix="orbitlake-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: With it, Spark drops the shuffle files of an execution at its end, not when the driver happens to collect its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: The folders of the scratch() that run.
_SCRATCH: list[str] = []


def materialize(df: DataFrame, tag: str, folder: str | None = None) -> DataFrame:
    """Writes df as Parquet to the shared folder (or another one) and reads it back: cuts lineage so that a lost executor costs no more than its tasks. The write's shuffle files go at its end."""
    spark = df.sparkSession
    path = f"{folder or (_SCRATCH or [shared_dir(spark)])[-1]}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes the files of a materialized table that no later step reads."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """What is materialized inside, without a folder, goes at the end. Gives the folder for what stays."""
    outside = (_SCRATCH or [shared_dir(spark)])[-1]
    _SCRATCH.append(f"{outside}/scratch-{uuid.uuid4().hex}")
    try:
        yield outside
    finally:
        _delete(spark, _SCRATCH.pop())


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words of a text, native."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


# --- byte-level hashing, for the operators that run in Arrow batches -------------------------------------------------

_STEP = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Words longer than this are hashed one by one.
_LONG = 64


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _tables(lower: bool) -> np.ndarray:
    t = mix64(np.arange(1, 257, dtype=np.uint64) * _STEP)
    if lower:
        t[65:91] = t[97:123]
    return t


_TABLES = {False: _tables(False), True: _tables(True)}
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
_R = 0xD6E8FEB86659FD93
_R_INV = pow(_R, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        p = np.full(size, base, np.uint64)
        p[0] = 1
        _POWERS[base] = np.multiply.accumulate(p)
    return _POWERS[base][:n]


def word_hashes(data: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of data, and where each starts and ends in it. lower: A-Z count as a-z."""
    buf = np.frombuffer(data, np.uint8)
    inside = np.empty(len(buf) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_IS_BLANK[buf], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.empty(0, np.uint64), start, end
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_TABLES[lower][buf] * _powers(_R, len(buf)), out=total[1:])
    h = (total[end] - total[start]) * _powers(_R_INV, len(buf))[start]
    h = mix64(h + (end - start).astype(np.uint64) * _STEP)
    for i in np.flatnonzero(end - start > _LONG):
        word = data[start[i] : end[i]]
        h[i] = xxhash.xxh3_64_intdigest(word.lower() if lower else word)
    return h, start, end


def texts_words(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of many texts at once, and bounds: text i has words bounds[i]:bounds[i + 1]."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    h, start, _ = word_hashes(b" ".join(texts), lower)
    return h, np.concatenate(([0], np.searchsorted(start, np.cumsum(sizes))))


def chunks(texts: list, limit: int = 2 << 20):
    """Index ranges of texts of about limit bytes each; a longer text stands alone. Hashing takes some forty bytes a byte of text."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if texts:
        yield begin, len(texts)


def runs_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word runs that start at each word (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mix64(out * _STEP + h[j : j + n])
    return out


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bounds the Arrow batches that Python workers get: a batch holds whole texts or sets, some of them very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def give_back() -> None:
    """Returns what Arrow and the C library hold on to, unused, to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run):
    """run, for mapInArrow, with unused memory given back at the task's end: workers live on, and later steps run in them."""

    def inner(batches):
        yield from run(batches)
        give_back()

    return inner


#: A key of more rows than this, and than 1 / MANY_KEYS of all rows, is hot: there are MANY_KEYS of them at most.
HOT_ROWS, MANY_KEYS = 10_000, 100_000


def join_skewed(left: DataFrame, right: DataFrame, key: str, right_key: str, n: str, rows: int) -> DataFrame:
    """left joined to right, which has one row a key and in n the rows that left has of it; rows: those of left, about. Nulls match. Rows of hot keys
    stay where they are: the hot part of right is broadcast, MANY_KEYS rows at most; the rest meets by key."""
    limit = max(HOT_ROWS, rows // MANY_KEYS)
    same = F.col(key).eqNullSafe(F.col(right_key))
    hot = F.broadcast(right.where(F.col(n) > limit))
    rest = left.join(hot.select(right_key), same, "left_anti").join(right.where(F.col(n) <= limit), same)
    return left.join(hot, same).unionByName(rest)


#: Bits of a bit map, as a power of two. A row has 64 of them, so that a map of any number of keys has 262,144 rows at most.
MAP_BITS = 24


def _bit(key: str) -> Column:
    return F.xxhash64(key).bitwiseAND((1 << MAP_BITS) - 1)


def bit_map(keys: DataFrame, key: str) -> DataFrame:
    """A bit for each key, a null one too, by its hash: _word, _bits."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _bit(key).bitwiseAND(63).cast("int"))
    return keys.groupBy(F.shiftright(_bit(key), 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def mapped(df: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """df with _mapped: false only for keys that are not in the bit map, which is broadcast; the more keys that has, the more others get true. Rows stay where they are."""
    out = df.join(F.broadcast(bits), F.shiftright(_bit(key), 6) == F.col("_word"), "left")
    got = F.call_function("shiftright", F.col("_bits"), _bit(key).bitwiseAND(63).cast("int")).bitwiseAND(1) == 1
    return out.withColumn("_mapped", F.coalesce(got, F.lit(False))).drop("_word", "_bits")


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """edges: a, b (long). Connected components: node, root (the smallest node of its component), for the nodes that have edges. Large-star
    and small-star steps in turn, until nothing changes; each step's edges are written to the shared folder."""

    def least(e: DataFrame) -> DataFrame:
        low = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("_u", "m").alias("m"))
        return e.join(low, e["u"] == low["_u"]).drop("_u")

    def sums(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("a", "b"), 30))).first()

    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), tag)
    before = None
    while (state := sums(now)) != before:
        before = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = least(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = least(down)
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
        last, now = now, materialize(small.where("a <> b").distinct(), tag)
        forget(last)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
