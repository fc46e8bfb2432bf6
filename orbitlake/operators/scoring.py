"""Pluggable scorers over Arrow batches, ensembles, and reports on predictions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import portable_hash

#: name -> function of a matrix (rows: samples) to the probability of the positive class.
SCORERS: dict[str, Callable[[np.ndarray], np.ndarray]] = {}


def register_scorer(name: str, fn: Callable[[np.ndarray], np.ndarray]) -> None:
    SCORERS[name] = fn


def logistic(weights: Sequence[float], bias: float = 0.0) -> Callable[[np.ndarray], np.ndarray]:
    """A deterministic scorer: a logistic function of the weighted sum."""
    w = np.asarray(weights, float)
    return lambda x: 1 / (1 + np.exp(-(x @ w + bias)))


def score(df: DataFrame, vector: Column, scorer: str | Callable[[np.ndarray], np.ndarray], name: str = "p") -> DataFrame:
    """Adds the probability of each row's vector; NULL where the vector or one of its elements is missing. The model goes to the tasks with the function."""
    fn = SCORERS[scorer] if isinstance(scorer, str) else scorer

    @F.pandas_udf("double")
    def run(vectors: pd.Series) -> pd.Series:
        good = vectors.map(lambda v: v is not None and not np.isnan(np.asarray(v, float)).any())
        out = pd.Series(np.nan, index=vectors.index, dtype="float64")
        if good.any():
            out[good] = fn(np.stack([np.asarray(v, float) for v in vectors[good]]))
        return out.where(good, None)

    whole = F.when(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull()), vector)
    return df.withColumn(name, F.nullif(run(whole), F.lit(float("nan"))))


def score_logistic(vector: Column, weights: Sequence[float], bias: float = 0.0) -> Column:
    """The logistic scorer as an expression, without Python."""
    z = F.aggregate(F.zip_with(vector, F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w), F.lit(float(bias)), lambda s, x: s + x)
    return 1 / (1 + F.exp(-z))


def ensemble(df: DataFrame, keys: Sequence[str], method: str = "median", value: str = "p") -> DataFrame:
    """One row a model and key to one a key."""
    return df.groupBy(*keys).agg({"median": F.median, "mean": F.avg}[method](value).alias(value))


def majority(df: DataFrame, keys: Sequence[str], vote: str = "vote") -> DataFrame:
    """Majority of 0/1 votes (ties: 0) and their disagreement, the population standard deviation."""
    return df.groupBy(*keys).agg((F.avg(vote) > 0.5).cast("int").alias("vote"), F.stddev_pop(vote).alias("disagreement"))


def confusion(df: DataFrame, threshold: float, label: str = "label", p: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    """tp, tn, fp, fn at p > threshold, and their rates."""
    hit, pos = F.col(p) > threshold, F.col(label) == 1
    out = df.groupBy(*keys).agg(F.count_if(hit & pos).alias("tp"), F.count_if(~hit & ~pos).alias("tn"), F.count_if(hit & ~pos).alias("fp"), F.count_if(~hit & pos).alias("fn"))
    return out.withColumn("tpr", F.try_divide("tp", F.col("tp") + F.col("fn"))).withColumn("tnr", F.try_divide("tn", F.col("tn") + F.col("fp")))


def outcome(label: Column, p: Column, threshold: float) -> Column:
    """TP, TN, FP or FN."""
    hit = p > threshold
    return F.when(hit & (label == 1), "TP").when(hit, "FP").when(label == 1, "FN").otherwise("TN")


def classification_report(df: DataFrame, threshold: float, label: str = "label", p: str = "p") -> DataFrame:
    """class (0, 1, accuracy, macro avg, weighted avg), precision, recall, f1, support. An undefined ratio is 0. One pass over the rows."""
    c = confusion(df, threshold, label, p).select("tp", "tn", "fp", "fn")
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    per = lambda name, t, f_pos, f_neg: F.struct(F.lit(name).alias("class"), zero(t, t + f_pos).alias("precision"), zero(t, t + f_neg).alias("recall"), (t + f_neg).cast("double").alias("support"))
    rows = c.select("*", F.array(per("0", F.col("tn"), F.col("fn"), F.col("fp")), per("1", F.col("tp"), F.col("fp"), F.col("fn"))).alias("k"))
    rows = rows.withColumn("k", F.transform("k", lambda r: F.struct(r["class"].alias("class"), r["precision"].alias("precision"), r["recall"].alias("recall"), zero(2 * r["precision"] * r["recall"], r["precision"] + r["recall"]).alias("f1"), r["support"].alias("support"))))
    n = F.get("k", 0)["support"] + F.get("k", 1)["support"]
    macro = lambda f: (F.get("k", 0)[f] + F.get("k", 1)[f]) / 2
    weighted = lambda f: zero(F.get("k", 0)[f] * F.get("k", 0)["support"] + F.get("k", 1)[f] * F.get("k", 1)["support"], n)
    acc = zero(F.col("tp") + F.col("tn"), n)
    line = lambda name, f: F.struct(F.lit(name).alias("class"), f("precision").alias("precision"), f("recall").alias("recall"), f("f1").alias("f1"), n.alias("support"))
    every = F.concat("k", F.array(line("accuracy", lambda _: acc), line("macro avg", macro), line("weighted avg", weighted)))
    return rows.select(F.explode(every).alias("r")).select("r.class", "r.precision", "r.recall", "r.f1", F.col("r.support").cast("long").alias("support"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (classes * n_class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()  # one row
    return counts.withColumn("weight", F.lit(float(total[0] or 0)) / (F.lit(total[1]) * F.col("n")))


def stable_split(df: DataFrame, share: float = 0.2, key: str = "id", seed: int = 42) -> DataFrame:
    """Adds is_test by a hash of the key: the same row falls the same way in every run and every partitioning."""
    return df.withColumn("is_test", portable_hash(F.lit(seed), key) % 10_000 < int(share * 10_000))


def weak_labels(df: DataFrame, vote: Column, disagreement: Column, pixel: Column, svm: Column) -> DataFrame:
    """Soft label of a patch: the ensemble's prior updated by the pixel classifier's vote (sensitivity 0.83, specificity 0.89) and by the support vector machine's (0.78, 0.90)."""
    from ..functions.spectral import bayes_update, vote_prior

    return df.withColumn("soft_label", bayes_update(bayes_update(vote_prior(vote, disagreement), pixel, 0.83, 0.89), svm, 0.78, 0.90))


#: Vectors of a block in best_match.
BLOCK = 2048


def best_match(df: DataFrame, key: str, vector: str, group: str) -> DataFrame:
    """key, best: each key's largest cosine similarity to a vector of another key in its group. Blocks of vectors meet in pairs, so any number of executors shares
    a large group. Null keys, groups and vectors take no part; vectors meet those of their own length; one without a norm has no similarity, and best is NULL
    where no other has one."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = df.select(F.col(key).alias("_key"), v.alias("_v"), F.col(group).alias("_group")).where(F.col("_key").isNotNull() & F.col("_group").isNotNull() & F.forall("_v", lambda x: x.isNotNull()))
    rows = rows.withColumn("_size", F.size("_v"))
    groups = rows.groupBy("_group", "_size").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_blocks"))
    dealt = rows.join(groups, ["_group", "_size"]).withColumn("_block", F.pmod(F.xxhash64("_key"), F.col("_blocks")).cast("int"))
    blocks = dealt.groupBy("_group", "_size", "_block").agg(F.collect_list(F.struct("_key", "_v")).alias("_m"))
    blocks = blocks.select("_group", "_size", "_block", F.col("_m._key").alias("_keys"), F.flatten("_m._v").alias("_x"))
    other = blocks.select("_group", "_size", F.col("_block").alias("_block2"), F.col("_keys").alias("_keys2"), F.col("_x").alias("_x2"))
    pairs = blocks.join(other, ["_group", "_size"]).repartition("_group", "_size", "_block", "_block2")
    kind = df.schema[key].dataType.simpleString()

    def unit(x, n: int) -> np.ndarray:
        x = np.asarray(x, float).reshape(n, -1)
        with np.errstate(divide="ignore", invalid="ignore"):
            return x / np.linalg.norm(x, axis=1, keepdims=True)

    def run(keys: pd.Series, x: pd.Series, keys2: pd.Series, x2: pd.Series) -> pd.Series:
        out = []
        for a, xa, b, xb in zip(keys, x, keys2, x2):
            s = unit(xa, len(a)) @ unit(xb, len(b)).T
            s[np.isnan(s) | (np.asarray(a)[:, None] == np.asarray(b)[None, :])] = -np.inf
            best = s.max(axis=1)
            out.append([{"key": k, "best": None if v == -np.inf else float(v)} for k, v in zip(a, best) if (np.asarray(b) != k).any()])
        return pd.Series(out)

    run.__annotations__ = {k: pd.Series for k in ("keys", "x", "keys2", "x2", "return")}
    # a row holds two blocks; Spark ends an Arrow batch at spark.sql.execution.arrow.maxBytesPerBatch (64 MB)
    found = pairs.select(F.explode(F.pandas_udf(run, f"array<struct<key:{kind},best:double>>")("_keys", "_x", "_keys2", "_x2")).alias("m"))
    return found.groupBy(F.col("m.key").alias(key)).agg(F.max("m.best").alias("best"))
