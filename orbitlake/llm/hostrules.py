"""Quality rules by host (native): document rules, failures summed by host, rates shrunk with an empirical beta prior, verdicts joined back.

All measures of a text are array expressions inside its row, so that words are never shuffled; what moves is a few
numbers a document, summed by host on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import WORD, join_skewed, materialize, read, text_or_empty

#: A document fails a rule of the method beyond these: symbols a word, share of repeated lines, mean word length.
SYMBOLS_A_WORD, DUP_LINES, WORD_LENGTH = 0.1, 0.3, (2.0, 20.0)
#: Limits of a host's failure rate, in standard deviations of the fitted prior above its mean, and the standard deviations of its posterior by which the shrunk rate has to be above a limit (1.645: it is
#: with a probability of 95 %). Beyond the first limit a host is suspect: its documents that fail any rule go. Beyond the second it is rejected with all its documents.
SUSPECT, REJECTED, SURE = 0.25, 2.0, 1.645


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column, k: int = 3) -> Column:
    """Number of words inside k-word windows that occur twice or more in the array, the first occurrence included."""

    def covered(found: Column) -> Column:  # found: ascending starts of the repeated windows
        steps = F.transform(found, lambda p, j: F.least(F.lit(k), F.coalesce(F.get(found, j + 1) - p, F.lit(k))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(s: Column) -> Column:
        same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
        hits = F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
        return _let(F.sort_array(F.transform(hits, lambda x: x["i"])), covered)

    def of_hashes(h: Column) -> Column:
        once = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(once, F.lit(0).cast("long")).otherwise(_let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), repeated))

    def of_words(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        return F.when(F.size(w) < k + 1, F.lit(0).cast("long")).otherwise(_let(grams, of_hashes))

    return _let(words, of_words)


def measures(docs: DataFrame, host: Column, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, host, those of keep, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long)."""
    body = text_or_empty(text)
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select("doc_id", host.alias("host"), *keep, F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("_w"), lines.alias("_l"), F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))
    long = lambda c, name: c.cast("long").alias(name)
    return rows.select("doc_id", "host", *keep, long(F.size("_w"), "n_words"), long(F.length(F.array_join("_w", "")), "word_chars"), "n_symbols", long(F.size("_l"), "n_lines"), long(F.size("_l") - F.size(F.array_distinct("_l")), "n_dup_lines"), repeat_words(F.col("_w")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_failed() -> Column:
    mean = F.try_divide("word_chars", "n_words")
    return base_failed() | (F.col("n_symbols") > F.col("n_words") * SYMBOLS_A_WORD) | (F.col("n_dup_lines") > F.col("n_lines") * DUP_LINES) | ~F.coalesce(mean.between(*WORD_LENGTH), F.lit(False))


def host_verdicts(measured: DataFrame, suspect: float = SUSPECT, rejected: float = REJECTED, sure: float = SURE) -> DataFrame:
    """One row a host: host, n, failed, rate (shrunk), suspect, rejected. The prior Beta(a, b) has the mean of the hosts' raw rates, and of their variance what sampling does not explain: a binomial
    rate of n rows has mean (1 - mean) / n of its own. Where nothing is left (and with one host) all hosts have the mean, and none is suspect; a + b is 2 at least."""
    hosts = measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(rule_failed().cast("long")).alias("failed"))
    hosts = materialize(hosts, "hosts")
    raw = F.col("failed") / F.col("n")
    mean, var, inverse = hosts.agg(F.avg(raw), F.var_samp(raw), F.avg(1 / F.col("n"))).first()
    between = (var or 0.0) - (mean or 0.0) * (1 - (mean or 0.0)) * (inverse or 0.0)
    if between <= 1e-12:
        return hosts.withColumn("rate", F.lit(mean or 0.0)).withColumn("suspect", F.lit(False)).withColumn("rejected", F.lit(False))
    size = max(2.0, mean * (1 - mean) / between - 1)
    deviation = (mean * (1 - mean) / (size + 1)) ** 0.5
    hosts = hosts.withColumn("rate", (F.col("failed") + F.lit(mean * size)) / (F.col("n") + F.lit(size)))
    low = F.col("rate") - F.lit(sure) * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.lit(size + 1)))
    return hosts.withColumn("suspect", low > mean + suspect * deviation).withColumn("rejected", low > mean + rejected * deviation)


def judge(docs: DataFrame, host: Column, text: str = "text", keep: tuple[str, ...] = (), suspect: float = SUSPECT, rejected: float = REJECTED) -> DataFrame:
    """One row per input row: the measures, base_failed, host_rate and kept: false where the base rules fail, the host is rejected, or it is suspect and any rule fails.

    Nulls: a null text has no words and fails; a null host is a host of its own. Repeated rows count each. An empty table gives no rows. Other columns
    are ignored, whatever their names."""
    measured = materialize(measures(docs, host, text, keep), "measures")
    hosts = host_verdicts(measured, suspect, rejected).select(F.col("host").alias("_host"), F.col("n").alias("_n"), F.col("rate").alias("host_rate"), "suspect", "rejected")
    out = join_skewed(measured, hosts, "host", "_host", "_n", hosts.agg(F.sum("_n")).first()[0] or 0)
    goes = F.col("rejected") | F.col("suspect") & rule_failed()
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~goes).drop("_host", "_n", "suspect", "rejected")


def op6_hostrules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(read(spark, sf_dir, "documents"), F.col("source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = rf"""
WITH t AS (SELECT doc_id, source AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM t)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
m AS (
  SELECT t.doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM t LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
r AS (SELECT *, base_failed OR n_symbols > n_words * {SYMBOLS_A_WORD} OR n_dup_lines > n_lines * {DUP_LINES}
  OR NOT coalesce(word_chars::DOUBLE / nullif(n_words, 0) BETWEEN {WORD_LENGTH[0]} AND {WORD_LENGTH[1]}, false) AS failed FROM f),
h AS (SELECT host, count(*) AS n, sum(failed::INT)::DOUBLE AS failed FROM r GROUP BY host),
p AS (SELECT avg(failed / n) AS mean, var_samp(failed / n) - avg(failed / n) * (1 - avg(failed / n)) * avg(1 / n::DOUBLE) AS between_hosts FROM h),
s AS (SELECT mean, CASE WHEN between_hosts > 1e-12 THEN greatest(2, mean * (1 - mean) / between_hosts - 1) END AS size FROM p),
u AS (SELECT host, h.n, (h.failed + mean * size) / (h.n + size) AS rate, mean, size, sqrt(mean * (1 - mean) / (size + 1)) AS deviation FROM h, s),
v AS (SELECT host, mean, deviation, rate - {SURE} * sqrt(rate * (1 - rate) / (n + size + 1)) AS low FROM u)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(low > mean + {REJECTED} * deviation OR low > mean + {SUSPECT} * deviation AND failed, false) AS kept
FROM r JOIN v ON r.host IS NOT DISTINCT FROM v.host
"""
