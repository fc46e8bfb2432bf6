"""Source divergence audit, plain relational.

The regexp matches of the texts are counted by language, source and term; the terms of enough documents are the
vocabulary of their language. Every (language, source) group meets the whole vocabulary of its language, so that a term
that it lacks counts zero; smoothed shares follow. Two sources of a language are compared by a self-join on language and
term, whose sums are ranked by window; the terms that set a source apart from its language are ranked likewise.

Matches are found and added up in Arrow batches, before they become rows: exploding each match natively took two to three times
the CPU time. What a batch counts is added up by Spark, so frequent terms and a hot source cost no task more than others.
Groups and vocabulary meet by language and one of SALTS slices of the vocabulary: a language with most of the terms is spread
over that many keys. All arithmetic is exact: integers, and decimals of 38 digits where counts are scaled.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import materialize, read, text_or_empty

#: A term is a match of [^\x00-\x40\x5B-\x60\x7B-\x7F]+: ASCII letters and characters beyond ASCII. Byte by byte: A-Z are lower-cased, what ends a term is a blank.
LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 128 else 32 for i in range(256))
BETWEEN = re.compile(rb"[^A-Za-z\x80-\xff]")
#: Documents of a language that have a term of its vocabulary, at least; ranks of the part `term`; scale of the shares; count that is added to every term.
MIN_DOCS, TOP_TERMS, SCALE, ADDED = 10, 10, 1_000_000_000, 2
#: Slices of each language's vocabulary; rows of a task's counts that are held before they go out; bytes of a text that are matched at a time.
SALTS, HELD, PIECE = 64, 200_000, 1 << 20


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about PIECE bytes, cut where no term is."""
    start = 0
    while len(text) - start > PIECE and (cut := BETWEEN.search(text, start + PIECE)):
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in found.items():
            size = len(n)
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            yield pa.record_batch(
                [pa.repeat(pa.scalar(lang), size), pa.repeat(pa.scalar(source), size), terms, pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())],
                ["lang", "source", "term", "n", "docs"],
            )
        found.clear()

    held = 0
    for b in batches:
        for lang, source, text in zip(b["lang"].to_pylist(), b["source"].to_pylist(), b["text"].cast(pa.binary())):
            n, docs = found[lang, source]
            before, seen = len(n), set()
            for piece in pieces(text.as_py()):
                terms = piece.translate(LETTERS).split()
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            held += len(n) - before
            if held > HELD:
                yield from out()
                held = 0
    yield from out()


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows of the group that have the term)."""
    rows = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"), text_or_empty(text).alias("text"))
    each = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + ADDED) / (total + ADDED * size)), exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(n + ADDED), wide(total + ADDED * size))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def dense_shares(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, p (the group's share), q (the language's): one row for each group and each term of its language's vocabulary, and one of term '' with
    n = 0, p = q = 1, so that groups without vocabulary have a row."""
    counts = materialize(term_counts(docs, text), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("_d")).where(F.col("_d") >= min_docs).drop("_d")
    kept = materialize(kept, "divergence-vocabulary")
    known = materialize(counts.drop("docs").join(kept.select("lang", "term"), ["lang", "term"], "left_semi"), "divergence-known")
    groups = docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
    per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("total").alias("lang_total"))
    per_group = known.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    groups = groups.join(per_lang, "lang", "left").join(per_group, ["lang", "source"], "left").na.fill(0)
    groups = materialize(groups, "divergence-groups")
    salt = F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")
    vocabulary = kept.withColumn("_salt", salt).unionByName(groups.select("lang", F.lit("").alias("term"), F.lit(0).cast("long").alias("total")).distinct().withColumn("_salt", F.lit(0)))
    cells = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).join(vocabulary, ["lang", "_salt"])
    cells = cells.join(known, ["lang", "source", "term"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    real = F.col("term") != ""
    p, q = share(F.col("n"), F.col("group_total"), F.col("size")), share(F.col("total"), F.col("lang_total"), F.col("size"))
    return cells.select("lang", "source", "term", "n", F.when(real, p).otherwise(1).cast("long").alias("p"), F.when(real, q).otherwise(1).cast("long").alias("q"))


def audit(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """docs: text, lang, source; further columns are ignored, whatever their names. lang, source, part, item, value, rank.

    pair: each other source of the language as item, its distance from the group summed over the whole vocabulary (0 without vocabulary) as value, all ranks.
    term: each term that the group uses more than its language does as item, ranks to top. Ranks go by value, largest first, then by the item's bytes.
    Nulls in text, lang and source are empty strings. Repeated rows count as often as they occur. Empty texts give groups without terms; an empty table gives none.
    A language of one source has no pairs."""
    cells = materialize(dense_shares(docs, text, min_docs), "divergence-shares")
    a = cells.select("lang", "term", "source", "p")
    b = cells.select("lang", "term", F.col("source").alias("other"), F.col("p").alias("r"))
    both = a.join(b, ["lang", "term"]).where(F.col("source") < F.col("other"))
    sums = both.groupBy("lang", "source", "other").agg(F.sum(distance(F.col("p"), F.col("r"))).alias("value"))
    ends = F.explode(F.array(F.struct(F.col("source"), F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"))))
    pairs = sums.select("lang", ends.alias("_e"), "value").select("lang", "_e.source", F.lit("pair").alias("part"), "_e.item", "value")
    terms = cells.where((F.col("n") > 0) & (F.col("p") > F.col("q"))).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
terms AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM terms GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
per_lang AS (SELECT lang, count(*) AS v, CAST(sum(total) AS HUGEINT) AS lt FROM kept GROUP BY 1),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
per_group AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS gt FROM counts GROUP BY 1, 2),
grp AS (SELECT lang, source, coalesce(gt, 0) AS gt FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN per_group USING (lang, source)),
cells AS (SELECT lang, source, term, coalesce(n, 0) AS n,
                 CAST(1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (gt + 2 * v) AS BIGINT) AS p, CAST(1 + (1000000000::HUGEINT * (total + 2)) // (lt + 2 * v) AS BIGINT) AS q
          FROM grp JOIN kept USING (lang) JOIN per_lang USING (lang) LEFT JOIN counts USING (lang, source, term)),
sums AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value
         FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
most AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM cells WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM most))
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
