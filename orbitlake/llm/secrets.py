"""Secret scans by corpus-wide ownership frequency (native).

Candidates are found by pattern in every whole text. Their values' hashes are counted over the corpus by distinct
owners and repositories: a value that several owners share, or that is in many repositories, is a copied example; a value of one
owner, in few repositories, that looks random is a live credential; one that looks so but is neither is shared. A hot value is summed by
(hash, owner, repository), then by (hash, owner), then by hash, each time on the map side first; verdicts on hot values are broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import join_skewed, materialize, read, text_or_empty

#: Kind, pattern, group of the value, least characters of that group.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: One pass that finds out which texts have anything; what it finds is a superset.
ANY = r"(?i:(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=])|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
#: A value that this many owners share, or that this many repositories hold, is an example; a live value is in this many repositories at most.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES, LIVE_REPOSITORIES = 3, 5, 2
#: The verdicts whose spans are masked.
MASKED = ("live", "shared")
#: A live value has this many different characters at least, a letter and a digit, and none of the words below.
LIVE_DISTINCT = 8
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your|xxxx|test|1234|abcd"


def _matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (kind, idx, gap, n, value): gap is the length of the text between the match before and this one, n the match's length."""
    # regexp_extract_all and split go by the same leftmost matches, so gaps and matches interleave; a shorter hex run is no match at all
    pattern = r"[0-9a-f]{24,}" if kind == "hex" else pattern
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    found = F.transform(parts, lambda p, i: F.struct(F.lit(kind).alias("kind"), i.alias("idx"), F.length(p["gap"]).alias("gap"), F.length(p["all"]).alias("n"), p["value"].alias("value")))
    return F.filter(found, lambda p: p["n"].isNotNull())


def candidates(docs: DataFrame, owner: str = "source", repository=None, text: str = "text") -> DataFrame:
    """Every base span: doc_id, _th (hash of the text), owner, repository, kind, ord, start, end (code points, end exclusive), value. Rows with
    the same id and text, owner and repository count once."""
    repository = F.concat_ws("/", F.col(owner), F.col("lang")) if repository is None else repository
    body = text_or_empty(text)
    some = docs.where(body.rlike(ANY)).select("doc_id", F.xxhash64(body).alias("_th"), F.col(owner).alias("owner"), repository.alias("repository"), *[_matches(body, *k).alias(f"_{k[0]}") for k in KINDS])
    some = some.dropDuplicates(["doc_id", "_th", "owner", "repository"])
    rows = some.select("doc_id", "_th", "owner", "repository", F.explode(F.concat(*[f"_{k[0]}" for k in KINDS])).alias("m")).select("doc_id", "_th", "owner", "repository", "m.*")
    upto = W.partitionBy("doc_id", "_th", "owner", "repository", "kind").orderBy("idx").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto)).withColumn("start", F.col("end") - F.col("n"))
    least = reduce(lambda c, k: c.when(F.col("kind") == k[0], k[3]), KINDS[1:], F.when(F.col("kind") == KINDS[0][0], KINDS[0][3]))
    order = reduce(lambda c, k: c.when(F.col("kind") == k[1][0], k[0]), list(enumerate(KINDS))[1:], F.when(F.col("kind") == KINDS[0][0], 0))
    return rows.where(F.length("value") >= least).select("doc_id", "_th", "owner", "repository", "kind", order.alias("ord"), "start", "end", "value")


def ownership(found: DataFrame) -> DataFrame:
    """One row a value: value_hash (SHA-256), n_owners, n_repositories, n_spans, verdict: example, live, shared or unsure."""
    hashed = found.select(F.sha2("value", 256).alias("value_hash"), "value", "owner", "repository")
    live = hashed["value"].rlike("[A-Za-z]") & hashed["value"].rlike("[0-9]") & ~hashed["value"].rlike(PLACEHOLDER) & (F.size(F.array_distinct(F.split("value", ""))) >= LIVE_DISTINCT)
    by_repository = hashed.withColumn("_live", live).groupBy("value_hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"), F.max("_live").alias("_live"))
    by_owner = by_repository.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("r"), F.sum("n").alias("n"), F.max("_live").alias("_live"))
    out = by_owner.groupBy("value_hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("r").alias("n_repositories"), F.sum("n").alias("n_spans"), F.max("_live").alias("_live"))
    example = (F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_repositories") >= EXAMPLE_REPOSITORIES)
    own = (F.col("n_owners") == 1) & (F.col("n_repositories") <= LIVE_REPOSITORIES)
    verdict = F.when(example, "example").when(own & F.col("_live"), "live").when(F.col("_live"), "shared").otherwise("unsure")
    return out.withColumn("verdict", verdict).drop("_live")


def scan(docs: DataFrame, owner: str = "source", repository=None, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, those of keep, n_assign, n_access, n_hex, base_sha256 (of the base spans), spans (with those the method adds: live:start:end
    and example:start:end for values of either verdict), n_live, n_example, masks (start and end of the values that MASKED verdicts hit, in order).

    Nulls: a null text is empty; null ids, owners and repositories are keys like others. Repeated rows give the same result each and count once.
    An empty table gives no rows. Other columns are ignored, whatever their names."""
    docs = docs.select(*dict.fromkeys(["doc_id", text, owner, "lang", *keep])) if repository is None else docs
    repo = F.concat_ws("/", F.col(owner), F.col("lang")) if repository is None else repository
    found = materialize(candidates(docs, owner, repo, text).withColumn("value_hash", F.sha2("value", 256)), "secrets")
    values = materialize(ownership(found), "secret-values")
    n_spans = values.agg(F.sum("n_spans")).first()[0] or 0
    judged = join_skewed(found, values.select(F.col("value_hash").alias("_vh"), "verdict", "n_spans"), "value_hash", "_vh", "n_spans", n_spans)
    label = lambda kind, start, end: F.concat_ws(":", kind, start.cast("string"), end.cast("string"))
    base = F.struct(F.col("start"), F.col("ord"), label(F.col("kind"), F.col("start"), F.col("end")).alias("s"))
    from_ = F.col("end") - F.length("value")
    extra = F.when(F.col("verdict").isin("live", "example"), F.struct(from_.alias("start"), F.when(F.col("verdict") == "live", 3).otherwise(4).alias("ord"), label(F.col("verdict"), from_, F.col("end")).alias("s")))
    joined = lambda c: F.array_join(F.transform(F.sort_array(c), lambda x: x["s"]), ",")
    of = judged.groupBy("doc_id", "_th", "owner", "repository").agg(
        *[F.count_if(F.col("kind") == k[0]).alias(f"n_{k[0]}") for k in KINDS],
        F.collect_list(base).alias("_base"), F.array_distinct(F.collect_list(extra)).alias("_extra"),
        F.array_sort(F.array_distinct(F.collect_list(F.when(F.col("verdict").isin(*MASKED), F.struct(from_.cast("int").alias("start"), F.col("end").cast("int").alias("end")))))).alias("masks"))
    of = of.select(
        F.col("doc_id").alias("_id"), F.col("_th").alias("_h"), F.col("owner").alias("_o"), F.col("repository").alias("_r"), *[f"n_{k[0]}" for k in KINDS], joined("_base").alias("_s"),
        joined(F.concat("_base", "_extra")).alias("spans"), F.size(F.filter("_extra", lambda x: x["ord"] == 3)).cast("long").alias("n_live"), F.size(F.filter("_extra", lambda x: x["ord"] == 4)).cast("long").alias("n_example"),
        "masks")
    slim = docs.select("doc_id", *keep, F.xxhash64(text_or_empty(text)).alias("_th"), F.col(owner).alias("_owner"), repo.alias("_repo"))
    same = slim["doc_id"].eqNullSafe(of["_id"]) & (slim["_th"] == of["_h"]) & slim["_owner"].eqNullSafe(of["_o"]) & slim["_repo"].eqNullSafe(of["_r"])
    out = slim.join(of, same, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", *keep, *[zero(f"n_{k[0]}") for k in KINDS], F.sha2(F.coalesce("_s", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), zero("n_live"), zero("n_example"), F.coalesce("masks", F.array().cast("array<struct<start: int, end: int>>")).alias("masks"))


def masked_text(text: Column, masks: Column, sign: str = "<secret>") -> Column:
    """The text with the spans of masks (start and end in code points, by start) replaced; spans that overlap are one."""
    piece = lambda begin, n: F.substr(text, begin + 1, n)

    def step(a: Column, m: Column) -> Column:
        out = F.when(m["start"] >= a["at"], F.concat(a["out"], piece(a["at"], m["start"] - a["at"]), F.lit(sign))).otherwise(a["out"])
        return F.struct(out.alias("out"), F.greatest(a["at"], m["end"]).alias("at"))

    return F.aggregate(masks, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, lambda a: F.concat(a["out"], piece(a["at"], F.length(text))))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents")).drop("masks")


def _oracle_kind(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, source, lang, '{kind}' AS kind, {order} AS ord, i, len(gaps[i]) AS gap, len(alls[i]) AS n, vals[i] AS value, {least} AS least
    FROM (SELECT *, unnest(generate_series(1, len(alls))) AS i FROM (SELECT doc_id, source, lang, string_split_regex(coalesce(text, ''), '{p}') AS gaps,
      regexp_extract_all(coalesce(text, ''), '{p}', 0) AS alls, regexp_extract_all(coalesce(text, ''), '{p}', {group}) AS vals FROM documents))"""


ORACLE = f"""
WITH raw AS ({" UNION ALL ".join(_oracle_kind(k, i, p, g, n) for i, (k, p, g, n) in enumerate(KINDS))}),
placed AS (SELECT *, CAST(sum(gap + n) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS e FROM raw),
found AS (SELECT *, e - n AS s FROM placed WHERE len(value) >= least),
verdicts AS (
  SELECT value, CASE WHEN owners >= {EXAMPLE_OWNERS} OR repositories >= {EXAMPLE_REPOSITORIES} THEN 'example'
    WHEN owners = 1 AND repositories <= {LIVE_REPOSITORIES} AND regexp_matches(value, '[A-Za-z]') AND regexp_matches(value, '[0-9]') AND NOT regexp_matches(value, '{PLACEHOLDER}')
         AND len(list_distinct(string_split(value, ''))) >= {LIVE_DISTINCT} THEN 'live' ELSE 'unsure' END AS verdict
  FROM (SELECT value, count(DISTINCT coalesce('s' || source, '')) AS owners, count(DISTINCT (coalesce('s' || source, ''), concat_ws('/', source, lang))) AS repositories FROM found GROUP BY value)),
judged AS (SELECT f.*, v.verdict FROM found f JOIN verdicts v USING (value)),
spans AS (
  SELECT doc_id, s, ord, kind || ':' || s || ':' || e AS l FROM judged
  UNION SELECT doc_id, e - len(value), CASE verdict WHEN 'live' THEN 3 ELSE 4 END, verdict || ':' || (e - len(value)) || ':' || e FROM judged WHERE verdict <> 'unsure'),
per AS (
  SELECT doc_id, count(*) FILTER (l LIKE 'assign%') AS n_assign, count(*) FILTER (l LIKE 'access%') AS n_access, count(*) FILTER (l LIKE 'hex%') AS n_hex,
    string_agg(l, ',' ORDER BY s, ord) FILTER (ord < 3) AS base, string_agg(l, ',' ORDER BY s, ord) AS spans, count(*) FILTER (ord = 3) AS n_live, count(*) FILTER (ord = 4) AS n_example
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example FROM documents d LEFT JOIN per USING (doc_id)
"""
