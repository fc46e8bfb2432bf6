"""Toxicity by weak supervision.

Voters look at each text and speak only where they find something: the weightiest words of a lexicon are a voter each,
other words, word beginnings, several entries at once and disguised entries are voters too, and so are patterns of
characters; one voter speaks against toxicity where a text of some length has nothing of the lexicon. The annotators'
labels serve twice: a bounded sample of them yields the lexicon, and their share the prior. A generative label model,
fitted by EM on the counts of all vote vectors of the whole corpus, estimates how often each voter speaks in either class
and which voters move together beyond what the class explains; voters of a correlated group share one voice. A linear
classifier is trained on the posterior labels of a bounded sample of texts, labelled or not, and scores every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import materialize, read, releasing, small_batches

#: Labelled rows that the lexicon is mined from, and texts that the classifier learns from, at most: those of the smallest hash of the id.
SAMPLE = 20_000
#: Entries of the lexicon at most; texts of the sample with the entry, share of toxic ones among them (one less counted), and standard deviations above chance, at least.
ENTRIES, MIN_TEXTS, MIN_PRECISION, MIN_DEVIATIONS = 400, 3, 0.6, 5.0
#: Lengths of word beginnings that count as entries, words that are voters of their own, and words of a text that the voter against needs.
BEGINNINGS, SINGLE_VOTERS, LONG_ENOUGH = (4, 5, 6), 6, 20
FOLDS = 5
_WORDS = re.compile(r"[^\W_]+")
#: Pattern voters: name, pattern.
PATTERNS = (
    ("shouting", re.compile(r"\b[A-Z]{4,}(?:\W+[A-Z]{4,})+")),
    ("marks", re.compile(r"[!?]{3,}")),
    ("masked", re.compile(r"\b\w+\*{2,}\w*|\b\w+[@$]\w+\b")),
    ("stretched", re.compile(r"([A-Za-z])\1{3,}")),
)
#: What may stand for a letter (in lower case), and words that use it or repeat a letter.
_DISGUISE = str.maketrans("013457@$!", "oieastasi")
_DISGUISED = re.compile(r"[a-z]+[013457@$!][a-z013457@$!]*[a-z]|[a-z]*([a-z])\1\1[a-z]*")
_REPEATED = re.compile(r"([a-z])\1{2,}")
#: What every text with such a word has; found faster than the words.
_MAY_DISGUISE = re.compile(r"[a-z][013457@$!]+[a-z]|([a-z])\1\1")
#: The voters of a code, in the order of its bits: single words, one other word, several words, few words with beginnings, SEVERAL words with them, disguised entries, patterns, and the one against.
N_VOTERS, SEVERAL = SINGLE_VOTERS + 5 + len(PATTERNS) + 1, 3
AGAINST = N_VOTERS - 1
WEAK = (SINGLE_VOTERS, SINGLE_VOTERS + 2, *range(SINGLE_VOTERS + 5, AGAINST))


def entries(text: str) -> set[str]:
    """The lexicon entries that a text has: whole words, as =word, and beginnings of longer words."""
    words = set(_WORDS.findall(text.lower()))
    out = {"=" + w for w in words}
    for n in BEGINNINGS:
        out.update(w[:n] for w in words if len(w) > n)
    return out


def held_out(doc_id="doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def labelled_sample(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, toxic of the rows to learn from: not held out, not null, one an id, sample of them at most."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def mine_lexicon(texts: DataFrame, share: float) -> list[str]:
    """texts: text, toxic; share: of toxic ones, above 0 and below 1. The entries whose texts are mostly toxic, the weightiest ENTRIES of them, whole words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[int(bool(toxic))].update(entries(text or ""))
            names = [*(seen[0] | seen[1])]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][x] for x in names], pa.int64()), pa.array([seen[0][x] for x in names], pa.int64())], names=["entry", "n1", "n0"])

    counts = texts.select("text", "toxic").mapInArrow(releasing(run), "entry string, n1 bigint, n0 bigint").groupBy("entry").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    precision, n = (F.col("n1") - 1) / (F.col("n1") + F.col("n0")), F.col("n1") + F.col("n0")
    by_chance = (F.col("n1") - n * share) / F.sqrt(n * share * (1 - share))
    good = counts.where((n >= MIN_TEXTS) & (precision >= MIN_PRECISION) & (by_chance >= MIN_DEVIATIONS))
    found = [r["entry"] for r in good.orderBy(F.desc(F.col("n1") * precision), "entry").limit(ENTRIES).collect()]
    return sorted(found, key=lambda e: e[0] != "=")


def look(docs: DataFrame, lexicon: list[str], text: str, keep: tuple[str, ...]) -> DataFrame:
    """What the voters see in every text: those of keep, hits (numbers of lexicon entries), patterns (bits), code (bits of the voters that speak)."""
    known = docs.sparkSession.sparkContext.broadcast({x: i for i, x in enumerate(lexicon)})
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        whole = {k[1:]: i for k, i in number.items() if k[0] == "="}
        begins = [(n, {k: i for k, i in number.items() if k[0] != "=" and len(k) == n}) for n in BEGINNINGS]
        for batch in batches:
            hits, bits, codes = [], [], []
            for t in batch.column(0).to_pylist():
                t = t or ""
                low = t.lower()
                words = set(_WORDS.findall(low))
                found = [whole[w] for w in words & whole.keys()]
                begun = set()
                for n, table in begins:
                    if table:
                        some = [w for w in words if w[:n] in table and len(w) > n]
                        found += {table[w[:n]] for w in some}
                        begun.update(some)
                seen = sum(1 << i for i, (_, p) in enumerate(PATTERNS) if p.search(t))
                disguised = _MAY_DISGUISE.search(low) is not None and any(_REPEATED.sub(r"\1", m.group().translate(_DISGUISE)) in whole for m in _DISGUISED.finditer(low))
                hits.append(sorted(found))
                bits.append(seen)
                codes.append(speak(found, len(begun), seen, disguised, len(whole), len(words)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(hits, pa.list_(pa.int32())), pa.array(bits, pa.int32()), pa.array(codes, pa.int32())], names=[*keep, "hits", "patterns", "code"])

    return docs.select(text, *keep).mapInArrow(releasing(run), ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "hits array<int>", "patterns int", "code int"]))


def speak(hits: list[int], begun: int, patterns: int, disguised: bool, n_whole: int, n_words: int) -> int:
    """The voters that speak, as bits. hits: entries found, of which the first n_whole are whole words; begun: words with a beginning among the entries; n_words: different words of the text."""
    whole = [h for h in hits if h < n_whole]
    code = 0
    for h in whole:
        if h < SINGLE_VOTERS or len(whole) == 1:
            code |= 1 << min(h, SINGLE_VOTERS)
    at = SINGLE_VOTERS + 1
    code |= (len(whole) > 1) << at | (0 < begun < SEVERAL) << at + 1 | (begun >= SEVERAL) << at + 2 | disguised << at + 3 | patterns << at + 4
    return code | (not hits and not disguised and n_words >= LONG_ENOUGH) << AGAINST


def votes(code: int) -> tuple[int, ...]:
    """1: for toxic, -1: against, 0: abstains."""
    return tuple((code >> v & 1) * (-1 if v == AGAINST else 1) for v in range(N_VOTERS))


class LabelModel:
    """P(voter speaks | class), by EM on counted vote vectors under a given prior; correlations of voters given the class. Silence is weighed too: of a voter that often speaks in one class, it tells for the other."""

    def __init__(self, vectors: np.ndarray, counts: np.ndarray, prior: float, weak: tuple[int, ...] = (), rounds: int = 30):
        """vectors: votes of -1, 0 and 1; weak: voters whose vote counts half at first. Then a text with more than one vote for is toxic, with one perhaps, with half a vote hardly."""
        self.n, self.prior = vectors.shape[1], np.array([1 - prior, prior])
        spoken = (vectors != 0).astype(float)
        side, margin = np.sign(vectors.sum(0)), vectors @ np.where(np.isin(np.arange(self.n), weak), 0.5, 1.0)
        q = np.select([margin > 1, margin == 1, margin > 0, margin < 0], [0.9, 0.5, 0.5 * prior, 0.1 * prior], prior)
        self.share = np.ones(self.n)
        for _ in range(rounds):
            w = np.stack([counts * (1 - q), counts * q])
            rate = (w @ spoken + 0.5) / (w.sum(1, keepdims=True) + 1)
            # a voter may turn out to say nothing, not the opposite of what it says
            right = side * (rate[1] - rate[0]) > 0
            self.weight, self.silence = (np.where(right, np.log(r[1] / r[0]), 0.0) for r in (rate, 1 - rate))
            q = self.posterior(vectors)
        # voices are shared in the end: within the rounds, weaker voices would blur the classes that they are estimated from
        self.share = 1 / self._groups(vectors, w)

    def _groups(self, x: np.ndarray, w: np.ndarray) -> np.ndarray:
        """How many voters speak with one voice: 1 plus the sum of the others' correlations given the class."""
        total = np.zeros((self.n, self.n))
        for c in (0, 1):
            weight = w[c] / max(w[c].sum(), 1e-9)
            d = x - weight @ x
            cov = (d * weight[:, None]).T @ d
            s = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            total += np.clip(cov / np.outer(s, s), 0, 1) * self.prior[c]
        np.fill_diagonal(total, 0)
        self.correlation = total
        return 1 + total.sum(1)

    def posterior(self, x: np.ndarray) -> np.ndarray:
        spoken = x != 0
        z = spoken @ (self.weight * self.share) + ~spoken @ (self.silence * self.share) + np.log(self.prior[1] / self.prior[0])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train_linear(x: np.ndarray, y: np.ndarray, l2: float = 0.3, rounds: int = 40) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, l2), 1e-3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _features(hits: list[list[int]], patterns: list[int], n: int) -> np.ndarray:
    x = np.zeros((len(hits), n + len(PATTERNS) + 2), np.float64)
    for i, (h, p) in enumerate(zip(hits, patterns)):
        x[i, h] = 1
        x[i, n : n + len(PATTERNS)] = [p >> b & 1 for b in range(len(PATTERNS))]
        x[i, -2:] = bool(h), min(len(h), 10) / 10
    return x


def score(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, those of keep, held_out, score (0 to 1), predicted.

    Nulls: a null or empty text has no hits and gets the score of such a text; a null id counts as the empty text in held_out and has no label. Labels with a null are not learned from; of several an id has, the largest holds.
    Without labels, with one class alone, or where no word of the labelled texts stands out, nothing is learned and every score is the share of toxic labels (0 without any). Repeated rows are scored each. An empty table gives no rows. Other columns are not read."""
    spark = docs.sparkSession
    small_batches(spark)
    chosen = materialize(labelled_sample(labels, sample), "toxicity-labels")
    texts = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])  # sample rows at most
    share = chosen.join(docs.select("doc_id"), "doc_id", "left_semi").agg(F.avg("toxic")).first()[0] or 0.0
    lexicon = mine_lexicon(texts, share) if 0 < share < 1 else []
    n = len(lexicon)
    keep = tuple(c for c in keep if c != "doc_id")
    seen = materialize(look(docs, lexicon, text, ("doc_id",)), "toxicity-seen")
    weights = np.zeros(n + len(PATTERNS) + 3)
    weights[-1] = np.log(max(share, 1e-12) / max(1 - share, 1e-12))
    if n:
        learned = seen.groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()  # 2 ** N_VOTERS rows at most
        model = LabelModel(np.array([votes(r["code"]) for r in learned]), np.array([r["n"] for r in learned], float), share, WEAK)
        fold = seen.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "hits", "patterns", "code")
        # each task sends its first rows to the driver: of the hashes, the lowest that hold four times the sample will do
        reach = min(4 * sample / max(sum(r["n"] for r in learned), 1), 1.0)
        fold = fold.where(F.xxhash64("doc_id") <= min(-(1 << 63) + int(reach * (1 << 64)), (1 << 63) - 1))
        fit = fold.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toPandas()  # sample rows at most
        if len(fit):
            weights = train_linear(_features(list(fit["hits"]), list(fit["patterns"]), n), model.posterior(np.array([votes(c) for c in fit["code"]])))
    w = F.array(*[F.lit(float(x)) for x in weights[:n]]) if n else F.array(F.lit(0.0))
    z = F.lit(float(weights[-1])) + F.aggregate("hits", F.lit(0.0), lambda a, i: a + F.get(w, i))
    for b in range(len(PATTERNS)):
        z = z + F.shiftright("patterns", b).bitwiseAND(1) * F.lit(float(weights[n + b]))
    z = z + F.when(F.size("hits") > 0, float(weights[-3])).otherwise(0.0) + F.least(F.size("hits"), F.lit(10)) / 10 * F.lit(float(weights[-2]))
    rows = look(docs, lexicon, text, ("doc_id", *keep)) if keep else seen  # columns to keep are not written, the texts are looked at again with them
    out = rows.withColumn("held_out", held_out()).withColumn("score", 1 / (1 + F.exp(-z)))
    return out.select("doc_id", *keep, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
