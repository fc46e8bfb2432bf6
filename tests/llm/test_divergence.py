"""The source divergence audit against a brute-force version in whole numbers."""

import collections
import re

from orbitlake.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs=10, top=10):
    counts, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(UPPER))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {k for k, _ in counts}:
        kept = {t for t, n in docs[lang].items() if n >= min_docs}
        groups = {s: c for (k, s), c in counts.items() if k == lang}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[u] for u in kept) + 2 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(sum(groups.values(), collections.Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


def rows(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


def test_audit_equals_brute_force(spark, corpus):
    want = brute([(r["text"], r["lang"], r["source"]) for r in corpus.collect()])
    assert rows(divergence.audit(corpus)) == want and {x[2] for x in want} == {"pair", "term"}


def test_audit_of_odd_rows(spark, odd):
    got = brute([(r["text"], r["lang"], r["source"]) for r in odd.collect()], min_docs=2)
    assert rows(divergence.audit(odd, min_docs=2)) == got
    # no vocabulary: every pair of groups at distance 0; one language without any partner has no pairs
    assert {x[4] for x in rows(divergence.audit(odd, min_docs=99))} == {0}
    assert divergence.audit(odd.limit(0)).count() == 0
    lone = spark.createDataFrame([(None, None, None, 1), ("a b", "", "", 2)], "text string, lang string, source string, term long")
    assert rows(divergence.audit(lone)) == []


def test_long_texts_are_counted_whole_and_cut_between_terms(spark, monkeypatch):
    text = "Ärger und Straße, naïve Öl " * 40_000
    assert list(divergence.pieces(b"abc def"[:0])) == [b""]
    parts = list(divergence.pieces(text.encode()))
    assert len(parts) > 1 and sum(len(p.translate(divergence.LETTERS).split()) for p in parts) == len(TERM.findall(text))
    assert list(divergence.pieces(b"a" * (3 << 20))) == [b"a" * (3 << 20)]


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, size = 3 * 10**13 + 7, 9 * 10**13 + 1, 12345
    got = spark.range(1).selectExpr(f"{n}L AS n", f"{total}L AS t", f"{size}L AS v").select(divergence.share(*(divergence.F.col(c) for c in "ntv"))).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * size)


def test_held_counts_go_out_in_parts(spark, corpus, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 50)
    import pyarrow as pa

    t = pa.table({"lang": ["en"] * 40, "source": ["a", "b"] * 20, "text": [f"w{chr(97 + i % 26)}x common" for i in range(40)]})
    out = [r for b in divergence._count(iter(t.to_batches(max_chunksize=7))) for r in b.to_pylist()]
    assert sum(r["n"] for r in out if r["term"] == "common") == 40
