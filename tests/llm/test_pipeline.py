"""The pipeline's stages against brute force, on the small tables."""

import collections

import corpus_pipeline as cp
import test_llm_operators as brute


def live_looking(value):
    low = value.lower()
    words = ("example", "sample", "dummy", "changeme", "placeholder", "your", "xxxx", "test", "1234", "abcd")
    return any(c.isascii() and c.isalpha() for c in value) and any(c in "0123456789" for c in value) and len(set(value)) >= 8 and not any(w in low for w in words)


def masked(docs):
    """docs: rows. Texts with the values of live-looking secrets cut out that are of fewer than 3 owners and 5 repositories."""
    owners, repositories, spans = collections.defaultdict(set), collections.defaultdict(set), {}
    for r in docs:
        spans[r.doc_id] = []
        for kind, m, group in brute.base_matches(r.text or ""):
            v = m.group(group)
            owners[v].add(r.source)
            repositories[v].add((r.source, r.lang))
            spans[r.doc_id].append((m.end() - len(v), m.end(), v))
    out = {}
    for r in docs:
        text, at = "", 0
        for a, b, v in sorted(spans[r.doc_id]):
            if live_looking(v) and len(owners[v]) < 3 and len(repositories[v]) < 5:
                text, at = (text + r.text[at:a] + "<secret>", b) if a >= at else (text, max(at, b))
        out[r.doc_id] = text + r.text[at:] if at else r.text
    return out


def test_stages_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = [docs]
    for _, stage in cp.STAGES:
        steps.append(cp.materialize(stage(spark, steps[-1], sf), "test-stage"))
    for df in steps[:-1]:
        assert tuple(df.columns) == cp.COLUMNS
    rows = [df.collect() for df in steps]
    every, toxic, near, secret, mixed, packed = rows
    assert collections.Counter(toxic) <= collections.Counter(every)
    # one document of each component, the smallest id
    sets, pairs = brute.links([r.text for r in toxic])
    low = {r.doc_id: r.doc_id for r in toxic}
    for _ in toxic:
        for i, j in pairs:
            a, b = toxic[i].doc_id, toxic[j].doc_id
            low[a] = low[b] = min(low[a], low[b])
    assert collections.Counter(near) == collections.Counter(r for r in toxic if low[r.doc_id] == r.doc_id)
    # texts with spans cut out, all else unchanged
    texts = masked(near)
    assert {r.doc_id: r.text for r in secret} == texts
    before = {r.doc_id: r for r in near}
    for r in secret:
        b = before[r.doc_id]
        assert (r.lang, r.source) == (b.lang, b.source) and r.n_chars == (b.n_chars if r.text == b.text else len(r.text))
    # each source's words near its target, rows unchanged
    assert set(mixed) <= set(secret)
    size, taken, most = collections.Counter(), collections.Counter(), collections.Counter()
    for r in secret:
        n = len(brute.words(r.text))
        size[r.source] += n
        most[r.source] = max(most[r.source], n)
    for r in mixed:
        taken[r.source] += len(brute.words(r.text))
    for s, want in brute.fill(dict(size)).items():
        assert abs(taken[s] - want) <= most[s] / 2 + 1
    assert max(collections.Counter(r.doc_id for r in mixed).values()) <= 3
    # all tokens of all rows, gapless
    brute.check_packing(brute.packing.pack(steps[4], with_ids=True).collect(), [(r.doc_id, r.text) for r in mixed])
    assert collections.Counter((r.doc_id, r.start, r.length) for r in packed) == collections.Counter((r.doc_id, r.start, r.length) for r in brute.packing.pack(steps[4]).collect())


def test_stages_on_empty_tables_and_nulls(spark, sf, odd):
    docs = odd.select(*cp.COLUMNS)
    for df in (docs.limit(0), docs):
        for name, stage in cp.STAGES:
            out = stage(spark, df, sf)
            n, kept = df.count(), out.count()
            if name == "packing":
                assert kept >= n
            else:
                assert tuple(out.columns) == cp.COLUMNS and (kept <= n or name == "mixing") and (n == 0) == (kept == 0)
    near = cp.near_duplicate_stage(spark, docs, sf).collect()
    assert len([r for r in near if r.doc_id in (5, 6)]) == 2 and len([r for r in near if r.doc_id is None]) == 1


def test_repeated_rows_are_kept_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20)
    out = cp.near_duplicate_stage(spark, docs.union(docs), sf)
    assert out.count() == cp.near_duplicate_stage(spark, docs, sf).count()


def test_run_is_registered(spark, sf):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is cp.run and "pipeline" not in entry.oracle_sql()
    assert {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in entry.queries() if k.startswith("op")}
    assert cp.run(spark, sf).count() > 0
