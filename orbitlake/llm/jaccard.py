"""N-gram Jaccard join by prefix trees.

A document's set is its distinct 5-word shingles. All sets are ordered by one global order: shingles that are not
frequent by their hash, then the frequent ones by their count. Equal sets form one class. Two sets of Jaccard
similarity t or more share a token among their first n - ceil(t n) + 1, so classes meet in the groups of those tokens;
a group with the same members as one of an earlier token is dropped, since its pairs meet there, and a member leaves if its size and a few
bits a token show that it is like no other. Members that by their sizes and bits may be alike, and what hangs together by them, become one family. A family's sets are stored, from the frequent end of the
order on, in a path-compressed tree and all members traverse it at once: the overlap up to a node is counted once for all sets
below it, and a subtree is left as soon as the overlap so far and what remains cannot reach the bound any more. A family of p times
the tokens that a tree may hold is dealt to p parts, and each two parts meet in a tree: every pair meets once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bit_map, chunks, components, forget, join_skewed, mapped, materialize, mix64, read, releasing, runs_hash, small_batches, texts_words

#: Words of a shingle, and least similarity in hundredths.
K, PERCENT = 5, 80
#: The global order knows this many frequent shingles at most; which ones it knows changes the speed, never the result.
FREQUENT, FREQUENT_FROM, SEEN_FROM = 400_000, 8, 3
#: Members, and tokens in all their sets, of a part; two parts meet in a tree.
GROUP, GROUP_TOKENS = 4096, 1_000_000
#: Bytes of text that are hashed at once: a worker takes some forty times as much.
CHUNK = 1_000_000
_TOP = np.uint64(1 << 63)


class Order:
    """The global order: a token (63 bits) becomes a key; keys compare as the order does."""

    def __init__(self, tokens: np.ndarray):
        """tokens: the frequent ones, by ascending count."""
        self.by_value = np.argsort(tokens)
        self.tokens = tokens[self.by_value]

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return tokens
        at = np.searchsorted(self.tokens, tokens)
        at[at == len(self.tokens)] = 0
        return np.where(self.tokens[at] == tokens, _TOP + self.by_value[at].astype(np.uint64), tokens)


def shingle_sets(texts: list[str], order: Order | None = None, k: int = K) -> Iterator[np.ndarray]:
    """Each text's set as ascending keys."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    for a, b in chunks(raw, CHUNK):
        h, bounds = texts_words(raw[a:b], lower=True)
        grams = runs_hash(h, k) >> np.uint64(1)
        if order:
            grams = order(grams)
        for i in range(b - a):
            lo, hi = bounds[i], bounds[i + 1]
            if hi - lo >= k:
                yield np.unique(grams[lo : hi - k + 1])
            elif hi > lo:
                one = runs_hash(h[lo:hi], int(hi - lo)) >> np.uint64(1)
                yield order(one) if order else one
            else:
                yield np.empty(0, np.uint64)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _node(keys: np.ndarray) -> int:
    """The class of a set: equal sets have equal classes (64 bits)."""
    return xxhash.xxh3_64_intdigest(keys.tobytes(), len(keys))


def _signed(x: np.ndarray) -> np.ndarray:
    return (x ^ _TOP).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(np.concatenate(arrays)) if arrays else np.empty(0, np.int64)))


class Tree:
    """Sets of integers from 0 on, each ascending, in a path-compressed prefix tree."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        """sizes: the sets' full sizes, tokens that are not stored included."""
        keys = [s.astype(">u4").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.sets, self.sizes = sets, sizes
        #: a node: (member whose set spells it, from, to, first and last + 1 of the members below in order, parent)
        self.nodes: list[list[int]] = []
        stack: list[int] = []
        for pos, m in enumerate(self.order):
            s = sets[m]
            common = 0
            if pos:
                p = sets[self.order[pos - 1]]
                n = min(len(p), len(s))
                differ = np.flatnonzero(p[:n] != s[:n])
                common = int(differ[0]) if len(differ) else n
            while stack and self.nodes[stack[-1]][2] > common:
                node = self.nodes[stack[-1]]
                if node[1] < common:  # the path splits inside this node: a new one takes its head
                    head = [node[0], node[1], common, node[3], pos, node[5]]
                    self.nodes.append(head)
                    node[1], node[5], node[4] = common, len(self.nodes) - 1, pos
                    stack[-1] = len(self.nodes) - 1
                    break
                node[4] = pos
                stack.pop()
            if len(s) > common or not pos:
                self.nodes.append([m, common, len(s), pos, pos + 1, stack[-1] if stack else -1])
                stack.append(len(self.nodes) - 1)
        for i in stack:
            self.nodes[i][4] = len(self.order)
        self.children: list[list[int]] = [[] for _ in self.nodes]
        self.roots = []
        for i, node in enumerate(self.nodes):
            (self.children[node[5]] if node[5] >= 0 else self.roots).append(i)

    def traverse(self, vocabulary: int, percent: int, block: int = 512) -> Iterator[tuple[np.ndarray, int]]:
        """Per block of probes and set: the probes (numbers of sets) that are similar to it, and the set."""
        order, sizes = np.array(self.order), self.sizes
        block = max(8, min(block, (32 << 20) // vocabulary))  # the matrix of probes and tokens takes 32 MB or so
        lengths = np.array([len(s) for s in self.sets])
        for begin in range(0, len(order), block):
            probes = order[begin : begin + block]
            member = np.zeros((vocabulary, len(probes)), np.uint8)
            for j, p in enumerate(probes):
                member[self.sets[p], j] = 1
            n, m = sizes[probes], lengths[probes]
            todo = [(r, np.arange(len(probes)), np.zeros(len(probes), np.int32)) for r in self.roots]
            while todo:
                i, who, overlap = todo.pop()
                spell, a, b, lo, hi, _ = self.nodes[i]
                run = self.sets[spell][a:b]
                if len(run):
                    got = member[run] if len(who) == len(probes) else member[run][:, who]
                    overlap = overlap + got.sum(0, dtype=np.int32)
                below = order[lo:hi]
                least, most = sizes[below].min(), sizes[below].max()
                reach = overlap + np.minimum(lengths[below].max() - b, m[who] - overlap)
                stay = (reach * (100 + percent) >= percent * (n[who] + least)) & (100 * most >= percent * n[who]) & (percent * least <= 100 * n[who])
                if not stay.any():
                    continue
                who, overlap = who[stay], overlap[stay]
                for s in below[lengths[below] == b] if self.children[i] else below:
                    hit = overlap * (100 + percent) >= percent * (n[who] + sizes[s])
                    if hit.any():
                        yield probes[who[hit]], int(s)
                todo += [(c, who, overlap) for c in self.children[i]]


def join_group(sets: list[np.ndarray], weights: np.ndarray, parts: np.ndarray | None = None, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The links of a tree's members: each member's smallest connected member, and the weight of those that it is linked to. parts: only pairs of different parts count."""
    sizes = np.array([len(s) for s in sets])
    every, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # what one member alone has cannot overlap; the rest keeps the global order, from its frequent end on, so that paths are shared
    shared = counts > 1
    vocabulary = int(shared.sum())
    rank = np.where(shared, vocabulary - np.cumsum(shared), vocabulary).astype(np.int32)
    ends = np.cumsum(sizes)
    ranked = [(r := rank[inverse[e - n : e]])[r < vocabulary][::-1] for e, n in zip(ends, sizes)]
    del every, inverse, rank
    label, linked = np.arange(len(sets)), np.zeros(len(sets), np.int64)
    for probes, s in Tree(ranked, sizes).traverse(max(1, vocabulary), percent):
        if parts is not None:
            probes = probes[parts[probes] != parts[s]]
        linked[s] += weights[probes[probes != s]].sum()
        found = np.unique(label[np.append(probes, s)])
        if len(found) > 1:
            label[np.isin(label, found)] = found[0]
    return label, linked


def bit_set(keys: np.ndarray) -> bytes:
    """A set's tokens hashed into 1 to 2 bits a token: the bits that one set has and another lacks are tokens that they do not share."""
    size = max(64, 1 << int(len(keys) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(mix64(keys) & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _close(sizes: np.ndarray, bits: list[bytes], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of the members of a group, each with those that may be similar to it by their sizes and bits: no similar pair is missed."""
    lengths = np.array([len(b) for b in bits])
    for length in np.unique(lengths):
        # sizes of similar sets are within percent / 100, so their bits are as many or twice as many
        same, twice = (x[np.argsort(sizes[x], kind="stable")] for x in (np.flatnonzero(lengths == length), np.flatnonzero(lengths == 2 * length)))
        at = np.concatenate([same, twice])
        rows = [np.frombuffer(bits[i], np.uint64) for i in same]
        rows += [np.bitwise_or.reduce(np.frombuffer(bits[i], np.uint64).reshape(2, -1)) for i in twice]
        table, n = np.stack(rows), sizes[at]
        # in order of size: what is too large for i comes last
        ends = np.searchsorted(n, n * 100 // percent, "right")
        for i in range(len(same)):
            rest, size = table[i + 1 : ends[i]], n[i + 1 : ends[i]]
            mine = n[i] - np.bitwise_count(table[i] & ~rest).sum(1, dtype=np.int64)
            other = size - np.bitwise_count(rest & ~table[i]).sum(1, dtype=np.int64)
            hit = np.minimum(mine, other) * (100 + percent) >= percent * (n[i] + size)
            if hit.any():
                yield at[i], at[i + 1 : ends[i]][hit]


def may_link(sizes: np.ndarray, bits: list[bytes], percent: int = PERCENT) -> np.ndarray:
    """Of the members of a group, those that may be similar to another."""
    out = np.zeros(len(sizes), bool)
    for i, others in _close(sizes, bits, percent):
        out[i] = out[others] = True
    return out


def may_reach(sizes: np.ndarray, bits: list[bytes], percent: int = PERCENT) -> np.ndarray:
    """For each member of a group the first one that it hangs together with by pairs that may be similar: itself, if there is none."""
    label = np.arange(len(sizes))
    for i, others in _close(sizes, bits, percent):
        found = np.unique(label[np.append(others, i)])
        if len(found) > 1:
            label[np.isin(label, found)] = found[0]
    return label


def _shared(posts: DataFrame, rows: int) -> DataFrame:
    """Those posts whose token has more than one: most tokens have one, and to tell them by a count alone moves a token and its count, not what tells groups apart."""
    counts = materialize(posts.groupBy(F.col("token").alias("_token")).agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "jaccard-tokens")
    out = materialize(join_skewed(posts, counts, "token", "_token", "size", rows).select("token", "node"), "jaccard-posts")
    forget(counts)
    return out


def _groups(posts: DataFrame) -> DataFrame:
    """posts: token, node, each pair once. The tokens of two nodes or more: token, low and high (nodes), size, and m1, m2 that tell groups of other members apart."""
    mark = lambda seed: F.sum(F.shiftright(F.xxhash64("node", F.lit(seed)), 34))
    groups = posts.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("size"), mark(1).alias("m1"), mark(2).alias("m2"))
    return groups.where("size > 1")


def _first_of_equal(groups: DataFrame) -> DataFrame:
    """Of the groups with the same members, that of the first token."""
    return groups.groupBy("low", "high", "size", "m1", "m2").agg(F.min("token").alias("_token")).select("_token", "low", "size")


def _cells(members: DataFrame, sets: DataFrame) -> DataFrame:
    """members: token (of a group or family), node, parts. Deals each group to cells of two of its parts, so that any two members meet; with what sets has of each node. Cells lie together."""
    cells = members.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.select("token", "node", "part", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.join(sets, "node").repartition(n, "token", "one", "two").sortWithinPartitions("token", "one", "two", "node")


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], list[dict]]]:
    """The rows of each cell of two members or more."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            at = (row["token"], row["one"], row["two"])
            if at != key:
                if len(rows) > 1:
                    yield key, rows
                key, rows = at, []
            rows.append(row)
    if len(rows) > 1:
        yield key, rows


def frequent_order(docs: DataFrame, text: str) -> Order:
    """Finds the frequent shingles: those in SEEN_FROM texts of one chunk of a few thousand count, their counts are summed over the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        own: set[int] = set()
        size = 0

        def flush() -> pa.RecordBatch:
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(tokens[n >= SEEN_FROM].view(np.int64)), pa.array(n[n >= SEEN_FROM])], names=["token", "n"])

        for batch in batches:
            for s in shingle_sets([t or "" for t in batch.column(0).to_pylist()]):
                if (node := _node(s)) in own:  # equal sets are one class
                    continue
                own.add(node)
                held.append(s)
                size += len(s)
                if size > 2_000_000:
                    yield flush()
                    held, own, size = [], set(), 0
        if held:
            yield flush()

    seen = docs.select(text).mapInArrow(releasing(run), "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    top = seen.where(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "token").limit(FREQUENT).toPandas()  # FREQUENT rows at most
    return Order(top["token"].to_numpy(np.int64).view(np.uint64)[::-1].copy())


def similar(docs: DataFrame, percent: int = PERCENT, k: int = K, text: str = "text") -> DataFrame:
    """Links all rows of docs whose sets have a Jaccard similarity of percent / 100 or more. One row per input row: doc_id, n_shingles,
    component_id (the smallest id that links lead to, its own included), n_links (rows that it is linked to, equal ones included).

    Nulls: a null text is empty; a row with a null id takes part, and a component of null ids alone has the id null. An empty text (no words) has
    an empty set and no links: its component is itself. Repeated rows are rows of their own, linked to each other. An empty table gives no rows.
    Other columns are not read."""
    spark = docs.sparkSession
    small_batches(spark)
    order = spark.sparkContext.broadcast(frequent_order(docs, text))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets([t or "" for t in batch.column(1).to_pylist()], order.value, k))
            nodes = np.array([_node(s) for s in found], np.uint64).view(np.int64)
            cols = [batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(nodes), _lists([s[: prefix_length(len(s), percent)] for s in found]), pa.array([bit_set(s) for s in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n", "node", "prefix", "bits"])

    base = materialize(docs.select("doc_id", text).mapInArrow(releasing(sets), f"doc_id {kind}, n bigint, node bigint, prefix array<bigint>, bits binary"), "jaccard-sets")

    # each large table goes as soon as nothing reads it any more, and each large shuffle is a job of its own: the disk holds one of them at a time
    slim = materialize(base.select("doc_id", F.col("n").alias("n_shingles"), "node"), "jaccard-rows")
    some = base.where("n > 0")
    signed = materialize(some.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("prefix").alias("prefix"), F.count(F.lit(1)).alias("weight")), "jaccard-signed")
    forget(base)
    classes = materialize(signed.select("node", "doc_id", "n", "weight"), "jaccard-classes")
    n_tokens = signed.agg(F.sum(F.size("prefix"))).first()[0] or 0

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_cell(batches):
            nodes = np.array([r["node"] for r in rows], np.int64)
            label = may_reach(np.array([r["n"] for r in rows]), [r["bits"] for r in rows], percent)
            keep = label != np.arange(len(rows))
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(nodes[label][keep])], names=["a", "b"])

    # groups: a token and the classes that have it in their prefix
    posts = _shared(signed.select("node", F.explode("prefix").alias("token")), n_tokens)
    groups = join_skewed(posts, _first_of_equal(_groups(posts)), "token", "_token", "size", n_tokens)
    groups = materialize(groups.select("token", "node", F.ceil(F.col("size") / GROUP).cast("int").alias("parts")), "jaccard-groups")
    forget(posts)
    near = _cells(groups, signed.select("node", "n", "bits")).mapInArrow(releasing(filtered), "a bigint, b bigint").distinct()
    near = materialize(near, "jaccard-near")
    forget(groups)
    forget(signed)
    # what is left hangs together in families, by its pairs: groups have members in common far more often, the more rows there are, and would be one family in the end
    family = components(near, "jaccard-families").withColumnRenamed("root", "token")
    family = materialize(family.join(classes.select("node", "n"), "node"), "jaccard-families")
    extent = family.groupBy(F.col("token").alias("_token")).agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("tokens"))
    parts = F.greatest(F.ceil(F.col("members") / GROUP), F.ceil(F.col("tokens") / GROUP_TOKENS)).cast("int")
    posts = join_skewed(family, extent, "token", "_token", "members", n_tokens).select("token", "node", parts.alias("parts"))

    # the classes' whole sets, from one document each
    wanted = materialize(classes.select("node", "doc_id").join(family.select("node"), "node", "left_semi").select(F.col("doc_id").alias("_id")), "jaccard-wanted")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets([t or "" for t in batch.column(0).to_pylist()], order.value, k))
            nodes = np.array([_node(s) for s in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([s.tobytes() for s in found], pa.binary())], names=["node", "keys"])

    # most texts are not wanted: a bit map tells nearly all of them, the others meet the ids
    texts = mapped(docs.select("doc_id", text), "doc_id", bit_map(wanted, "_id")).where("_mapped")
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select(text)
    full = materialize(texts.mapInArrow(releasing(whole), "node bigint, keys binary").dropDuplicates(["node"]), "jaccard-full")
    forget(wanted)
    cells = _cells(posts, full.join(classes.select("node", "weight"), "node"))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, one, two), rows in _by_cell(batches):
            nodes = np.array([r["node"] for r in rows], np.int64)
            cross = np.array([r["part"] for r in rows]) if one != two else None
            label, linked = join_group([np.frombuffer(r["keys"], np.uint64) for r in rows], np.array([r["weight"] for r in rows], np.int64), cross, percent)
            keep = (label != np.arange(len(rows))) | (linked > 0)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(nodes[label][keep]), pa.array(linked[keep])], names=["a", "b", "linked"])

    links = materialize(cells.mapInArrow(releasing(trees), "a bigint, b bigint, linked bigint"), "jaccard-links")
    forget(full)
    roots = components(links.select("a", "b"))
    degree = links.groupBy(F.col("a").alias("node")).agg(F.sum("linked").alias("linked"))
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy(F.col("root").alias("_root")).agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("_n"))
    named = materialize(named.select("node", "doc_id", "weight", "root").join(smallest, F.col("root") == F.col("_root")).join(degree, "node", "left").select(F.col("node").alias("_node"), "component_id", (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "weight"), "jaccard-named")
    out = join_skewed(slim.where("n_shingles > 0"), named, "node", "_node", "weight", n_tokens).select("doc_id", "n_shingles", "component_id", "n_links")
    out = out.unionByName(slim.where("n_shingles = 0").select("doc_id", "n_shingles", F.lit(None).cast(kind).alias("component_id"), F.lit(0).cast("long").alias("n_links")))
    alone = F.col("n_shingles") == 0
    return out.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.b FROM reach r JOIN e ON r.y = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(y) FROM reach WHERE x = w.doc_id) AS component_id, (SELECT count(*) FROM e WHERE e.a = w.doc_id) AS n_links FROM w LEFT JOIN n USING (doc_id)
"""
