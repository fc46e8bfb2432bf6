"""Exact substring duplicates by prefix-partitioned suffix trees over words.

A suffix matters by its first `window` words; its anchor is the least hash among the 6-word runs in them, so suffixes
that begin with the same window have the same anchor. An anchor that the corpus has once rules its suffixes out. The
suffixes that follow one another under one anchor travel together, as a segment of some 27 words of text.

Variable-length prefixes split the suffixes into groups that fit a task's memory. An anchor with few segments is a group
as it is. The suffixes of a frequent anchor leave their segments: equal ones are combined on the map side first, what
stays is grouped by its first 8 words, where these are too frequent by the first 14, then by the whole window, and one
window that is too frequent by itself is split by document and closed by the least of its parts' first leaves.

In a group the suffixes are put in order by their words (ranks of runs of 1, 2, 4, 8 and 16 words, found by doubling);
words are told apart by their bytes. The longest common prefixes of neighbours in that order are the tree: a run of
neighbours with d words in common or more is an internal node of depth d. A leaf takes the deepest node of `window` words or
more in which a leaf starts earlier: it repeats that leaf for d words. Repeats that lie in longer ones are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import chunks, materialize, read, runs_hash, small_batches, word_hashes

WINDOW = 20
#: Words of an anchor, and of the two prefixes that are shorter than the window.
ANCHOR, PREFIXES = 6, (8, 14)
#: Segments or suffixes of a group at most, those of the trees that are built at a time, and windows of a segment.
GROUP_ROWS, TREE_ROWS, SEGMENT = 4096, 30_000, 64
#: Bits of the anchors' maps (8 MB each, whatever the input). A full map lets unique anchors through: these cost time, not results.
MAP_BITS = 26
_MAX = np.uint64((1 << 64) - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NULL_ID = (1 << 63) - 1


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over each width consecutive elements."""
    have = 1
    while 2 * have <= width:
        x = op(x[:-have], x[have:])
        have *= 2
    return op(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


class Windows:
    """The windows of some texts, by their first word: whether whole, and the hash of their anchor."""

    def __init__(self, texts: list[bytes], window: int = WINDOW):
        self.data = b" ".join(texts)
        self.words, self.begin, self.end = word_hashes(self.data, False)
        self.bounds = np.concatenate(([0], np.searchsorted(self.begin, np.cumsum([len(t) + 1 for t in texts]))))
        n, self.window, width = len(self.words), window, window - ANCHOR + 1
        ends = np.repeat(self.bounds[1:], np.diff(self.bounds))
        at = np.arange(n)
        self.runs = np.full(n, _MAX)
        if n >= ANCHOR:
            self.runs[: n - ANCHOR + 1] = runs_hash(self.words, ANCHOR)
        self.runs[at + ANCHOR > ends] = _MAX
        self.whole = at + window <= ends
        self.least = _slide(np.append(self.runs, np.full(width - 1, _MAX)), width, np.minimum)
        self.least[~self.whole] = 0
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def anchors(self) -> np.ndarray:
        """The anchors of all windows, one for each place that holds one."""
        width = self.window - ANCHOR + 1
        most = _slide(np.append(np.zeros(width - 1, np.uint64), self.least), width, np.maximum)
        return self.runs[(most == self.runs) & (self.runs != _MAX)]


def _slot(anchors: np.ndarray) -> np.ndarray:
    return ((anchors * _STEP) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _marked(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def _texts(column: pa.Array) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def anchor_maps(docs: DataFrame, text: str, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed bits: the slots of the anchors that occur twice or more, and of those that occur over GROUP_ROWS times."""
    limit = GROUP_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(0))
            for a, b in chunks(texts):
                found, n = np.unique(Windows(texts[a:b], window).anchors(), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    twice = docs.select(text).mapInArrow(run, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", (F.col("n") > limit).alias("many"))
    piece_bits = MAP_BITS - 6

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, many = _slot(batch.column(0).to_numpy().view(np.uint64)), batch.column(1).to_numpy(zero_copy_only=False)
            for kind, some in ((0, s), (1, s[many])):
                u = np.unique(some)
                yield pa.RecordBatch.from_arrays([pa.array((u >> piece_bits).astype(np.int32) + 64 * kind), pa.array((u & ((1 << piece_bits) - 1)).astype(np.int32))], names=["piece", "slot"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            piece, slot = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for p in np.unique(piece):
                maps.setdefault(int(p), np.zeros(1 << piece_bits, bool))[slot[piece == p]] = True
        if maps:
            yield pa.RecordBatch.from_arrays([pa.array([*maps], pa.int32()), pa.array([np.packbits(m).tobytes() for m in maps.values()], pa.binary())], names=["piece", "bits"])

    pieces = twice.mapInArrow(slots, "piece int, slot int").repartition(64, "piece").mapInArrow(pack, "piece int, bits binary")
    out = np.zeros((128, 1 << (piece_bits - 3)), np.uint8)
    for row in pieces.collect():  # 128 rows of fixed size
        out[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return out[:64].ravel(), out[64:].ravel()


# --- trees ---------------------------------------------------------------------------------------------------------------


def exact_ids(data: bytes, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Numbers of the words data[start:end], equal where the words are. The hashes h only speed this up: bytes decide."""
    _, first, ids = np.unique(h, return_index=True, return_inverse=True)
    buf, n, rep = np.frombuffer(data, np.uint8), end - start, first[ids]
    same = bool((n == n[rep]).all())
    for a in range(0, len(n) if same else 0, 1 << 17):
        part = slice(a, a + (1 << 17))
        m = n[part]
        inside = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        if not (buf[np.repeat(start[part], m) + inside] == buf[np.repeat(start[rep[part]], m) + inside]).all():
            same = False
            break
    if not same:  # two words of one hash
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(data[a:b], len(known)) for a, b in zip(start, end)), np.int64, len(start))
    return ids


class Repeats(NamedTuple):
    """Spans of words that repeat earlier ones, and the first leaf of each node of depth `window` (leaves without a node included)."""

    segment: np.ndarray  # of each span
    start: np.ndarray
    length: np.ndarray
    first_segment: np.ndarray
    first_start: np.ndarray
    lead_segment: np.ndarray  # of each first leaf
    lead_start: np.ndarray


def suffix_trees(blobs: list[bytes], key: np.ndarray, start: np.ndarray, count: np.ndarray, window: int) -> Repeats:
    """blobs: the words of each segment; key, start: document and place of its first word; count: suffixes in it, each with window words or more."""
    data = b"\n".join(blobs)
    h, begin, end = word_hashes(data, False)
    offset = np.cumsum([0, *(len(b) + 1 for b in blobs)])
    bounds = np.searchsorted(begin, offset)
    # every segment ends in a mark of its own
    ids, n_segments = exact_ids(data, h, begin, end), len(blobs)
    tokens = np.insert(ids, bounds[1:], ids.max(initial=0) + 1 + np.arange(n_segments))
    first_token = bounds[:-1] + np.arange(n_segments)
    ranks, step = [tokens], 1
    while 2 * step <= window:
        r = ranks[-1]
        _, r = np.unique(r * (int(r.max()) + 1) + np.append(r[step:], np.zeros(step, r.dtype)), return_inverse=True)
        ranks.append(r)
        step *= 2
    segment = np.repeat(np.arange(n_segments), count)
    place = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)
    at, leaf_key, leaf_start = first_token[segment] + place, key[segment], start[segment] + place
    last, depth = len(tokens) - 1, 2 * step
    order = np.lexsort((ranks[-1][np.minimum(at + step, last)], ranks[-1][at]))
    a, b = at[order[:-1]], at[order[1:]]
    common = np.zeros(len(a), np.int64)
    for r, words in [(ranks[-1], step), *((r, 1 << j) for j, r in reversed([*enumerate(ranks)]))]:
        x, y = np.minimum(a + common, last), np.minimum(b + common, last)
        common += np.where((r[x] == r[y]) & (x != y), words, 0)
    common = np.minimum(common, depth)

    # leaves in the order of the tree; seniority: equal for rows that are repeated whole
    by_age = np.lexsort((leaf_start, leaf_key))
    new = np.ones(len(by_age), np.int64)
    new[1:] = (leaf_key[by_age][1:] != leaf_key[by_age][:-1]) | (leaf_start[by_age][1:] != leaf_start[by_age][:-1])
    age = np.empty(len(by_age), np.int64)
    age[by_age] = np.cumsum(new)
    age, n = age[order], len(order)
    cut = np.concatenate(([0], np.flatnonzero(common < window) + 1)) if n else np.empty(0, np.int64)
    sizes = np.diff(np.append(cut, n))
    inner = np.flatnonzero(np.repeat(sizes > 1, sizes))  # leaves below a node
    lead = _least_of(age, cut)
    found, witness = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if len(inner):
        sub = age[inner]
        link = np.where(np.diff(inner) == 1, common[inner[:-1]], 0) if n > 1 else np.empty(0, np.int64)
        got, who = np.zeros(len(inner), np.int64), np.zeros(len(inner), np.int64)
        for d in range(int(link.max(initial=0)), window - 1, -1):
            edges = np.concatenate(([0], np.flatnonzero(link < d) + 1))
            least = _least_of(sub, edges)
            of = np.repeat(least, np.diff(np.append(edges, len(sub))))
            mine = (got == 0) & (sub[of] < sub)
            got[mine], who[mine] = d, of[mine]
        found[inner], witness[inner] = got, inner[who]
    # by segment and place; a repeat that an earlier one reaches over adds nothing
    hit = np.flatnonzero(found)
    hit = hit[np.argsort(order[hit], kind="stable")]
    leaf, other = order[hit], order[witness[hit]]
    stop = place[leaf] + found[hit]
    reach = np.maximum.accumulate(stop + segment[leaf] * (int(count.max()) + depth)) if len(leaf) else stop
    keep = np.ones(len(leaf), bool)
    keep[1:] = (segment[leaf][1:] != segment[leaf][:-1]) | (reach[1:] > reach[:-1])
    leaf, other, length = leaf[keep], other[keep], found[hit][keep]
    return Repeats(segment[leaf], leaf_start[leaf], length, segment[other], leaf_start[other], segment[order[lead]], leaf_start[order[lead]])


def _least_of(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where the first least element of each run x[edges[i]:edges[i + 1]] is."""
    if not len(x):
        return np.empty(0, np.int64)
    least = np.repeat(np.minimum.reduceat(x, edges), np.diff(np.append(edges, len(x))))
    at = np.flatnonzero(x == least)
    return at[np.searchsorted(at, edges)]


# --- from texts to groups ------------------------------------------------------------------------------------------------

#: kind 0: a segment (size suffixes, words), by its anchor; 1: a suffix of a frequent anchor, by its prefixes; 2: a span (size words) that repeats an earlier one.
_SUFFIXES = "kind int, key bigint, row int, start int, size int, p1 bigint, p2 bigint, p3 bigint, words binary, first_key bigint, first_start int"
_SPANS = "key bigint, row int, start int, size int, first_key bigint, first_start int, words binary"


def _batch(schema: str, n: int, **columns) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    arrays = [pa.nulls(n, kinds[t]) if columns.get(c) is None else columns[c] if isinstance(columns[c], pa.Array) else pa.array(columns[c], kinds[t]) for c, t in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[c for c, _ in fields])


def _keyed(docs: DataFrame, text: str) -> tuple[Column, Column, str]:
    """The key of a document (null ids: the largest long), what tells rows of one key apart, and the text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("key"), F.shiftright(F.xxhash64(F.coalesce(text, F.lit(""))), 33).cast("int").alias("row"), text


def suffixes(docs: DataFrame, text: str, window: int) -> DataFrame:
    """The suffixes that may begin with a repeated window, as _SUFFIXES says."""
    maps = docs.sparkSession.sparkContext.broadcast(anchor_maps(docs, text, window))

    def of_texts(keys: np.ndarray, rows: np.ndarray, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        w = Windows(texts, window)
        at = np.flatnonzero(w.whole)
        slot = _slot(w.least[at])
        repeated = _marked(maps.value[0], slot)
        at, slot = at[repeated], slot[repeated]
        if not len(at):
            return
        # runs of neighbours with one anchor
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (w.least[at][1:] != w.least[at][:-1]) | (w.text_of[at][1:] != w.text_of[at][:-1])
        run = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        new |= (np.arange(len(at)) - run) % SEGMENT == 0
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(at)))
        first = at[head]
        t, heavy, anchor = w.text_of[first], _marked(maps.value[1], slot[head]), w.least[first].view(np.int64)
        start = first - w.bounds[t]
        blobs = [w.data[a:b] for a, b in zip(w.begin[first], w.end[first + size + window - 2])]
        light = np.flatnonzero(~heavy)
        if len(light):
            yield _batch(_SUFFIXES, len(light), kind=np.zeros(len(light), np.int32), key=keys[t[light]], row=rows[t[light]], start=start[light].astype(np.int32), size=size[light].astype(np.int32), p1=anchor[light], words=[blobs[i] for i in light])
        some = np.flatnonzero(heavy)
        for i in range(0, len(some), TREE_ROWS):
            part = some[i : i + TREE_ROWS]
            tree = suffix_trees([blobs[j] for j in part], keys[t[part]], start[part], size[part], window)
            own, other = t[part][tree.segment], t[part][tree.first_segment]
            if len(own):
                yield _batch(_SUFFIXES, len(own), kind=np.full(len(own), 2, np.int32), key=keys[own], row=rows[own], start=tree.start.astype(np.int32), size=tree.length.astype(np.int32), first_key=keys[other], first_start=tree.first_start.astype(np.int32))
            own = t[part][tree.lead_segment]
            word = w.bounds[own] + tree.lead_start
            prefix = [runs_hash(w.words, k)[word].view(np.int64) for k in (*PREFIXES, window)]
            yield _batch(_SUFFIXES, len(own), kind=np.ones(len(own), np.int32), key=keys[own], row=rows[own], start=tree.lead_start.astype(np.int32), size=np.ones(len(own), np.int32), p1=prefix[0], p2=prefix[1], p3=prefix[2], words=[b" ".join(w.data[a:b].split()) for a, b in zip(w.begin[word], w.end[word + window - 1])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _texts(batch.column(2))
            for a, b in chunks(texts):
                yield from of_texts(keys[a:b], rows[a:b], texts[a:b])

    return docs.select(*_keyed(docs, text)).mapInArrow(run, _SUFFIXES)


def _grouped(rows: DataFrame) -> DataFrame:
    """Adds group, and salted: the suffix's group is one of several that hold the same window."""
    limit = GROUP_ROWS
    light = rows.where("kind = 0").select("*", F.col("p1").alias("group"), F.lit(False).alias("salted"))
    single = rows.where("kind = 1")
    if single.isEmpty():
        return light

    def frequent(df: DataFrame, prefix: str) -> DataFrame:
        """Its prefixes of over GROUP_ROWS suffixes, so few: at most one for every GROUP_ROWS suffixes."""
        return materialize(df.groupBy(prefix).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit), "prefixes").select(F.col(prefix).alias("_p"), F.ceil(F.col("n") / limit).cast("int").alias("_parts"))

    out, level = [], single
    for i, prefix in enumerate(("p1", "p2", "p3")):
        longer = frequent(level, prefix)
        here = level.join(longer, level[prefix] == longer["_p"], "left_anti")
        out.append(here.select("*", F.xxhash64(F.lit(i), prefix).alias("group"), F.lit(False).alias("salted")))
        rest = level.join(longer, level[prefix] == longer["_p"])
        level = rest.drop("_p", "_parts")
    salt = F.pmod(F.xxhash64("key", "row"), F.col("_parts"))
    out.append(rest.withColumn("group", F.xxhash64(F.lit(3), "p3", salt)).withColumn("salted", F.lit(True)).drop("_p", "_parts"))
    for more in out:
        light = light.unionByName(more)
    return light


def repeats(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """Spans of window words or more that start earlier too (at a smaller id, or in the same document further ahead), each within the reach of one anchor: key (id; null: the
    largest long), row (tells rows of one id apart), start, size (words), first_key, first_start. Every repeated window is in one of them."""
    if window < PREFIXES[-1]:
        raise ValueError(f"windows have {PREFIXES[-1]} words at least")
    spark = docs.sparkSession
    small_batches(spark)
    rows = materialize(suffixes(docs, text, window), "suffixes")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.where("kind < 2").count() // (8 * TREE_ROWS)))
    group = _grouped(rows).select("key", "row", "start", "size", "words", "salted", "group").repartition(n, "group").sortWithinPartitions("group")

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, row, start, size, salted = (np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts]) for c in (0, 1, 2, 3, 5))
            blobs = [b for p in parts for b in p.column(4).to_pylist()]
            tree = suffix_trees(blobs, key, start, size, window)
            s, f = tree.segment, tree.first_segment
            yield _batch(_SPANS, len(s), key=key[s], row=row[s], start=tree.start.astype(np.int32), size=tree.length.astype(np.int32), first_key=key[f], first_start=tree.first_start.astype(np.int32))
            lead = tree.lead_segment[salted[tree.lead_segment]]
            yield _batch(_SPANS, len(lead), key=key[lead], row=row[lead], start=start[lead], size=np.full(len(lead), window, np.int32), words=[blobs[i] for i in lead])

        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            while batch.num_rows:
                g = batch.column(6).to_numpy()
                # trees are closed between groups only
                edge = np.flatnonzero(np.append([g[0] != last], g[1:] != g[:-1])) if last is not None else np.flatnonzero(np.append([False], g[1:] != g[:-1]))
                edge = edge[size + edge >= TREE_ROWS]
                cut = int(edge[0]) if len(edge) else batch.num_rows
                if cut:
                    held.append(batch.slice(0, cut))
                    size, last = size + cut, g[cut - 1]
                if len(edge):
                    yield from build(held)
                    held, size, last = [], 0, None
                batch = batch.slice(cut)
        if held:
            yield from build(held)

    spans = materialize(group.mapInArrow(trees, _SPANS), "spans")
    out = spans.where("words is null").drop("words").unionByName(rows.where("kind = 2").select("key", "row", "start", "size", "first_key", "first_start"))
    firsts = spans.where("words is not null").drop("first_key", "first_start")
    node = firsts.groupBy("words").agg(F.min(F.struct("key", "start")).alias("m")).select("words", F.col("m.key").alias("first_key"), F.col("m.start").alias("first_start"))
    more = firsts.join(node, "words").where("key <> first_key or start <> first_start")
    return out.unionByName(more.drop("words"))


def maximal_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The repeats as spans: doc_id, start, length (words), first_id, first_start; spans that continue one another in both places are one."""
    at = W.partitionBy("key", "row", "first_key", "shift").orderBy("start", "size")
    spans = repeats(docs, window, text).withColumn("shift", F.col("start") - F.col("first_start")).withColumn("end", F.col("start") + F.col("size"))
    before = F.max("end").over(at.rowsBetween(W.unboundedPreceding, -1))
    spans = spans.withColumn("new", (F.coalesce(F.col("start") > before - window + 1, F.lit(True))).cast("int"))
    spans = spans.withColumn("run", F.sum("new").over(at.rowsBetween(W.unboundedPreceding, 0)))
    out = spans.groupBy("key", "row", "first_key", "shift", "run").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    back = lambda c: F.when(F.col(c) != _NULL_ID, F.col(c))
    return out.select(back("key").alias("doc_id"), "start", "length", back("first_key").alias("first_id"), (F.col("start") - F.col("shift")).alias("first_start"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", with_text: bool = False) -> DataFrame:
    """Removes every word that a repeated window covers. One row per input row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by
    one space), and kept_text where with_text is set.

    doc_id is an integer. Nulls: a null text has no words; rows with a null id are one document, the last. Rows of the same id are one document in that a window is not
    earlier than one at the same start; each row loses its own windows only. Repeated rows all stay or all lose alike. An empty table gives no rows. Other columns are not read."""
    found = repeats(docs, window, text)
    lists = found.groupBy("key", "row").agg(F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes"))
    rows = docs.select("doc_id", *_keyed(docs, text)).join(lists, ["key", "row"], "left").select("doc_id", text, "starts", "sizes")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(1))
            n_words, n_removed, kept = [], [], []
            for t, starts, sizes in zip(texts, batch.column(2), batch.column(3)):
                words = t.split()
                n_words.append(len(words))
                if starts.is_valid:
                    edge = np.zeros(len(words) + 1, np.int32)
                    np.add.at(edge, starts.values.to_numpy(), 1)
                    np.add.at(edge, starts.values.to_numpy() + sizes.values.to_numpy(), -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            cols = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols.append(pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept_text string" if with_text else ""))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS k FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM g) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM again, range(0, {WINDOW}) t(j)),
x AS (SELECT doc_id, p, w[p] AS x FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM w)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS s FROM x ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""
