"""Scores of texts under a gated recurrent language model, trained on the corpus.

Counting: words of all training documents are counted by a 64-bit hash; the counts stay a table. Symbols: the most frequent
words are symbols of their own, the end of a text is one, and all other words share symbols by their shape. The output
softmax is factored: first the class of a symbol, then the word within its class; a word behind a shape symbol has its
smoothed share of all words of that shape, so every text has a probability, words never seen included.

Training: truncated backpropagation in numpy. Every training document is seen once: the rounds deal them out by hash, and in
a round each task starts from the same parameters and trains on its own documents; the tasks' parameters are averaged by
tokens, in two steps of bounded size. Documents run side by side in lanes, one after the other in each; windows of STEPS tokens
are backpropagated, the state goes on from window to window and starts anew with each document.

Scoring: the same lanes without gradients, the state carried through whole documents. Counts of rare words are joined by key; those
of LISTED frequent ones travel with the tasks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import chunks, materialize, read, text_or_empty, word_hashes

#: Words with a symbol of their own and words a class of the output; words whose counts travel with the tasks; sizes of embedding and state.
WORDS, CLASS, LISTED, EMBED, STATE = 1024, 32, 1 << 18, 12, 16
#: Rounds of averaging; steps that are backpropagated, and steps of a window in scoring; lanes; updates that a task makes at least,
#: where it has the tokens; tokens that a task holds; tokens of a document that training takes with one state.
ROUNDS, STEPS, SCORE_STEPS, LANES, UPDATES, POOL, SEGMENT = 3, 32, 128, 256, 64, 4_000_000, 1024
RATE, CLIP, SEED = 0.01, 1.0, 7
#: Smoothing of counts.
ADDED = 0.1
#: Symbols of rare words: by length (four classes), a last character that is no letter, and characters beyond ASCII.
SHAPES = 16
#: Parameters a row when they are averaged, and groups of tasks of the first step.
VALUES, GROUPS = 4096, 64


# --- words and symbols -----------------------------------------------------------------------------------------------------


def shaped_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z as a-z), their shapes, and bounds: text i has words bounds[i]:bounds[i + 1]."""
    data = b" ".join(texts)
    h, start, end = word_hashes(data, True)
    buf = np.frombuffer(data, np.uint8)
    size = end - start
    beyond = np.concatenate(([0], np.cumsum(buf >= 128)))
    last = buf[end - 1] if len(end) else buf[:0]
    letter = (last >= 128) | ((last | 32) >= 97) & ((last | 32) <= 122)
    shape = np.searchsorted([5, 9, 13], size, side="right") + 4 * ~letter + 8 * (beyond[end] > beyond[start])
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return h, shape.astype(np.uint8), np.concatenate(([0], np.searchsorted(start, ends)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b["text"].cast(pa.binary()).to_pylist()
        for i, j in chunks(texts):
            h, shape, _ = shaped_words(texts[i:j])
            h, at, n = np.unique(h, return_index=True, return_counts=True)
            yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(shape[at].astype(np.int32)), pa.array(n)], ["h", "shape", "n"])


def word_counts(training: DataFrame) -> DataFrame:
    """training: text. h (hash), shape, n."""
    return training.mapInArrow(_count, "h long, shape int, n long").groupBy("h").agg(F.min("shape").alias("shape"), F.sum("n").alias("n"))


class Vocabulary:
    """What the tasks know of the counts: the listed words, and the sums over all words. symbols: words in order of their counts, then the end, then the shapes."""

    def __init__(self, h: np.ndarray, shape: np.ndarray, n: np.ndarray, shape_n: np.ndarray, shape_words: np.ndarray, ends: int, words: int = WORDS):
        order = np.lexsort((h, -n))
        self.words = min(words, len(h))
        own = order[: self.words]
        self.own_n = n[own]
        symbol = np.full(len(h), -1)
        symbol[own] = np.arange(self.words)
        by_hash = np.argsort(h)
        self.h, self.n, self.symbol = h[by_hash], n[by_hash], symbol[by_hash]
        self.ends, self.total = ends, int(shape_n.sum()) + ends
        self.distinct = int(shape_words.sum()) + (ends > 0)
        self.log_all = math.log10(self.total + ADDED * (self.distinct + 1))
        shared_n = shape_n - np.bincount(shape[own], self.own_n, SHAPES)
        # one word that was never seen belongs to each shape
        self.mass = shared_n + ADDED * (shape_words - np.bincount(shape[own], minlength=SHAPES) + 1)
        self.end = self.words
        self.classes = -(-self.words // CLASS)

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the listed words and whether the word is there."""
        if not len(self.h):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return at, self.h[at] == h


def vocabulary(counts: DataFrame, ends: int, words: int = WORDS, listed: int = LISTED) -> Vocabulary:
    """counts: what word_counts gives, written. Listed are all words with at least as many occurrences as bring no more than so many rows to the driver."""
    step = F.floor(F.log2("n") * 16).cast("int")
    sums = counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    steps = sorted(((r["k"], r["words"]) for r in counts.groupBy(step.alias("k")).agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    least, so_far = None, 0
    for k, w in steps:
        so_far += w
        if so_far > listed:
            break
        least = k
    t = counts.where(step >= F.lit(least if least is not None else 1 << 20)).toArrow()
    shape_n, shape_words = np.zeros(SHAPES), np.zeros(SHAPES, np.int64)
    for r in sums:
        shape_n[r["shape"]], shape_words[r["shape"]] = r["n"], r["words"]
    return Vocabulary(np.asarray(t["h"]).view(np.uint64), np.asarray(t["shape"]), np.asarray(t["n"]), shape_n, shape_words, ends, words)


def symbols(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """docs: columns to keep, and text. Adds n_tokens, n_known and log_base (base score; both over the words whose counts are listed, and the end), log_shared (log10 of count and ADDED over those of
    them that have no symbol of their own), symbols (two bytes each), and rest: hash and number of the words that are not listed."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b["text"].cast(pa.binary()).to_pylist()
            for i, j in chunks(texts):
                h, shape, bounds = shaped_words(texts[i:j])
                at, found = known.look_up(h)
                n = np.where(found, known.n[at] if len(known.n) else 0, 0)
                own = np.where(found, known.symbol[at] if len(known.n) else -1, -1)
                symbol = np.where(own >= 0, own, known.end + 1 + shape.astype(np.int64)).astype("<u2")
                logs = np.where(found, np.log10(n + ADDED), 0.0)
                k = j - i
                doc = np.repeat(np.arange(k), np.diff(bounds))
                log_end = math.log10(known.ends + ADDED) - known.log_all
                rest = [np.unique(h[a:z][~found[a:z]], return_counts=True) for a, z in zip(bounds[:-1], bounds[1:])]
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(r[0]) for r in rest]))), pa.int32())
                flat = lambda c, kind: pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([r[c] for r in rest]).astype(kind)))
                end = np.array([known.end], "<u2").tobytes()
                sums = lambda x: np.bincount(doc, x, k).astype(np.float64)  # noqa: E731  without words numpy would give whole numbers
                columns = [
                    pa.array(np.diff(bounds) + 1), pa.array(np.bincount(doc, found, k).astype(np.int64) + (known.ends > 0)), pa.array(sums(np.where(found, logs - known.log_all, 0)) + log_end),
                    pa.array(sums(np.where(own < 0, logs, 0))), pa.array([symbol[a:z].tobytes() + end for a, z in zip(bounds[:-1], bounds[1:])], pa.binary()), flat(0, np.int64), flat(1, np.int64),
                ]
                kept = b.drop_columns(["text"]).slice(i, k)
                yield pa.record_batch([*kept.columns, *columns], [*kept.schema.names, "n_tokens", "n_known", "log_base", "log_shared", "symbols", "rest_h", "rest_n"])

    return docs.mapInArrow(code, f"{kinds}, n_tokens long, n_known long, log_base double, log_shared double, symbols binary, rest_h array<long>, rest_n array<long>")


# --- the network -----------------------------------------------------------------------------------------------------------


class Network:
    """A gated recurrent unit over symbols; all parameters are views of one vector."""

    def __init__(self, known: Vocabulary, flat: np.ndarray | None = None, dtype: type = np.float32):
        self.words, self.end, self.classes = known.words, known.end, known.classes
        n, c = known.words + 1 + SHAPES, known.classes + 1 + SHAPES
        self.shapes = {"embed": (EMBED, n), "wx": (3 * STATE, EMBED), "b": (3 * STATE,), "u": (3 * STATE, STATE), "wc": (c, STATE), "bc": (c,), "wo": (known.classes, CLASS, STATE), "bo": (known.classes, CLASS)}
        if flat is None:
            flat = self._start(known)
        self.flat = flat.astype(dtype)
        self._views(self.flat, self)
        self.class_of = np.concatenate((np.arange(known.words) // CLASS, known.classes + np.arange(1 + SHAPES)))

    def _views(self, flat: np.ndarray, to) -> None:
        at = 0
        for name, shape in self.shapes.items():
            size = math.prod(shape)
            setattr(to, name, flat[at : at + size].reshape(shape))
            at += size

    def _start(self, known: Vocabulary) -> np.ndarray:
        """Small random weights; biases that make the shares of the counts."""
        rng = np.random.default_rng(SEED)
        flat = rng.normal(size=sum(math.prod(s) for s in self.shapes.values()))
        self._views(flat, self)
        self.embed *= 0.3
        self.wx *= EMBED**-0.5
        self.u *= STATE**-0.5
        self.b[:] = 0
        self.wc *= 0.1
        self.wo *= 0.1
        counts = np.zeros(known.classes * CLASS)
        counts[: known.words] = known.own_n + ADDED
        counts = counts.reshape(known.classes, CLASS)
        self.bc[:] = np.log(np.concatenate((counts.sum(axis=1), [known.ends + ADDED], known.mass)))
        self.bo[:] = np.log(np.maximum(counts, 1e-300))
        self.bo[counts == 0] = -1e4  # places of the last class that no word has
        return flat

    def states(self, x: np.ndarray, h: np.ndarray, anew: list) -> tuple:
        """x: symbols (steps, lanes); h: states before (STATE, lanes); anew: for each step, lanes whose document begins. States after each step (STATE, steps, lanes) and what gradients need."""
        steps, lanes = x.shape
        gates = (self.wx @ self.embed[:, x.ravel()] + self.b[:, None]).reshape(3 * STATE, steps, lanes)
        after, before, inner = (np.empty((STATE, steps, lanes), self.flat.dtype) for _ in range(3))
        for t in range(steps):
            if len(anew[t]):
                h = h.copy()
                h[:, anew[t]] = 0
            before[:, t] = h
            g = self.u @ h
            rz = gates[: 2 * STATE, t] + g[: 2 * STATE]
            rz *= 0.5
            np.tanh(rz, out=rz)
            rz *= 0.5
            rz += 0.5
            n = rz[:STATE] * g[2 * STATE :]
            n += gates[2 * STATE :, t]
            np.tanh(n, out=n)
            gates[: 2 * STATE, t], gates[2 * STATE :, t], inner[:, t] = rz, n, g[2 * STATE :]
            h = h - n
            h *= rz[STATE:]
            h += n
            after[:, t] = h
        return after, (before, gates, inner)

    def log_shares(self, h: np.ndarray, y: np.ndarray, grad: Network | None = None, weight: np.ndarray | None = None) -> np.ndarray | tuple:
        """Natural log of the probability of symbol y after state h (STATE, n), class times word; with grad, also adds the gradients of the weighted sum of -log and gives that of h."""
        every = np.arange(len(y))
        c = self.class_of[y]
        logits = self.wc @ h + self.bc[:, None]
        logits -= logits.max(axis=0)
        picked = logits[c, every]
        np.exp(logits, out=logits)
        total = logits.sum(axis=0)
        out = picked - np.log(total)
        if grad is not None:
            logits *= weight / total
            logits[c, every] -= weight
            grad.wc += logits @ h.T
            grad.bc += logits.sum(axis=1)
            dh = self.wc.T @ logits
        order = np.argsort(c.astype(np.int16), kind="stable")
        bounds = np.searchsorted(c[order], np.arange(self.classes + 1))
        sorted_h = h[:, order[: bounds[-1]]]
        sorted_dh = np.empty_like(sorted_h) if grad is not None else None
        for k in range(self.classes):
            i, j = bounds[k], bounds[k + 1]
            if i == j:
                continue
            own, mine, here = sorted_h[:, i:j], y[order[i:j]] - k * CLASS, np.arange(j - i)
            z = self.wo[k] @ own + self.bo[k][:, None]
            z -= z.max(axis=0)
            first = z[mine, here]
            np.exp(z, out=z)
            total = z.sum(axis=0)
            out[order[i:j]] += first - np.log(total)
            if grad is not None:
                w = weight[order[i:j]]
                z *= w / total
                z[mine, here] -= w
                grad.wo[k] += z @ own.T
                grad.bo[k] += z.sum(axis=1)
                sorted_dh[:, i:j] = self.wo[k].T @ z
        if grad is None:
            return out
        dh[:, order[: bounds[-1]]] += sorted_dh
        return out, dh

    def gradients(self, x: np.ndarray, y: np.ndarray, h: np.ndarray, anew: list, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of one window: gradient of the weighted sum of -log probabilities by all parameters, the log probabilities, and the states after it."""
        grad = Network.__new__(Network)
        grad.flat = np.zeros_like(self.flat)
        self._views(grad.flat, grad)
        after, (before, gates, inner) = self.states(x, h, anew)
        steps, lanes = x.shape
        out, dh_all = self.log_shares(after.reshape(STATE, -1), y.ravel(), grad, weight.ravel())
        dh_all = dh_all.reshape(STATE, steps, lanes)
        r, z, n = gates[:STATE], gates[STATE : 2 * STATE], gates[2 * STATE :]
        # how far each gate moves the state, for the whole window at once
        by_n = (1 - z) * (1 - n * n)
        by_r, by_z = inner * r * (1 - r), (before - n) * z * (1 - z)
        dx, dg = np.empty_like(gates), np.empty_like(gates)
        dh = np.zeros((STATE, lanes), self.flat.dtype)
        back = np.ascontiguousarray(self.u.T)
        for t in range(steps - 1, -1, -1):
            dh += dh_all[:, t]
            dn = dh * by_n[:, t]
            d = np.concatenate((dn * by_r[:, t], dh * by_z[:, t], dn * r[:, t]))
            dg[:, t] = d
            dx[2 * STATE :, t] = dn
            dh *= z[:, t]
            dh += back @ d
            if len(anew[t]):
                dh[:, anew[t]] = 0
        dx[: 2 * STATE] = dg[: 2 * STATE]
        dx, dg, ids = dx.reshape(3 * STATE, -1), dg.reshape(3 * STATE, -1), x.ravel()
        grad.u += dg @ before.reshape(STATE, -1).T
        grad.b += dx.sum(axis=1)
        grad.wx += dx @ self.embed[:, ids].T
        order = np.argsort(ids.astype(np.uint16), kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], np.diff(ids[order]) != 0)))
        grad.embed[:, ids[order[starts]]] += np.add.reduceat((self.wx.T @ dx)[:, order], starts, axis=1)
        return grad.flat, out.reshape(steps, lanes), after[:, -1]


class Lanes:
    """Documents side by side: each lane holds whole documents one after the other, the longest lane first. ids: symbols (steps, lanes); doc: which document, -1 after a lane's last."""

    def __init__(self, docs: list[np.ndarray], end: int, most: int):
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        n = int(max(1, min(most, sizes.sum() // max(1, sizes.max(initial=1)))))
        loads = [(0, i) for i in range(n)]
        placed: list[list[int]] = [[] for _ in range(n)]
        for d in np.argsort(-sizes, kind="stable").tolist():
            load, i = heapq.heappop(loads)
            placed[i].append(d)
            heapq.heappush(loads, (load + int(sizes[d]), i))
        lengths = np.zeros(n, np.int64)
        for load, i in loads:
            lengths[i] = load
        order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[order]
        self.ids = np.full((int(self.lengths[0]), n), end, np.uint16)
        self.doc = np.full(self.ids.shape, -1, np.int32)
        for lane, i in enumerate(order.tolist()):
            at = 0
            for d in placed[i]:
                self.ids[at : at + len(docs[d]), lane] = docs[d]
                self.doc[at : at + len(docs[d]), lane] = d
                at += len(docs[d])
        self.end = end

    def windows(self, steps: int) -> Iterator[tuple]:
        """Inputs, targets, documents, and for each step the lanes that begin a document, for the lanes that have not ended. An input is the symbol before; the end before the first."""
        first = np.full((1, self.ids.shape[1]), self.end, np.uint16)
        for t in range(0, len(self.ids), steps):
            lanes = int((self.lengths > t).sum())
            y = self.ids[t : t + steps, :lanes].astype(np.int64)
            x = np.concatenate((self.ids[t - 1 : t, :lanes] if t else first[:, :lanes], self.ids[t : t + steps - 1, :lanes]))[: len(y)].astype(np.int64)
            yield x, y, self.doc[t : t + steps, :lanes], [np.flatnonzero(row == self.end) for row in x]


def score_documents(net: Network, docs: list[np.ndarray], steps: int = SCORE_STEPS, lanes: int = LANES) -> np.ndarray:
    """Natural log of each document's symbols, whole documents with the state carried on."""
    out = np.zeros(len(docs))
    if not docs:
        return out
    side = Lanes(docs, net.end, lanes)
    h = np.zeros((STATE, side.ids.shape[1]), net.flat.dtype)
    for x, y, doc, anew in side.windows(steps):
        after, _ = net.states(x, h[:, : x.shape[1]], anew)
        h = after[:, -1]
        logs = net.log_shares(after.reshape(STATE, -1), y.ravel())
        out += np.bincount(doc.ravel() + 1, logs, len(docs) + 1)[1:]  # places behind a lane's last document have number -1
    return out


def train_documents(net: Network, docs: list[np.ndarray]) -> int:
    """Adam on one pass over the documents, in place; those longer than SEGMENT in several runs. Number of tokens."""
    tokens = sum(map(len, docs))
    if not tokens:
        return 0
    docs = [d[i : i + SEGMENT] for d in docs for i in range(0, len(d), SEGMENT)]
    side = Lanes(docs, net.end, max(1, min(LANES, tokens // (STEPS * UPDATES))))
    h = np.zeros((STATE, side.ids.shape[1]), net.flat.dtype)
    mean, square, updates = np.zeros_like(net.flat), np.zeros_like(net.flat), 0
    for x, y, doc, anew in side.windows(STEPS):
        live = (doc >= 0).astype(net.flat.dtype)
        grad, _, h = net.gradients(x, y, h[:, : x.shape[1]], anew, live / live.sum())
        grad *= min(1.0, CLIP / (float(np.sqrt(grad @ grad)) + 1e-9))
        updates += 1
        mean += 0.1 * (grad - mean)
        square += 0.01 * (grad * grad - square)
        net.flat -= RATE * (mean / (1 - 0.9**updates)) / (np.sqrt(square / (1 - 0.99**updates)) + 1e-8)
    return tokens


def _pools(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    """Batches with their documents' symbols, POOL tokens or so at a time."""
    held, docs, tokens = [], [], 0
    for b in batches:
        own = [np.frombuffer(s, "<u2") for s in b["symbols"].to_pylist()]
        held.append(b.drop_columns(["symbols"]))
        docs += own
        tokens += sum(map(len, own))
        if tokens >= POOL:
            yield held, docs
            held, docs, tokens = [], [], 0
    if docs:
        yield held, docs


def train(coded: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """coded: symbols and _row of the training documents, written. The averaged parameters."""
    flat = Network(known).flat
    kind = "block int, part int, weight double, total array<double>"
    for r in range(rounds):

        def learn(batches: Iterator[pa.RecordBatch], flat: np.ndarray = flat) -> Iterator[pa.RecordBatch]:
            net, tokens = Network(known, flat), 0
            for _, docs in _pools(batches):
                tokens += train_documents(net, docs)
            if tokens:
                blocks = [net.flat[i : i + VALUES].astype(np.float64) * tokens for i in range(0, len(net.flat), VALUES)]
                part = TaskContext.get().partitionId() % GROUPS
                yield pa.record_batch([pa.array(range(len(blocks)), pa.int32()), pa.array([part] * len(blocks), pa.int32()), pa.array([float(tokens)] * len(blocks)), pa.array(blocks, pa.list_(pa.float64()))], ["block", "part", "weight", "total"])

        def add(t: pa.Table) -> pa.Table:
            total = np.sum([np.asarray(x) for x in t["total"].to_pylist()], axis=0)
            return pa.table({"block": t["block"][:1], "part": t["part"][:1], "weight": [sum(t["weight"].to_pylist())], "total": [total.tolist()]}, pa.schema([("block", pa.int32()), ("part", pa.int32()), ("weight", pa.float64()), ("total", pa.list_(pa.float64()))]))

        mine = coded.where(F.pmod(F.xxhash64("_row"), F.lit(rounds)) == r).select("symbols")
        sums = mine.mapInArrow(learn, kind).groupBy("block", "part").applyInArrow(add, kind).withColumn("part", F.lit(0)).groupBy("block", "part").applyInArrow(add, kind)
        found = sorted(((x["block"], np.array(x["total"]) / x["weight"]) for x in sums.collect()), key=lambda x: x[0])
        if found:
            flat = np.concatenate([v for _, v in found]).astype(np.float32)
    return flat


def score(docs: DataFrame, text: str = "text", words: int = WORDS, listed: int = LISTED, rounds: int = ROUNDS) -> DataFrame:
    """docs: doc_id, text; further columns are ignored, whatever their names. doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10, whole texts with their end).

    held_out rows (crc32 of the id as text divisible by 10; a null id counts as the empty text, whose crc32 is 0, and is held out) are scored like the others and teach nothing. A
    null text is the empty text, which has its end alone. Repeated rows are trained on and scored as often as they occur. Without any training document every probability
    comes from the smoothing; an empty table gives no rows. Words are told apart by 64 bits."""
    held = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10) == 0
    rows = docs.select("doc_id", held.alias("held_out"), text_or_empty(text).alias("text"))
    training = rows.where(~F.col("held_out"))
    counts = materialize(word_counts(training.select("text")), "lm-counts")
    known = vocabulary(counts, docs.where(~held).count(), words, listed)
    coded = materialize(symbols(rows.withColumn("_row", F.monotonically_increasing_id()), known), "lm-symbols")
    flat = train(coded.where(~F.col("held_out")), known, rounds)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, mass = Network(known, flat), np.log10(known.mass)
        for held, found in _pools(batches):
            logs = score_documents(net, found) / math.log(10)
            logs -= [mass[s[s > known.end].astype(np.int64) - known.end - 1].sum() for s in found]
            at = 0
            for b in held:
                yield pa.record_batch([*b.columns, pa.array(logs[at : at + b.num_rows])], [*b.schema.names, "_model"])
                at += b.num_rows

    kept = coded.select("doc_id", "held_out", "_row", "n_tokens", "n_known", "log_base", "log_shared", "symbols")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "symbols")
    scored = kept.mapInArrow(whole, f"{kinds}, _model double")
    rest = coded.select("_row", F.explode(F.arrays_zip("rest_h", "rest_n")).alias("_w")).select("_row", F.col("_w.rest_h").alias("h"), F.col("_w.rest_n").alias("times"))
    rest = rest.join(counts.select("h", "n"), "h", "left")
    log = F.log10(F.coalesce("n", F.lit(0)) + ADDED)
    logs = rest.groupBy("_row").agg(F.sum(F.col("times") * log).alias("_logs"), F.sum(F.col("times") * (log - known.log_all)).alias("_base"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("_known"))
    out = scored.join(logs, "_row", "left").na.fill(0, ["_logs", "_base", "_known"])
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("_known")).alias("n_known"), F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("log_base") + F.col("_base")).alias("base_score"), (F.col("_model") + F.col("log_shared") + F.col("_logs")).alias("score"),
    )


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"))
