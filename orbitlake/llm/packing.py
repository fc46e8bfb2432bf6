"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A piece of n tokens belongs to class k = capacity // n: k such pieces fill one bin. Each worker keeps one open bin a
class and closes it once it holds its k pieces, so workers never exchange anything and memory is one open bin a class
(under 2 * sqrt(capacity) classes are in use). Since documents may be cut, a piece is first trimmed to the length that
wastes nothing in its class, capacity // k, and the rest falls into a finer class; after a few cuts at most a token or
two a piece are lost. What is left open when a worker ends is chained, cut to whole sequences, and the last remainder
is split at powers of two.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ._common import chunks, read, releasing

#: One more token after each document.
END_ID = 2
#: Entries of a worker's tables of tokenised pieces and words, those of the last turn included.
WORD_TABLE = 700_000
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ž"
_PLAIN = re.compile(f"[\n -~{_LETTERS}]*")
#: The tokenizer's pre-tokens in plain text, where its \p{L} and \p{N} are these letters and digits.
_PIECES = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^{_LETTERS}0-9 \n]+")
#: What the tokenizer's special tokens begin with.
_SPECIAL = "<|"


class Table(dict):
    """make(key) of the keys seen, made once. Of the keys before the last turn, only those met again stay at the next."""

    def __init__(self, make):
        self.make, self.last = make, {}

    def __missing__(self, key: str) -> bytes:
        got = self.last.get(key)
        if got is None:
            got = self.make(key)
        self[key] = got
        return got

    def turn(self) -> None:
        self.last = dict(self)
        self.clear()


class WordTokens:
    """Token ids of texts, exactly those of the tokenizer file, as little-endian uint32 bytes.

    The tokenizer's pre-tokens never cross white space. Texts of Latin letters and ASCII signs are cut to pre-tokens here, and each
    distinct one goes to the BPE model once. Other texts are split at spaces and line feeds; of their words, those of other
    characters take the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.pieces, self.words = Table(self._piece), Table(self._word)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.chars = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}

    def _piece(self, low: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(low if low.isascii() else low.encode().decode("latin-1").translate(self.chars))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and _SPECIAL not in word:
            return self._plain(word)
        return np.array(self.whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.pieces) + len(self.words) > WORD_TABLE // 2:
            self.pieces.turn()
            self.words.turn()
        word = self.words.__getitem__
        return [self._plain(t) if _PLAIN.fullmatch(t) and _SPECIAL not in t else b"".join(map(word, t.replace("\n", " ").split(" "))) for t in texts]


_TOKENS: dict[str, WordTokens] = {}


def pieces(n: int, capacity: int) -> list[int]:
    """Lengths into which a document of n tokens is cut: full sequences, then for the rest, as long as it fills less than its class's
    share capacity // k, the largest smaller share capacity // (k + 1). Lengths up to the square root of the capacity stay whole: their
    class holds that length alone."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n:
        k = capacity // n
        if n * n <= capacity or n == capacity // k:
            out.append(n)
            break
        out.append(capacity // (k + 1))
        n -= out[-1]
    return out


class Packer:
    """One worker's bins. add() gives the pieces of bins that it fills, end() those of the rest: (doc, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, capacity: int, first: int = 0):
        self.capacity, self.next, self.open = capacity, first, {}

    def _close(self, items: list) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in items:
            yield doc, start, ids, total, self.next, offset
            offset += len(ids) // 4
        self.next += 1

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        total, at = len(ids) // 4, 0
        for n in pieces(total, self.capacity):
            k = self.capacity // n
            items = self.open.setdefault(k, [])
            items.append((doc, at, ids[4 * at : 4 * (at + n)], total))
            at += n
            if len(items) == k:
                yield from self._close(self.open.pop(k))

    def end(self) -> Iterator[tuple]:
        rest = [x for k in sorted(self.open) for x in self.open[k]]
        self.open = {}
        left = sum(len(x[2]) for x in rest) // 4
        sizes = [self.capacity] * (left // self.capacity) + [1 << b for b in reversed(range(self.capacity.bit_length())) if (left % self.capacity) >> b & 1]
        queue = iter(rest)
        item = next(queue, None)
        for size in sizes:
            items, room = [], size
            while room:
                doc, start, ids, total = item
                n = min(room, len(ids) // 4)
                items.append((doc, start, ids[: 4 * n], total))
                room -= n
                item = (doc, start + n, ids[4 * n :], total) if 4 * n < len(ids) else next(queue, None)
            yield from self._close(items)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 4096, with_ids: bool = False, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Packs every row of docs. tokenizer: path of a tokenizers file, on all executors (default: the 49k word BPE). One row per piece: doc_id,
    start, length, ids_crc32, doc_tokens, sequence_id, offset, class_size (pieces a full bin of its class holds), and ids where with_ids is set.

    Nulls: a null text counts as empty (its document is the end id alone); a null id stays null. An empty table gives no rows. Repeated rows are
    packed each by itself. Documents longer than a sequence are cut. Other columns of docs are not read. No shuffle: sequence_id is the task's number times 2**32 plus a count."""
    if capacity & (capacity - 1):
        raise ValueError("capacity: a power of two")
    fields = [("doc_id", docs.schema[id_col].dataType.simpleString()), *((c, "bigint") for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class_size"))]
    schema = ", ".join(f"{a} {b}" for a, b in fields) + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        tokens = _TOKENS.setdefault(path, None) or _TOKENS.update({path: WordTokens(path)}) or _TOKENS[path]
        packer = Packer(capacity, TaskContext.get().partitionId() << 32)
        kind = None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            ids = [r[2] for r in rows]
            cols = [pa.array([r[0] for r in rows], kind), *(pa.array(x, pa.int64()) for x in ([r[1] for r in rows], [len(b) // 4 for b in ids], [zlib.crc32(b) for b in ids], [r[3] for r in rows], [r[4] for r in rows], [r[5] for r in rows], [capacity * 4 // len(b) for b in ids]))]
            names = [f[0] for f in fields]
            if with_ids:
                cols.append(pa.array([np.frombuffer(b, "<i4") for b in ids], pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(cols, names=names)

        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            kind = batch.column(0).type
            names, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts, 1_000_000):
                rows = [row for name, ids in zip(names[a:b], tokens(texts[a:b])) for row in packer.add(name, ids + end)]
                if rows:
                    yield table(rows)
        if rows := list(packer.end()):
            yield table(rows)

    return docs.select(id_col, text).mapInArrow(releasing(run), schema)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
