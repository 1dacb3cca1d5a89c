"""Removal of long word sequences that stand more than once, found by recompression.

Texts are dealt into chunks of a few megabytes.  Three rounds of Spark jobs follow:

1. Every chunk is recompressed (see :mod:`.recompression`).  The high-level symbols of at
   least ``MIN_SYMBOL`` words are its keys.  A window that holds the reach of no such symbol
   is a key itself; whether it does is a matter of its words alone, so this holds for all
   its copies.  Hence two equal windows always share a key.  Keys are made distinct in the
   chunk, dealt by name and counted over all chunks; each chunk is told which of its keys
   stand elsewhere.
2. The windows that hold a repeated key are verified: their 128-bit fingerprints are
   counted over all chunks in the same way, and each chunk is told which of its windows
   stand nowhere else.
3. Each chunk drops the words that the other windows cover.

A chunk sends each key once, however often it stands there, so a passage that a third of
all texts share is one entry for each chunk.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .recompression import mix, recompress
from .work import bucketed, stored, text_bytes

ROUNDS = 6
MIN_SYMBOL = 4
CHUNK_BYTES = 8 << 20
PART_BYTES = 48 << 20  # of text whose keys are counted together
MAX_BUCKETS = 50_000

_REPLY = "chunk long, keys binary"
_SENT = "part long, chunk long, keys binary, more binary, many binary"


class _Names(dict):
    """64-bit names of words."""

    def __missing__(self, word: bytes) -> int:
        self[word] = name = xxhash.xxh3_64_intdigest(word)
        return name


class Chunk:
    """The texts of a chunk as one sequence of words."""

    def __init__(self, texts: list[bytes | None], width: int):
        self.words = [(t or b"").split() for t in texts]
        self.width = width
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.size = int(sizes.sum())
        names = _Names()
        self.names = np.fromiter(
            (names[w] for words in self.words for w in words), np.uint64, self.size
        )
        self.wall = np.zeros(self.size, bool)
        self.wall[self.starts[sizes > 0]] = True
        #: First word of the text of each word, and the end of it.
        self.text_start = np.repeat(self.starts, sizes)
        self.whole = np.arange(self.size) + width <= np.repeat(self.ends, sizes)

    def windows(self, multiplier: int) -> np.ndarray:
        """A 64-bit fingerprint of the ``width`` words from each position on."""
        total = np.zeros(self.size, np.uint64)
        block, length, done = self.names.copy(), 1, 0
        factor = multiplier
        while length <= self.width:
            if self.width & length:  # append this block to what is done
                power = np.uint64(pow(multiplier, length, 1 << 64))
                total *= power
                total[: max(self.size - done, 0)] += block[done:]
                done += length
            wider = block * np.uint64(factor)
            wider[: max(self.size - length, 0)] += block[length:]
            block, length, factor = wider, length * 2, factor * factor % (1 << 64)
        return mix(total)

    def covered(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The window starts whose window holds one of the stretches ``[low, high)``."""
        first = np.maximum(high - self.width, self.text_start[low])
        some = first <= low
        steps = np.bincount(first[some], minlength=self.size + 1)
        steps -= np.bincount(low[some] + 1, minlength=self.size + 1)
        return (np.cumsum(steps[:-1]) > 0) & self.whole

    def keys(self) -> tuple:
        """Names, reaches and the starts of the windows that are keys themselves."""
        symbols = recompress(self.names, self.wall, ROUNDS)
        length = np.diff(np.append(symbols.start, self.size))
        use = (symbols.high - symbols.low <= self.width) & (symbols.low >= 0)
        use &= length >= min(MIN_SYMBOL, self.width)
        name, low, high = symbols.name[use], symbols.low[use], symbols.high[use]
        alone = np.flatnonzero(self.whole & ~self.covered(low, high))
        return name, low, high, alone

    def revealed(self, repeated: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The starts of the windows that hold one of the ``repeated`` keys."""
        name, low, high, alone = self.keys()
        mine = _among(name, repeated)
        starts = self.covered(low[mine], high[mine])
        starts[alone[_among(first[alone], repeated)]] = True
        return np.flatnonzero(starts)


_FIRST, _SECOND = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def _unpack(column) -> np.ndarray:
    return np.concatenate(
        [np.frombuffer(b, np.uint64) for b in column.to_pylist()] or [np.empty(0, np.uint64)]
    )


def _send(chunk: int, keys: np.ndarray, more: np.ndarray | None, parts: int) -> pa.Table:
    """Distinct keys of a chunk, one row for each part of the key space.

    ``many`` marks keys that stand several times in the chunk; ``more`` are further 64
    bits of each key.
    """
    order = np.argsort(keys, kind="stable") if more is None else np.lexsort((more, keys))
    keys = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    if more is not None:
        more = more[order]
        fresh[1:] |= more[1:] != more[:-1]
    heads = np.flatnonzero(fresh)
    many = (np.diff(np.append(heads, len(keys))) > 1).astype(np.uint8)
    keys, more = keys[heads], None if more is None else more[heads]
    part = (keys % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    rows = [r for r in np.split(order, cuts) if len(r)]
    return pa.table(
        {
            "part": pa.array([int(part[r[0]]) for r in rows], pa.int64()),
            "chunk": pa.array([chunk] * len(rows), pa.int64()),
            "keys": pa.array([keys[r].tobytes() for r in rows], pa.binary()),
            "more": pa.array(
                [b"" if more is None else more[r].tobytes() for r in rows], pa.binary()
            ),
            "many": pa.array([many[r].tobytes() for r in rows], pa.binary()),
        }
    )


def _counted(repeated: bool):
    """A function that tells each chunk which of its keys are (not) repeated."""

    def count(table: pa.Table) -> pa.Table:
        chunks = table["chunk"].to_pylist()
        blobs = [np.frombuffer(b, np.uint64) for b in table["keys"].to_pylist()]
        keys, more = np.concatenate(blobs), _unpack(table["more"])
        more = more if len(more) else np.zeros(len(keys), np.uint64)
        many = np.frombuffer(b"".join(table["many"].to_pylist()), np.uint8) > 0
        owner = np.repeat(np.arange(len(chunks)), [len(b) for b in blobs])
        order = np.lexsort((more, keys))
        k, m = keys[order], more[order]
        same = np.zeros(len(k) + 1, bool)
        same[1:-1] = (k[1:] == k[:-1]) & (m[1:] == m[:-1])
        twice = np.empty(len(k), bool)
        twice[order] = same[:-1] | same[1:]
        twice |= many
        told = np.flatnonzero(twice == repeated)
        owners, begin = np.unique(owner[told], return_index=True)
        pieces = np.split(keys[told], begin[1:]) if len(told) else []
        return pa.table(
            {
                "chunk": pa.array([chunks[o] for o in owners], pa.int64()),
                "keys": pa.array([p.tobytes() for p in pieces], pa.binary()),
            }
        )

    return count


def _texts(table: pa.Table) -> list:
    return table["text"].cast(pa.binary()).to_pylist()


def remove_repeats(docs: DataFrame, width: int = 35) -> DataFrame:
    """Drop every word inside a window of ``width`` words that stands anywhere else.

    ``docs`` needs ``doc_id`` and ``text``; words are what lies between ASCII blanks.
    Windows are judged on the input: all copies of a passage go, also the first.  Returns
    one row for each row: ``doc_id``, ``n_words``, ``n_removed`` and ``kept_text`` (the
    words that stay, joined by one space).

    Null and empty texts have no words and give an empty ``kept_text``; so do texts that
    are dropped as a whole.  Texts of fewer than ``width`` words stay as they are.  Rows
    with equal or null ``doc_id`` count as different texts; further columns are ignored.
    An empty table gives an empty one.  Windows are told apart by 128-bit fingerprints.
    """
    if width < 1:
        raise ValueError("width must be at least 1")
    docs = docs.select("doc_id", "text")
    size = text_bytes(docs)
    chunks = math.ceil(size / CHUNK_BYTES) or 1
    parts = math.ceil(size / PART_BYTES) or 1
    buckets = min(max(math.ceil(chunks / 3), 1), MAX_BUCKETS)
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk")
    texts = bucketed(docs.select(dealt, "doc_id", "text"), "chunk", buckets, "texts")

    def reveal(key: tuple, table: pa.Table) -> pa.Table:
        chunk = Chunk(_texts(table), width)
        name, _, _, alone = chunk.keys()
        first = chunk.windows(_FIRST)[alone] if len(alone) else np.empty(0, np.uint64)
        return _send(key[0].as_py(), np.concatenate([name, first]), None, parts)

    def verify(key: tuple, table: pa.Table, reply: pa.Table) -> pa.Table:
        if not (table.num_rows and reply.num_rows):
            return _send(0, np.empty(0, np.uint64), np.empty(0, np.uint64), parts)
        chunk = Chunk(_texts(table), width)
        first = chunk.windows(_FIRST)
        at = chunk.revealed(np.sort(_unpack(reply["keys"])), first)
        second = chunk.windows(_SECOND)
        return _send(key[0].as_py(), first[at], second[at], parts)

    def remove(key: tuple, table: pa.Table, reply: pa.Table) -> pa.Table:
        chunk = Chunk(_texts(table), width)
        covered = np.zeros(chunk.size, bool)
        if reply.num_rows:
            first = chunk.windows(_FIRST)
            single = np.array(reply["single"].to_pylist(), bool)
            keys = [reply["keys"].filter(pa.array(single == s)) for s in (False, True)]
            at = chunk.revealed(np.sort(_unpack(keys[0])), first)
            at = at[~_among(first[at], np.sort(_unpack(keys[1])))]
            steps = np.bincount(at, minlength=chunk.size + width + 1)
            steps -= np.bincount(at + width, minlength=chunk.size + width + 1)
            covered = np.cumsum(steps)[: chunk.size] > 0
        kept, removed = [], []
        for words, a, b in zip(chunk.words, chunk.starts, chunk.ends):
            gone = covered[a:b]
            removed.append(int(gone.sum()))
            if removed[-1]:
                words = [words[i] for i in np.flatnonzero(~gone)]
            kept.append(b" ".join(words))
        return pa.table(
            {
                "doc_id": table["doc_id"].cast(pa.int64()),
                "n_words": pa.array([len(w) for w in chunk.words], pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    by_chunk = texts.groupBy("chunk")
    sent = by_chunk.applyInArrow(reveal, _SENT)
    repeated = stored(
        sent.groupBy("part").applyInArrow(_counted(True), _REPLY), "repeated"
    )
    sent = by_chunk.cogroup(repeated.groupBy("chunk")).applyInArrow(verify, _SENT)
    single = sent.groupBy("part").applyInArrow(_counted(False), _REPLY)
    replies = repeated.withColumn("single", F.lit(False)).unionByName(
        single.withColumn("single", F.lit(True))
    )
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept_text string"
    )
