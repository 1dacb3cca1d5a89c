"""Texts as token IDs in compressed binary blocks, and back.

Tokens are made by a given vocabulary file of the ``tokenizers`` library.  The blocks are
rows of a Parquet folder: Spark's writer commits them as a whole on any store, a lost
executor leaves nothing half written, and each row is decoded on its own.
"""

from __future__ import annotations

import json
import math
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from .rans import Block, Frequencies, encode_block
from .work import fresh_path, stored, text_bytes

BLOCK_IDS = 1 << 18
PART_BYTES = 12 << 20
MAX_PARTS = 50_000
CACHED_PIECES = 500_000  # of each generation

#: Marks after a word, up to the blank behind them.
_TRAILING = re.compile(
    rb"([.,;:!?](?:(?<=[a-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))[.,;:!?]*)"
    rb"(?=[\x20\x09-\x0d]|\Z)"
)
#: Small letters of ASCII and Latin-1: nothing for normalisation or splitting to do.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: The kind of vocabulary whose texts can be cut at blanks: small letters, runs of letters,
#: single digits and runs of marks (fixed values of such files).
_NORMALISER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters of ASCII and Latin-1, for which a small letter is just another letter.
_LATIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
BYTES_AT_ONCE = 4 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it is
    printable, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


_RAW = "part int, place long, doc_ids array<long>, lengths array<int>, ids binary, width int"
_CODED = "part int, place long, doc_ids array<long>, block binary"


def cuts_at_blanks(tokenizer: Tokenizer) -> bool:
    """Whether the pieces of a text between blanks, in small letters, have its tokens."""
    made = json.loads(tokenizer.to_str())
    steps = (made["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    marks = [t["content"] for t in made["added_tokens"]]
    return (
        (made["normalizer"] or {}).get("normalizers") == _NORMALISER
        and len(steps) == 2
        and steps[0].get("pattern") == {"Regex": _SPLIT}
        and (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True)
        and (steps[1]["type"], steps[1]["use_regex"], steps[1]["add_prefix_space"]) == ("ByteLevel", False, False)
        and made["model"]["type"] == "BPE"
        and not made["model"]["dropout"]
        and bool(made["model"]["end_of_word_suffix"])
        and all(m.startswith("<|") for m in marks)
    )


class Pieces(dict):
    """IDs of pieces as bytes; those of a batch that are new are encoded together.

    Pieces are remembered in two generations, so memory is bounded and frequent ones stay.
    Plain words are one text for the merges alone; the IDs that end a word part them again.
    """

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.words = Tokenizer(tokenizer.model)
        self.words.pre_tokenizer = WhitespaceSplit()
        self.letters = dict(enumerate(byte_letters()))
        suffix = json.loads(tokenizer.to_str())["model"]["end_of_word_suffix"]
        known = tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(1 + max(known.values()), bool)
        self.ends[[i for token, i in known.items() if token.endswith(suffix)]] = True
        self.old: dict[bytes, bytes] = {}

    def by_all(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8", "replace")
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def by_merges(self, words: list[bytes]) -> list[bytes]:
        text = b" ".join(words).decode("latin-1")
        text = text if text.isascii() else text.translate({**self.letters, 32: " "})
        (found,) = self.words.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(ends) != len(words):
            raise ValueError("a word has more or fewer ends than one")
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, pieces: list[bytes]) -> None:
        if len(self) >= CACHED_PIECES:
            self.old = dict(self)
            self.clear()
        words: dict[bytes, bytes] = {}
        for piece in pieces:
            if piece in self:
                continue
            ids = self.old.get(piece)
            if ids is not None:
                self[piece] = ids
            elif _PLAIN.fullmatch(piece):
                words[piece] = piece
            elif _LATIN.fullmatch(piece):
                words[piece] = piece.decode().lower().encode()
            else:
                self[piece] = self.by_all(piece)
        if words:
            self.update(zip(words, self.by_merges(list(words.values()))))


class Encoder:
    """IDs of texts by way of their blank-separated pieces, which are encoded once.

    Right for vocabularies that :func:`cuts_at_blanks`, as a token then never reaches from
    one piece into another; with any other, whole texts go to the library.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = Pieces(self.tokenizer) if cuts_at_blanks(self.tokenizer) else None

    @staticmethod
    def prepared(text: bytes) -> bytes:
        """In small letters (ASCII ones) and with marks after a word apart.

        Texts that may hold special tokens or combining marks are left as they are: there
        small letters first could make a difference.
        """
        if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
            return text
        return _TRAILING.sub(rb" \1", text.lower())

    def encode(self, texts: list[bytes | None], end: int) -> list[np.ndarray]:
        """The IDs of each text and the ``end`` ID."""
        if self.known is None:
            whole = ((t or b"").decode() for t in texts)
            found = (self.tokenizer.encode(t, add_special_tokens=False).ids for t in whole)
            return [np.array([*ids, end], np.uint32) for ids in found]
        prepared = pa.array([self.prepared(t or b"") for t in texts], pa.binary()).view(pa.string())
        split = pc.ascii_split_whitespace(prepared)
        coded = split.flatten().dictionary_encode()
        pieces = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        self.known.learn(pieces)
        ids_of = list(map(self.known.__getitem__, pieces))
        pool = np.frombuffer(b"".join(ids_of), "<u4")
        sizes = np.array([len(ids) for ids in ids_of], np.int64) // 4
        return _gathered(pool, sizes, coded.indices.to_numpy(), split.offsets.to_numpy(), end)


def _gathered(pool, sizes, pieces, offsets, end: int) -> list[np.ndarray]:
    """Each text's IDs from those of its pieces, which stand in ``pool`` one after another."""
    counts = sizes[pieces]
    ends = np.cumsum(counts)
    first = (np.cumsum(sizes) - sizes)[pieces] - (ends - counts)
    ids = pool[np.repeat(first, counts) + np.arange(ends[-1] if len(ends) else 0)]
    bounds = np.concatenate([[0], ends])[offsets].tolist()
    last = np.array([end], np.uint32)
    return [np.concatenate([ids[a:b], last]) for a, b in zip(bounds, bounds[1:])]


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in slices of about ``BYTES_AT_ONCE``."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    low = 0
    while low < batch.num_rows:
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + BYTES_AT_ONCE)))
        yield batch.slice(low, high - low)
        low = high


_encoders: dict[str, Encoder] = {}


def encoder_of(vocabulary: str) -> Encoder:
    """The encoder of this worker process, which later tasks go on using."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def _in_blocks(vocabulary: str, end: int):
    """Sorted documents of a partition as rows of about ``BLOCK_IDS`` raw IDs."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, place = None, 0, 0
        doc_ids: list = []
        held: list[np.ndarray] = []

        def flush() -> tuple[pa.RecordBatch, int]:
            ids = np.concatenate(held)
            row = pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "place": pa.array([place], pa.int64()),
                    "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                    "lengths": pa.array([[len(h) for h in held]], pa.list_(pa.int32())),
                    "ids": pa.array([ids.astype(_width(ids)).tobytes()], pa.binary()),
                    "width": pa.array([_width(ids).itemsize], pa.int32()),
                }
            )
            return row, len(ids)

        waiting = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            encoder = encoder or encoder_of(vocabulary)
            part = batch["part"][0].as_py()
            for piece in _chunks(batch):
                texts = piece["text"].cast(pa.binary()).to_pylist()
                for doc, ids in zip(piece["doc_id"].to_pylist(), encoder.encode(texts, end)):
                    doc_ids.append(doc)
                    held.append(ids)
                    waiting += len(ids)
                    if waiting >= BLOCK_IDS:
                        row, size = flush()
                        yield row
                        doc_ids, held, waiting, place = [], [], 0, place + size
        if held:
            yield flush()[0]

    return blocks


def _width(ids: np.ndarray) -> np.dtype:
    """Two bytes an ID where they do: the raw IDs are only a step between two passes."""
    return np.dtype("<u2" if ids.max(initial=0) < 1 << 16 else "<u4")


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1, np.int64)
    for batch in batches:
        for data, width in zip(batch["ids"], batch["width"]):
            more = np.bincount(np.frombuffer(data.as_buffer(), f"<u{width.as_py()}"))
            if len(more) > len(counts):
                counts, more = more.astype(np.int64), counts
            counts[: len(more)] += more
    ids = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"id": ids, "n": counts[ids]})


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end: int, text: str = "text"
) -> None:
    """Write the IDs of all texts as coded blocks under ``path``, by ascending ``doc_id``.

    ``path/frequencies`` holds the table, ``path/blocks`` the blocks: ``part`` and
    ``place`` (IDs before the block in all parts), ``doc_ids`` and the coded ``block``.

    Null and empty texts give just the ``end`` ID.  Null ids come first; rows with equal
    ids stand side by side, ordered by the hash of their text.  Further columns are
    ignored.  An empty table gives an empty folder of blocks.  What reaches the driver is
    bounded: a count for each ID of the vocabulary and for each of at most ``MAX_PARTS``
    parts.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col(text).alias("text"))
    parts = min(math.ceil(text_bytes(docs) / PART_BYTES) or 1, MAX_PARTS)
    tie = F.xxhash64("text")
    ordered = (
        docs.repartitionByRange(parts, "doc_id", tie)
        .sortWithinPartitions("doc_id", tie)
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    raw = stored(ordered.mapInArrow(_in_blocks(vocabulary, end), _RAW), "token-ids")
    counted = raw.select("ids", "width").mapInArrow(_histogram, "id long, n long")
    counted.groupBy("id").agg(F.sum("n").alias("n")).write.parquet(f"{path}/frequencies")
    table = _frequencies(spark, path)

    last = F.max_by(F.col("place") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x), "place")
    totals = sorted(map(tuple, raw.groupBy("part").agg(last).collect()))
    before = dict(zip([p for p, _ in totals], np.cumsum([0, *(n for _, n in totals)]).tolist()))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = np.frombuffer(row["ids"][0].as_buffer(), f"<u{row['width'][0].as_py()}")
                lengths = np.array(row["lengths"][0].as_py(), np.uint32)
                part, place = row["part"][0].as_py(), row["place"][0].as_py()
                block = encode_block(ids, lengths, table)
                yield pa.RecordBatch.from_arrays(
                    [
                        row["part"],
                        pa.array([before[part] + place], pa.int64()),
                        row["doc_ids"],
                        pa.array([block], pa.binary()),
                    ],
                    names=["part", "place", "doc_ids", "block"],
                )

    raw.mapInArrow(code, _CODED).write.option("compression", "none").parquet(f"{path}/blocks")


def _frequencies(spark: SparkSession, path: str) -> Frequencies:
    rows = spark.read.schema("id long, n long").parquet(f"{path}/frequencies").collect()
    counts = np.zeros(1 + max((r.id for r in rows), default=0), np.int64)
    for row in rows:
        counts[row.id] = row.n
    return Frequencies(counts)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: ``doc_id``, ``start`` (IDs before it), ``ids`` (binary u32)."""
    table = _frequencies(spark, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block(batch["block"][k].as_py())
                ids = block.decode_all(table)
                ends = np.cumsum(block.lengths.astype(np.int64))
                starts = ends - block.lengths
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch["doc_ids"][k].values,
                        "start": starts + batch["place"][k].as_py(),
                        "ids": pa.array(
                            [ids[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends)],
                            pa.binary(),
                        ),
                    }
                )

    blocks = spark.read.schema(_CODED).parquet(f"{path}/blocks")
    return blocks.mapInArrow(decode, "doc_id long, start long, ids binary")


def tokens_round_trip(docs: DataFrame, vocabulary: str, end: int) -> DataFrame:
    """Write the IDs of ``docs`` and return what stands in the files."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary, end)
    return read_tokens(docs.sparkSession, path)
