"""Token counts of texts, most of them without a single merge.

A byte-level vocabulary splits a text into pre-tokens and merges the bytes of each.  Which
strings of the vocabulary come out of the merges as one token is proved once, when the file
is loaded, by merging all of them.  A pre-token that is such a string counts 1 by a look-up;
only the others are merged, and each of those once as long as it is remembered.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from .tokens import byte_letters

#: How byte-level vocabularies split a text (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: No pre-token reaches over such a place.
_CUT = regex.compile(r"[!-~](?= )")
_CLASSES = {"b": regex.compile(r"\p{L}"), "1": regex.compile(r"\p{N}"), "!": regex.compile(r"[^\s\p{L}\p{N}]")}
REMEMBERED = 300_000
SLICE = 1 << 20


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters that are tokenised alike on their own."""
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


class Costs(dict):
    """Tokens of a pre-token: 1 for whole ones; others are merged when first asked for."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.merge = tokenizer.model.tokenize
        self.letters = byte_letters()
        raw = {letter: byte for byte, letter in enumerate(self.letters)}
        for string in tokenizer.get_vocab(with_added_tokens=False):
            if set(string) <= raw.keys() and len(self.merge(string)) == 1:
                try:
                    self[bytes(map(raw.__getitem__, string)).decode()] = 1
                except UnicodeDecodeError:
                    pass  # part of a character, which no pre-token is
        self.whole = len(self)

    def __missing__(self, piece: str) -> int:
        count = len(self.merge("".join(map(self.letters.__getitem__, piece.encode()))))
        if len(self) - self.whole < REMEMBERED and len(piece) <= 64:
            self[piece] = count
        return count


class TokenCounter:
    """Counts as the vocabulary's own library gives them, special strings included.

    The look-up stands for the library only where it is proved: for a byte-level BPE
    without normaliser, for texts without strings of added tokens, and for characters that
    the library and ``regex`` hold to be of the same kind.  Each character is put to the
    library when it first turns up.  All other texts are encoded by the library.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        made = json.loads(self.tokenizer.to_str())
        self.proved = (
            made["model"]["type"] == "BPE"
            and not made["normalizer"]
            and not made["model"].get("dropout")
            and {**(made["pre_tokenizer"] or {}), "trim_offsets": 0}
            == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True, "trim_offsets": 0}
        )
        added = [regex.escape(t["content"]) for t in made["added_tokens"]]
        self.added = regex.compile("|".join(added) or r"(?!)")
        self.split = regex.compile(SPLIT).findall
        self.alike: set[str] = set()
        self.unlike: set[str] = set()
        if self.proved:
            self.costs = Costs(self.tokenizer)

    def same_kind(self, char: str) -> bool:
        """Whether ``regex`` and the library put ``char`` with the same neighbours."""
        for lead, kind in _CLASSES.items():
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(lead + char)
            if (len(pieces) == 1) != bool(kind.match(char)):
                return False
        return True

    def fits(self, text: str) -> bool:
        for char in set(text) - self.alike - self.unlike:
            (self.alike if self.same_kind(char) else self.unlike).add(char)
        return self.unlike.isdisjoint(text) and not self.added.search(text)

    def count(self, text: str) -> int:
        if self.proved and self.fits(text):
            cost = self.costs.__getitem__
            return sum(sum(map(cost, self.split(part))) for part in slices(text))
        parts = slices(text) if self.proved else [text]
        return sum(len(self.tokenizer.encode(p, add_special_tokens=False)) for p in parts)


_counters: dict[str, TokenCounter] = {}


def counter_of(vocabulary: str) -> TokenCounter:
    """The counter of this worker process, which later tasks go on using."""
    if vocabulary not in _counters:
        _counters[vocabulary] = TokenCounter(vocabulary)
    return _counters[vocabulary]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    One pass over the scan without a shuffle.  Whole texts are counted, long ones in
    pieces, so that memory does not grow with a text beyond the text itself.  A null text is
    an empty one: 0 bytes, 0 tokens.  Rows are not told apart by their id, so null and
    repeated ids give a row each.  Columns of ``docs`` that bear one of the three new names
    are replaced.  An empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.lit(None).cast("int")
    rows = docs.select(whole.alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary)
        for batch in batches:
            counts = [counter.count(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    pa.compute.binary_length(batch["text"].cast(pa.binary())).cast(pa.int64()),
                    pa.array(np.array(counts, np.int64)),
                ],
                names=["row", "n_bytes", "n_tokens"],
            )

    schema = StructType([rows.schema["row"]]).add("n_bytes", "long").add("n_tokens", "long")
    counted = rows.mapInArrow(count, schema)
    fields = [F.col("row").getField(c).alias(c) for c in kept]
    return counted.select(
        *fields, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
