"""Near-duplicate texts: an n-gram Jaccard join with MinHash bands.

1. Each text becomes its set of word n-grams, a MinHash signature and a fingerprint of the
   set.  Texts with equal sets are one *node* from here on.
2. Nodes that share a band hash are candidates.  Each bucket links its nodes to its
   smallest one, so a bucket gives as many rows as it has nodes; connected candidates form
   a *cluster*.
3. Each cluster is cut into blocks of bounded size and every two blocks meet in one group.
   There all pairs are verified on their full sets.  Counting goes by what a set has more
   or less than the common set of the group, which is little for copies; pairs are counted
   in place and never emitted.
4. Verified links are connected to classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .recompression import mix
from .work import stored

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
HASHES = 128
BLOCK_NGRAMS = 1_000_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def bands_for(similarity: float, recall: float, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows for which ``recall`` is met with ``hashes`` values."""
    best = None
    for rows in range(1, hashes + 1):
        hit = similarity**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows > hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("more hashes are needed for this recall")
    return best


class _Names(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = name = xxhash.xxh3_64_intdigest(word)
        return name


def ngrams(text: bytes | None, names: dict, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams.

    A text of fewer words, but not none, is one gram.
    """
    words = (text or b"").split()
    one = np.fromiter(map(names.__getitem__, words), np.uint64, len(words))
    if not len(one):
        return one
    width = min(n, len(one))
    total = np.full(len(one) - width + 1, width, np.uint64)
    for k in range(width):
        total = total * _GOLD + one[k : len(one) - width + 1 + k]
    return np.unique(mix(total))


class Signer:
    def __init__(self, bands: int, rows: int):
        random = np.random.default_rng(20240229)
        shape = (1, bands * rows)
        self.bands, self.rows = bands, rows
        self.factor = random.integers(0, 1 << 32, shape, np.uint64).astype(np.uint32) | np.uint32(1)
        self.shift = random.integers(0, 1 << 32, shape, np.uint64).astype(np.uint32)

    def bands_of(self, grams: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each band of the MinHash signature."""
        low = np.full(self.factor.shape[1], np.iinfo(np.uint32).max, np.uint32)
        half = (grams >> np.uint64(32)).astype(np.uint32)[:, None]
        for at in range(0, len(half), 1024):
            low = np.minimum(low, (half[at : at + 1024] * self.factor + self.shift).min(axis=0))
        low = low.reshape(self.bands, self.rows).astype(np.uint64)
        total = np.arange(1, self.bands + 1, dtype=np.uint64)
        for k in range(self.rows):
            total = mix(total * _GOLD + low[:, k])
        return total


def _signed(words: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, names = Signer(bands, rows), _Names()
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                piece = batch.slice(low, 1024)
                size, first, second, keys = [], [], [], []
                for text in piece["text"].cast(pa.binary()).to_pylist():
                    grams = ngrams(text, names, words)
                    size.append(len(grams))
                    with np.errstate(over="ignore"):
                        first.append(int(grams.sum().astype(np.int64)) if len(grams) else None)
                        second.append(int(mix(grams).sum().astype(np.int64)) if len(grams) else None)
                    keys.append(signer.bands_of(grams).view(np.int64) if len(grams) else None)
                if len(names) > 500_000:
                    names.clear()
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": piece["row"],
                        "doc_id": piece["doc_id"],
                        "size": pa.array(size, pa.int64()),
                        "first": pa.array(first, pa.int64()),
                        "second": pa.array(second, pa.int64()),
                        "bands": pa.array(keys, pa.list_(pa.int64())),
                    }
                )

    return sign


def linked(sets: list[np.ndarray], left: np.ndarray, similarity: float):
    """Numbers of links and a label of the linked group of each set.

    ``left`` marks one side; pairs are taken across the sides, or among all if every set is
    on the left.  The overlap of two sets follows from their sizes and from how many of
    their differences to the common set (grams of more than half of the sets) they share.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    grams, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    common = np.bincount(column, minlength=len(grams)) > n / 2
    # Differences to the common set: own grams that are not common, common ones it lacks.
    has = common[column]
    lacks = np.ones((n, int(common.sum())), bool)
    place = np.cumsum(common) - 1
    lacks[owner[has], place[column[has]]] = False
    lack_owner, lack_place = np.nonzero(lacks)
    owner = np.concatenate([owner[~has], lack_owner])
    column = np.concatenate([column[~has], np.flatnonzero(common)[lack_place]])
    by_owner, by_column = np.argsort(owner, kind="stable"), np.argsort(column, kind="stable")
    differs = np.bincount(owner, minlength=n)
    holders, times = owner[by_column], np.bincount(column, minlength=len(grams))
    start = np.cumsum(times) - times
    mine, ends = column[by_owner], np.cumsum(differs)
    links, label = np.zeros(n, np.int64), np.arange(n)
    across = not left.all()
    for i in np.flatnonzero(left):
        own = mine[ends[i] - differs[i] : ends[i]]
        count = times[own]
        at = np.repeat(start[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        shared = np.bincount(holders[at], minlength=n)
        apart = differs[i] + differs - 2 * shared
        whole = sizes[i] + sizes
        near = (whole - apart) >= similarity * (whole + apart) - 1e-9
        near[i] = False
        if across:
            near &= ~left
        found = np.flatnonzero(near)
        if len(found):
            links[i] += len(found)
            if across:
                links[found] += 1
            joined = np.unique(label[np.append(found, i)])
            if len(joined) > 1:
                label[np.isin(label, joined)] = joined[0]
    return links, label


def _verify(words: int, similarity: float):
    def verify(key: tuple, table: pa.Table) -> pa.Table:
        names = _Names()
        sets = [ngrams(t, names, words) for t in table["text"].cast(pa.binary()).to_pylist()]
        left = table["block"].to_numpy() == key[1].as_py()
        links, label = linked(sets, left, similarity)
        node = table["node"].to_numpy()
        some = links > 0
        return pa.table({"node": node[some], "links": links[some], "near": node[label[some]]})

    return verify


def rows_of(docs: DataFrame) -> DataFrame:
    """``docs`` written once, each row in ``doc`` with a number of its own in ``row``."""
    kept = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    return stored(kept.withColumn("row", F.monotonically_increasing_id()), "documents")


def near_duplicates(
    rows: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """Classes of near duplicates over the table that :func:`rows_of` gives.

    Two texts are linked if the Jaccard similarity of their sets of ``words``-grams is at
    least ``similarity``; words are what lies between ASCII blanks, unchanged.  A class is
    what links connect.  Returns one row for each row: ``row``, ``doc_id``, ``class_id``
    (the smallest ``doc_id`` of the class), ``n_links`` (texts with another set of grams
    that it is linked to), ``n_copies`` (other rows with its set) and ``stays`` (true for
    one row of each class, the first by ``doc_id``).

    A pair at exactly ``similarity`` shares a band with probability ``recall`` or more, a
    closer one with a higher one; equal texts are always found.  Null texts and texts
    without words are in a class of their own with no links.  Rows with equal or null ids
    are texts of their own; a null id comes first.  An empty table gives an empty one.
    """
    bands, depth = bands_for(similarity, recall)
    texts = rows.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").alias("text"))
    signed = stored(
        texts.mapInArrow(
            _signed(words, bands, depth),
            "row long, doc_id long, size long, first long, second long, bands array<long>",
        ),
        "signed",
    )
    same = signed.where("size > 0").groupBy("first", "second").agg(
        F.min(F.struct("doc_id", "row", "size", "bands")).alias("least"),
        F.count("*").alias("copies"),
    )
    nodes = stored(
        same.select("first", "second", "copies", "least.*", F.monotonically_increasing_id().alias("node")),
        "nodes",
    )
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = stored(
        banded.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .where("low < high").select("bucket", "low"),
        "buckets",
    )
    candidates = banded.join(buckets, "bucket").select("node", "low")
    clusters = stored(
        components(candidates, "node", "low").join(nodes.select("node", "row", "size"), "node"),
        "clusters",
    )
    total = clusters.groupBy("root").agg(
        F.ceil(F.sum("size") / F.lit(BLOCK_NGRAMS)).cast("int").alias("blocks")
    )
    placed = clusters.join(stored(total, "totals"), "root").select(
        "row", "node", "root", "blocks",
        F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"),
    )
    tiles = texts.select("row", "text").join(placed, "row").select(
        "root", "node", "block", "text",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    tiles = tiles.select(
        "root", F.least("block", "other").alias("upper"), F.greatest("block", "other").alias("lower"),
        "node", "block", "text",
    )
    found = stored(
        # The first of the blocks is the left side of a tile.
        tiles.groupBy("root", "upper", "lower").applyInArrow(
            _verify(words, similarity), "node long, links long, near long"
        ),
        "links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select("node", "near"), "node", "near")
    grouped = stored(
        nodes.drop("bands", "size").join(links, "node", "left").join(classes, "node", "left")
        .withColumn("root", F.coalesce("root", "node")),
        "grouped",
    )
    heads = grouped.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("head"))
    decided = stored(
        grouped.join(stored(heads, "heads"), "root").select(
            "first", "second", "links", "copies", "head"
        ),
        "decided",
    )
    return signed.select("row", "doc_id", "first", "second").join(
        decided, ["first", "second"], "left"
    ).select(
        "row", "doc_id",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("copies") - 1, F.lit(0)).cast("long").alias("n_copies"),
        F.coalesce(F.col("head.row") == F.col("row"), F.lit(True)).alias("stays"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, one row of each class of near duplicates."""
    rows = rows_of(docs)
    stay = near_duplicates(rows).where("stays").select("row")
    # A merge join at every size: both sides grow with the documents.
    return rows.join(stored(stay, "stay").hint("merge"), "row").select("doc.*")
