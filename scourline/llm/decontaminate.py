"""Benchmark decontamination by winnowing, in DataFrame functions alone.

The fingerprint of a window of ``WIDTH`` words is the smallest hash of its ``GRAM``-word
grams.  Neighbouring windows mostly agree on it, so a text has few distinct fingerprints;
and equal windows have equal ones, so joining them misses no shared span of ``WIDTH`` words
or more.  Hits are then extended: in texts with a shared fingerprint the words of the
windows that have it are compared in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import stored

WIDTH = 10
GRAM = 5

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Digits, small ASCII letters and what is beyond ASCII, after lower-casing A-Z."""
    split = F.split(F.translate(text, _UPPER, _LOWER), _BREAK)
    return F.coalesce(F.array_remove(split, ""), F.array().cast("array<string>"))


def _each(size: Column, width: int, make) -> Column:
    """``make(i)`` for each start of a window of ``width`` in a list of ``size``."""
    starts = F.sequence(F.lit(0), size - F.lit(width))
    return F.when(size >= width, F.transform(starts, make)).otherwise(F.array().cast("array<bigint>"))


def _gram(width: int):
    return lambda i: F.xxhash64(F.lit(width), *[F.get("words", i + k) for k in range(width)])


def fingerprinted(df: DataFrame, widths: list[int]) -> DataFrame:
    """``df`` with ``words`` and, for each width, ``print_<width>``: one value per window."""
    df = df.withColumn("size", F.size("words"))
    if WIDTH in widths:
        df = df.withColumn("grams", _each(F.col("size"), GRAM, _gram(GRAM)))
    last = WIDTH - GRAM
    for width in widths:
        if width == WIDTH:
            least = lambda i: F.least(*[F.get("grams", i + k) for k in range(last + 1)])
            made = _each(F.col("size"), WIDTH, least)
        else:
            made = _each(F.col("size"), width, _gram(width))
        df = df.withColumn(f"print_{width}", made)
    return df


def _windows(width: int, wanted: Column | None) -> Column:
    """Structs of start, width and text of the windows, or of those with wanted prints."""
    prints = F.col(f"print_{width}")
    at = F.transform(prints, lambda p, i: F.struct(i.alias("at"), p.alias("print")))
    if wanted is not None:
        at = F.filter(at, lambda s: F.array_contains(wanted, s["print"]))
    return F.transform(
        at,
        lambda s: F.struct(
            s["at"].alias("at"),
            F.lit(width).alias("width"),
            s["print"].alias("print"),
            F.array_join(F.slice("words", s["at"] + 1, width), " ").alias("window"),
        ),
    )


def _key() -> list[Column]:
    """Rows with equal ids and texts are one; 96 bits keep all others apart."""
    return [F.xxhash64("doc_id", "text").alias("key"), F.hash("text", "doc_id").alias("key2")]


def contaminated_windows(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> tuple:
    """Two stored tables: hits by document (``key``, ``key2``, ``n_hit``) and its items."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    found = items.select(F.least(F.size("words"), F.lit(width)).alias("w")).distinct().collect()
    widths = sorted(row.w for row in found)  # at most `width` values
    docs = docs.select("doc_id", "text")
    parts = [F.when(F.least("size", F.lit(width)) == w, _windows(w, None)) for w in widths]
    if not widths:
        return None, None
    windows = fingerprinted(items, widths).select("item_id", F.explode(F.coalesce(*parts)).alias("w"))
    windows = stored(windows.select("item_id", "w.width", "w.print", "w.window").distinct(), "windows")
    prints = windows.select("print").distinct()

    read = docs.select(*_key(), words_of(F.col("text")).alias("words"))
    printed = fingerprinted(read, widths).select(
        "key", "key2", F.explode(F.array_distinct(F.concat(*[f"print_{w}" for w in widths]))).alias("print")
    )
    shared = printed.join(prints, "print").groupBy("key", "key2").agg(F.collect_set("print").alias("wanted"))
    shared = stored(shared, "shared")

    suspects = docs.select("*", *_key()).join(shared, ["key", "key2"])
    suspects = suspects.select("key", "key2", "wanted", words_of(F.col("text")).alias("words"))
    near = F.concat(*[_windows(w, F.col("wanted")) for w in widths])
    near = fingerprinted(suspects, widths).select("key", "key2", F.explode(near).alias("w"))
    # Rows that are equal throughout are suspects with the same key: each place counts once.
    near = near.select("key", "key2", "w.at", "w.width", "w.window").distinct()
    hits = stored(near.join(windows.select("window", "width").distinct(), ["window", "width"]), "hits")
    spans = F.transform(F.collect_list(F.struct("at", "width")), lambda s: F.sequence(s["at"], s["at"] + s["width"] - 1))
    by_text = hits.groupBy("key", "key2").agg(
        F.size(F.array_distinct(F.flatten(spans))).cast("long").alias("n_hit")
    )
    of_item = hits.select("key", "key2", "window", "width").distinct()
    of_item = of_item.join(windows.select("window", "width", "item_id"), ["window", "width"])
    of_item = of_item.where("item_id is not null").groupBy("key", "key2").agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    return stored(by_text.join(of_item, ["key", "key2"], "left"), "contaminated"), windows


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """How much of each document stands in the benchmark.

    A window is ``WIDTH`` consecutive words of an item (all words of a shorter one); the
    words inside any occurrence of it in a document are hit.  One row for each row of
    ``docs``: ``doc_id``, ``n_words``, ``n_hit`` and ``items`` (sorted ids, as strings, of
    the items with occurring windows).

    Null and empty texts and texts without words have no words and no hits; an item without
    words has no windows.  Rows with equal or null ``doc_id`` count as different documents;
    items that share an id are one, and an item without id hits but is not listed.  Further
    columns are ignored; an empty side gives no hits.
    """
    hits, _ = contaminated_windows(docs, benchmark)
    n_words = F.size(words_of(F.col("text"))).cast("long").alias("n_words")
    read = docs.select("doc_id", *_key(), n_words)
    none = F.array().cast("array<string>")
    if hits is None:
        return read.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"))
    return read.join(hits, ["key", "key2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark."""
    hits, _ = contaminated_windows(docs, benchmark)
    if hits is None:
        return docs
    given = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), *_key())
    return given.join(hits.select("key", "key2"), ["key", "key2"], "left_anti").select("doc.*")
