"""Line deduplication by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import stored

WINDOW = 3


def drop_repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Remove the later occurrences of every ``window`` consecutive lines.

    Lines are what lies between line feeds, compared as they are.  Of equal windows the
    first by ``doc_id`` and position stays; each line that another one covers is removed,
    overlaps within one text included.  Returns for each row ``doc_id``, ``n_lines``,
    ``n_removed`` and ``kept_text``.

    A null text has no lines and stays null, an empty one has one empty line; a text of
    fewer lines than a window stays as it is.  Null ids come first.  Rows that share an id are
    ordered by a hash of their text; of rows equal in id and text one is the first, and the
    others lose all their lines (if they have a window at all).  Further columns are ignored; an empty table gives an
    empty one.  Windows are told apart by two 64-bit hashes.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    docs = docs.select("doc_id", "text", F.xxhash64("text", "doc_id").alias("key"), F.hash("doc_id", "text").alias("key2"))
    cut = docs.select("doc_id", "key", "key2", F.split("text", "\n").alias("lines"))

    def hashed(i, *seed):
        return F.xxhash64(*seed, *[F.get("lines", i + k) for k in range(window)])

    every = F.transform(
        F.sequence(F.lit(0), F.size("lines") - window),
        lambda i: F.struct(i.alias("at"), hashed(i).alias("h1"), hashed(i, F.lit(7)).alias("h2")),
    )
    places = cut.where(F.size("lines") >= window).select("doc_id", "key", "key2", F.explode(every).alias("w"))
    place = F.struct("doc_id", "key", "key2", "w.at").alias("place")
    places = places.select("w.h1", "w.h2", place)
    counted = places.groupBy("h1", "h2").agg(
        F.min("place").alias("first"), F.max("place").alias("last")
    )
    repeated = stored(counted.where("first != last").select("h1", "h2", "first"), "repeated-lines")
    # Merge joins at every size: both sides grow with the documents.
    later = places.join(repeated.hint("merge"), ["h1", "h2"]).where("place != first").select("place.*")
    gone = later.groupBy("key", "key2").agg(F.collect_set("at").alias("starts"))
    gone = stored(gone, "later-lines")
    covered = F.array_distinct(
        F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (window - 1))))
    )
    stays = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), covered)
    kept = F.array_join(F.transform(stays, lambda i: F.get("lines", i)), "\n")
    found = docs.join(gone.hint("merge"), ["key", "key2"], "left").withColumn("lines", F.split("text", "\n"))
    # Equal rows, which have met by their keys, are told apart by a number.
    copy = F.row_number().over(Window.partitionBy("key", "key2").orderBy("doc_id"))
    again = (copy > 1) & (F.size("lines") >= window)
    found = found.withColumn("again", again & F.col("text").isNotNull())
    size = F.size("lines")
    return found.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("again"), size).when(F.col("starts").isNull(), 0).otherwise(F.size(covered)).cast("long").alias("n_removed"),
        F.when(F.col("again"), "").when(F.col("starts").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
    )
