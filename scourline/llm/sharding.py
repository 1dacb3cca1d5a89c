"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of slots.  A key stands in the slot of its hash and belongs to
the next virtual node clockwise; if the shard of that node is full, it goes on to the next
node whose shard is not.  How many keys of a slot go where depends on the counts of the
slots alone: these bounded counts are summed by Spark and walked once, and each row then
finds its shard from its rank in its slot.
"""

from __future__ import annotations

from bisect import bisect_left

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .work import stored

RING_SLOTS = 1 << 16
NODES = 128  # virtual nodes of a shard

_SEGMENT = "place int, low long, high long, shard int, base long"


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """Slot and shard of each virtual node, clockwise; a shard's nodes never depend on
    how many shards there are."""
    points = (
        (xxhash.xxh3_64_intdigest(f"{s}/{k}") % RING_SLOTS, s)
        for s in range(shards) for k in range(nodes)
    )
    return sorted(points, key=lambda p: (p[0], xxhash.xxh3_64_intdigest(f"{p[0]}:{p[1]}"), p[1]))


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """The most rows of each shard: with no slack they add up to ``rows`` exactly."""
    total = max(int(rows * (1 + slack)), rows)
    return [total // shards + (s < total % shards) for s in range(shards)]


def segments(counts: dict[int, int], shards: int, slack: float = 0.0) -> list[tuple]:
    """Where the keys of each slot go: slot, first and last rank, shard, first place there."""
    points = ring(shards)
    slots = [p for p, _ in points]
    free = capacities(sum(counts.values()), shards, slack)
    used = [0] * shards
    onward = list(range(len(points) + 1))  # to the next node whose shard may have room

    def next_open(i: int) -> int:
        path = []
        while i < len(points) and (onward[i] != i or free[points[i][1]] == 0):
            if onward[i] == i:
                onward[i] = i + 1
            path.append(i)
            i = onward[i]
        for p in path:
            onward[p] = i
        return i

    found = []
    for slot in sorted(counts):
        rank, left = 0, counts[slot]
        at = bisect_left(slots, slot)
        while left:
            at = next_open(at)
            if at == len(points):  # past the top: the ring goes on at its first node
                at = next_open(0)
            shard = points[at][1]
            take = min(left, free[shard])
            found.append((slot, rank, rank + take - 1, shard, used[shard]))
            free[shard] -= take
            used[shard] += take
            rank, left = rank + take, left - take
    return found


def assign_shards(docs: DataFrame, shards: int, slack: float = 0.0) -> DataFrame:
    """Put every row of ``docs`` (``doc_id``, ``text``) into one of ``shards`` shards.

    No shard gets more than its share of the rows times ``1 + slack``; with no slack the
    counts differ by one at most (the law ``rows``).  Returns ``doc_id``, ``size`` (UTF-8
    bytes of the text plus 16), ``text_crc32``, ``law``, ``shard``, ``slot`` (place in the
    shard, from 0 without gaps) and ``grown_shard`` (null: the law is not ``key``).

    A null text has size 16 and the checksum 0, as an empty one.  Null ids stand in one slot
    of the ring.  Rows equal in id and text are counted before they are ranked and each get
    a place of their own.  Further columns are ignored; an empty table gives an empty one.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    text = F.coalesce(docs["text"].cast("binary"), F.lit(b""))
    rows = docs.select(
        docs["doc_id"].alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 48).cast("int").alias("place")
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    rows = stored(rows.select("*", place), "digests")
    counts = {r.place: r.n for r in rows.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    routes = docs.sparkSession.createDataFrame(segments(counts, shards, slack), _SEGMENT)
    order = Window.partitionBy("place").orderBy(F.xxhash64("doc_id"), "doc_id", "size", "text_crc32")
    until = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = rows.select("*", until.alias("until")).select(
        "*", F.explode(F.sequence(F.col("until") - F.col("n"), F.col("until") - 1)).alias("rank")
    )
    # At most one segment for each slot of the ring and each shard that fills up.
    found = ranked.join(F.broadcast(routes), "place").where("rank between low and high")
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("base") + F.col("rank") - F.col("low")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
