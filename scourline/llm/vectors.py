"""Nearest neighbours by cosine: a block matrix join with int8 tiles and error bounds.

Queries and candidates are cut into blocks of bounded size by a hash of their ids, and
each block of queries meets each block of candidates in one group, a tile.  In a tile all
vectors are scaled to length one and rounded to int8; a matrix product of the codes gives
every cosine within a known bound.  Pairs whose upper bound reaches the k-th best lower
bound survive; their cosines are computed anew in double precision from the given vectors
and go through a heap for each query.  The tiles' heaps are merged by rank, so the result
is exact.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
STRIPE = 2048  # candidates in one product
_EXACT_DIMS = 1024  # 127 * 127 * 1024 < 2**24: float32 sums of code products are exact


class Coded:
    """Vectors of one length with their int8 codes and the error of these."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        top = np.abs(vectors).max(axis=1, keepdims=True)
        self.norm = np.sqrt(np.square(vectors / top).sum(axis=1)) * top[:, 0]
        unit = vectors / top
        unit /= np.sqrt(np.square(unit).sum(axis=1, keepdims=True))
        self.scale = np.abs(unit).max(axis=1) / 127
        codes = np.rint(unit / self.scale[:, None])
        self.error = np.sqrt(np.square(unit - codes * self.scale[:, None]).sum(axis=1))
        self.codes = codes.astype(np.int8)


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows of int8 codes, as floats."""
    total = 0.0
    for low in range(0, a.shape[1], _EXACT_DIMS):
        part = slice(low, low + _EXACT_DIMS)
        product = a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
        total = total + product.astype(np.float64)
    return total


def tile(query_ids, queries: np.ndarray, ids, vectors: np.ndarray, copies, k: int) -> list[list]:
    """For each query a heap of its ``k`` best ``(cosine, -id)``.

    ``copies`` says how often each candidate row occurs; one that is the query itself counts
    once less.
    """
    heaps: list[list] = [[] for _ in query_ids]
    order = np.argsort(ids, kind="stable")
    ids, vectors, copies = ids[order], vectors[order], copies[order]
    # Of equal vectors only the k + 1 smallest ids can be among the best k of any query.
    _, group = np.unique(vectors, axis=0, return_inverse=True)
    group = group.ravel()
    by = np.argsort(group, kind="stable")
    heads = np.flatnonzero(np.diff(group[by], prepend=-1))
    sizes = np.diff(np.append(heads, len(by)))
    keep = np.empty(len(by), bool)
    keep[by] = np.arange(len(by)) - np.repeat(heads, sizes) <= k
    ids, copies, c, q = ids[keep], copies[keep], Coded(vectors[keep]), Coded(queries)
    for low in range(0, len(ids), STRIPE):
        part = slice(low, low + STRIPE)
        near = code_products(q.codes, c.codes[part]) * np.outer(q.scale, c.scale[part])
        slack = q.error[:, None] + (1 + q.error[:, None]) * c.error[None, part] + 1e-9
        mine, same = np.nonzero(query_ids[:, None] == ids[None, part])
        itself = (q.vectors[mine] == c.vectors[same + low]).all(axis=1)
        mine, same = mine[itself], same[itself]
        single = copies[same + low] == 1
        near[mine[single], same[single]] = -np.inf
        own = set(zip(mine.tolist(), (same + low).tolist()))
        worst = near - slack
        width = worst.shape[1]
        floor = np.full(len(query_ids), -np.inf)
        if width > k:
            floor = np.partition(worst, width - k, axis=1)[:, width - k]
        best = [h[0][0] if len(h) == k else -np.inf for h in heaps]
        floor = np.maximum(floor, np.array(best) - 1e-9)
        near += slack
        rows, cols = np.nonzero((near >= floor[:, None]) & (near > -np.inf))
        for a in range(0, len(rows), 100_000):
            r, s = rows[a : a + 100_000], cols[a : a + 100_000] + low
            score = (q.vectors[r] / q.norm[r, None] * (c.vectors[s] / c.norm[s, None])).sum(axis=1)
            for i, value, at in zip(r.tolist(), score.tolist(), s.tolist()):
                entry = (value, -int(ids[at]))
                for _ in range(min(k, int(copies[at]) - ((i, at) in own))):
                    if len(heaps[i]) < k:
                        heapq.heappush(heaps[i], entry)
                    elif entry > heaps[i][0]:
                        heapq.heapreplace(heaps[i], entry)
                    else:
                        break
    return heaps


def _by_length(table: pa.Table, other: str) -> dict[int, tuple[np.ndarray, ...]]:
    """Ids, vectors and one more column by the length of the vectors."""
    column = table["vector"].combine_chunks()
    ids, more = table["id"].to_numpy(), table[other].to_numpy()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    starts = column.offsets.to_numpy()[:-1]
    found = {}
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        found[int(d)] = ids[at], flat[starts[at][:, None] + np.arange(d)], more[at]
    return found


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` nearest ``vectors`` of each query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both tables have ``id`` and ``vector`` (an array of floats).  ``score`` is the cosine
    in double precision; equal scores go to the smaller id.  The query's own row is left out,
    not so other rows with its id; where fewer than ``k`` are left, all are returned.

    Rows whose id or vector is null, and vectors that are empty, zero or hold null, NaN or
    infinite components, take no part.  Rows that share an id are candidates and queries of
    their own, also equal ones as candidates (an id can then come up several times); queries
    equal in id and vector are one query.  Vectors of different lengths are not compared.  An empty side gives
    no rows.  Other columns are ignored.
    """

    def usable(df: DataFrame) -> DataFrame:
        fine = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
        some = F.exists("vector", lambda x: x != 0)
        df = df.select(F.col("id").cast("long").alias("id"), "vector")
        df = df.where(F.col("id").isNotNull() & F.coalesce(fine & some, F.lit(False)))
        return df.groupBy("id", "vector").agg(F.count(F.lit(1)).alias("copies"))

    vectors, queries = usable(vectors), usable(queries)
    many, asked = vectors.count(), queries.count()
    across, down = (max(math.ceil(n / size), 1) for n, size in ((many, CANDIDATE_BLOCK), (asked, QUERY_BLOCK)))

    def block(n: int):
        return F.pmod(F.xxhash64("id", "vector"), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    key = F.xxhash64("id", "vector").alias("key")
    left = queries.select(block(down).alias("row"), every(across).alias("column"), "id", "vector", key)
    right = vectors.select(every(down).alias("row"), block(across).alias("column"), "id", "vector", "copies")

    def search(asked: pa.Table, given: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if asked.num_rows and given.num_rows:
            candidates = _by_length(given, "copies")
            for d, (ids, rows, keys) in _by_length(asked, "key").items():
                if d in candidates:
                    heaps = tile(ids, rows, *candidates[d], k)
                    for i, own, heap in zip(ids.tolist(), keys.tolist(), heaps):
                        out += [(i, own, -other, score) for score, other in heap]
        names = ("query_id", "key", "vec_id", "score")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table(
            [pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], names=names
        )

    found = left.groupBy("row", "column").cogroup(right.groupBy("row", "column"))
    found = found.applyInArrow(search, "query_id long, key long, vec_id long, score double")
    best = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
