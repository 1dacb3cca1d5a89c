"""The Merkle manifest against a plain recursive one."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from scourline.llm.manifest import Block, digest_of, manifest
from scourline.llm.ranks import ranked


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes, k):
    """The root over ``nodes``, and the siblings of node ``k`` as (left, right) lists."""
    path = []
    while len(nodes) > 1:
        low = k - k % 16
        run = nodes[low : low + 16]
        path.append((run[: k - low], run[k - low + 1 :]))
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        k //= 16
    return nodes[0], path


def fold(digest, path):
    for left, right in path:
        digest = h(*left, digest, *right)
    return digest


def brute(rows):
    """``rows``: (row, group, leaf, changed)."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[3] or r[2])
    names = sorted({r[1] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = [sorted((r for r in rows if r[1] == g), key=key) for g in names]
    subroots = [climb([r[2] for r in t], 0)[0] for t in trees]
    out = []
    for g, tree in enumerate(trees):
        root, over = climb(subroots, g)
        for k, (row, _, leaf, changed) in enumerate(tree):
            path = climb([r[2] for r in tree], k)[1] + over
            proof = h(*(x for left, right in path for x in (*left, *right)))
            folded = fold(changed or leaf, path)
            out.append((row, leaf, subroots[g], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def rows_of(sizes):
    rows = []
    for group, size in sizes.items():
        for i in range(size):
            row = zlib.crc32(f"{group}{i}".encode())
            leaf = h(str(row))
            rows.append((row, group, leaf, h(leaf) if row % 5 == 0 else None))
    return rows


SCHEMA = "row long, group string, leaf string, changed string"


@pytest.mark.parametrize(
    "sizes",
    [
        {"one": 1},
        {"a": 1, "b": 16, "c": 17, "é": 257, "z": 256, None: 3, "": 2},
        {"large": 4200, "small": 5},
        {f"g{i}": 1 + i % 2 for i in range(300)},
    ],
)
def test_like_plain_tree(spark, sizes):
    rows = rows_of(sizes)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert sorted(map(tuple, manifest(df).collect()), key=repr) == brute(rows)


def test_odd_rows(spark):
    same = [(3, "g", h("x"), None)] * 20
    rows = [*same, (None, None, h("n"), h("m")), (None, "g", h("q"), None), (None, "g", h("p"), None)]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], SCHEMA + ", place int, tree string")
    got = sorted(map(tuple, manifest(df).collect()), key=repr)
    assert got == brute(rows)
    assert manifest(df.limit(0)).count() == 0


def test_states_are_resumed():
    leaves = [h(str(i)) for i in range(200)]
    block = Block(leaves, 200)
    root, path = climb(leaves, 77)
    digest = "0" * 64
    for parent, slot in block.parents(77):
        digest = parent.fold(slot, digest)
    assert digest == fold("0" * 64, path)
    assert block.levels[-1][0].digest == root


def test_digest_of_values(spark):
    df = spark.createDataFrame([(1, None, "é\n"), (None, "", "-")], "a long, b string, c string")
    got = [r[0] for r in df.select(digest_of("a", "b", "c")).collect()]
    assert got == [h("1:1", "-", "3:é\n"), h("-", "0:", "1:-")]


def test_one_group_is_spread(spark):
    """A group that fills several parts is numbered without a gap."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        df = spark.range(0, 20_000, 1, 8).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 20_000).alias("x"))
        found = ranked(df, "g", [F.col("x").asc()])
        assert found.where("place = x and n = 20000").count() == 20_000
    finally:
        spark.conf.unset(name)
