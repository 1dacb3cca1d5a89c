"""A Merkle manifest of a table: a tree over the rows of each group, and one over the groups.

Nodes are lowercase hex SHA-256 digests; a parent hashes up to ``FANOUT`` consecutive nodes
as text.  A tree grows while it has more than one node.  Trees are built and walked in
blocks of ``FANOUT ** 2`` nodes of a level, so that no tree, whatever its size, meets in one
task; a tier of blocks takes two levels off.

To check a row again, its leaf is folded to the root.  A parent keeps a copy of its hash
state before each child slot, so folding resumes the state before the slot, takes in the
replacement and the siblings to the right, and never hashes the left ones again.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import ranked
from .work import stored

FANOUT = 16
BLOCK = FANOUT**2
_PATHS = "tree string, place long, path array<struct<left:string,right:string>>, subroot string"


def digest_of(*values: str) -> Column:
    """H of some columns: each ``-`` if null, else its bytes in UTF-8, a colon, its text."""
    parts = []
    for value in values:
        text = F.col(value).cast("string")
        tagged = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(tagged, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _tier(nodes: DataFrame) -> DataFrame:
    """The nodes two levels up (fewer where a single one remains): one shuffle."""
    up = nodes.withColumn("block", F.expr(f"place div {BLOCK}")).repartition("tree", "block")
    for size in (FANOUT, BLOCK):
        here = F.array_sort(F.collect_list(F.struct("place", "digest")))
        joined = F.array_join(F.transform("nodes", lambda x: x["digest"]), "")
        alone = F.col("n") == 1
        up = (
            up.groupBy("tree", "block", "n", F.expr(f"place div {FANOUT}").alias("run"))
            .agg(here.alias("nodes"))
            .select(
                "tree", "block", F.col("run").alias("place"),
                F.when(alone, F.col("nodes")[0]["digest"]).otherwise(F.sha2(joined, 256)).alias("digest"),
                F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
            )
        )
    return up.select("tree", "place", "digest", "n")


def grow(leaves: DataFrame, label: str) -> list[DataFrame]:
    """All tiers of the trees over ``leaves`` (tree, place, digest, n), the roots last."""
    tiers = [leaves]
    while (tiers[-1].agg(F.max("n")).first()[0] or 0) > 1:
        tiers.append(stored(_tier(tiers[-1]), label))
    return tiers


class Parent:
    """A node with its hash states before each child slot."""

    def __init__(self, children: list[str]):
        state = hashlib.sha256()
        self.children, self.before, self.right = children, [], []
        for k, child in enumerate(children):
            self.before.append(state.copy())
            self.right.append("".join(children[k + 1 :]))
            state.update(child.encode())
        self.digest = state.hexdigest()

    def fold(self, slot: int, replacement: str) -> str:
        state = self.before[slot].copy()
        state.update((replacement + self.right[slot]).encode())
        return state.hexdigest()

    def siblings(self, slot: int) -> tuple[str, str]:
        return "".join(self.children[:slot]), self.right[slot]


class Block:
    """Up to ``BLOCK`` consecutive nodes of a tree of ``n``, and the levels over them."""

    def __init__(self, digests: list[str], n: int):
        self.levels: list[list[Parent]] = []
        for _ in range(2):
            if n == 1:
                break
            runs = range(0, len(digests), FANOUT)
            self.levels.append([Parent(digests[k : k + FANOUT]) for k in runs])
            digests, n = [p.digest for p in self.levels[-1]], -(-n // FANOUT)

    def parents(self, k: int):
        """Each parent over node ``k``, and the slot below it."""
        for level in self.levels:
            yield level[k // FANOUT], k % FANOUT
            k //= FANOUT


class Above:
    """The levels over a block: states before its slot, kept once for all its rows."""

    def __init__(self, path: list[dict]):
        self.text = "".join(level["left"] + level["right"] for level in path)
        self.states = [(hashlib.sha256(level["left"].encode()), level["right"]) for level in path]

    def fold(self, digest: str) -> str:
        for before, right in self.states:
            state = before.copy()
            state.update((digest + right).encode())
            digest = state.hexdigest()
        return digest


def _in_order(nodes: pa.Table) -> pa.Table:
    return nodes.take(pc.sort_indices(nodes["place"]))


def _paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """The siblings of each node of a block, level by level up to the last root."""
    nodes, rest = _in_order(nodes), above["path"][0].as_py()
    block = Block(nodes["digest"].to_pylist(), nodes["n"][0].as_py())
    paths = []
    for k in range(nodes.num_rows):
        own = [dict(zip(("left", "right"), p.siblings(slot))) for p, slot in block.parents(k)]
        paths.append(own + rest)
    level = pa.struct([("left", pa.string()), ("right", pa.string())])
    return pa.table(
        {
            "tree": nodes["tree"],
            "place": nodes["place"],
            "path": pa.array(paths, pa.list_(level)),
            "subroot": pa.repeat(above["subroot"][0], nodes.num_rows),
        }
    )


def _folded(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """Proof and folded root of each row of a block."""
    nodes, over = _in_order(nodes), Above(above["path"][0].as_py())
    leaves = nodes["digest"].to_pylist()
    block = Block(leaves, nodes["n"][0].as_py())
    proofs, roots = [], []
    for k, digest in enumerate(nodes["changed"].to_pylist()):
        proof = hashlib.sha256()
        for parent, slot in block.parents(k):
            proof.update("".join(parent.siblings(slot)).encode())
            digest = parent.fold(slot, digest)
        proof.update(over.text.encode())
        proofs.append(proof.hexdigest())
        roots.append(over.fold(digest))
    return pa.table(
        {
            "row": nodes["row"],
            "leaf": nodes["digest"],
            "subroot": pa.repeat(above["subroot"][0], nodes.num_rows),
            "proof": proofs,
            "folded": roots,
        }
    )


def _by_block(nodes: DataFrame, above: DataFrame, step, schema: str) -> DataFrame:
    nodes = nodes.withColumn("block", F.expr(f"place div {BLOCK}"))
    above = above.withColumnRenamed("place", "block")
    keys = ["tree", "block"]
    return nodes.groupBy(*keys).cogroup(above.groupBy(*keys)).applyInArrow(step, schema)


def _descend(tiers: list[DataFrame], above: DataFrame, label: str) -> DataFrame:
    """From the paths over a tier to those over the nodes of the first of ``tiers``."""
    for nodes in reversed(tiers):
        above = stored(_by_block(nodes, above, _paths, _PATHS), label)
    return above


def manifest(rows: DataFrame) -> DataFrame:
    """``row``, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded`` and ``verified``.

    ``rows`` has ``row`` (long, an id), ``group`` (string), ``leaf`` (its digest) and
    ``changed`` (the digest to fold in place of ``leaf``; null: ``leaf`` itself).  Rows of a
    group stand by ``row``, null first, ties by ``leaf`` and ``changed``; groups stand by
    their UTF-8 bytes, null first; an empty group is one of its own.  ``proof`` is H of the
    siblings from the leaf to the root.  Repeated rows are leaves of their own.  Empty
    tables give no rows.  Other columns are not read.  One root reaches the driver.
    """
    tree = F.coalesce(F.concat(F.lit("="), "group"), F.lit(""))  # null before empty
    leaves = rows.select(
        "row", tree.alias("tree"), F.col("leaf").alias("digest"),
        F.coalesce("changed", "leaf").alias("changed"),
    )
    leaves = stored(leaves, "leaves")
    first = [F.col("row").asc_nulls_first(), F.col("digest").asc(), F.col("changed").asc()]
    leaves = stored(ranked(leaves, "tree", first), "leaves-placed")
    tiers = grow(leaves.select("tree", "place", "digest", "n"), "tiers")
    subroots = tiers[-1].select(F.col("tree").alias("name"), "digest", F.lit("").alias("tree"))
    subroots = stored(ranked(subroots, "tree", [F.col("name").asc()]), "subroots")
    top = grow(subroots.select("tree", "place", "digest", "n"), "top")
    roots = top[-1]
    found = roots.first()
    root = found["digest"] if found else None

    none = F.array().cast("array<struct<left:string,right:string>>").alias("path")
    above = roots.select("tree", "place", none, F.lit(None).cast("string").alias("subroot"))
    above = _descend(top[:-1], above, "top-paths").drop("tree", "subroot")
    above = above.join(subroots.select("place", "name", "digest"), "place").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), "path",
        F.col("digest").alias("subroot"),
    )
    above = _descend(tiers[1:-1], stored(above, "paths"), "paths")
    schema = "row long, leaf string, subroot string, proof string, folded string"
    return _by_block(leaves, above, _folded, schema).select(
        "row", "leaf", "subroot", F.lit(root).alias("root"), "proof", "folded",
        (F.col("folded") == F.lit(root)).alias("verified"),
    )
