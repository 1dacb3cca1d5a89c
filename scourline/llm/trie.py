"""The prefix trie of conversations, with totals of all subtrees by parallel tree contraction.

A node is a distinct sequence of first turns.  Nodes are found by digests of prefixes, which
are sums (exclusive or) of digests of turn and place, so that they need no walk along a
conversation.  Subtree totals come by contraction: each round splices unary chains out
(compress) and then adds the leaves to their parents (rake), until the root is left; spliced
nodes get their totals from the chain's top, last round first.  Every step is a join or a
grouping, so neither depth nor width of the trie meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import ranked
from .work import stored

#: Turns of a conversation, nodes of a chain and ids of a list that are handled together.
CHUNK = 1024
#: Parents with more than this part of all nodes as children are joined by broadcast.
HOT_PART = 2000
HOT_LEAST = 1000
WORD = r"[^\x20\x09-\x0D]+"
_KEY = ["depth", "k1", "k2"]


def placed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 0), ``turn_digest`` and ``n_words`` of each turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(role).cast("string")
    turns = conversations.where("conv_id is not null").select(
        "conv_id", "turn",
        F.md5(F.concat(size, F.lit(":"), role, text)).alias("turn_digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("turn_digest").asc()]
    return ranked(stored(turns, "turns"), "conv_id", order, "turns").drop("turn", "n")


def branched(turns: DataFrame, family: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that take over the first turns of another, and the ids of all.

    ``turns`` is what :func:`placed_turns` gives.  Conversation c starts with the first h
    turns of conversation c - c % ``family`` (all if there are fewer), followed by its own
    after its first h; h is the unsigned CRC-32 of c as decimal text, modulo ``most`` + 1.
    """
    ids = turns.select("conv_id").distinct().select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).alias("h"),
    )
    ids = stored(ids, "conversations")
    own = F.crc32(F.col("conv_id").cast("string")) % (most + 1)
    tails = turns.where(F.col("place") >= own).withColumn("kind", F.lit(1))
    heads = (
        turns.where((F.col("conv_id") % family == 0) & (F.col("place") < most))
        .withColumnRenamed("conv_id", "base")
        .join(ids, "base")
        .where("place < h")
        .select("conv_id", "place", "turn_digest", "n_words", F.lit(0).alias("kind"))
    )
    both = stored(tails.unionByName(heads).withColumnRenamed("place", "was"), "branched")
    placed = ranked(both, "conv_id", [F.col("kind").asc(), F.col("was").asc()], "branched")
    return placed.drop("kind", "was"), ids.select("conv_id")


def _prefixes(turns: DataFrame) -> DataFrame:
    """A row for each turn: the digest of the prefix that ends with it, and of the one before.

    Digests run within chunks of a conversation; those of whole chunks are put before them.
    """
    depth = (F.col("place") + 1).alias("depth")
    mixed = turns.select(
        "conv_id", depth, "n", "n_words",
        F.expr(f"place div {CHUNK}").alias("chunk"),
        F.xxhash64(depth, "turn_digest").alias("m1"),
        F.xxhash64("turn_digest", depth).alias("m2"),
    )
    chunk = Window.partitionBy("conv_id", "chunk").orderBy("depth")
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        mixed.groupBy("conv_id", "chunk")
        .agg(F.bit_xor("m1").alias("c1"), F.bit_xor("m2").alias("c2"))
        .select("conv_id", "chunk", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(c) for c in ("c1", "c2")])
    )
    return (
        mixed.join(before, ["conv_id", "chunk"])
        .withColumn("k1", F.bit_xor("m1").over(chunk).bitwiseXOR(F.col("c1")))
        .withColumn("k2", F.bit_xor("m2").over(chunk).bitwiseXOR(F.col("c2")))
        .select(
            "conv_id", *_KEY, "n", "n_words",
            F.col("k1").bitwiseXOR(F.col("m1")).alias("p1"),
            F.col("k2").bitwiseXOR(F.col("m2")).alias("p2"),
        )
    )


def _sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids from its sorted blocks, one state at a time."""
    key, state, found = None, None, []
    for batch in batches:
        for *here, text in zip(*(batch[c].to_pylist() for c in (*_KEY, "ids"))):
            if here != key:
                if state:
                    found.append((*key, state.hexdigest()))
                key, state = here, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield _digests(found)
        found = []
    if state:
        yield _digests([(*key, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_KEY, "ends_sha256"]
    )


def _ends(ended: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, ascending; blocks of ids are joined first."""
    blocks = ended.groupBy(*_KEY, F.shiftright("conv_id", 10).alias("block")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    sorted_blocks = blocks.repartition(*_KEY).sortWithinPartitions(*_KEY, "block")
    return sorted_blocks.mapInArrow(_sha256, "depth long, k1 long, k2 long, ends_sha256 string")


def _nodes(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie with their parents, not yet with totals.

    ``path`` is the smallest id among the longest members: along a chain of nodes with one
    child each it stays the same, as no member that ends on the way is among the longest.
    """
    rows = stored(_prefixes(turns), "prefixes")
    longest = F.min(F.struct((-F.col("n")).alias("n"), "conv_id"))["conv_id"]
    deeper = rows.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), longest.alias("path"),
        F.min("n_words").alias("n_words"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
    )
    zero = F.lit(0).cast("long")
    no_key = F.lit(None).cast("long")
    first = rows.where("depth = 1").agg(longest.alias("path"))
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    root = root.where("n_convs > 0").select(
        *[zero.alias(k) for k in _KEY], "conv_id", "n_convs", no_key.alias("path"),
        zero.alias("n_words"), no_key.alias("p1"), no_key.alias("p2"),
    )
    path = first.first()["path"]
    nodes = deeper.unionByName(root.withColumn("path", F.coalesce(F.lit(path), "conv_id")))

    turnless = ids.join(rows.where("depth = 1").select("conv_id"), "conv_id", "left_anti")
    ended = rows.where("depth = n").select("conv_id", *_KEY)
    ends = _ends(ended.unionByName(turnless.select("conv_id", *[zero.alias(k) for k in _KEY])))
    kids = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(
        nodes.join(kids, _KEY, "left")
        .join(ends, _KEY, "left")
        .fillna(0, ["n_children"])
        .fillna(hashlib.sha256().hexdigest(), ["ends_sha256"]),
        "nodes",
    )
    return _with_parents(nodes)


def _with_parents(nodes: DataFrame) -> DataFrame:
    """``parent_conv_id`` by a join; parents of very many nodes, which are few, by broadcast."""
    limit = max(HOT_LEAST, nodes.count() // HOT_PART)
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"), "n_children",
    )
    on = ["depth", "p1", "p2"]
    few = parents.where(F.col("n_children") > limit).drop("n_children")
    many = parents.where(F.col("n_children") <= limit).drop("n_children")
    met = nodes.join(F.broadcast(few), on, "left")
    found = met.where("parent_conv_id is not null or depth = 0")
    rest = met.where("parent_conv_id is null and depth > 0").drop("parent_conv_id").join(many, on)
    return stored(found.unionByName(rest).drop("k1", "k2", "p1", "p2"), "trie")


def _compressed(nodes: DataFrame, by_path: bool, turn: int, sums: list[str]) -> DataFrame:
    """One round's nodes with ``kids``, and with chains spliced into their ``top``.

    Groups hold unary nodes only: by path and chunk of depths, or by coins, where a node
    that shows heads meets its only child if that shows tails.  Spliced nodes get ``top``
    and ``above_``, what the chain holds above them; a top gets the sum of its chain.
    """
    kids = (
        nodes.where("parent is not null")
        .groupBy(F.col("parent").alias("id"))
        .agg(F.count(F.lit(1)).alias("kids"), F.min("id").alias("only"))
    )
    here = stored(nodes.join(kids, "id", "left").fillna(0, ["kids"]), "kids")
    if by_path:
        group = F.struct("path", F.expr(f"id.depth div {CHUNK}"))
    else:
        heads = F.xxhash64(F.lit(turn), "id") % 2 == 0
        group = F.when(heads, F.col("only")).otherwise(F.col("id"))
    chain = Window.partitionBy("group").orderBy("id.depth")
    run = Window.partitionBy("group", "run")
    down = run.orderBy("id.depth")
    runs = (
        here.where("kids = 1")
        .withColumn("group", group)
        .withColumn("linked", F.coalesce(F.col("parent") == F.lag("id").over(chain), F.lit(False)))
        .withColumn("run", F.sum(F.when(F.col("linked"), 0).otherwise(1)).over(chain))
        .withColumn("top", F.first("id").over(down))
        .withColumn("length", F.count(F.lit(1)).over(run))
        .where("length > 1")
    )
    runs = stored(
        runs.select(
            "id", "top", "only",
            (F.row_number().over(down) == F.col("length")).alias("last"),
            *[F.sum(c).over(run).alias(f"run_{c}") for c in sums],
            *[(F.sum(c).over(down) - F.col(c)).alias(f"above_{c}") for c in sums],
        ),
        "chains",
    )
    # The child below a chain, which is in no other place of one, hangs on the top now.
    below = runs.where("last").select(F.col("only").alias("id"), F.col("top").alias("new_parent"))
    return (
        here.join(runs.drop("only", "last"), "id", "left")
        .join(below, "id", "left")
        .withColumn("parent", F.coalesce("new_parent", "parent"))
        .withColumn("gone", F.coalesce(F.col("top") != F.col("id"), F.lit(False)))
        .select(
            "id", "parent", "path", "kids", "gone", "top",
            *[F.coalesce(f"run_{c}", c).alias(c) for c in sums],
            *[f"above_{c}" for c in sums],
        )
    )


def subtree_sums(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """``id`` and the sums of some long columns over the subtree of each node.

    ``nodes`` has ``id`` and ``parent`` (structs with a ``depth``; null for the root),
    ``path`` and the columns; within a path there is one node of each depth.  Rounds are
    about the logarithm of the number of nodes, as chains are shortened by a part and
    leaves leave; by paths, whole chains of a path go at once.
    """
    rounds, turn = [], 0
    left = nodes
    while not left.isEmpty():
        turn += 1
        here = stored(_compressed(left, turn % 2 == 1, turn, sums), "contracted")
        rounds.append(here)
        leaves = here.where("not gone and kids = 0")
        raked = leaves.groupBy(F.col("parent").alias("id")).agg(*[F.sum(c).alias(f"raked_{c}") for c in sums])
        left = here.where("not gone and kids > 0").join(raked, "id", "left").select(
            "id", "parent", "path",
            *[(F.col(c) + F.coalesce(f"raked_{c}", F.lit(0))).alias(c) for c in sums],
        )
        left = stored(left, "left")
    return _expanded(rounds, nodes, sums)


def _expanded(rounds: list[DataFrame], nodes: DataFrame, sums: list[str]) -> DataFrame:
    """Totals of spliced nodes from those of their tops, last round first."""
    known = nodes.select("id", *sums).limit(0)
    for here in reversed(rounds):
        known = known.unionByName(here.where("not gone and kids = 0").select("id", *sums))
        tops = known.select(F.col("id").alias("top"), *sums)
        spliced = here.where("gone").select("id", "top", *[f"above_{c}" for c in sums]).join(tops, "top")
        known = known.unionByName(
            spliced.select("id", *[(F.col(c) - F.col(f"above_{c}")).alias(c) for c in sums])
        )
        known = stored(known, "totals")
    return known


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """A row for each node of the trie over placed ``turns`` of the conversations ``ids``.

    ``turns`` has ``conv_id``, ``place`` (gapless from 0), ``n`` (turns of the conversation),
    ``turn_digest`` and ``n_words``; ``ids`` lists each conversation once, also those without
    turns, which are members of the root alone.  A node is named by ``conv_id``, its smallest
    member, and ``depth``.  Totals over subtrees are ``n_leaves`` and ``saved_tokens``, the
    words of a node's last turn times its members but one.  Equal conversations share all
    their nodes, whatever their number.  Without conversations there is no row.

    Conversations with a null id take no part.  Null roles and texts are empty.  Turns stand
    by ``turn``, null first, ties by the MD5 of role and text; repeated rows are turns of
    their own.  Other columns are not read.
    """
    trie = _nodes(turns, ids)

    def named(conv_id: str, depth: Column) -> Column:
        return F.struct(F.col(conv_id).alias("conv_id"), depth.cast("long").alias("depth"))

    parent = F.when(F.col("depth") > 0, named("parent_conv_id", F.col("depth") - 1))
    nodes = trie.select(
        named("conv_id", F.col("depth")).alias("id"), parent.alias("parent"), "path",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
    )
    totals = subtree_sums(nodes, ["n_leaves", "saved_tokens"])
    totals = totals.select("id.conv_id", "id.depth", "n_leaves", "saved_tokens")
    return trie.join(totals, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    )
