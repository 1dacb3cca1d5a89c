"""The prefix trie against a plain one in memory."""

import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from scourline.llm import trie
from scourline.llm.trie import branched, placed_turns, prefix_trie, subtree_sums

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows, family=20, most=3):
    own = {}
    digest = lambda r: hashlib.md5(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest()
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, digest(r))):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids.get(node, [])) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids.get(node, []))
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(node))
        out.append(
            (min(who), len(node), min(members[node[:-1]]) if node else None, len(who),
             len(kids.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def check(spark, rows, family=20, most=3):
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefix_trie(*branched(placed_turns(df), family, most)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rebuilt(rows, family, most))


def test_like_plain_trie(spark, monkeypatch):
    monkeypatch.setattr(trie, "HOT_LEAST", 3)
    monkeypatch.setattr(trie, "HOT_PART", 10)
    r = random.Random(3)
    rows = []
    for c in range(-25, 90):
        if c % 7 != 5:
            for t in range(r.randrange(1, 9)):
                rows.append((c, r.choice([t, None, t // 2]), r.choice(["user", None]), r.choice(["a b", "", None, "é x y"])))
    check(spark, rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "no id"), (1, 1, "u", "x y"), (1, 1, "u", "x y"), (5, None, None, None),
        (6, 2, "u", ""), (7, 0, "ab", "c"), (9, 0, "a", "bc"), (2**62, 1, "u", "word " * 30_000),
    ]
    check(spark, rows)
    more = spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA + ", n int, place string")
    assert prefix_trie(*branched(placed_turns(more), 20, 3)).count() == len(brute(rebuilt(rows)))
    empty = more.limit(0)
    assert prefix_trie(*branched(placed_turns(empty), 20, 3)).count() == 0


def test_long_and_common_conversations(spark, monkeypatch):
    """A conversation of several chunks, equal ones, prefixes of each other, many at once."""
    monkeypatch.setattr(trie, "CHUNK", 16)
    rows = [(0, t, "u", f"turn {t}") for t in range(150)]
    rows += [(20 * k, t, "u", f"turn {t}") for k in range(1, 60) for t in range(k * 2)]
    rows += [(20_000 + 20 * k, t, "u", f"same {t}") for k in range(1200) for t in range(2)]
    rows += [(90_020, t, "u", f"turn {t}" if t < 70 else "other") for t in range(140)]
    check(spark, rows)


def test_sums_of_any_tree(spark, monkeypatch):
    """Chains across paths are shortened by coins."""
    monkeypatch.setattr(trie, "CHUNK", 4)
    r = random.Random(5)
    parent = {0: None, **{i: max(0, i - 1 - (r.randrange(3) == 0) * r.randrange(i)) for i in range(1, 300)}}
    depth = {0: 0}
    for i in range(1, 300):
        depth[i] = depth[parent[i]] + 1
    rows = [(i, depth[i], parent[i], depth.get(parent[i]), i, i + 1) for i in parent]
    df = spark.createDataFrame(rows, "i long, d long, p long, pd long, path long, w long").select(
        F.struct(F.col("i").alias("conv_id"), F.col("d").alias("depth")).alias("id"),
        F.when(F.col("p").isNotNull(), F.struct(F.col("p").alias("conv_id"), F.col("pd").alias("depth"))).alias("parent"),
        "path", "w",
    )
    want = {i: i + 1 for i in parent}
    for i in range(299, 0, -1):
        want[parent[i]] += want[i]
    assert {x.id.conv_id: x.w for x in subtree_sums(df, ["w"]).collect()} == want
