"""The registered queries of this package: thin digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, mixing, toxicity
from .decontaminate import contamination
from .lines import drop_repeated_lines
from .manifest import digest_of, manifest
from .ngram_join import near_duplicates, rows_of
from .sharding import assign_shards
from .substrings import remove_repeats
from .token_counts import count_tokens
from .tokens import tokens_round_trip
from .trie import branched, placed_turns, prefix_trie
from .vectors import nearest
from .work import ship_package, stored, table

#: Exponents of the data's shares, and the share of all tokens that the mix takes.
MIX = {"source": 0.5, "lang": 0.7, "topic": 0.9}
MIX_BUDGET = 0.6
SHARDS = 40
#: Conversations in a family, and the most turns that one takes over.
FAMILY, BRANCH_TURNS = 20, 3
TOKEN_LIMIT = 1024


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )
    return nearest(rows, rows.where("id % 50 = 0"), k=5)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), SHARDS)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, by trigrams of labelled documents and the evidence of the pages."""
    ship_package(spark)
    trigrams = language.learn_trigrams(table(spark, sf_dir, "documents"))
    host = language.host_of(F.col("url"))
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.col("html").alias("text"), host.alias("host"),
        language.suffix_of(host).alias("suffix"),
        language.declared_in(F.col("html")).alias("declared"),
    )
    return language.identify(pages, trigrams, markup=True).drop("text")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_duplicates(rows_of(table(spark, sf_dir, "documents"))).drop("row")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    read = tokens_round_trip(table(spark, sf_dir, "documents"), vocabulary, end=2)
    return read.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = toxicity.fit(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    return toxicity.toxicity(docs, *model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = mixing.n_tokens(F.col("text"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", tokens.alias("tokens"))
    rows = stored(rows.withColumn("topic", mixing.topic_of(F.col("tokens"))), "sizes")
    return mixing.mix(rows, MIX, MIX_BUDGET)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the conversations, each begun with turns of the first of its family."""
    ship_package(spark)
    turns = placed_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie(*branched(turns, FAMILY, BRANCH_TURNS))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), TOKEN_LIMIT)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the documents by source; every fifth text is folded in small letters."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    fields = ("doc_id", "source", "lang", "n_chars")
    rows = docs.select(*fields, "text", F.translate("text", UPPER, LOWER).alias("lower"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = manifest(
        rows.select(
            F.col("doc_id").alias("row"), F.col("source").alias("group"),
            digest_of(*fields, "text").alias("leaf"),
            F.when(tampered, digest_of(*fields, "lower")).alias("changed"),
        )
    )
    return found.select(
        F.col("row").alias("doc_id"), "leaf", "subroot", "root",
        F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"), "verified",
    )


QUERIES = {
    query.__name__: query
    for query in (
        op1_ann, op2_substring_dedup, op3_decontamination, op4_sharding, op5_language_id,
        op6_ngram_join, op7_line_dedup, op8_tokens, op9_toxicity, op10_mixing,
        op11_prefix_trie, op12_token_counts, op13_manifest,
    )
}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII letters: its bits go through the register one by one."""
    step = "(xor(a, b) >> 1)"
    return f"""xor(list_reduce(list_prepend(cast(4294967295 as bigint), flatten(list_transform(
        string_split({text}, ''), lambda c: [cast(ord(c) as bigint), 0, 0, 0, 0, 0, 0, 0]))),
        lambda a, b: xor({step}, 3988292384 * (xor(a, b) & 1))), cast(4294967295 as bigint))"""


def _tagged(*values: str) -> str:
    parts = (
        f"coalesce(octet_length(encode(cast({v} as varchar))) || ':' || cast({v} as varchar), '-')"
        for v in values
    )
    return f"sha256({' || '.join(parts)})"


def _manifest_sql(levels: int) -> str:
    """Trees of at most ``16 ** levels`` leaves, level by level; sources are a tree as well."""
    fields = ("doc_id", "source", "lang", "n_chars")
    steps = [
        f"""d as (select doc_id, coalesce('=' || source, '') as tree,
            {_tagged(*fields, 'text')} as leaf,
            case when {_crc32('cast(doc_id as varchar)')} % 5 = 0
                then {_tagged(*fields, f"translate(text, '{UPPER}', '{LOWER}')")} end as changed
            from documents)""",
        """l0 as (select tree, doc_id, leaf as node, coalesce(changed, leaf) as changed,
            row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos,
            count(*) over (partition by tree) as n from d)""",
    ]

    def grow(name: str, first: str) -> str:
        for k in range(levels):
            node = "case when n > 1 then sha256(string_agg(node, '' order by pos)) else min(node) end"
            steps.append(
                f"""{name}{k + 1} as (select tree, pos // 16 as pos, {node} as node,
                (n + 15) // 16 as n from {name}{k} group by tree, pos // 16, n)"""
            )
        return f"{name}{levels}"

    subroots = grow("l", "l0")
    steps.append(
        f"""t0 as (select '' as tree, tree as name, node,
            row_number() over (order by tree) - 1 as pos, count(*) over () as n from {subroots})"""
    )
    root = grow("t", "t0")
    steps.append(
        f"""f0 as (select doc_id, l0.tree, l0.node as leaf, changed as node, pos, '' as proof from l0)"""
    )

    def fold(name: str, base: str, k: int, tree: str) -> None:
        mine = f"{base}{k}.pos = f.pos"
        steps.append(
            f"""{name} as (select f.doc_id, f.tree, f.leaf,
            case when min({base}{k}.n) > 1 then sha256(string_agg(
                case when {mine} then f.node else {base}{k}.node end, '' order by {base}{k}.pos))
                else min(f.node) end as node, f.pos // 16 as pos, min(f.proof)
            || coalesce(string_agg({base}{k}.node, '' order by {base}{k}.pos) filter (not {mine}), '') as proof
            from {tree} f join {base}{k} on {base}{k}.pos // 16 = f.pos // 16
                and {base}{k}.tree = {"f.tree" if base == "l" else "''"}
            group by f.doc_id, f.tree, f.leaf, f.pos)"""
        )

    for k in range(levels):
        fold(f"f{k + 1}", "l", k, f"f{k}")
    steps.append(
        f"""g0 as (select f.doc_id, f.tree, f.leaf, f.node, t0.pos, f.proof
            from f{levels} f join t0 on t0.name = f.tree)"""
    )
    for k in range(levels):
        fold(f"g{k + 1}", "t", k, f"g{k}")
    return f"""with {', '.join(steps)}
        select doc_id, leaf, s.node as subroot, r.node as root, sha256(proof) as proof_sha256,
            g.node as folded_root, g.node = r.node as verified
        from g{levels} g join {subroots} s using (tree), {root} r"""


ORACLES = {
    "op3_decontamination": f"""with d as (select doc_id, {_WORDS} as w from documents),
        b as (select item_id, {_WORDS} as w from benchmark),
        bw as (select distinct item_id, least(len(w), 10) as n,
            array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
            from b, unnest(range(1, len(w) - least(len(w), 10) + 2)) t(i) where len(w) > 0),
        dw as (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win
            from d, (select distinct n from bw) s, unnest(range(1, len(w) - n + 2)) t(i)),
        h as (select doc_id, i, n, item_id from dw join bw using (win, n)),
        c as (select doc_id, count(distinct p) as n_hit from
            (select distinct doc_id, i, n from h) x, unnest(range(i, i + n)) t(p) group by 1),
        m as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
            from (select distinct doc_id, cast(item_id as varchar) as item from h) x group by 1)
        select doc_id, cast(len(w) as bigint) as n_words,
            cast(coalesce(n_hit, 0) as bigint) as n_hit,
            cast(coalesce(n_items, 0) as bigint) as n_items,
            sha256(coalesce(items, '')) as items_sha256,
            coalesce(n_hit, 0) > 0 as contaminated
        from d left join c using (doc_id) left join m using (doc_id)""",
    "op11_prefix_trie": f"""with o as (select conv_id, coalesce(text, '') as text,
            md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '')
                || coalesce(text, '')) as turn_digest,
            row_number() over (partition by conv_id order by turn nulls first, md5(
                octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '')
                || coalesce(text, ''))) as place
            from conversations where conv_id is not null),
        ids as (select conv_id, conv_id - conv_id % 20 as base,
            {_crc32("cast(conv_id as varchar)")} % 4 as h from (select distinct conv_id from o) i),
        rebuilt as (select ids.conv_id, 0 as kind, place, text, turn_digest
                from ids join o on o.conv_id = base where place <= h
            union all select o.conv_id, 1, place, text, turn_digest
                from o join ids using (conv_id) where place > h),
        placed as (select conv_id, row_number() over w as depth, text,
            md5(string_agg(turn_digest, '') over w) as k from rebuilt
            window w as (partition by conv_id order by kind, place)),
        members as (select conv_id, depth, k, len(regexp_extract_all(text,
                '[^\x20\x09-\x0D]+')) as n_words from placed
            union all select conv_id, 0, '', 0 from ids),
        linked as (select *, lag(k) over (partition by conv_id order by depth) as parent,
            depth = max(depth) over (partition by conv_id) as ended from members),
        nodes as (select k, min(conv_id) as conv_id, min(depth) as depth, min(parent) as parent,
            count(*) as n_convs, (count(*) - 1) * min(n_words) as saved,
            sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id)
                filter (ended), '')) as ends_sha256 from linked group by k),
        kids as (select parent as k, count(*) as n_children from nodes group by 1),
        whole as (select nodes.*, coalesce(n_children, 0) as n_children
            from nodes left join kids using (k)),
        sums as (select m.k, sum(saved) as saved_tokens,
            count(*) filter (n_children = 0) as n_leaves
            from whole w join members m on m.conv_id = w.conv_id and m.depth <= w.depth group by 1)
        select w.conv_id, cast(w.depth as bigint) as depth, p.conv_id as parent_conv_id, w.n_convs,
            w.n_children, n_leaves, cast(saved_tokens as bigint) as saved_tokens, w.ends_sha256
        from whole w join sums using (k) left join whole p on p.k = w.parent""",
    "op13_manifest": _manifest_sql(4),
    "op7_line_dedup": """with l as (select doc_id, string_split(text, chr(10)) as l
            from documents),
        w as (select doc_id, i, array_to_string(l[i:i + 2], chr(10)) as win
            from l, unnest(range(1, len(l) - 1)) t(i)),
        later as (select doc_id, i from w
            qualify row_number() over (partition by win order by doc_id, i) > 1),
        gone as (select distinct doc_id, p from later, unnest(range(i, i + 3)) t(p)),
        lines as (select doc_id, p, l[p] as line from l, unnest(range(1, len(l) + 1)) t(p)),
        kept as (select doc_id, string_agg(line, chr(10) order by p) as kept
            from lines anti join gone using (doc_id, p) group by 1),
        n as (select doc_id, count(*) as n_removed from gone group by 1)
        select doc_id, cast(len(l) as bigint) as n_lines,
            cast(coalesce(n_removed, 0) as bigint) as n_removed,
            sha256(coalesce(kept, '')) as kept_sha256
        from l left join kept using (doc_id) left join n using (doc_id)""",
}
