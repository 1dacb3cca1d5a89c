"""Token blocks: exact round trips and the given tokenizer."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scourline.llm import rans, tokens
from scourline.llm.rans import Block, Frequencies, encode_block
from scourline.llm.tokens import Encoder, tokens_round_trip

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("size", [0, 1, 5, rans.LANES, rans.LANES * rans.STRIDE * 3 + 17])
def test_block_round_trip(size):
    choose = np.random.default_rng(size)
    ids = np.minimum(choose.geometric(0.01, size), 3000).astype(np.uint32)
    table = Frequencies(np.bincount(ids, minlength=4000))
    block = Block(encode_block(ids, np.array([size]), table))
    assert (block.decode_all(table) == ids).all() and block.lengths.tolist() == [size]
    stretch = rans.STRIDE * rans.LANES
    assert len(block.marks) == -(-size // stretch)
    for mark in reversed(range(len(block.marks))):  # in any order
        assert (block.decode(table, mark) == ids[mark * stretch :][:stretch]).all()
    if block.marks:
        word, crc, states = block.marks[-1]
        block.marks[-1] = (word, crc ^ 1, states)
        with pytest.raises(ValueError, match="checksum"):
            block.decode(table, len(block.marks) - 1)


def test_blocks_are_small_and_refuse_damage():
    choose = np.random.default_rng(1)
    ids = np.minimum(choose.geometric(0.05, 300_000), 3000).astype(np.uint32)
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    data = encode_block(ids, np.array([len(ids)]), Frequencies(counts))
    assert len(data) < 1.2 * len(ids) * -(share * np.log2(share)).sum() / 8
    with pytest.raises(ValueError):
        Block(data[:-1] + bytes([data[-1] ^ 1]))
    with pytest.raises(ValueError):
        encode_block(np.array([5000 - 1], np.uint32), np.array([1]), Frequencies(np.ones(5000) * (np.arange(5000) < 9)))


def test_pieces_give_the_ids_of_whole_texts():
    parts = ["a", "B", "é", "É", "ß", "Σ", "ς", "'s", "'", "’", "<|", "|>", "<|endoftext|>", "1",
             "٣", "½", ".", ",", "!!", " ", "\n", " ", "J̌", "̈", "中", "😀", "\x1c", "\x85",
             "İ", "ǅ", "ﬁ", "×", "÷", "-", "_", "'RE", " "]
    choose = random.Random(1)
    texts = ["".join(choose.choice(parts) for _ in range(choose.randint(0, 14))) for _ in range(3000)]
    whole = Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)
    mine = Encoder(VOCABULARY).encode([t.encode() for t in texts], 2)
    assert [list(m) for m in mine] == [w.ids + [2] for w in whole]


def test_old_pieces_pass_and_stay_right(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_PIECES", 20)
    encoder, whole = Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    for k in range(30):
        text = " ".join(f"word{(k * 7 + i * i) % 90}" for i in range(12))
        (got,) = encoder.encode([text.encode()], 2)
        assert got.tolist() == whole.encode(text, add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_vocabularies_that_do_not_cut_at_blanks(name):
    path = public_tokenizers.path(name)
    encoder, whole = Encoder(path), Tokenizer.from_file(path)
    assert (encoder.known is None) == (name != "word_bpe_49k.json")
    texts = ["Some Words,  in CAPITALS.\n", "", "x" * 40_000, "A very long text, " * 20_000]
    got = encoder.encode([t.encode() for t in texts] + [None], 2)
    assert [g.tolist() for g in got] == [whole.encode(t, add_special_tokens=False).ids + [2] for t in [*texts, ""]]


def test_round_trip_of_a_table(spark, monkeypatch):
    monkeypatch.setattr(tokens, "PART_BYTES", 2000)
    monkeypatch.setattr(tokens, "BLOCK_IDS", 300)
    texts = [None, "", "Same text.", "Same text.", "<|endoftext|> İ"] + [f"Word {i} of many, " * (i % 40) for i in range(90)]
    rows = [(None, "no id")] + [(1000 - i * 3, t) for i, t in enumerate(texts)] + [(1000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumn("ids", F.lit("clash")).withColumn("part", F.lit(3))
    got = sorted(tokens_round_trip(df, VOCABULARY, 2).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    whole = Tokenizer.from_file(VOCABULARY)
    want = sorted(whole.encode(t or "", add_special_tokens=False).ids + [2] for _, t in rows)
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in got) == want
    sizes = [len(r.ids) // 4 for r in got]
    assert [r.start for r in got] == [sum(sizes[:i]) for i in range(len(got))]
    assert tokens_round_trip(df.limit(0), VOCABULARY, 2).count() == 0
