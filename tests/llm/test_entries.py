"""The registered queries against brute force on the smallest tables."""

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scourline.llm import entries
from tests.llm import test_ngram_join, test_sharding, test_substrings

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    return sorted(map(tuple, rows.collect()))


def test_vectors(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    unit = np.array([r.embedding for r in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    found = entries.op1_ann(spark, SF_DIR).collect()
    for query in ids[ids % 50 == 0]:
        score = unit @ unit[ids == query][0]
        score[ids == query] = -9
        best = np.lexsort((ids, -score))[:5]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == query)
        assert [m[1] for m in mine] == ids[best].tolist()
        assert np.allclose([m[2] for m in mine], score[best], atol=1e-12)


def test_substrings_removed(spark, docs):
    want = test_substrings.brute([t for _, t in docs], 35)
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for (d, _), (n, k, t) in zip(docs, want)}
    got = {r.doc_id: tuple(r)[1:] for r in entries.op2_substring_dedup(spark, SF_DIR).collect()}
    assert got == want


def test_shards(spark, docs):
    test_sharding.check(docs, entries.op4_sharding(spark, SF_DIR).collect(), 40)


def test_languages_of_pages(spark):
    got = entries.op5_language_id(spark, SF_DIR).collect()
    assert len(got) == spark.read.parquet(f"{SF_DIR}/pages.parquet").count()
    right = [r.language == r.declared for r in got if r.declared]
    assert np.mean(right) > 0.9


def test_near_duplicates(spark, docs):
    got = entries.op6_ngram_join(spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in got) == test_ngram_join.brute(docs)


def test_token_files(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for doc, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, entries.op8_tokens(spark, SF_DIR).collect())) == want


def test_token_counts(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc, text in docs:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        want.append((doc, len((text or "").encode()), n, n > 1024))
    assert sorted(map(tuple, entries.op12_token_counts(spark, SF_DIR).collect())) == want


def test_toxic_documents(spark, docs):
    got = {r.doc_id: r for r in entries.op9_toxicity(spark, SF_DIR).collect()}
    assert set(got) == {d for d, _ in docs}
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_toxic_held_out(spark):
    larger = "/root/testdata/sf0.1"
    if not os.path.isdir(larger):
        pytest.skip("no larger tables")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    got = entries.op9_toxicity(spark, larger).where("held_out").collect()
    scores = [(r.score, labels[r.doc_id]) for r in got if r.doc_id in labels]
    ones, zeros = ([s for s, t in scores if t == k] for k in (1, 0))
    above = np.mean([a > b for a in ones for b in zeros])
    assert above > 0.85
    assert np.mean([(s >= 0.5) == t for s, t in scores]) > 0.92


def test_mix(spark, docs):
    got = entries.op10_mixing(spark, SF_DIR).collect()
    assert len(got) == len(docs)
    total = sum(r.tokens for r in got)
    assert sum(r.tokens * r.probability for r in got) == pytest.approx(entries.MIX_BUDGET * total)
    fitted = {}
    for r in got:
        fitted[r.lang] = fitted.get(r.lang, 0) + r.tokens * r.weight / total
    size = {}
    for r in got:
        size[r.lang] = size.get(r.lang, 0) + r.tokens
    shares = {k: v ** entries.MIX["lang"] for k, v in size.items()}
    whole = sum(shares.values())
    assert fitted == pytest.approx({k: v / whole for k, v in shares.items()}, abs=1e-4)
