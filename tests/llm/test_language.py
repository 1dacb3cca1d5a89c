"""Language ID: held-out accuracy, and what each kind of evidence does."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from scourline.llm import language as lang

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TEXTS = {
    "en": "the quick brown fox and the lazy dog were with them in the house of the king",
    "de": "der schnelle braune Fuchs und der faule Hund waren bei ihnen im Haus des Königs",
    "es": "el rápido zorro marrón y el perro perezoso estaban con ellos en la casa del rey",
    "fr": "le rapide renard brun et le chien paresseux étaient avec eux dans la maison du roi",
}


@pytest.fixture(scope="module")
def trigrams(spark):
    rows = [(i, k, f"{t} " * 200) for i, (k, t) in enumerate(TEXTS.items())] + [(9, "xx", "zzz"), (None, "en", "a"), (10, None, "b"), (11, "en", None)]
    return lang.learn_trigrams(spark.createDataFrame(rows, "doc_id long, lang string, text string"))


SCHEMA = "id int, text string, declared string, suffix string, host string"


def told(spark, trigrams, rows, markup=False):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.id: (r.language, r.confidence, r.by_text) for r in lang.identify(df, trigrams, markup=markup).collect()}


def test_texts_and_odd_rows(spark, trigrams):
    rows = [(i, t, None, None, None) for i, t in enumerate(TEXTS.values())]
    rows += [(10, None, None, None, None), (11, "", "en", "com", "h"), (12, "§§ 0x9f @@ #{}~ qqq zzx", None, None, "h"),
             (13, "the house of the dog " * 20000, None, "com", None), (13, "the house", None, None, "h")]
    got = told(spark, trigrams, rows)
    assert [got[i][0] for i in range(4)] == ["en", "de", "es", "fr"]
    assert [got[i][0] for i in (10, 11, 12)] == ["und", "und", "und"]
    assert got[13][0] == "en"
    empty = spark.createDataFrame([], SCHEMA)
    assert lang.identify(empty, trigrams).count() == 0


def test_evidence_decides_doubtful_texts(spark, trigrams):
    sure = [(i, TEXTS["fr"], "fr", "org", "f.org") for i in range(30)]
    sure += [(100 + i, TEXTS["de"], "de", "org", "d.org") for i in range(30)]
    doubt = "en"  # a word of several languages
    rows = sure + [(200, doubt, None, "org", "f.org"), (201, doubt, "de", "org", "d.org")]
    got = told(spark, trigrams, rows)
    alone = told(spark, trigrams, [(1, doubt, None, None, None)])[1]
    assert got[200][1] != alone[1]
    assert got[201][0] == "de" or got[201][1] < alone[1]


def test_markup_and_addresses(spark, trigrams):
    html = '<!-- der --><HTML class=x lang="fr-CA"><script>var der = "der die das";</script>' + TEXTS["en"]
    assert told(spark, trigrams, [(1, html, "fr", None, None)], markup=True)[1][2] == "en"
    cases = [
        ("https://User@WWW.Example.co.uk:80/a?b", html), ("no address", "<p lang='de'>"), (None, None),
    ]
    host = lang.host_of(F.col("url"))
    df = spark.createDataFrame(cases, "url string, html string")
    got = df.select(host, lang.suffix_of(host), lang.declared_in(F.col("html"))).collect()
    assert list(map(tuple, got)) == [("www.example.co.uk", "uk", "fr"), (None, None, None), (None, None, None)]


def test_held_out_accuracy(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) > 200")
    trigrams = lang.learn_trigrams(docs.where("doc_id % 2 = 0"))
    rest = docs.where("doc_id % 2 = 1").select(
        "text", "lang", *[F.lit(None).cast("string").alias(c) for c in ("declared", "suffix", "host")]
    )
    got = lang.identify(rest, trigrams).agg(F.avg((F.col("language") == F.col("lang")).cast("int"))).first()[0]
    assert got > 0.95


def test_likelihoods_are_shares(trigrams):
    assert np.allclose(np.exp(trigrams.astype(float)).sum(axis=0), 1, atol=1e-3)
