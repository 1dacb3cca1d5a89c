"""The pipeline, its stages and the registered queries on small tables."""

import os

import pytest

import corpus_pipeline
from check_oracle import compare, oracle_connection
from scourline.llm import entries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages_narrow_down(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = entries.stored(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    assert corpus_pipeline.run(spark, SF_DIR).count() == before


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, kept string, tokens string"
    text = "the house of the king and the dog were with them in the end"
    rows = [(1, text, "en", "s", 9, 1, "k", "t"), (1, text, "en", "s", 9, 1, "k", "t"),
            (None, None, None, None, None, None, None, None), (2, "", "en", None, 0, 2, None, None)]
    docs = spark.createDataFrame(rows, schema)
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SF_DIR)
            assert out.columns == docs.columns and out.count() <= table.count()
        assert corpus_pipeline.STAGES[-1][1](spark, table, SF_DIR).count() == table.count()


@pytest.mark.parametrize("name", entries.QUERIES)
def test_query(spark, name):
    if name in entries.ORACLES:
        assert compare(spark, oracle_connection(SF_DIR), SF_DIR, name) is None
    else:
        assert entries.QUERIES[name](spark, SF_DIR).count() > 0
