"""The corpus pipeline: language ID, near duplicates, decontamination, mixing, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return
the columns of the documents.  :func:`run` writes what a stage returns as Parquet in the
folder that all executors share, and the next stage reads that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scourline.llm import language, mixing
from scourline.llm.decontaminate import drop_contaminated
from scourline.llm.entries import MIX, MIX_BUDGET, SHARDS
from scourline.llm.ngram_join import drop_near_duplicates
from scourline.llm.sharding import assign_shards
from scourline.llm.work import ship_package, stored, table

MIN_CONFIDENCE = 0.5
#: Not expressible in SQL: languages, near duplicates and raking are fitted to the data.
ORACLE_SQL = None


def _whole(docs: DataFrame):
    """A row of ``docs`` as one column, which no other name can clash with."""
    return F.struct(*[docs[c] for c in docs.columns]).alias("_doc")


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those in none (noise, no text) or in doubt go.

    The declared language of a document is its ``lang``, its host is its ``source``.
    """
    ship_package(spark)
    trigrams = language.learn_trigrams(docs)
    rows = docs.select(
        _whole(docs), F.col("text"), F.col("lang").alias("declared"),
        F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"),
    )
    found = language.identify(rows, trigrams)
    sure = F.col("confidence") >= MIN_CONFIDENCE
    return found.where(sure & (F.col("language") != language.UNKNOWN)).select("_doc.*")


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    ship_package(spark)
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn towards the target shares of sources, languages and topics."""
    tokens = mixing.n_tokens(F.col("text"))
    rows = docs.select(_whole(docs), "doc_id", "source", "lang", tokens.alias("tokens"))
    rows = rows.withColumn("topic", mixing.topic_of(F.col("tokens")))
    return mixing.mix(rows, MIX, MIX_BUDGET).where("kept").select("_doc.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A shard and a place in it for each document."""
    return assign_shards(docs, SHARDS)


STAGES = [
    ("language_id", identify_languages),
    ("ngram_jaccard_join", join_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
