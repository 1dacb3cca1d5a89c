"""Language identification by Bayesian fusion of evidence.

A text's likelihood under each language comes from character trigrams.  Three other kinds of
evidence are estimated from the data by grouped aggregation of the text posteriors: how
often pages of a language declare each language in their markup, and the prior of the
languages on a host, smoothed towards that of its address suffix, which is smoothed towards
that of all pages.  A page does not count to the priors that judge it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grams import grams
from .work import stored

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
SIZES, BITS = (3,), 16
SAMPLE = 800  # the most texts of a language that the trigrams are learned from
STEP_BITS = 12  # of the hash by which those are chosen
SMOOTH = 0.1
OVERLAP = 6.0  # a trigram shares most of its letters with its neighbours
HOST_WEIGHT, SUFFIX_WEIGHT, DECLARED_WEIGHT = 5.0, 20.0, 1.0
FLOOR = 1e-3

_HIDDEN = re.compile(rb"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>|&[a-z0-9#]+;")


def visible_text(html: bytes | None) -> bytes:
    """What a page shows: without tags, comments, scripts and styles."""
    return _HIDDEN.sub(b" ", html or b"")


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def declared_in(html: Column) -> Column:
    """The primary subtag of the ``lang`` of the root element; null if there is none."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]+)", 1))
    return F.when(found != "", found)


def learn_trigrams(labelled: DataFrame, languages: Sequence[str] = LANGUAGES) -> np.ndarray:
    """Log likelihoods: one row per bucket, one column per language and one for none.

    ``labelled`` has ``doc_id``, ``lang`` and ``text``.  Of each language at most ``SAMPLE``
    texts are read, the first by a hash of their id; so the counts that reach the driver are
    bounded too.  Without texts of a language it has the likelihood of noise.
    """
    ids = labelled.select("doc_id", "lang").where(F.col("lang").isin(list(languages)))
    picked = ids.where("doc_id is not null").distinct().withColumn("luck", F.xxhash64("doc_id"))
    picked = picked.withColumn("step", F.shiftright("luck", 64 - STEP_BITS))
    # The steps of the hash are counted, and only those up to the last id wanted are sorted.
    rising = Window.partitionBy("lang").orderBy("step")
    steps = picked.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n"))
    steps = steps.withColumn("before", F.sum("n").over(rising) - F.col("n")).where(F.col("before") < SAMPLE)
    last = {r["lang"]: r["step"] for r in steps.groupBy("lang").agg(F.max("step").alias("step")).collect()}
    wanted = F.lit(False)
    for lang, step in last.items():
        wanted = F.when(F.col("lang") == lang, F.col("step") <= step).otherwise(wanted)
    order = Window.partitionBy("lang").orderBy("luck", "doc_id")
    picked = picked.where(wanted).withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE)
    picked = stored(picked.select("doc_id", "lang"), "labelled")
    texts = labelled.select("doc_id", "lang", "text").join(F.broadcast(picked), ["doc_id", "lang"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), 1 << BITS), np.int64)
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                bucket, _ = grams([text], SIZES, BITS)
                total[languages.index(lang)] += np.bincount(bucket, minlength=1 << BITS)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"lang": lang.astype(np.int32), "bucket": bucket.astype(np.int32), "n": total[lang, bucket]}
        )

    counted = texts.mapInArrow(count, "lang int, bucket int, n long")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.full((1 << BITS, len(languages) + 1), SMOOTH)
    total[rows["bucket"].to_numpy(), rows["lang"].to_numpy()] += rows["n"].to_numpy()
    return np.log(total / total.sum(axis=0)).astype(np.float32)


def _shares(logs: np.ndarray) -> np.ndarray:
    """Rows of log weights as shares."""
    odds = np.exp(logs - logs.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def _scored(rows: DataFrame, keep: list[str], table: np.ndarray, markup: bool) -> DataFrame:
    """Columns of rows with ``text``, tempered log ``_likelihood`` and the shares ``_text``."""

    def arrays(values: np.ndarray) -> pa.Array:
        ends = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(values.ravel(), pa.float64()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                piece = batch.slice(low, 128)
                texts = piece["text"].cast(pa.binary()).to_pylist()
                if markup:
                    texts = [visible_text(t) for t in texts]
                bucket, owner = grams(texts, SIZES, BITS)
                sums = [np.bincount(owner, row[bucket], len(texts)) for row in table.T]
                logs = np.stack(sums, axis=1) / OVERLAP
                yield pa.RecordBatch.from_arrays(
                    [*[piece[c] for c in keep], arrays(logs), arrays(_shares(logs))],
                    names=[*keep, "_likelihood", "_text"],
                )

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    schema += ", `_likelihood` array<double>, `_text` array<double>"
    return rows.select(*dict.fromkeys(["text", *keep])).mapInArrow(score, schema)


def _fused(names: list[str], prior: np.ndarray, known: np.ndarray):
    """Decides rows from their likelihoods and the counts of their groups."""

    @F.pandas_udf("language string, confidence double, by_text string")
    def fuse(likelihood: pd.Series, suffix: pd.Series, host: pd.Series, declared: pd.Series) -> pd.DataFrame:
        logs = np.stack(likelihood.to_list())
        own = _shares(logs)

        def others(counts: pd.Series) -> np.ndarray:
            """Counts of a group without the row itself; none for rows without a group."""
            full = [o if c is None else c for c, o in zip(counts, own)]
            return np.maximum(np.stack(full) - own, 0.0)

        def drawn(counts: np.ndarray, towards: np.ndarray, weight: float) -> np.ndarray:
            return (counts + weight * towards) / (counts.sum(axis=1, keepdims=True) + weight)

        by_host = drawn(others(host), drawn(others(suffix), prior, SUFFIX_WEIGHT), HOST_WEIGHT)
        said = np.log((others(declared) + DECLARED_WEIGHT) / known)
        said[declared.isna().to_numpy()] = 0.0
        every = _shares(logs + np.log(np.maximum(by_host, FLOOR)) + said)
        silent = ~logs.any(axis=1)

        def best(shares: np.ndarray) -> np.ndarray:
            return np.where(silent, UNKNOWN, np.array(names)[shares.argmax(axis=1)])

        return pd.DataFrame({"language": best(every), "confidence": every.max(axis=1), "by_text": best(own)})

    return fuse.asNondeterministic()  # or a filter would have it run twice


def identify(
    rows: DataFrame, table: np.ndarray, languages: Sequence[str] = LANGUAGES, markup: bool = False
) -> DataFrame:
    """``rows`` with ``language``, ``confidence`` and ``by_text`` (of the text alone).

    ``rows`` has ``text`` (markup if ``markup``) and the evidence ``declared``, ``suffix``
    and ``host``; further columns are kept, but those that bear one of the three new names
    are replaced, and names that begin with ``_`` are this function's own.

    The language is ``und`` where noise explains the text better than any language, or
    where it has no trigrams at all (null, empty, blank).  Null evidence says nothing:
    rows without host go by their suffix, rows without either by all rows.  Repeated rows
    each count.  An empty table gives an empty one.
    """
    names = [*languages, UNKNOWN]
    rows = rows.drop("language", "confidence", "by_text")
    scored = _scored(rows, rows.columns, table, markup)
    light = _scored(rows, ["suffix", "host", "declared"], table, markup)
    soft = [F.element_at("_text", k + 1).alias(f"_p{k}") for k in range(len(names))]
    sums = [F.sum(f"_p{k}").alias(f"_s{k}") for k in range(len(names))]
    base = light.select("suffix", "host", "declared", *soft)
    base = stored(base.groupBy("suffix", "host", "declared").agg(*sums), "evidence")

    def grouped(*by: str) -> DataFrame:
        again = base.groupBy(*by).agg(*[F.sum(f"_s{k}").alias(f"_s{k}") for k in range(len(names))])
        return again.select(*[F.col(b).alias(f"_{b}") for b in by], F.array(*[f"_s{k}" for k in range(len(names))]).alias("_".join(["", *by, "n"])))

    whole = base.agg(*[F.coalesce(F.sum(f"_s{k}"), F.lit(0.0)) for k in range(len(names))]).first()
    hosts = stored(grouped("suffix", "host").where("_host is not null"), "hosts")
    suffixes = stored(grouped("suffix").where("_suffix is not null").withColumnRenamed("_suffix", "_only"), "suffixes")
    declared = stored(grouped("declared").where("_declared is not null"), "declared")
    kinds = declared.count()
    judged = (
        scored.join(suffixes, F.col("suffix") == F.col("_only"), "left")
        .join(hosts, (F.col("host") == F.col("_host")) & F.col("suffix").eqNullSafe(F.col("_suffix")), "left")
        .join(declared, F.col("declared") == F.col("_declared"), "left")
    )

    whole = np.array(whole, float)
    prior = (whole + 1) / (whole.sum() + len(names))
    fuse = _fused(names, prior, whole + DECLARED_WEIGHT * (kinds + 1))
    told = fuse("_likelihood", "_suffix_n", "_suffix_host_n", "_declared_n").alias("_told")
    kept = [F.col(f"`{c}`") for c in rows.columns]
    return judged.select(*kept, told).select(*kept, "_told.language", "_told.confidence", "_told.by_text")
