"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, PII, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor
kept. All but the last return the columns of ``docs``, whatever further columns there are.

Defined cases, stage by stage: a null or empty text is scored like any other (quality), has
no lines and stays as it is (lines), has fingerprint zero, so one of all such documents stays
(simhash), holds no personal data (pii) and is its end id alone (packing). A null id ranks
before all others in line dedup and loses to any id in a group of near duplicates; packing
carries it. Rows that repeat another's id and text lose their lines, and then go as near
duplicates of the emptied texts or of each other. Ties: equal lines go from the second on, and
the smallest id of a group stays. Texts of any length are worked on whole. An empty table
gives an empty result with the same columns; without labelled rows of both kinds the
classifier is as ``quality.fit`` states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import lines, packing, pii, quality, simhash
from colloquy.llm.common import read, small_batches, stage


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects; it learns from rows not held out."""
    small_batches(spark)
    model, _ = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every line that an earlier line matches (Jaccard similarity of words 0.8 or more)."""
    small_batches(spark)
    return _counted(lines.dedup_lines(docs))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by fingerprints at most 4 bits apart (4-word shingles)."""
    small_batches(spark)
    return simhash.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by keyed pseudonyms of the same format."""
    return _counted(pii.pseudonymise(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents along a Hilbert curve: one row per piece of a sequence."""
    small_batches(spark)
    return packing.pack(docs, packing.vocabulary).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality", quality_stage),
    ("lines", lines_stage),
    ("simhash", simhash_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: None: neither the classifier, the fingerprints nor the tokenizer can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
