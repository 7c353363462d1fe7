"""Corpus pipeline: quality, near-duplicate, passage, privacy and packing stages.

Each stage takes ``(spark, docs, sf_dir)``, works on every row its predecessor
kept and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``;
``n_chars`` follows the text.

Defined results: null texts pass the first four stages as they are and are packed
as an end id; a document whose text is wholly cut away stays, with the empty
text; an empty table gives empty results; further columns pass to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import jaccard, packing, passages, pii, quality
from quire.llm.common import table
from quire.session import scratch_path

#: Near-duplicate documents: shingles of five words, a similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind)
    return docs.select(*[size.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the importance resampling rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each group of near duplicates stays."""
    return jaccard.keep_one(docs, SHINGLE, PERCENT)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: passages of 200 bytes that occur again are cut out."""
    return _counted(passages.strip(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: personal data is replaced by its kind."""
    return _counted(pii.redact(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the places of all pieces in sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: No stage has a SQL form; tests/llm/test_pipeline.py checks it by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each from its predecessor's table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
