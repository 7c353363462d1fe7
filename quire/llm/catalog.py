"""The registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``.

Each applies its operator, with production parameters, to the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import audit, centroids, exact_topk, jaccard, lsh, packing, passages, pieces, pii, polytope, quality, secrets, toxicity
from quire.llm.common import table


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every 20th vector."""
    return exact_topk.topk(table(spark, sf_dir, "embeddings"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every document."""
    return jaccard.link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts, digest of the base spans, all spans."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op6_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, log_ratio, sample_key, kept)`` of every document."""
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of 200 bytes that repeat."""
    return passages.digest(passages.without_repeats(table(spark, sf_dir, "documents")))


def op8_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N best segmentations of every document: scores, sizes, digests and the ids themselves."""
    return pieces.encode(table(spark, sf_dir, "documents"), with_ids=True).drop("ids")


def op9_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts, digest of the base spans, all spans."""
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


def op10_multiprobe_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every 20th vector."""
    return lsh.nearest(table(spark, sf_dir, "embeddings"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a cosine of 0.9 or more: their number and the component of every vector."""
    return polytope.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and exact squared distance of every vector, with the sums and centroid digests."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters keep, remove and share, by language, for all 120 orders."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_exact_topk": op1_exact_topk,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_toxicity": op3_toxicity,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_secret_scans": op5_secret_scans,
    "op6_quality_resampling": op6_quality_resampling,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_sentencepiece_nbest": op8_sentencepiece_nbest,
    "op9_pii_weak_supervision": op9_pii_weak_supervision,
    "op10_multiprobe_lsh": op10_multiprobe_lsh,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_filter_audit": op13_filter_audit,
}

#: The others have no SQL form; tests/llm holds brute-force versions.
ORACLE_SQL: dict[str, str] = {
    "op1_exact_topk": exact_topk.SQL,
    "op2_ngram_jaccard": jaccard.oracle(),
    "op11_embedding_dedup": polytope.SQL,
    "op12_centroid_clustering": centroids.oracle(),
    "op13_filter_audit": audit.SQL,
}
