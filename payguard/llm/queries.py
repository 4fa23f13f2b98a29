"""The registered queries of the corpus operators, with their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from payguard.llm import ann, bpe, centroids, decontaminate, html, langid, licenses, mixing, quality, resample, secrets, simhash, toxicity
from payguard.llm.common import table

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, judged by how many sources and documents hold them."""
    return secrets.scan(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and expressions in every document."""
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus mixed to the square roots of the sources' sizes."""
    return mixing.mix(table(spark, sf_dir, "documents", *DOCUMENTS))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    return toxicity.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every 20th vector."""
    return ann.neighbours(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return langid.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return quality.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a test item, with the item and the overlaps."""
    return decontaminate.find(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after three rounds, with distances and the centroid's hash."""
    return centroids.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark's texts, and its rank if it is drawn."""
    return resample.resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids and the bytes they decode to, as hashes."""
    import public_tokenizers
    return bpe.digest(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {q.__name__: q for q in (
    op1_secret_scan, op2_html_text, op3_license_scan, op4_simhash_near_dedup, op5_poisson_mix, op6_toxicity, op7_ann,
    op8_language_id, op9_quality, op10_decontamination, op11_centroid_clustering, op12_importance_resampling, op13_byte_bpe)}
#: Which results DuckDB can state; the others are tested against brute force in tests/llm.
ORACLE = {"op1_secret_scan": secrets.SQL, "op5_poisson_mix": mixing.SQL, "op11_centroid_clustering": centroids.SQL,
          "op12_importance_resampling": resample.SQL}
