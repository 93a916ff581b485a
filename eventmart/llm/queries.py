"""The registered queries: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventmart.llm import centroids, decontaminate, html_text, jaccard, langid, lexical, licenses, mixing, secrets, separators, token_files, urls, vectors
from eventmart.llm.common import table
from eventmart.llm.oracles import ORACLES  # noqa: F401  read by __spark_entry__

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
END_OF_TEXT = 50256


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), TOKENIZER, END_ID)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(table(spark, sf_dir, "documents")).drop("source", "text_hash")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).drop("score")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def embeddings_noisy_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over every vector of the table and three noisy copies of it, which have links."""
    return vectors.near_duplicates(vectors.noisy_copies(table(spark, sf_dir, "embeddings")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separators.token_counts(table(spark, sf_dir, "documents"), TOKENIZER, END_OF_TEXT)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of the embeddings, after ten rounds."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_html_text": op2_html_text,
    "op3_language": op3_language,
    "op4_decontamination": op4_decontamination,
    "op5_mixing": op5_mixing,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_url_filter": op7_url_filter,
    "op8_secrets": op8_secrets,
    "op9_embeddings": op9_embeddings,
    "embeddings_noisy_copies": embeddings_noisy_copies,
    "op10_token_counts": op10_token_counts,
    "op11_lexical_search": op11_lexical_search,
    "op12_license_scan": op12_license_scan,
    "op13_centroids": op13_centroids,
}
