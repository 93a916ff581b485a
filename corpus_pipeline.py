"""The training-data pipeline over ``documents``: language, near duplicates, decontamination, mixing, token files.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.llm import decontaminate, jaccard, langid, mixing, token_files
from eventmart.llm.common import ship, small, staged, table
from eventmart.llm.queries import END_ID, TOKENIZER

#: Share of a text that its language has to have.
LEAST_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts with a predicted language that makes up half of them; without letters, or null, they go.

    The model is learned from the labelled rows of ``docs`` that aren't held out.
    """
    ship(spark)
    langs, model = langid.learn(docs.filter(~langid.held_out() & F.col("doc_id").isNotNull()))
    rows = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("row"), "text")
    kept = langid.predict(rows, langs, model).filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near copies, once.

    Rows that repeat a doc_id are one document, of which the text with the smallest hash stays.
    Rows without doc_id, and texts without words, are in no group and stay.
    """
    classes = staged(jaccard.jaccard_classes(docs).filter("doc_id is not null").select("doc_id", "component_id"), "classes")
    copies = classes.filter("doc_id <> component_id").select(F.col("doc_id").alias("_copy")).distinct()
    kept = docs.join(small(staged(copies, "copies")), F.col("doc_id") == F.col("_copy"), "left_anti")
    repeated = staged(classes.groupBy(F.col("doc_id").alias("_again")).count().filter("count > 1").select("_again"), "repeated")
    if repeated.isEmpty():
        return kept
    again = small(repeated)
    once = kept.join(again, F.col("doc_id") == F.col("_again"), "left_anti")
    rows = kept.join(again, F.col("doc_id") == F.col("_again"), "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    rows = rows.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("row"), first.alias("nth")).filter("nth = 1")
    return once.unionByName(rows.select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts that hold a copy of a test item, exact or edited."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    found = found.select(F.struct("doc_id", "text_hash").alias("_found")).distinct()
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    return docs.join(small(staged(found, "contaminated")), own.eqNullSafe(F.col("_found")), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bit-packed token files of all texts; what is returned is read back from them."""
    return token_files.token_files(docs, TOKENIZER, END_ID)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]

#: No stage but the mix can be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
