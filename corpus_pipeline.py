"""Corpus pipeline: quality, line dedup, near-duplicate classes, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of ``documents``; ``n_chars`` follows the text where a stage cuts it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import jaccard_join, line_dedup, packing, quality, substring_dedup
from strata.llm.catalog import QUALITY_THRESHOLD, quality_model, tokenizer_file
from strata.llm.common import checkpoint_dir, ship_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: SQL cannot train a classifier or run the content-defined cuts; the stages are tested against brute force.
ORACLE_SQL = None


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, with n_chars of the text as it is now."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts are scored like others (by the constant feature); repeated rows and null ids each for themselves; a
    very long text whole; an empty table gives an empty one.  Columns other than those of ``documents`` are dropped.
    """
    scored = quality.with_quality(docs, quality_model(spark, sf_dir), score_col="__score")
    return scored.where(F.col("__score") >= QUALITY_THRESHOLD).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines, and the lines that continue them, go; so does a document of which nothing is left by that.

    Null, empty and white-space-only texts lose nothing and stay; rows equal in id and text are one document and are treated
    alike; a null id is smallest; very long texts are read whole; an empty table gives an empty one.
    """
    cut = line_dedup.line_dedup(docs, removed_col="__removed")
    return _documents(cut.where((F.col("__removed") == 0) | (F.trim("text") != "")))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class stays (five words, similarity 0.8): that with the smallest id that is not null.

    Of rows of one class with that id, that with the smallest text hash stays, and one of equal rows.  A null id stays only
    in a class without other ids.  Texts without words are not alike, but rows equal in id and such text are one document.
    """
    return jaccard_join.one_of_each(docs, k=5, percent=80).select(*COLUMNS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside passages of 20 words that stand earlier in the corpus go; so does a document of which nothing is left by that.

    A text that loses nothing stays as it is, line breaks included, also a null or empty one.  Rows equal in id and text are
    one document; a null id is smallest; an empty table gives an empty one.
    """
    cut = substring_dedup.substring_dedup(docs.withColumn("__whole", F.col("text")), width=20, words_col="__words", removed_col="__removed")
    text = F.when(F.col("__removed") > 0, F.col("text")).otherwise(F.col("__whole"))
    return _documents(cut.withColumn("text", text).where((F.col("__removed") == 0) | (F.col("__removed") < F.col("__words"))))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences.

    A null or empty text is one piece, its end token; repeated rows are packed each; a null id is kept as null; a very long text
    goes over as many sequences as it needs; an empty table gives no pieces.
    """
    # workers live on through the stages, so this one keeps fewer words in them
    pieces = packing.pack(docs, tokenizer_file("word_bpe_49k.json"), size=4096, end_id=2, cache_words=250_000)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_duplicates", near_stage),
          ("substring_dedup", substring_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over ``documents``; each one's result is a Parquet table in the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    ship_package(spark)
    base = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4()}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
