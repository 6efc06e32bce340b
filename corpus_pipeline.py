"""From raw documents to packed training sequences, stage by stage.

Each stage reads what the one before wrote. All but the last return the columns of ``documents``; the last
returns the pieces of the packed sequences. ``ORACLE_SQL`` is None, as SQL cannot express the trained
stages; the tests hold each stage against a brute-force version.

Rows alike in id and text are repeated rows. Stages that remove rows judge each row by its text; near
duplicates keep one of the repeated rows, the other stages all that they keep. Columns beside those of
``documents`` are carried along; one named like a column that an operator adds comes back replaced. A table without rows gives none at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.llm import jaccard_join, language, packing, quality, suffix_dedup
from ledgerlake.llm.common import Workspace
from ledgerlake.llm.queries import BATCH_ROWS, END_OF_TEXT

# A document whose largest language holds less than this share of its words is no document of a language.
LANGUAGE_SHARE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; the rest goes, null texts and those without a letter too."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    model = language.LanguageModel.fit(docs, language.learnable())
    told = language.identify(docs, model)
    return told.where((F.col("lang_pred") != "und") & (F.col("score") >= LANGUAGE_SHARE)).select(docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counted rules and the classifier keep. Null and empty texts have no words and go."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, model).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest id (null ids last; then by the text's hash).

    Texts without words, null ones included, are near copies of nothing and stay. Unlike texts of one id both stay.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return jaccard_join.keep_one(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that occur more than once; a text of which nothing is left stays, empty.

    Null texts come back empty. ``n_chars`` is counted anew.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    left = suffix_dedup.remove_repeats(docs, window=200)
    return left.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of 2048 tokens; a null or empty text is one piece with the end token alone."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    pieces = packing.cut_pieces(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, capacity=2048, end_id=0,
        special=END_OF_TEXT)
    return packing.pack(pieces, capacity=2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("jaccard_join", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("packing", packed_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    space = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = space.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
