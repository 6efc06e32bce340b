"""One query per operator over its whole driver table, and its SQL twin where SQL can express it."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.llm import (
    ann, bpe, html_text, jaccard_join, language, minhash, oracle, packing, quality, substring_dedup, suffix_dedup, token_alignment, url_graph,
    vector_codes,
)

# Rows per Arrow batch: long texts make rows large, and a batch is held in memory as a whole.
BATCH_ROWS = "1000"

URL_RULES = (
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"),
)

END_OF_TEXT = (("<|endoftext|>", 50256),)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 2048 tokens."""
    pieces = packing.cut_pieces(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, capacity=2048, end_id=0, special=END_OF_TEXT)
    return packing.pack(pieces, capacity=2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles agree to 85 percent."""
    return jaccard_join.components(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from four fifths of the labels."""
    docs = _table(spark, sf_dir, "documents")
    model = language.LanguageModel.fit(docs, language.learnable())
    told = language.identify(docs.select("doc_id", "text"), model)
    return told.select("doc_id", F.coalesce(~language.learnable(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of 35-word windows that occur again."""
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), window=35, digest=True)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 200-byte strings that occur again."""
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), window=200, digest=True)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_texts(pages)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of every document and the verdict of the classifier."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs.select("doc_id", "text"), model).drop("text")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL, by rules or else by the link graph."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_graph.judge(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", F.round("trust", 9).alias("trust"), F.round("distrust", 9).alias("distrust"))


def _token_digest(path: str):
    def fold(batch: pa.RecordBatch, packed: list[bytes]) -> pa.RecordBatch:
        table = bpe.load_table(path)
        count, ids_sha, raw_sha = [], [], []
        for ids in packed:
            count.append(len(ids) // 4)
            listed = np.frombuffer(ids, "<u4").tolist()
            ids_sha.append(hashlib.sha256(",".join(map(str, listed)).encode()).hexdigest())
            raw_sha.append(hashlib.sha256(bpe.decode_bytes(ids, table)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch["_key"], pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(raw_sha, pa.string())],
            ["_key", "n_tokens", "ids_sha256", "decoded_sha256"])

    return fold


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(
        _table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN,
        fold=_token_digest(path), fold_schema="n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents, by 3-word shingles that agree to 85 percent."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, eight hex pairs each, and what they lose."""
    return vector_codes.encode(_table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers, aligned, with corpus-wide counts of token pairs."""
    return token_alignment.align(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filters": op8_url_filters,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_neighbours": op10_neighbours,
    "op11_minhash": op11_minhash,
    "op12_vector_codes": op12_vector_codes,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op2_jaccard_join": oracle.components(words=4, percent=85),
    "op4_substring_dedup": oracle.repeated_words(window=35),
    "op5_suffix_dedup": oracle.repeated_bytes(window=200),
    "op11_minhash": oracle.components(words=3, percent=85, kept=True),
    "op12_vector_codes": vector_codes.oracle("embeddings"),
}
