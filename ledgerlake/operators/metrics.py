"""Counters of a load, per account and in total."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def ingest_metrics(rows: DataFrame, file: str = "path") -> DataFrame:
    """Files and rows per (bank, account), per bank and overall (NULLs mark the totals)."""
    # Per file first: the distinct count then works on one row per file.
    per_file = rows.groupBy("bank", "account", file).agg(F.count("*").alias("n"))
    return per_file.rollup("bank", "account").agg(
        F.count("*").alias("n_files"), F.sum("n").alias("n_rows"),
    )
