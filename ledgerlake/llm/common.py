"""Shared tables and small helpers of the text operators."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ledgerlake.session import ensure_checkpoint_dir

NO_ID = -(2**63)  # stands for a null id inside joins


class Workspace:
    """Derived tables of one run, in the shared folder of ``spark.checkpoint.dir``.

    A kept table survives the loss of executors and cuts the lineage. ``drop`` removes tables that no
    later step reads; what the result itself still reads stays in the checkpoint folder.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        ensure_checkpoint_dir(spark)
        self.folder = f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"
        self.swept = time.monotonic()

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if time.monotonic() - self.swept > 5:
            gc.collect()  # plans of earlier steps hold on to their shuffle files
            self.spark.sparkContext._jvm.System.gc()
            self.swept = time.monotonic()
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def doc_keys(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Two join columns that tell any two rows with different content apart and are never null.

    Repeated rows (same id, same text) share them, and every result derived from the text is the same
    for such rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(text, F.length(text)).alias("_h"),
    ]


def own_columns(columns: list[str]) -> Column:
    """The caller's columns as one column ``_own``, so that no name of theirs meets one of an operator's steps."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_own")


def with_own(rows: DataFrame, columns: list[str], *added: str | Column) -> DataFrame:
    """The columns of ``_own`` side by side, then the added ones."""
    return rows.select(*[F.col("_own").getField(c).alias(c) for c in columns], *added)


def own_schema(docs: DataFrame, columns: list[str], added: str) -> StructType:
    """Schema of ``_own`` and the added fields, which are given as DDL."""
    return StructType([StructField("_own", StructType([docs.schema[c] for c in columns])), *StructType.fromDDL(added)])


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each; a longer row stands alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, min(end, rows)
        row = end


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (finaliser of a public 64-bit mixer)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values
