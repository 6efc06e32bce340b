"""Session defaults the library relies on."""

from __future__ import annotations

import gc
import tempfile
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Semantics: results depend on these.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}
# HotSpot does not compile methods above 8000 bytes of bytecode. Wide fact-table stages exceed that
# when fused into one method and then run interpreted, three times slower than unfused.
RECOMMENDED_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "ledgerlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the required settings; a cluster's own settings are left as they are."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_conf(spark: SparkSession) -> None:
    """The same settings on a session somebody else built."""
    for key, value in {**REQUIRED_CONF, **RECOMMENDED_CONF}.items():
        spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own; a cluster without
    one is an error, since a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    context.setCheckpointDir(folder)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for as long as the block lasts."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


_released = 0.0


def release_shuffles(spark: SparkSession, seconds: float = 5) -> None:
    """Have the shuffle files of finished steps deleted, at most every few seconds.

    Spark deletes them when their plans are collected as garbage, which a roomy driver puts off for half an hour.
    """
    global _released
    if time.monotonic() - _released > seconds:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _released = time.monotonic()


def local_table(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """A few driver rows as a table the optimizer can see into, with no job of its own to read it."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)

    def plain(value):
        return value.asDict() if isinstance(value, T.Row) else value

    arrow = pa.Table.from_pylist(
        [dict(zip(schema.names, map(plain, row))) for row in rows], schema=to_arrow_schema(schema)
    )
    return spark.createDataFrame(arrow, schema)


def settled(df: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """A small derived table, computed once and kept in the shared checkpoint folder.

    Its row count is then known, so it is broadcast exactly when that is safe; a longer one is
    left to an ordinary shuffle join. The files outlive a lost executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.checkpoint()
    return F.broadcast(kept) if kept.count() <= broadcast_rows else kept
