"""Continuous loading with Structured Streaming; each run takes what is there and stops.

The checkpoint is the record of processed files. A batch that fails is run again; that is harmless,
because landing replaces a file's folder and bronze only takes keys it does not hold. Files that gave
nothing stay pending in the report until a retry loads them. No watermark
is needed: identity comes from the content, so late rows are just new rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.lakehouse import Lakehouse
from ..schemas import RAW_TXN
from ..session import local_table
from ..sources import tables
from ..sources.config import AccountConfig
from ..sources.raw import write_raw
from ..sources.statements import read_statements

_FILE_COLUMNS = "path string, modificationTime timestamp, length long, content binary"


def _literal_path(path: str) -> str:
    """A path whose brackets and the like are not taken for a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def _inbox(reader, inbox: str, **options: str) -> DataFrame:
    """The files of an inbox; their content is never read by this."""
    files = reader.format("binaryFile").schema(_FILE_COLUMNS).options(recursiveFileLookup="true", **options).load(inbox)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def _last_attempts(spark: SparkSession, report_table: str) -> DataFrame:
    """The latest attempt of each file; reports of earlier versions know of one only."""
    report = spark.table(report_table)
    for name, kind in (("attempt", "int"), ("length", "long"), ("modified", "timestamp")):
        if name not in report.columns:
            report = report.withColumn(name, F.lit(None).cast(kind))
    last = F.struct(F.coalesce("attempt", F.lit(1)).alias("attempt"), "status", "length", "modified")
    return report.groupBy("path").agg(F.max_by(last, last.attempt).alias("last")).select("path", "last.*")


def _untried(files: DataFrame, report_table: str) -> DataFrame:
    """Files that are not loaded as they are now, with the number of the attempt that is next."""
    spark = files.sparkSession
    if not tables.exists(spark, report_table):
        return files.withColumn("attempt", F.lit(1))
    spark.catalog.refreshTable(report_table)
    last = _last_attempts(spark, report_table).select("path", F.struct("*").alias("last"))
    changed = (F.col("length") != F.col("last.length")) | (F.col("modified") != F.col("last.modified"))
    return files.join(last, "path", "left").where(
        F.col("last").isNull() | (F.col("last.status") != "loaded") | F.coalesce(changed, F.lit(False))
    ).select("path", "length", "modified", (F.coalesce("last.attempt", F.lit(0)) + 1).alias("attempt"))


def pending_files(spark: SparkSession, report_table: str) -> DataFrame:
    """Files whose last attempt gave no rows: path, status, attempt."""
    return _last_attempts(spark, report_table).where("status <> 'loaded'").select("path", "status", "attempt")


def _attempt(session: SparkSession, files: DataFrame, configs: Sequence[AccountConfig], landing: str,
             report_table: str, batch_id: int | None) -> None:
    """Parse the files (path, length, modified, attempt) once, land their rows and note every file's outcome.

    The parsed rows are written beside the landed ones and removed once both results are taken from them.
    """
    listed = files.collect()  # at most one batch of files; the file source holds that list on the driver as well
    if not listed:
        return
    folder = f"{landing}/_parsed/{'retry' if batch_id is None else batch_id}"

    def keep(rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(folder)
        return session.read.schema(rows.schema).parquet(folder)

    found = read_statements(session, [_literal_path(r.path) for r in listed], configs, keep)
    write_raw(found.transactions, landing)
    known = local_table(session, [tuple(r) for r in listed], files.schema)
    report = found.files.join(F.broadcast(known), "path", "left").select(
        "path", "bank", "account", "status", "n_rows", F.lit(batch_id).cast("long").alias("batch_id"),
        "attempt", "length", "modified", F.current_timestamp().alias("tried_at"))
    tables.ensure_namespace(session, report_table)
    if tables.exists(session, report_table):
        tables.sync_schema(session, report_table, report.schema)
        # A repeated batch does not report twice.
        done = session.table(report_table).where(F.col("batch_id") == batch_id).select("path", "batch_id")
        tables.append(report.join(done, ["path", "batch_id"], "left_anti"), report_table)
    else:
        tables.rebuild(report, report_table)
    session.catalog.refreshTable(report_table)
    path = session.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ingest_statements(
    spark: SparkSession, inbox: str, configs: Sequence[AccountConfig], landing: str, report_table: str,
    checkpoint: str, archive: str | None = None, files_per_batch: int = 1000,
) -> StreamingQuery:
    """New statement files to landed JSON lines, once each.

    ``report_table`` gets one row per file and attempt, with its outcome, length and times. Files with a
    problem and files without a valid row are found there; ``retry_statements`` takes them up again.
    ``archive`` moves processed files away after a later batch.
    """
    options = {"maxFilesPerTrigger": str(files_per_batch)}
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}

    def land(batch: DataFrame, batch_id: int) -> None:
        _attempt(batch.sparkSession, _untried(batch, report_table), configs, landing, report_table, batch_id)

    return (
        _inbox(spark.readStream, inbox, **options).writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def retry_statements(
    spark: SparkSession, inbox: str, configs: Sequence[AccountConfig], landing: str, report_table: str, files_per_batch: int = 1000,
) -> None:
    """Read the files of the inbox that are not loaded as they are now: mended ones, or all under new settings.

    These are files whose last attempt gave no rows, files changed since, and files without a byte when the
    stream came by, which no scan shows it. Each is tried once per call and not at all once it is loaded, by
    the stream neither. A call that dies leaves its files pending; trying them again is harmless, as landing
    replaces a file's folder. Not to be run beside the stream.
    """
    after = ""
    while True:
        waiting = _untried(_inbox(spark.read, inbox), report_table)
        batch = waiting.where(F.col("path") > after).orderBy("path").limit(files_per_batch)
        batch = local_table(spark, [tuple(r) for r in batch.collect()], batch.schema)
        last = batch.agg(F.max("path")).first()[0]
        if last is None:
            return
        _attempt(spark, batch, configs, landing, report_table, None)
        after = last


def load_bronze_stream(lake: Lakehouse, table: str, landing: str, checkpoint: str, files_per_batch: int = 10_000) -> StreamingQuery:
    """Newly landed JSON lines of one account's folder into its bronze table."""
    rows = (
        lake.spark.readStream.schema(RAW_TXN).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch).json(landing)
    )
    return (
        rows.writeStream.foreachBatch(lambda batch, _: lake.load_bronze(table, batch))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
