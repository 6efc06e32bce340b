"""Raw landing zone: JSON lines per source file, the hand-kept cash sheet, and rule CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.amounts import sql_number
from ..functions.identity import hash_id
from ..functions.text import path_parts, trim_ws
from ..operators.maintenance import clean_suggestions
from ..schemas import CASH_RAW, MASTER_RULES, RAW_TXN, TXN, conform
from .tables import rebalanced

_ISO_DAY = r"^\d{4}-\d{1,2}-\d{1,2}\z"

RULE_ID = T.StructField("rule_id", T.LongType())
CASH_ENTITY, CASH_ORIGIN = "Caja", "Cash"


def write_raw(transactions: DataFrame, root: str) -> None:
    """JSON lines under ``bank=/account=/stem=``; re-reading a file replaces what it wrote before.

    A stem is a folder and may hold several part files, so no file has to pass through one task. Files are
    packed with gzip, whose readers cannot split them; each has the rows of one task.
    """
    stem = path_parts(F.col("path"))[1]
    (
        rebalanced(transactions.select(*RAW_TXN.names, "bank", "account", stem.alias("stem")), "bank", "account", "stem")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
        .partitionBy("bank", "account", "stem").json(root)
    )


def read_raw(spark: SparkSession, root: str, bank: str | None = None, account: str | None = None) -> DataFrame:
    """Landed transactions with a fixed schema, cut down to one account's folders where given."""
    schema = T.StructType(RAW_TXN.fields + [
        T.StructField(c, T.StringType()) for c in ("bank", "account", "stem")
    ])
    df = spark.read.schema(schema).json(root)
    if bank is not None:
        df = df.where(F.col("bank") == bank)
    if account is not None:
        df = df.where(F.col("account") == account)
    return df.select(*RAW_TXN.names)


def read_cash(spark: SparkSession, path: str) -> DataFrame:
    """The cash sheet as text columns."""
    return spark.read.schema(CASH_RAW).option("header", True).csv(path)


def normalize_cash(cash: DataFrame) -> DataFrame:
    """Typed cash rows with identity.

    Rows are dropped for a missing date or amount before the casts, so one that fails to cast
    stays, with a NULL there and in ``hash_id``. A date is a whole ISO date, an amount a finite number.
    """
    day = F.trim("fecha")
    typed = cash.where(F.col("fecha").isNotNull() & F.col("importe").isNotNull()).select(
        F.when(day.rlike(_ISO_DAY), day.try_cast("date")).alias("fecha"),
        trim_ws(F.col("concepto")).alias("concepto"),
        sql_number(F.col("importe")).alias("importe"),
    )
    return typed.select(
        hash_id(F.col("fecha"), F.col("concepto"), F.col("importe")).alias("hash_id"),
        "fecha", "concepto", "importe",
        F.lit(CASH_ENTITY).alias("entidad"), F.lit(CASH_ORIGIN).alias("origen"),
    )


def bronze_rows(raw: DataFrame) -> DataFrame:
    """The bronze columns of landed rows, by name and type."""
    return conform(raw, TXN)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A seed CSV with a header; blanks are NULL.

    Files that ``write_seed`` made carry their ``rule_id``, however many they are. A single file
    without that column is numbered in file order; several such files have no order and are refused.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    header = spark.read.option("header", False).option("escape", '"').csv(path).first()
    if header is not None and header[0] == RULE_ID.name:
        return reader.schema(T.StructType([RULE_ID, *schema.fields])).csv(path).select(*schema.names, RULE_ID.name)
    df = reader.schema(schema).csv(path)
    if len(df.inputFiles()) > 1:
        raise ValueError(f"{path} has several files and no {RULE_ID.name} to order their rows by")
    # One file, so the row numbers grow with the place in it.
    return df.withColumn(RULE_ID.name, F.monotonically_increasing_id())


def read_suggestions(spark: SparkSession, path: str) -> DataFrame:
    """Suggested rules from CSV files, repeated header lines and repeated rules dropped."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in MASTER_RULES.fields])
    return clean_suggestions(spark.read.schema(text).option("header", True).option("escape", '"').csv(path))


def write_suggestions(rules: DataFrame, path: str) -> None:
    """Suggested rules as CSV with the rule header, for somebody to review."""
    columns = rules.select(*MASTER_RULES.names)
    columns.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_seed(rules: DataFrame, path: str) -> None:
    """Seed rows as CSV files with a header, each with its ``rule_id`` first; any number of rows."""
    if RULE_ID.name not in rules.columns:
        raise ValueError(f"rules need a {RULE_ID.name}: it decides between equal priorities")
    columns = [RULE_ID.name, *[c for c in rules.columns if c != RULE_ID.name]]
    rules.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
