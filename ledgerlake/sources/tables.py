"""Managed tables: namespaces, incremental append, rebuild, schema sync and persisted docs.

Plain parquet tables have no MERGE, so a rewrite goes to a staging table that then takes the old
table's name. A rewrite that dies before the swap leaves the old table as it was; one that dies
within it is finished by ``recover``. Every rewrite stages under a name of its own, so half-written
files of a dead run are in nobody's way.

An upsert of a partitioned table whose keys never change partition stages the partitions it touches and
then overwrites these. The stage is complete before the first is overwritten, so ``recover`` can do that
again, as often as needed; the other partitions keep their files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.identity import pack, unpack
from ..operators.incremental import new_rows, upsert
from ..session import release_shuffles, setting

DEFAULT_NAMESPACE = "default"
IDENTITY = "hash_id"
_STAGE, _OLD, _PART = "__stage", "__old", "__part"
# Partitions that a task writes side by side; rows of further ones are sorted first, and spilled where they are many.
WRITERS = ("spark.sql.maxConcurrentOutputFileWriters", "16")

# Types that hold all values of another one (fixed by the types' ranges).
_WIDER = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"), "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"), "float": ("double",), "date": ("timestamp", "timestamp_ntz"),
}


class SchemaChangeError(ValueError):
    """A column's new type cannot hold the stored values, nor the stored type the new ones."""


def table_name(name: str, namespace: str | None = None, default: str = DEFAULT_NAMESPACE) -> str:
    """Qualified name: the table's own namespace as given, else the default one."""
    return f"{namespace if namespace is not None else default}.{name}"


def ensure_namespace(spark: SparkSession, table: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rpartition('.')[0] or DEFAULT_NAMESPACE}")


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def _with_comments(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    if schema is None:
        return df
    docs = {f.name: f.metadata for f in schema.fields}
    return df.select(*[F.col(c).alias(c, metadata=docs.get(c, {})) for c in df.columns])


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt out by some columns; a hot value is split over many tasks, small ones are packed together.

    Identities have no pattern that compresses, so they travel as bytes, at half the size.
    """
    kinds = dict(df.dtypes)
    if kinds.get(IDENTITY) != "string" or IDENTITY in columns:
        return df.hint("rebalance", *columns)
    dealt = df.withColumn(IDENTITY, pack(F.col(IDENTITY))).hint("rebalance", *columns)
    return dealt.select(*[
        (unpack(F.col(f.name)) if f.name == IDENTITY else F.col(f"`{f.name}`")).alias(f.name, metadata=f.metadata) for f in df.schema.fields])


def _write(df: DataFrame, table: str, mode: str, partition_by: Sequence[str], dealt: bool = False) -> None:
    """``dealt`` rows already lie a few partitions to a task, as in a scan of a table with the same ones; they are written there."""
    if partition_by and not dealt:
        df = rebalanced(df, *partition_by)
    writer = df.write.mode(mode).format("parquet").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with setting(df.sparkSession, *WRITERS):
        writer.saveAsTable(table)
    release_shuffles(df.sparkSession)


def _drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def _rename(spark: SparkSession, table: str, new_name: str) -> None:
    spark.sql(f"ALTER TABLE {table} RENAME TO {new_name}")
    if any(c.isPartition for c in spark.catalog.listColumns(new_name)):
        # Not every catalog moves the partitions' locations along with the table.
        spark.sql(f"MSCK REPAIR TABLE {new_name} SYNC PARTITIONS")


def _stages(spark: SparkSession, table: str, kind: str = _STAGE) -> list[str]:
    """Completely written staging tables of ``table``."""
    namespace, _, name = table.rpartition(".")
    namespace = namespace or DEFAULT_NAMESPACE
    if not spark.catalog.databaseExists(namespace):
        return []
    listed = spark.catalog.listTables(namespace, f"{name}{kind}*")
    return [f"{namespace}.{t.name}" for t in listed]


def recover(spark: SparkSession, table: str) -> None:
    """Finish a swap that was interrupted: the staged rows take over, or the old ones come back."""
    stages = _stages(spark, table)
    if not exists(spark, table):
        # Between the two renames of a swap there is one stage; it is complete, or it would not be listed.
        for candidate in (*stages, table + _OLD):
            if exists(spark, candidate):
                _rename(spark, candidate, table)
                stages = [s for s in stages if s != candidate]
                break
    for stage in stages:
        _drop(spark, stage)
    _drop(spark, table + _OLD)
    for parts in _stages(spark, table, _PART):
        if exists(spark, table):
            _overwrite_parts(spark, parts, table)
        _drop(spark, parts)


def _overwrite_parts(spark: SparkSession, parts: str, table: str) -> None:
    """Put the staged partitions in place of the table's own; the same again if done twice."""
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"), setting(spark, *WRITERS):
        spark.table(parts).select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def rebuild(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), schema: T.StructType | None = None,
    comment: str | None = None, dealt: bool = False,
) -> None:
    """Replace a table's rows and schema; ``df`` may read the table it replaces. ``dealt``: see ``_write``."""
    spark = df.sparkSession
    ensure_namespace(spark, table)
    recover(spark, table)
    stage = f"{table}{_STAGE}_{uuid.uuid4().hex[:12]}"
    _write(_with_comments(df, schema), stage, "errorifexists", partition_by, dealt)
    if exists(spark, table):
        _rename(spark, table, table + _OLD)
    _rename(spark, stage, table)
    _drop(spark, table + _OLD)
    if comment:
        spark.sql(f"COMMENT ON TABLE {table} IS '{_quoted(comment)}'")


def among(column: str, values: Sequence) -> Column:
    """Whether a column has one of the values, None among them."""
    held = F.coalesce(F.col(column).isin([v for v in values if v is not None]), F.lit(False))
    return held | F.col(column).isNull() if None in values else F.col(column).isin(list(values))


def replace_parts(df: DataFrame, table: str, partition_by: Sequence[str], dealt: bool = False) -> None:
    """Put ``df`` in place of the partitions that it has rows for; the others keep their files."""
    spark = df.sparkSession
    parts = f"{table}{_PART}_{uuid.uuid4().hex[:12]}"
    _write(df, parts, "errorifexists", partition_by, dealt)
    _overwrite_parts(spark, parts, table)
    _drop(spark, parts)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def schema_changes(stored: T.StructType, incoming: T.StructType) -> tuple[list[T.StructField], list[str]]:
    """Columns to add (as the incoming rows have them) and names to drop."""
    have, want = set(stored.names), set(incoming.names)
    return [f for f in incoming.fields if f.name not in have], [n for n in stored.names if n not in want]


def _type_changes(stored: T.StructType, incoming: T.StructType) -> dict[str, T.DataType]:
    """Type each column must have after the change, where the stored one is too narrow."""
    wider, held = {}, {f.name: f.dataType for f in stored.fields}
    for f in incoming.fields:
        have, want = held.get(f.name, f.dataType), f.dataType
        if have == want or have.simpleString() in _WIDER.get(want.simpleString(), ()):
            continue
        if want.simpleString() not in _WIDER.get(have.simpleString(), ()):
            raise SchemaChangeError(f"{f.name} is {have.simpleString()}, rows have {want.simpleString()}")
        wider[f.name] = want
    return wider


def align(stored: DataFrame, incoming: T.StructType) -> DataFrame:
    """Stored rows in the incoming schema: new columns NULL, vanished ones gone, narrow ones widened."""
    have = {f.name: f for f in stored.schema.fields}
    wider = _type_changes(stored.schema, incoming)
    return stored.select(*[
        (F.col(f.name).cast(wider[f.name]) if f.name in wider else F.col(f.name)).alias(f.name, metadata=have[f.name].metadata)
        if f.name in have else F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata)
        for f in incoming.fields
    ])


def sync_schema(
    spark: SparkSession, table: str, incoming: T.StructType, partition_by: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> None:
    """Give a stored table the incoming columns and types; comments stay, new columns bring theirs.

    Adding is a catalog change. Dropping rewrites the table, since a column left behind in the
    files would come back with its old values if it were ever added again; so does widening a type.
    A type that can neither take nor give way is an error.
    """
    docs = {f.name: f.metadata for f in schema.fields} if schema is not None else {}
    incoming = T.StructType([T.StructField(f.name, f.dataType, True, docs.get(f.name) or f.metadata) for f in incoming.fields])
    stored = spark.table(table)
    add, drop = schema_changes(stored.schema, incoming)
    if drop or _type_changes(stored.schema, incoming):
        comment = spark.catalog.getTable(table).description
        rebuild(align(stored, incoming), table, partition_by, comment=comment)
    elif add:
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}"
            + (f" COMMENT '{_quoted(f.metadata['comment'])}'" if f.metadata.get("comment") else "") for f in add)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def append(df: DataFrame, table: str, partition_by: Sequence[str] = (), dealt: bool = False) -> None:
    """Add rows to a stored table, columns matched by name; a stored column may be wider, never narrower."""
    stored = df.sparkSession.table(table).schema
    narrow = _type_changes(stored, df.select(*stored.names).schema)
    if narrow:
        raise SchemaChangeError(f"{table} is too narrow for {', '.join(narrow)}")
    _write(df.select(*[F.col(f.name).cast(f.dataType) for f in stored.fields]), table, "append", partition_by, dealt)


def fresh_parts(
    df: DataFrame, table: str, prune_by: str | tuple[str, Sequence], key: str = "hash_id", null_policy: str = "raise",
    hot: Sequence | Callable[[DataFrame], Sequence] = (),
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose key is not stored yet: those of partitions that the table has, and those of new ones.

    ``prune_by`` is as in ``new_rows`` and a partition column of the table. The second rows can have no stored key,
    so they meet no stored row and stay in their tasks. ``hot`` may be a function that finds the hot keys of the first.
    """
    stored = df.sparkSession.table(table)
    column = prune_by if isinstance(prune_by, str) else prune_by[0]
    held = [r[0] for r in stored.select(column).distinct().collect()]  # as few as there are folders
    known = F.coalesce(F.col(column).isin([v for v in held if v is not None]), F.lit(False))
    met = df.where(known)
    return (
        new_rows(met, stored, key, null_policy, hot(met) if callable(hot) else hot, prune_by),
        new_rows(df.where(~known), stored, key, null_policy, prune_by=(column, ())),
    )


def append_new(
    df: DataFrame, table: str, key: str = "hash_id", full_refresh: bool = False,
    null_policy: str = "raise", partition_by: Sequence[str] = (), schema: T.StructType | None = None,
    comment: str | None = None, hot: Sequence | Callable[[DataFrame], Sequence] = (),
    prune_by: str | tuple[str, Sequence] | None = None,
) -> None:
    """Add the rows whose key is not stored yet; create the table on the first run.

    ``hot`` may be a function that finds the hot keys of the rows that are searched; it is not called on the first run.
    """
    spark = df.sparkSession
    recover(spark, table)
    if full_refresh or not exists(spark, table):
        rebuild(df, table, partition_by, schema, comment)
        return
    sync_schema(spark, table, df.schema, partition_by, schema)
    if prune_by is None:
        fresh = new_rows(df, spark.table(table), key, null_policy, hot(df) if callable(hot) else hot)
    else:
        met, others = fresh_parts(df, table, prune_by, key, null_policy, hot)
        fresh = met.unionByName(others)
    append(fresh, table, partition_by)


def merge(
    df: DataFrame, table: str, key: str = "hash_id", partition_by: Sequence[str] = (), hot: Sequence = (),
    fixed_partition: bool = False,
) -> None:
    """Insert new keys and replace the rows of stored ones.

    ``fixed_partition`` says that equal keys always lie in the same partition, as an identity that holds the
    date does in a table partitioned by month. Only the partitions that the batch touches are then read and
    rewritten; ``partition_by`` is one column, and its values in the batch are as few as the folders touched.
    """
    spark = df.sparkSession
    recover(spark, table)
    if not exists(spark, table):
        rebuild(df, table, partition_by)
        return
    sync_schema(spark, table, df.schema, partition_by)
    stored = spark.table(table)
    if not fixed_partition:
        rebuild(upsert(stored, df, key, hot), table, partition_by)
        return
    (column,) = partition_by
    touched = [r[0] for r in df.select(column).distinct().collect()]
    if not touched:
        return
    mine = among(column, touched)
    replace_parts(upsert(stored.where(mine), df, key, hot), table, partition_by)
