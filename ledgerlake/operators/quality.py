"""Declarative data tests: unique and not-null columns."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class ColumnTest:
    table: str
    column: str
    kind: str  # "unique" or "not_null"


BRONZE_TABLES = ("account", "card", "shared", "app_account", "cash")

# Thirteen tests: identity on every table, and the amount of hand-kept cash.
DECLARED_TESTS = tuple(
    [ColumnTest(t, "hash_id", k) for t in (*BRONZE_TABLES, "fct_transactions") for k in ("unique", "not_null")]
    + [ColumnTest("cash", "importe", "not_null")]
)


def duplicates(df: DataFrame, key: str = "hash_id") -> DataFrame:
    """Keys held by more than one row, with their row count; NULL is no duplicate."""
    return (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row with the number of NULLs in each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def _table_results(name: str, df: DataFrame, tests: list[ColumnTest], by: tuple[str, ...] = ()) -> list[DataFrame]:
    """One row per test of a table (and per value of ``by``), from one pass per unique column (at least one in all)."""
    unique = [t.column for t in tests if t.kind == "unique"]
    not_null = [t.column for t in tests if t.kind == "not_null"]
    passes = []
    for i, key in enumerate(unique or [None]):
        checked = not_null if i == 0 else []
        if key is None:
            counted = df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in checked])
            totals = [(c, "not_null", F.col(f"_null_{c}")) for c in checked]
        else:
            # Rows are reduced per key in the map tasks, also the rows without one.
            per_key = df.groupBy(*by, key).agg(
                F.count("*").alias("_n"),
                *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in checked if c != key],
            )
            missing = F.sum(F.when(F.col(key).isNull(), F.col("_n")))
            counted = per_key.groupBy(*by).agg(
                F.count_if((F.col("_n") > 1) & F.col(key).isNotNull()).alias("_repeated"),
                *[(missing if c == key else F.sum(f"_null_{c}")).alias(f"_null_{c}") for c in checked],
            )
            totals = [(key, "unique", F.col("_repeated"))] + [(c, "not_null", F.col(f"_null_{c}")) for c in checked]
        passes.append(counted.select(*by, F.inline(F.array(*[
            F.struct(
                F.lit(name).alias("table"), F.lit(c).alias("column"), F.lit(kind).alias("kind"),
                F.coalesce(n, F.lit(0)).cast("long").alias("failures"),
            ) for c, kind, n in totals
        ]))))
    return passes


def run_tests(tables: dict[str, DataFrame], tests: Iterable[ColumnTest] = DECLARED_TESTS, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per test of a given table: table, column, kind, failures (offending keys or rows).

    ``by`` are columns that equal keys always share, as an identity that holds the date does its month. There is
    then a row for each of their values, and the failures of a table are the sum over these.
    """
    tests = list(tests)
    unknown = {t.kind for t in tests} - {"unique", "not_null"}
    if unknown:
        raise ValueError(f"unknown test kinds {sorted(unknown)}")
    passes = []
    for name, df in tables.items():
        mine = [t for t in tests if t.table == name]
        if mine:
            passes += _table_results(name, df, mine, by)
    if not passes:
        raise ValueError("no test applies to the given tables")
    return reduce(DataFrame.unionByName, passes)
