"""Loading only rows whose key is not stored yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.identity import pack, unpack
from .skew import salted


class NullKeyError(ValueError):
    """The stored table holds NULL keys, which would block every later load."""


def unseen(batch: DataFrame, stored: DataFrame, key: str = "hash_id", hot: Sequence = ()) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``stored``; repeats and NULL keys are kept.

    The stored keys are reduced before they are shuffled, so a key stored a billion times arrives
    once per task. ``hot`` names keys with very many batch rows (see ``skew.hot_keys``).
    """
    keys = stored.select(key).where(F.col(key).isNotNull())
    rows, keys = salted(batch, keys, key, hot)
    texts = dict(batch.dtypes)[key] == dict(stored.dtypes)[key] == "string"
    if texts:  # identities travel at half their size
        rows, keys = (df.withColumn(key, pack(F.col(key))) for df in (rows, keys))
    passed = rows.join(keys.distinct(), [key, "_salt"], "left_anti").drop("_salt")
    return passed.withColumn(key, unpack(F.col(key))) if texts else passed


def new_rows(
    batch: DataFrame, stored: DataFrame, key: str = "hash_id", null_policy: str = "compat",
    hot: Sequence = (), prune_by: str | tuple[str, Sequence] | None = None,
) -> DataFrame:
    """Rows of ``batch`` that ``key NOT IN (SELECT key FROM stored)`` lets through, at any scale.

    SQL's NOT IN is null-aware, and as a join it falls back to a nested loop once the stored side
    cannot be broadcast. Here it is a plain anti join plus two one-value subqueries:

    * nothing stored: every row passes, also those with a NULL key;
    * a NULL key stored: no row passes (``compat``), or an error is raised (``raise``), or the
      stored NULLs are disregarded (``ignore``);
    * else rows with a non-NULL key that is not stored.

    ``prune_by`` is a column that equal keys always share, such as the month of a key that contains
    the date; the keys are then searched for only among stored rows with the batch's values of it.
    These are given along with the column, or else taken from the batch in the same plan, where a
    partition column prunes the stored files at run time. Given without a value, nothing is searched.
    """
    if null_policy not in ("compat", "raise", "ignore"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    nulls = stored.where(F.col(key).isNull()).select(F.lit(1))
    if null_policy == "raise" and not nulls.isEmpty():
        raise NullKeyError(f"stored table has NULL {key}")

    searched = stored
    if isinstance(prune_by, str):
        searched = searched_parts(stored, batch, prune_by)
    elif prune_by is not None:
        column, held = prune_by
        searched = stored.where(F.col(column).isin(list(held)))

    # A NULL key survives only the very first load; told before the keys are packed for the join.
    batch = batch.where(F.col(key).isNotNull() | ~stored.select(F.lit(1)).exists())
    unsearched = isinstance(prune_by, tuple) and not len(prune_by[1])
    passed = batch if unsearched else unseen(batch, searched, key, hot)
    return passed.where(~nulls.exists()) if null_policy == "compat" else passed


def searched_parts(stored: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Stored rows that share a value of ``column`` with the batch; a text column of few values, such as months.

    The values (at most one per month of the years that dates may have) are broadcast, and the filter on
    them, which all texts pass, lets the optimizer expect that they prune partitions.
    """
    held = batch.where(F.col(column) >= "").select(column).distinct()
    return stored.join(F.broadcast(held), column, "left_semi")


def upsert(stored: DataFrame, batch: DataFrame, key: str = "hash_id", hot: Sequence = ()) -> DataFrame:
    """The table after replacing stored rows by batch rows of equal key and adding the others.

    Stored rows with a NULL key match nothing and stay.
    """
    return unseen(stored, batch, key, hot).unionByName(batch.select(*stored.columns))
