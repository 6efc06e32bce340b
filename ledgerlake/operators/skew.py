"""Joins that stay balanced when one key, or NULL, holds a large share of the rows.

AQE splits skewed partitions only when both join inputs come straight from a shuffle. Where the
right side is pre-aggregated it cannot, so hot keys are salted here: rows of a hot key are spread
over ``SALTS`` buckets on the left and that key's right rows are repeated once per bucket. Which
keys are treated as hot changes the speed, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

SALTS = 64
MAX_HOT_KEYS = 256
BITS = 1 << 25  # of the map that stands for a table's keys: 4 MB, however many there are


def spread_scan(df: DataFrame) -> DataFrame:
    """Deal the rows out when a scan has too few pieces to keep the cluster's cores busy.

    A file with one row group is read by one task however large it is. Inputs with enough pieces,
    as all large tables have, are left alone. Filters and column pruning still reach the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def hot_keys(df: DataFrame, key: str, rows: int = 5_000_000, fraction: float = 0.001) -> list:
    """Keys estimated to hold more than ``rows`` rows, from a sampled count.

    The sample only guides the plan. At most ``MAX_HOT_KEYS`` keys reach the driver; any beyond
    them are simply not salted.
    """
    least = max(1, int(rows * fraction))
    counted = (
        df.select(key).where(F.col(key).isNotNull()).sample(fraction=fraction, seed=17)
        .groupBy(key).count().where(F.col("count") > least)
    )
    return [r[0] for r in counted.orderBy(F.desc("count")).limit(MAX_HOT_KEYS).collect()]


def marked(df: DataFrame, keys: DataFrame, key: str, out: str) -> DataFrame:
    """``df`` with ``out``, which is false only where no row of ``keys`` has the same ``key``.

    The keys are broadcast as a map of ``BITS`` bits, in blocks of 4 KB. Keys that share a bit mark rows too many, the
    more of them the more keys there are: 2 % for 650,000. Rows stay in their tasks.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(BITS))
    blocks = (
        keys.select(bit.alias("_bit")).groupBy(F.bitmap_bucket_number("_bit").alias("_block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits"))
    )
    at = F.bitmap_bit_position("_bit")
    held = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = df.withColumn("_bit", bit).withColumn("_block", F.bitmap_bucket_number("_bit"))
    return (
        rows.join(F.broadcast(blocks), "_block", "left")
        .withColumn(out, F.coalesce(F.getbit(held, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False)))
        .drop("_bit", "_block", "_bits")
    )


def salted(left: DataFrame, right: DataFrame, key: str, hot: Sequence = ()) -> tuple[DataFrame, DataFrame]:
    """Both inputs with a ``_salt`` column to add to the join key; NULL keys are always spread.

    The left salt is a hash of the row's own columns, so a task that runs again after a lost executor
    deals the same rows the same way. Rows alike in every column share a salt.
    """
    is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(False)) if hot else F.lit(False)
    hashable = [c for c, kind in left.dtypes if "map<" not in kind and "variant" not in kind]
    spread = F.pmod(F.xxhash64(*hashable), F.lit(SALTS)).cast("int")
    left = left.withColumn("_salt", F.when(F.col(key).isNull() | is_hot, spread).otherwise(F.lit(0)))
    if not hot:
        # Always zero, but not a literal: the optimizer would take a literal out of the join key,
        # and the NULL keys would all meet in one partition again.
        return left, right.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(1)).cast("int"))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return left, right.withColumn("_salt", F.explode(copies))
