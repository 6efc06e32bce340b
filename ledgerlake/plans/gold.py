"""Final mart, and the spending totals it is meant for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.flags import SHARED_SETTLEMENT
from ..operators.skew import marked
from ..schemas import GOLD, conform


def adjust(silver: DataFrame, adjustments: DataFrame) -> DataFrame:
    """Own share after manual adjustments: half of what remains of a shared card settlement.

    Joined on the content hash, so equal movements are all adjusted and repeated adjustments of a
    hash repeat its rows. The size of the adjustment table decides whether it is broadcast; the
    direct join also lets AQE split a hot hash.
    """
    a = adjustments.select("hash_id", F.col("adjustment_amount").alias("_amount"), F.lit(True).alias("_adjusted"))
    adjusted = (F.abs("importe") - F.col("_amount")) * 0.5 * -1
    applies = (F.col("operativa_interna") == SHARED_SETTLEMENT) & F.col("_adjusted").isNotNull()
    return (
        silver.join(a, "hash_id", "left")
        .withColumn("importe_personal", F.when(applies, adjusted).otherwise(F.col("importe_personal")))
        .drop("_amount", "_adjusted")
    )


def gold_transactions(silver: DataFrame, adjustments: DataFrame) -> DataFrame:
    return conform(adjust(silver, adjustments), GOLD)


def gold_parts(silver: DataFrame, adjustments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``gold_transactions`` in two parts: rows that may have an adjustment, and those that have none and stay in their tasks."""
    rows = marked(silver, adjustments, "hash_id", "_adjustable")
    some, none = (rows.where(c).drop("_adjustable") for c in (F.col("_adjustable"), ~F.col("_adjustable")))
    return gold_transactions(some, adjustments), conform(none, GOLD)


def money(c: Column) -> Column:
    """Exact total: decimals add up the same in any order, doubles do not."""
    return F.sum(c.cast("decimal(18,4)")).cast("double")


def monthly_spend(gold: DataFrame) -> DataFrame:
    """Own share of real movements per month, group and category."""
    return (
        gold.where("es_movimiento_real")
        .groupBy("anio_mes", "grupo", "categoria")
        .agg(money(F.col("importe_personal")).alias("total"), F.count("*").alias("n_rows"))
    )


def spend_rollup(gold: DataFrame) -> DataFrame:
    """Own share of real movements at every level of the hierarchy.

    ``level`` counts the levels in use, 0 being the grand total; it tells a total from a group
    whose own value is NULL.
    """
    levels = ("grupo", "categoria", "subcategoria")
    # Sums per leaf first, so that rollup multiplies leaves and not rows.
    leaves = (
        gold.where("es_movimiento_real").groupBy(*levels)
        .agg(F.sum(F.col("importe_personal").cast("decimal(18,4)")).alias("s"), F.count("*").alias("n"))
    )
    mask = F.grouping_id(*levels)
    return leaves.rollup(*levels).agg(
        F.when(mask == 0, 3).when(mask == 1, 2).when(mask == 3, 1).otherwise(0).alias("level"),
        F.sum("s").cast("double").alias("total"),
        F.sum("n").alias("n_rows"),
    )
