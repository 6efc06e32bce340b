"""Fact table: union of the bronze tables, classified and enriched."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import date_parts
from ..functions.text import initcap_words
from ..operators.flags import Household, with_flags
from ..operators.rules import UNKNOWN_ENTITY, classify
from ..schemas import SILVER, TXN, conform


def union_sources(sources: Iterable[DataFrame]) -> DataFrame:
    """All sources one after the other, columns matched by name; repeats stay."""
    return reduce(DataFrame.unionByName, [s.select(*TXN.names) for s in sources])


def merchant_name(entity: Column, concept: Column) -> Column:
    """The rule's entity; for an unknown one the movement text in title case."""
    return F.when(entity == UNKNOWN_ENTITY, initcap_words(concept)).otherwise(entity)


def enrich(
    transactions: DataFrame, master: DataFrame, house: Household, null_text: str | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """The fact table's columns for canonical transactions; works row by row."""
    df = transactions.withColumn("fecha", F.col("fecha").cast("date"))
    df = classify(with_flags(df, house), master, null_text=null_text, strategy=strategy)
    df = df.withColumns({
        **date_parts(F.col("fecha")),
        "grupo": F.col("clase.grupo"),
        "categoria": F.col("clase.categoria"),
        "subcategoria": F.col("clase.subcategoria"),
        "comercio": merchant_name(F.col("clase.entity_name"), F.col("concepto")),
    })
    return conform(df, SILVER)
