"""Keeping the rule table: reading rule sheets, finding unclassified texts, taking suggestions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.amounts import parse_number
from ..functions.text import blank_to_null, strip_fences, trim_ws
from ..schemas import MASTER_RULES

DEFAULT_PRIORITY = 50


def pad_cells(cells: Column, width: Column | int) -> Column:
    """A row of cells cut or filled with blanks to the header's width."""
    width = F.lit(width) if isinstance(width, int) else width
    missing = F.greatest(width - F.size(cells), F.lit(0))
    return F.slice(F.concat(cells, F.array_repeat(F.lit(""), missing)), F.lit(1), width)


def rule_priority(c: Column) -> Column:
    """Numeric text truncated to an integer; anything else gets the default priority."""
    return F.coalesce(parse_number(c), F.lit(float(DEFAULT_PRIORITY))).cast("int")


def sync_rules(rows: DataFrame, header: Sequence[str], cells: str = "cells") -> DataFrame:
    """Rule rows from ragged sheet rows: one column per header name, priority and keyword cleaned.

    Columns of ``rows`` other than ``cells``, such as a row number, are kept in front.
    """
    padded = rows.withColumn("_row", pad_cells(F.col(cells), len(header)))
    columns = []
    for i, name in enumerate(header):
        value = F.get("_row", i)
        if name == "priority":
            value = rule_priority(value)
        elif name == "keyword":
            value = trim_ws(value)
        columns.append(value.alias(name))
    return padded.select(*[c for c in rows.columns if c != cells], *columns)


def unclassified_concepts(silver: DataFrame, limit: int | None = 20) -> DataFrame:
    """The first ``limit`` distinct texts, in text order, that fell back to the unclassified expense.

    They are for somebody to write rules for. Unknown income carries another fallback and is not listed.
    """
    found = _pending(silver).select("concepto").distinct().orderBy("concepto")
    return found.limit(limit) if limit is not None else found


def unclassified_by_weight(silver: DataFrame) -> DataFrame:
    """All texts of that kind with their rows and money."""
    return _pending(silver).groupBy("concepto").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.abs("importe").cast("decimal(18,2)")).cast("double").alias("total"),
    )


def _pending(silver: DataFrame) -> DataFrame:
    def unset(name: str, *values: str) -> Column:
        return F.col(name).isNull() | F.col(name).isin(*values)

    # The fallback levels.
    return silver.where(
        unset("grupo", "Sin Clasificar", "Gastos Variables")
        & unset("categoria", "Otros Gastos")
        & unset("subcategoria", "Sin Clasificar")
    )


def parse_suggestions(answers: DataFrame, text: str = "text") -> DataFrame:
    """Rule rows from free-text CSV answers, one per line, fences and repeated headers dropped."""
    schema = ", ".join(f"{f.name} string" for f in MASTER_RULES.fields)
    lines = answers.select(F.explode(F.split(strip_fences(F.col(text)), r"\r?\n")).alias("line"))
    rows = lines.where(trim_ws(F.col("line")) != "").select(
        F.from_csv("line", schema, {"escape": '"'}).alias("r")
    )
    return clean_suggestions(rows.select("r.*"))


def clean_suggestions(rows: DataFrame) -> DataFrame:
    """Suggested rules without header lines and repeats, typed as rules."""
    return (
        rows.where(F.col("keyword").isNotNull() & (F.col("keyword") != "keyword"))
        .select(
            trim_ws(F.col("keyword")).alias("keyword"),
            rule_priority(F.col("priority")).alias("priority"),
            *[blank_to_null(F.col(c)).alias(c) for c in ("grupo_categoria", "categoria", "subcategoria", "entity_name")],
        )
        .where(F.col("keyword") != "")
        .dropDuplicates()
    )


def check_suggestions(suggestions: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Suggestions with ``known``: whether their classification triple is in use already."""
    levels = ["grupo_categoria", "categoria", "subcategoria"]
    # NULL levels are compared as blanks, which keeps this an equi-join.
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({f"_{c}": F.coalesce(c, F.lit("")) for c in levels})

    keys = [f"_{c}" for c in levels]
    known = keyed(taxonomy).select(*keys).distinct().withColumn("known", F.lit(True))
    return (
        keyed(suggestions).join(known, keys, "left")
        .withColumn("known", F.coalesce("known", F.lit(False))).drop(*keys)
    )
