"""Table contracts: column names, types and the comments persisted with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def _field(name: str, dtype: T.DataType, comment: str = "") -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": comment} if comment else {})


_HASH = _field("hash_id", T.StringType(), "SHA-256 over date, lower-case text and two-decimal amount; equal movements share it.")
_TEXT = _field("concepto", T.StringType(), "Text cell of the statement line, untouched.")
_AMOUNT = _field("importe", T.DoubleType(), "Signed euros of the line, before any split.")
_ENTITY = _field("entidad", T.StringType(), "Bank folder name, or the label its settings give.")
_ORIGIN = _field("origen", T.StringType(), "Account folder name, or the label its settings give.")

# Raw landing rows carry ISO text dates; bronze casts them.
RAW_TXN = T.StructType([_HASH, _field("fecha", T.StringType()), _TEXT, _AMOUNT, _ENTITY, _ORIGIN])
TXN = T.StructType([_HASH, _field("fecha", T.DateType(), "Value date."), _TEXT, _AMOUNT, _ENTITY, _ORIGIN])
CASH_RAW = T.StructType([_field(c, T.StringType()) for c in ("fecha", "concepto", "importe")])

SILVER = T.StructType([
    _HASH,
    _field("fecha", T.DateType(), "Value date."),
    _field("anio", T.IntegerType()),
    _field("mes", T.IntegerType()),
    _field("anio_mes", T.StringType(), "Year and month, yyyy-MM; partition column."),
    _field("trimestre", T.IntegerType()),
    _TEXT, _AMOUNT, _ENTITY, _ORIGIN,
    _field("operativa_interna", T.StringType(), "First operation of the household that fits."),
    _field("grupo", T.StringType(), "Group of the winning rule."),
    _field("categoria", T.StringType(), "Category of the winning rule."),
    _field("subcategoria", T.StringType(), "Subcategory of the winning rule."),
    _field("comercio", T.StringType(), "Entity of the winning rule, else the text in title case."),
    _field("es_compartido", T.BooleanType(), "Shared origin and no contribution."),
    _field("importe_personal", T.DoubleType(), "Amount after the split: half if shared, nothing for contributions."),
    _field("es_movimiento_real", T.BooleanType(), "Whether totals count the row."),
])

GOLD_COLUMNS = (
    "hash_id", "fecha", "anio", "mes", "anio_mes", "trimestre", "concepto", "importe", "comercio",
    "grupo", "categoria", "subcategoria", "entidad", "origen", "operativa_interna",
    "es_movimiento_real", "es_compartido", "importe_personal",
)
GOLD = T.StructType([SILVER[name] for name in GOLD_COLUMNS])

MASTER_RULES = T.StructType([
    _field("keyword", T.StringType()),
    _field("priority", T.IntegerType()),
    _field("grupo_categoria", T.StringType()),
    _field("categoria", T.StringType()),
    _field("subcategoria", T.StringType()),
    _field("entity_name", T.StringType()),
])
ENTITY_RULES = T.StructType([
    _field("keyword", T.StringType()),
    _field("entity_name", T.StringType()),
    _field("priority", T.IntegerType()),
])
CATEGORY_RULES = T.StructType([
    _field("keyword", T.StringType()),
    _field("category", T.StringType()),
    _field("priority", T.IntegerType()),
])
ADJUSTMENTS = T.StructType([
    _field("hash_id", T.StringType()),
    _field("adjustment_amount", T.DoubleType()),
    _field("reason", T.StringType()),
])

TABLE_COMMENTS = {
    "account": "Landed rows of ACCOUNT folders, one per statement line.",
    "card": "Landed rows of CARD folders, one per statement line.",
    "shared": "Landed rows of SHARED folders; silver splits their amounts.",
    "app_account": "Landed rows of app exports, dates with a time of day.",
    "cash": "Rows of the typed-in cash list that have a date and an amount.",
    "fct_transactions": "Union of the bronze tables with rule results and flags, new identities only.",
    "transactions": "Silver with manual adjustments applied.",
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, cast to its types and attach its comments."""
    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields
    ])
