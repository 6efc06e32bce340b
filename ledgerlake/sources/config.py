"""Parsing settings per bank and account, kept as one nested JSON document."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

log = logging.getLogger(__name__)

TARGETS = ("fecha", "concepto", "importe")

_SETTINGS = T.StructType([
    T.StructField("skip_rows", T.IntegerType()),
    T.StructField("skip_footer", T.IntegerType()),
    T.StructField("column_mapping", T.MapType(T.StringType(), T.StringType())),
    T.StructField("date_format", T.StringType()),
    T.StructField("filter_completed", T.BooleanType()),
])
CONFIG_DOCUMENT = T.MapType(T.StringType(), T.MapType(T.StringType(), _SETTINGS))


@dataclass(frozen=True)
class AccountConfig:
    """How to read one account's statements.

    ``column_mapping`` goes from header name to target column; without it the account's files are
    rejected. ``positional`` names the columns of header-less sheets instead. Without
    ``date_format`` the usual formats are tried. ``extra_required`` columns must not be blank
    either. ``status_column``/``status_value`` keep only rows in that state (off by default).
    ``plain_numbers`` reads amounts as plain decimals, without separator guessing.
    """

    bank: str
    account: str
    column_mapping: tuple[tuple[str, str], ...] = ()
    skip_rows: int = 0
    skip_footer: int = 0
    date_format: str | None = None
    positional: tuple[str, ...] = ()
    extra_required: tuple[str, ...] = ()
    plain_numbers: bool = False
    entidad: str | None = None
    origen: str | None = None
    status_column: str | None = None
    status_value: str | None = None

    def header_name(self, target: str) -> str | None:
        """Header text that holds a target column."""
        if self.positional:
            return target if target in self.positional else None
        return next((source for source, to in self.column_mapping if to == target), None)


def _account(bank: str, account: str, settings: dict) -> AccountConfig:
    """One account's settings; every field of ``AccountConfig`` may be given under its name.

    ``filter_completed: false`` turns a state filter off that is otherwise set.
    """
    filtered = settings.get("filter_completed", True)
    return AccountConfig(
        bank, account,
        tuple((settings.get("column_mapping") or {}).items()),
        settings.get("skip_rows") or 0,
        settings.get("skip_footer") or 0,
        settings.get("date_format"),
        tuple(settings.get("positional") or ()),
        tuple(settings.get("extra_required") or ()),
        bool(settings.get("plain_numbers")),
        settings.get("entidad"),
        settings.get("origen"),
        settings.get("status_column") if filtered else None,
        settings.get("status_value") if filtered else None,
    )


def parse_config(text: str) -> list[AccountConfig]:
    """The accounts of a settings document; an unreadable document has none."""
    try:
        return [
            _account(bank, account, settings)
            for bank, accounts in json.loads(text).items()
            for account, settings in accounts.items()
        ]
    except (ValueError, AttributeError, TypeError) as error:
        log.error("unreadable settings document: %s", error)
        return []


def load_config(spark: SparkSession, path: str) -> list[AccountConfig]:
    """Settings from any path Spark can read; a missing or broken document gives no accounts."""
    try:
        text = spark.read.text(path, wholetext=True).first()
    except Exception as error:  # a missing path is reported by the engine, not as FileNotFoundError
        log.error("no settings at %s: %s", path, error)
        return []
    return parse_config(text[0]) if text else []


def config_rows(document: Column, docs: DataFrame) -> DataFrame:
    """Settings documents held in a column, as one row per bank and account."""
    banks = docs.select(F.explode(F.from_json(document, CONFIG_DOCUMENT)).alias("bank", "accounts"))
    rows = banks.select("bank", F.explode("accounts").alias("account", "s"))
    return rows.select("bank", "account", "s.*")


def configured_only(rows: DataFrame, config: DataFrame) -> DataFrame:
    """Rows whose bank and account have settings."""
    return rows.join(config.select("bank", "account").distinct(), ["bank", "account"], "left_semi")
