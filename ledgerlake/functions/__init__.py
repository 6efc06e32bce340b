"""Column functions; every one is a composition of built-in Spark expressions."""

from .amounts import exact_cents_text, parse_amount, parse_number
from .dates import date_parts, parse_date, parse_date_any
from .identity import hash_id
from .text import (
    blank_to_null, capitalize, fold, initcap_words, path_parts, split_packed, strip_fences, trim_ws,
)

__all__ = [
    "blank_to_null", "capitalize", "date_parts", "exact_cents_text", "fold", "hash_id",
    "initcap_words", "parse_amount", "parse_date", "parse_date_any", "parse_number", "path_parts",
    "split_packed", "strip_fences", "trim_ws",
]
