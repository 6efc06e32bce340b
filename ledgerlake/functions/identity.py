"""Content identity of a transaction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .amounts import exact_cents_text
from .text import trim_ws


def hash_id(fecha: Column, concepto: Column, importe: Column) -> Column:
    """SHA-256 over ISO date, trimmed lower-case text and two-decimal amount.

    NULL when any part is NULL. Bank and account are not part of it, so equal movements share a
    hash: never group by it to look something up.
    """
    payload = F.concat(
        fecha.cast("string"), F.lit("-"), F.lower(trim_ws(concepto)), F.lit("-"),
        exact_cents_text(importe),
    )
    return F.sha2(payload, 256)


def pack(identity: Column) -> Column:
    """Any text as bytes that tell it apart from every other one; a SHA-256 in half its letters. NULL stays NULL."""
    raw = identity.cast("binary")
    return F.when(identity.rlike(r"^[0-9a-f]{64}\z"), F.concat(F.lit(b"\x01"), F.unhex(identity))).otherwise(F.concat(F.lit(b"\x00"), raw))


def unpack(packed: Column) -> Column:
    """The text that ``pack`` was given."""
    rest = F.substring(packed, 2, 2**31 - 1)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
