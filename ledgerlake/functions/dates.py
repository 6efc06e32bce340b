"""Date parsing driven by strptime-style formats, and calendar columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

# strptime directive -> (Spark pattern, what the text must look like).
_DIRECTIVES = {
    "d": ("d", r"\d{1,2}"),
    "m": ("M", r"\d{1,2}"),
    # Years a nanosecond timestamp holds in full; dates outside count as unparseable.
    "Y": ("yyyy", r"(?:167[89]|16[89]\d|1[789]\d\d|2[01]\d\d|22[0-5]\d|226[01])"),
    "H": ("H", r"\d{1,2}"),
    "M": ("m", r"\d{1,2}"),
    "S": ("s", r"\d{1,2}"),
    "y": ("yy", r"\d{2}"),
    "b": ("MMM", r"[A-Za-z]{3}"),
    "B": ("MMMM", r"[A-Za-z]{3,9}"),
    "I": ("h", r"\d{1,2}"),
    "p": ("a", r"[AaPp][Mm]"),
    "f": ("[SSSSSS][SSSSS][SSSS][SSS][SS][S]", r"\d{1,6}"),
}

# Formats a source without a stated one may have; on equal votes the earlier wins.
INFERRED_FORMATS = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y/%m/%d", "%m/%d/%Y", "%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y")


def _compile(fmt: str) -> tuple[str, str]:
    pattern, guard, i = [], [], 0
    while i < len(fmt):
        if fmt[i] == "%":
            code = fmt[i + 1:i + 2]
            if code not in _DIRECTIVES:
                raise ValueError(f"unsupported date directive %{code} in {fmt!r}")
            spark, regex = _DIRECTIVES[code]
            pattern.append(spark)
            guard.append(regex)
            i += 2
        else:
            pattern.append(f"'{fmt[i]}'" if fmt[i].isalpha() else "''" if fmt[i] == "'" else fmt[i])
            guard.append(re.escape(fmt[i]))
            i += 1
    return "".join(pattern), "^" + "".join(guard) + r"\z"


def supported(fmt: str) -> bool:
    """Whether every directive of a format is known here."""
    try:
        _compile(fmt)
    except ValueError:
        return False
    return True


def parse_date(c: Column, fmt: str) -> Column:
    """Text to date by one format, NULL when it does not match or is no calendar date.

    Two-digit years from 69 on are of the last century. Month names are English.
    """
    pattern, guard = _compile(fmt)
    day = F.to_date(F.try_to_timestamp(c, F.lit(pattern)))
    if "%y" in fmt:
        day = F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)
    return F.when(c.rlike(guard), day)


def parse_date_any(c: Column, formats: Sequence[str] = INFERRED_FORMATS) -> Column:
    """Text to date by the first format that fits."""
    return F.coalesce(*[parse_date(c, fmt) for fmt in formats])


def parse_date_as(c: Column, fmt: Column, formats: Sequence[str] = INFERRED_FORMATS) -> Column:
    """Text to date by the one of ``formats`` that a column names, NULL where it names none."""
    day = F.lit(None).cast("date")
    for known in formats:
        day = F.when(fmt == known, parse_date(c, known)).otherwise(day)
    return day


def elect_formats(rows: DataFrame, by: Sequence[str], text: str, formats: Sequence[str] = INFERRED_FORMATS) -> DataFrame:
    """One date format for all texts of a group: the one that most of them fit.

    Columns: ``by``, ``date_format`` (NULL if no text fits any), ``n_texts``, ``n_fit``, and ``ambiguous``:
    another format fits as many texts but reads some of them as other days. Votes are counted in the map
    tasks, so a group may be of any size.
    """
    days = {fmt: parse_date(F.col(text), fmt) for fmt in formats}
    # Only formats that look alike can fit the same text.
    alike = [(a, b) for a, b in combinations(formats, 2) if _compile(a)[1] == _compile(b)[1]]
    votes = rows.groupBy(*by).agg(
        F.count(text).alias("n_texts"), *[F.count(days[fmt]).alias(f"_v{i}") for i, fmt in enumerate(formats)],
        *[F.count_if(days[a] != days[b]).alias(f"_d{i}") for i, (a, b) in enumerate(alike)])
    of = {fmt: F.col(f"_v{i}") for i, fmt in enumerate(formats)}
    best = F.greatest(*of.values()) if len(of) > 1 else next(iter(of.values()))
    first = F.coalesce(*[F.when(of[fmt] == F.col("n_fit"), F.lit(fmt)) for fmt in formats])
    tied = F.lit(False)
    for i, (a, b) in enumerate(alike):
        tied = tied | ((of[a] == F.col("n_fit")) & (of[b] == F.col("n_fit")) & (F.col(f"_d{i}") > 0))
    return votes.withColumn("n_fit", best).select(
        *by, F.when(F.col("n_fit") > 0, first).alias("date_format"), "n_texts", "n_fit",
        ((F.col("n_fit") > 0) & tied).alias("ambiguous"))


def date_parts(day: Column) -> dict[str, Column]:
    """The calendar columns of the fact table."""
    return {
        "anio": F.year(day),
        "mes": F.month(day),
        "anio_mes": F.date_format(day, "yyyy-MM"),
        "trimestre": F.quarter(day),
    }
