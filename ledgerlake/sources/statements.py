"""Bank statement files to canonical transactions.

Layout: ``<root>/<bank>/<account>/[PENDING/]<file>``. Files whose suffix contains ``csv`` are read
as text, all others as workbooks. Only configured bank/account folders are read.

CSV files of any size are read as splittable lines, kept once, and put together to records (see
``records``). A file with a problem yields no transactions and says so in ``files``. Where the settings
state no date format, each file's dates are read by the one format that most of them fit; ``dates`` tells
which, and whether another would fit as well.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.amounts import parse_amount, parse_number
from ..functions.dates import elect_formats, parse_date, parse_date_as, supported
from ..functions.identity import hash_id
from ..functions.text import capitalize, trim_ws
from ..schemas import RAW_TXN
from ..session import local_table, settled
from . import xlsx_cells
from .config import TARGETS, AccountConfig
from .records import FIELD, file_lines, kept, leaves_open, number_records, with_steps

# Texts the pandas readers take as missing.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# What both readers deliver per data row; the header positions are zero-based, NULL when absent.
_ROW = ["path", "bank", "account", "cells", "days", "reason", "at_fecha", "at_concepto", "at_importe",
        "at_extra", "at_status"]


@dataclass
class StatementBatch:
    """``transactions`` has the canonical columns plus bank, account and path; ``files`` one row
    per file: path, bank, account, status, n_rows. Status is ``loaded``, ``empty`` or the problem.
    ``dates`` has the elected format of each file whose settings state none: path, date_format, n_texts,
    n_fit, ambiguous."""

    transactions: DataFrame
    files: DataFrame
    dates: DataFrame


def _folder_name(name: Column, kind: str) -> Column:
    """Folders may be named as Spark names those of a partitioned table."""
    return F.when(name.startswith(f"{kind}=") & (name != f"{kind}="), name.substr(F.lit(len(kind) + 2), F.length(name))).otherwise(name)


def _located(df: DataFrame, uri: str = "_metadata.file_path") -> DataFrame:
    """Add path, bank and account (empty if there are none) from the file's encoded address.

    Every line of a file pays for this, so the path is cut once and no regular expression runs over it.
    """
    df = once(df, path=F.url_decode(F.replace(F.col(uri), F.lit("+"), F.lit("%2B"))))
    df = once(df, _parts=F.reverse(F.split("path", "/")))

    def part(i: int) -> Column:
        return F.coalesce(F.get("_parts", F.lit(i)), F.lit(""))

    pending = (part(1) == "PENDING") & (part(2) != "") & (part(3) != "")
    bank, account = (F.when(pending, part(i + 1)).otherwise(part(i)) for i in (2, 1))
    df = once(df, _bank=bank, _account=account, _whole=(part(0) != "") & (part(1) != "") & (part(2) != ""))
    columns = {k: F.when(F.col("_whole"), _folder_name(F.col(f"_{k}"), k)).otherwise("") for k in ("bank", "account")}
    return once(df, **columns).drop("_parts", "_bank", "_account", "_whole")


def config_frame(spark: SparkSession, configs: Sequence[AccountConfig]) -> DataFrame:
    """One row per configured account; as small as the settings document."""
    rows = [
        (
            c.bank, c.account, c.skip_rows, c.skip_footer,
            [n for n, _ in c.column_mapping], [t for _, t in c.column_mapping], list(c.positional),
            *[c.header_name(t) for t in TARGETS],
            list(c.extra_required), c.status_column, c.status_value,
            c.date_format, c.plain_numbers, c.entidad, c.origen,
        )
        for c in configs
    ]
    return local_table(spark, rows, (
        "bank string, account string, skip_rows int, skip_footer int, sources array<string>,"
        "targets array<string>, positional array<string>, src_fecha string, src_concepto string,"
        "src_importe string, extra array<string>, status_column string, status_value string,"
        "date_format string, plain_numbers boolean, entidad_label string, origen_label string"
    ))


def _pieces(c: Column) -> Column:
    return F.regexp_extract_all(F.concat(F.lit(","), c), F.lit(f",{FIELD}"), 0)


def split_record(c: Column) -> Column:
    """Fields of one CSV record; only records with quotes pay for the regular expression."""
    def unquote(piece: Column) -> Column:
        inner = piece.substr(F.lit(3), F.length(piece) - 3)
        plain = piece.endswith('"') & ~inner.contains('"')
        general = F.regexp_replace(piece, r'(?s)^,"((?:[^"]++|"")*+)"(.*)$', "$1$2")
        return (
            F.when(~piece.startswith(',"'), piece.substr(F.lit(2), F.length(piece)))
            .when(plain, inner)
            .otherwise(F.replace(general, F.lit('""'), F.lit('"')))
        )

    return F.when(c.contains('"'), F.transform(_pieces(c), unquote)).otherwise(F.split(c, ","))


def _field_count(c: Column) -> Column:
    commas = F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))
    return F.when(c.contains('"'), F.size(_pieces(c))).otherwise(commas + 1)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns computed once per row.

    A generator over a single struct is a wall for the optimizer, which would otherwise repeat an
    expression in every filter and projection that uses it.
    """
    added = F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*[c for c in df.columns if c not in columns], added)


def _is_blank(c: Column) -> Column:
    return trim_ws(c) == ""


def _position(header: Column, *names: Column) -> Column:
    """Zero-based place of the first of the names that the header has, else NULL."""
    return F.coalesce(*[F.nullif(F.array_position(header, n), F.lit(0)) for n in names]).cast("int") - 1


def _with_header(rows: DataFrame, header: Column) -> DataFrame:
    """Resolve the configured columns against the header and judge it."""
    has_names = F.size("positional") > 0
    rows = rows.withColumn("header", F.when(has_names, F.col("positional")).otherwise(header))
    places = {f"at_{t}": _position(F.col("header"), F.col(f"src_{t}"), F.lit(t)) for t in TARGETS}
    places["at_extra"] = F.transform("extra", lambda n: F.array_position("header", n).cast("int") - 1)
    places["at_status"] = _position(F.col("header"), F.col("status_column"))
    rows = rows.withColumns(places)
    mapped = F.forall(
        F.arrays_zip("sources", "targets"),
        lambda p: F.array_contains("header", p["sources"]) | F.array_contains("header", p["targets"]),
    )
    complete = mapped & F.forall("extra", lambda n: F.array_contains("header", n))
    for t in TARGETS:
        complete = complete & F.col(f"at_{t}").isNotNull()
    return rows.withColumn("header_reason", F.when(
        (F.size("sources") == 0) & ~has_names, "no_column_mapping",
    ).when(F.col("header").isNull(), "empty").when(~F.coalesce(complete, F.lit(False)), "missing_columns"))


def _metadata_filter(csv: bool) -> Column:
    """Whether the suffix (the last dot behind another character, and what follows) has ``csv`` in it."""
    name = F.col("_metadata.file_name")
    last = F.substring_index(name, ".", -1)
    before = name.substr(F.lit(1), F.length(name) - F.length(last) - 1)
    told = (last != "") & (before != "") & ~before.endswith(".") & F.lower(last).contains("csv")
    return told if csv else ~told


def rows_from_records(records: DataFrame, config: DataFrame) -> DataFrame:
    """Data rows of statement records; ``records`` has path, bank, account, value, line_no, total."""
    skips = config.select("bank", "account", "skip_rows", "skip_footer")
    records = records.join(F.broadcast(skips), ["bank", "account"])
    usable = (F.col("line_no") >= F.col("skip_rows")) & ~_is_blank(F.col("value"))
    in_data = F.col("line_no") < F.col("total") - F.col("skip_footer")
    # One row per file, reduced in the map tasks already. A quote that never closes holds the rest of a file.
    files = records.groupBy("path", "bank", "account").agg(
        F.min(F.when(usable, F.struct("line_no", "value"))).alias("head"),
        F.max(F.when(usable & in_data, _field_count(F.col("value")))).alias("widest"),
        F.max(leaves_open(F.col("value"))).alias("open_quote"),
        F.min(F.is_valid_utf8("value")).alias("utf8"),
    ).join(F.broadcast(config), ["bank", "account"])
    files = _with_header(files, split_record(F.col("head.value"))).withColumns({
        "head_no": F.when(F.size("positional") > 0, F.col("skip_rows") - 1).otherwise(F.col("head.line_no")),
        "reason": F.coalesce(
            F.when(~F.col("utf8"), "not_utf8"),
            F.when(F.col("open_quote"), "unclosed_quote"),
            "header_reason",
            F.when(F.col("widest") > F.size("header"), "ragged_rows"),
        ),
        "cells": F.lit(None).cast("array<string>"),
        "days": F.lit(None).cast("array<string>"),
    })
    files = settled(files.select("path", "head_no", *[c for c in _ROW if c != "path"]))
    accepted = files.where(F.col("reason").isNull()).select(
        "path", "head_no", "reason", *[c for c in _ROW if c.startswith("at_")]
    )
    body = records.where(usable & in_data).join(accepted, "path").where(F.col("line_no") > F.col("head_no"))
    rows = body.withColumn("days", F.lit(None).cast("array<string>"))
    rows = once(rows.select("value", *[c for c in _ROW if c != "cells"]), cells=split_record(F.col("value")))
    # Every file also keeps one row without cells, to be reported by.
    return rows.select(*_ROW).unionByName(files.select(*_ROW))


def _csv(spark: SparkSession, root, config: DataFrame) -> DataFrame:
    """Files of any size, read once."""
    known = config.select("bank", "account").distinct()
    lines = _located(file_lines(spark, root, _metadata_filter(True)), "file").drop("file")
    lines = kept(with_steps(lines.join(F.broadcast(known), ["bank", "account"], "left_semi")), "statement-lines")
    return rows_from_records(kept(number_records(lines), "statement-records"), config)


def _read_workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["path", "bank", "account", "found", "cells", "days", "problem"]
    for files in batches:
        for file in files.itertuples(index=False):
            place = (file.path, file.bank, file.account)
            found, seen, chunk, waiting, problem = None, 0, [], deque(), None
            try:
                for cells, days in xlsx_cells.sheet_rows(file.content):
                    seen += 1
                    if seen <= file.skip_rows:
                        continue
                    if found is None and not file.positional:
                        found = cells
                        continue
                    # The last ``skip_footer`` rows are held back and so never released.
                    waiting.append((*place, found, cells, days, None))
                    if len(waiting) > file.skip_footer:
                        chunk.append(waiting.popleft())
                    if len(chunk) == 5000:
                        yield pd.DataFrame(chunk, columns=columns)
                        chunk = []
            except Exception:  # any damage means the same: not a workbook we can read
                problem = "unreadable"
            chunk.append((*place, found, None, None, problem))
            yield pd.DataFrame(chunk, columns=columns)


def _workbooks(spark: SparkSession, root, config: DataFrame) -> DataFrame:
    """First sheets of workbooks, parsed once, one workbook at a time in a task."""
    cloudpickle.register_pickle_by_value(xlsx_cells)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    files = _located(
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .where(_metadata_filter(False)).select("content", "_metadata")
    ).join(F.broadcast(config), ["bank", "account"])
    files = files.select(
        "path", "bank", "account", "content", "skip_rows", "skip_footer",
        (F.size("positional") > 0).alias("positional"),
    )
    parsed = files.mapInPandas(_read_workbooks, (
        "path string, bank string, account string, found array<string>, cells array<string>,"
        "days array<string>, problem string"
    ))
    parsed = kept(parsed, "statement-sheets")
    rows = _with_header(parsed.join(F.broadcast(config), ["bank", "account"]), F.col("found"))
    return rows.withColumn("reason", F.coalesce("problem", "header_reason")).select(*_ROW)


def _cell(place: Column, column: str = "cells") -> Column:
    """Text of a row's cell; missing texts are NULL."""
    value = F.get(column, place)
    return F.when(~value.isin(*NA_TEXTS), value)


def file_dates(rows: DataFrame, config: DataFrame) -> DataFrame:
    """The elected date format of each file whose settings state none."""
    unstated = config.where(F.col("date_format").isNull()).select("bank", "account")
    texts = rows.join(F.broadcast(unstated), ["bank", "account"], "left_semi").where(F.col("reason").isNull())
    return elect_formats(texts.select("path", _cell(F.col("at_fecha")).alias("text")).where(F.col("text").isNotNull()), ["path"], "text")


def normalize(rows: DataFrame, config: DataFrame, formats: Sequence[str | None], dates: DataFrame | None = None) -> DataFrame:
    """Canonical columns of data rows, with ``valid`` telling whether a row counts.

    ``formats`` are the date formats that occur in the settings, ``dates`` the elected ones of files without.
    """
    if dates is not None:
        rows = rows.join(dates.select("path", F.col("date_format").alias("elected")), "path", "left")
    settings = config.select(
        "bank", "account", "date_format", "plain_numbers", "entidad_label", "origen_label", "status_value",
    )
    rows = rows.join(F.broadcast(settings), ["bank", "account"])
    day_text = _cell(F.col("at_fecha"))
    day = F.lit(None).cast("date")
    unknown = [fmt for fmt in dict.fromkeys(formats) if fmt is not None and not supported(fmt)]
    if unknown:  # only the accounts that ask for such a format are rejected
        rows = rows.withColumn("reason", F.coalesce("reason", F.when(F.col("date_format").isin(unknown), "unknown_date_format")))
    for fmt in dict.fromkeys(formats):
        if fmt in unknown:
            continue
        if fmt is None:
            if dates is not None:
                day = F.when(F.col("date_format").isNull(), parse_date_as(day_text, F.col("elected"))).otherwise(day)
        else:
            day = F.when(F.col("date_format") == fmt, parse_date(day_text, fmt)).otherwise(day)
    amount_text = _cell(F.col("at_importe"))
    amount = F.when(F.col("plain_numbers"), parse_number(amount_text)).otherwise(parse_amount(amount_text))
    rows = once(
        rows,
        fecha=F.coalesce(F.get("days", F.col("at_fecha")), day.cast("string")),
        concepto=_cell(F.col("at_concepto")),
        importe=amount,
        entidad=F.coalesce("entidad_label", capitalize(F.col("bank"))),
        origen=F.coalesce("origen_label", capitalize(F.col("account"))),
    )
    filled = F.forall("at_extra", lambda place: _cell(place).isNotNull())
    in_state = F.col("status_value").isNull() | F.coalesce(
        F.get("cells", F.col("at_status")) == F.col("status_value"), F.lit(False)
    )
    return rows.withColumn(
        "valid",
        F.col("reason").isNull() & F.col("fecha").isNotNull() & F.col("concepto").isNotNull()
        & F.col("importe").isNotNull() & F.coalesce(filled, F.lit(False)) & in_state,
    )


def batch_of(
    rows: DataFrame, config: DataFrame, configs: Sequence[AccountConfig], keep: Callable[[DataFrame], DataFrame] | None = None,
) -> StatementBatch:
    """Transactions and file report of data rows from any of the readers.

    ``keep`` may write the parsed rows and return what it wrote; both results are then taken from that.
    """
    formats = [c.date_format for c in configs]
    dates = file_dates(rows, config)
    if None in formats:
        dates = settled(dates)
    normal = normalize(rows, config, formats, dates if None in formats else None)
    if keep:
        normal = keep(normal.select(
            "path", "bank", "account", "reason", "valid", *[c for c in RAW_TXN.names if c != "hash_id"]))
    transactions = normal.where("valid").withColumn(
        "hash_id", hash_id(F.col("fecha"), F.col("concepto"), F.col("importe"))
    ).select(*RAW_TXN.names, "bank", "account", "path")
    files = normal.groupBy("path", "bank", "account").agg(
        F.max("reason").alias("reason"), F.count_if("valid").alias("n_rows"),
    ).select("path", "bank", "account", F.coalesce(
        "reason", F.when(F.col("n_rows") == 0, "empty"), F.lit("loaded"),
    ).alias("status"), "n_rows")
    return StatementBatch(transactions, files, dates)


def read_statements(
    spark: SparkSession, root: str | list[str], configs: Sequence[AccountConfig],
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> StatementBatch:
    """All statements under ``root`` (or the given files) that have settings; ``keep`` as in ``batch_of``."""
    config = config_frame(spark, configs)
    rows = _csv(spark, root, config).unionByName(_workbooks(spark, root, config))
    batch = batch_of(rows, config, configs, keep)
    # A file without a byte is in no scan at all. The listing that Spark holds on the driver has it.
    held = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).inputFiles()
    listed = local_table(spark, [(uri,) for uri in held], "uri string").withColumn(
        "uri", F.regexp_replace("uri", "^file:/+", "file:/"))  # as the readers' metadata spell it
    listed = _located(listed, "uri").select("path", "bank", "account")
    listed = listed.join(F.broadcast(config.select("bank", "account").distinct()), ["bank", "account"], "left_semi")
    files = listed.join(batch.files.drop("bank", "account"), "path", "left").select(
        "path", "bank", "account", F.coalesce("status", F.lit("empty")).alias("status"),
        F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"))
    return StatementBatch(batch.transactions, files, batch.dates)
