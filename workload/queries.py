"""One query per operator over the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerlake.functions import (
    capitalize, date_parts, exact_cents_text, fold, initcap_words, parse_amount, parse_date,
    parse_date_any, parse_number, path_parts, split_packed, strip_fences, trim_ws,
)
from ledgerlake.functions.dates import elect_formats, parse_date_as
from ledgerlake.operators import flags, incremental, maintenance, metrics, quality, rules
from ledgerlake.plans import gold, silver
from ledgerlake.plans.lakehouse import Lakehouse
from ledgerlake.schemas import MASTER_RULES, TXN
from ledgerlake.session import ensure_checkpoint_dir
from ledgerlake.sources import config as config_source, raw, statements, tables

from . import data
from .data import HOUSE, bronze_slice, movements, table, txn

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CUT, OVERLAP = "1997-01-01", "1996-07-01"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Sources and projections

@query
def scan_bronze(spark, d):
    return raw.bronze_rows(movements(spark, d).withColumn("fecha", F.col("fecha").cast("string")))


@query
def union_sources(spark, d):
    df = movements(spark, d)
    return silver.union_sources(bronze_slice(df, name) for name in data.SLICES)


@query
def hash_identity(spark, d):
    return movements(spark, d).select("hash_id", "fecha", "concepto", "importe")


@query
def money_text(spark, d):
    x = F.when(F.col("l_orderkey") % 2 == 0, F.col("l_quantity") * 0.125).otherwise(
        F.col("l_quantity") * F.col("l_discount") * -0.5)
    return table(spark, d, "lineitem").select("l_orderkey", x.alias("x")).select(
        "l_orderkey", "x", exact_cents_text(F.col("x")).alias("text"))


def _cash_sheet(spark, d) -> DataFrame:
    odd = F.get(F.array(*map(F.lit, ("12d", "NaN", "inf", "1e400", "1f"))), F.dayofmonth("fecha") - 1)
    return bronze_slice(txn(spark, d), "cash").select(
        F.when(F.dayofmonth("fecha") == 31, "n/a").when(F.dayofmonth("fecha") == 29, F.year("fecha").cast("string")).when(F.dayofmonth("fecha") != 30, F.col("fecha").cast("string")).alias("fecha"),
        F.concat(F.lit("\t "), "concepto", F.lit(" ")).alias("concepto"),
        F.when(F.col("importe") > 50000, "mucho").when(F.dayofmonth("fecha") <= 5, odd).when(F.col("importe") > -50000, F.col("importe").cast("string")).alias("importe"),
    )


@query
def cash_normalize(spark, d):
    return raw.normalize_cash(_cash_sheet(spark, d))


def _amount_text():
    price, style = F.col("l_extendedprice"), F.col("l_orderkey") % 7
    thousands = F.floor(price / 1000).cast("string")
    rest = F.lpad((F.floor(price) % 1000).cast("long").cast("string"), 3, "0")
    return (
        F.when(style == 0, price.cast("string"))
        .when(style == 1, F.replace(price.cast("string"), F.lit("."), F.lit(",")))
        .when(style == 2, F.concat(thousands, F.lit("."), rest, F.lit(",50")))
        .when(style == 3, F.concat(thousands, F.lit(","), rest, F.lit(".25")))
        .when(style == 4, F.concat(F.lit(" -"), thousands, F.lit("."), rest, F.lit(" ")))
        .when(style == 5, F.concat(thousands, F.lit("."), rest, F.lit(".000")))
        .otherwise(F.concat(price.cast("string"), F.lit(" EUR")))
    )


@query
def amount_parse(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", _amount_text().alias("text"))
    return df.withColumn("importe", parse_amount(F.col("text")))


@query
def number_parse(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", _amount_text().alias("text"))
    return df.withColumn("importe", parse_number(F.col("text")))


def _day_text():
    day, style = F.col("o_orderdate"), F.col("o_orderkey") % 4
    return (
        F.when(style == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(style == 1, F.concat_ws("/", F.dayofmonth(day), F.month(day), F.year(day)))
        .when(style == 2, F.concat_ws("/", F.lit("31"), F.month(day), F.year(day)))
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    )


@query
def date_parse(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", _day_text().alias("text"))
    return df.withColumns({
        "by_day": parse_date(F.col("text"), "%d/%m/%Y"),
        "by_stamp": parse_date(F.col("text"), "%Y-%m-%d %H:%M:%S"),
    })


@query
def date_infer(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", _day_text().alias("text"))
    return df.withColumn("fecha", parse_date_any(F.col("text"), ("%Y-%m-%d %H:%M:%S", "%d/%m/%Y")))


@query
def date_election(spark, d):
    """Texts of forty groups, each read by the format that most texts of its group fit."""
    formats = ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y")
    day, grp = F.col("o_orderdate"), F.col("o_custkey") % 40
    iso, day_first = F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "dd/MM/yyyy")
    text = (
        F.when(grp % 5 == 0, day_first).when(grp % 5 == 1, F.date_format(day, "MM/dd/yyyy")).when(grp % 5 == 2, iso)
        .when(grp % 5 == 3, F.concat_ws("/", F.dayofmonth(day) % 12 + 1, F.month(day), F.year(day)))
        .otherwise(F.when(F.col("o_orderkey") % 3 == 0, iso).otherwise(day_first))
    )
    df = table(spark, d, "orders").select("o_orderkey", grp.alias("grp"), text.alias("text"))
    told = elect_formats(df, ["grp"], "text", formats).select("grp", "date_format", "ambiguous")
    return df.join(told, "grp").withColumn("fecha", parse_date_as(F.col("text"), F.col("date_format"), formats))


@query
def capitalize_names(spark, d):
    name = F.concat_ws(" ", "c_mktsegment", "c_name")
    return table(spark, d, "customer").select("c_custkey", capitalize(name).alias("entidad"))


@query
def initcap_text(spark, d):
    text = F.replace("text", F.lit("ß"), F.lit("ss"))
    return data.documents(spark, d).select("doc_id", initcap_words(text).alias("title"))


@query
def accent_fold(spark, d):
    text = F.replace("text", F.lit("ß"), F.lit("ss"))
    return data.documents(spark, d).select("doc_id", fold(text).alias("folded"))


@query
def trim_unicode(spark, d):
    padded = F.concat(F.lit("\t\u00a0 "), "p_name", F.lit(" \u2003 "), "p_type", F.lit("\u3000\n"))
    return table(spark, d, "part").select("p_partkey", trim_ws(padded).alias("text"))


@query
def file_parts(spark, d):
    ending = (
        F.when(F.col("doc_id") % 4 == 0, ".CSV").when(F.col("doc_id") % 4 == 1, ".tar.Xlsx")
        .when(F.col("doc_id") % 4 == 2, "").otherwise(".csv2")
    )
    path = F.concat(F.lit("/in.box/"), "source", F.lit("/"), "lang", F.lit("/doc_"), F.col("doc_id").cast("string"), ending)
    name, stem, suffix = path_parts(path)
    return table(spark, d, "documents").select(
        "doc_id", name.alias("name"), stem.alias("stem"), suffix.alias("suffix"), suffix.contains("csv").alias("is_csv"),
    )


@query
def rename_project(spark, d):
    names = {"o_orderdate": "fecha", "o_orderpriority": "concepto", "o_totalprice": "importe", "no_such": "x"}
    return table(spark, d, "orders").withColumnsRenamed(names).select(
        F.col("fecha").cast("date").alias("fecha"), "concepto", "importe", F.lit("Banco").alias("entidad"))


@query
def drop_null_critical(spark, d):
    df = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate").cast("date")).alias("fecha"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("concepto"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("importe"),
    )
    return df.na.drop(subset=["fecha", "concepto", "importe"])


@query
def split_packed_parts(spark, d):
    packed = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.concat_ws("|", "p_brand", "p_type", F.lit(""), "p_name"))
    return table(spark, d, "part").select("p_partkey", *[split_packed(packed, i).alias(f"part_{i}") for i in range(5)])


@query
def date_dims(spark, d):
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in date_parts(day).items()])


# Statements

CONFIGS = tuple(
    config_source.AccountConfig(
        bank, account, (("FECHA", "fecha"), ("TEXTO", "concepto"), ("IMPORTE", "importe")), 2, 1, "%d/%m/%Y")
    for bank, account in (("BANK1", "ACCOUNT"), ("BANK1", "CARD"), ("BANK1", "SHARED"), ("CAJA", "CASH"))
)
_LAST = 1 << 62


_FRAME = (
    (0, "Listado de movimientos"), (1, ""), (2, ""), (3, "FECHA,TEXTO,IMPORTE"), (4, "31/02/2024,imposible,1"),
    (5, "01/02/2024,NA,1"), (_LAST, "TOTAL,,0"),
)
# Account, line number and text of lines that spoil a statement.
_DEFECTS = (
    ("ACCOUNT", 3, "FECHA,IMPORTE"), ("CARD", 6, "01/02/2024,uno,1,de más"), ("SHARED", 6, '01/02/2024,"abierto,1'),
)


def _statement_lines(spark, d, defects: bool = False) -> DataFrame:
    """The movements printed as CSV statements with title lines, a header and a total line."""
    df = txn(spark, d)
    bank, account = F.upper("entidad"), F.upper("origen")
    path = F.concat(F.lit("/in/"), bank, F.lit("/"), account, F.lit("/all.csv"))
    line = F.concat(
        F.dayofmonth("fecha"), F.lit("/"), F.date_format("fecha", "MM/yyyy"), F.lit(',"'), "concepto", F.lit(', ""x""",'),
        F.concat(F.lit('"'), F.replace(F.col("importe").cast("string"), F.lit("."), F.lit(",")), F.lit('"')),
    )
    data_lines = df.select(
        path.alias("path"), bank.alias("bank"), account.alias("account"), line.alias("value"),
        (F.monotonically_increasing_id() + 10).alias("line_no"),
    )
    source = table(spark, d, "supplier").select((F.col("s_suppkey") % 5).alias("n")).distinct()
    files = source.select(
        F.when(F.col("n") <= 2, "BANK1").when(F.col("n") == 3, "BANK2").otherwise("CAJA").alias("bank"),
        F.when(F.col("n") == 1, "CARD").when(F.col("n") == 2, "SHARED").when(F.col("n") == 4, "CASH").otherwise("ACCOUNT").alias("account"),
    )

    def text(number: int, default: str):
        c = F.lit(default)
        for name, at, spoiled in _DEFECTS if defects else ():
            if at == number:
                c = F.when(F.col("account") == name, spoiled).otherwise(c)
        return c

    frame = F.inline(F.array(*[
        F.struct(text(n, line).alias("value"), F.lit(n).cast("long").alias("line_no")) for n, line in (*_FRAME, (6, ""))
    ]))
    around = files.select(
        F.concat(F.lit("/in/"), "bank", F.lit("/"), "account", F.lit("/all.csv")).alias("path"), "bank", "account", frame)
    return data_lines.unionByName(around).withColumn("total", F.lit(_LAST + 1))


def _statements(lines: DataFrame, configs=CONFIGS) -> statements.StatementBatch:
    config = statements.config_frame(lines.sparkSession, configs)
    return statements.batch_of(statements.rows_from_records(lines, config), config, configs)


@query
def csv_statement(spark, d):
    return _statements(_statement_lines(spark, d)).transactions


@query
def statement_report(spark, d):
    return _statements(_statement_lines(spark, d)).files


@query
def statement_defects(spark, d):
    return _statements(_statement_lines(spark, d, defects=True)).files


def _folder(spark, name: str) -> str:
    """A new folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def _write_statements(spark, d) -> str:
    """The movements as files, several for each account, some with a line break within a text."""
    df = txn(spark, d)
    many = max(8, table(spark, d, "lineitem").rdd.getNumPartitions())
    bank, account = F.upper("entidad").alias("bank"), F.upper("origen").alias("account")
    text = F.concat("concepto", F.when(F.dayofmonth("fecha") == 7, ',\n ""x""').otherwise(', ""x""'))
    line = F.concat(
        F.dayofmonth("fecha"), F.lit("/"), F.date_format("fecha", "MM/yyyy"), F.lit(',"'), text,
        F.lit('","'), F.replace(F.col("importe").cast("string"), F.lit("."), F.lit(",")), F.lit('"'))
    rows = df.select(
        bank, account, F.pmod(F.xxhash64("fecha", "concepto", "importe"), F.lit(many)).cast("int").alias("file"),
        (F.monotonically_increasing_id() + 10).alias("n"), F.split(line, "\n").alias("lines"))
    frame = F.inline(F.array(*[
        F.struct(F.lit(n).cast("long").alias("n"), F.array(F.lit(t or " ")).alias("lines")) for n, t in _FRAME]))
    around = df.select(bank, account).distinct().withColumn("file", F.explode(F.sequence(F.lit(0), F.lit(many - 1))))
    lines = rows.unionByName(around.select("bank", "account", "file", frame)).select(
        "bank", "account", "file", "n", F.posexplode("lines").alias("part", "value"))
    root = _folder(spark, "statements")
    # A task holds one file of each account and writes it in order.
    (
        lines.repartitionById(many, F.col("file")).sortWithinPartitions("bank", "account", "n", "part")
        .select("bank", "account", "value").write.partitionBy("bank", "account")
        .options(sep="\u0001", quote="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(root)
    )
    return root


@query
def statement_files(spark, d):
    """Statements read from files, as a directory scan finds them."""
    return statements.read_statements(spark, _write_statements(spark, d), CONFIGS).transactions.drop("path")


@query
def landing_zone(spark, d):
    """Movements through the landing zone's JSON lines and back into bronze columns."""
    rows = movements(spark, d).select(
        "*", F.upper("entidad").alias("bank"), F.upper("origen").alias("account"),
        F.concat(F.lit("/in/"), F.date_format("fecha", "yyyy"), F.lit(".csv")).alias("path"))
    root = _folder(spark, "landing")
    raw.write_raw(rows.withColumn("fecha", F.col("fecha").cast("string")), root)
    return raw.bronze_rows(raw.read_raw(spark, root))


@query
def cash_files(spark, d):
    """The cash sheet through CSV files."""
    root = _folder(spark, "cash")
    _cash_sheet(spark, d).write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(root)
    return raw.normalize_cash(raw.read_cash(spark, root))


@query
def seed_files(spark, d):
    """Rules through seed files, then in matching form."""
    root = _folder(spark, "seed")
    raw.write_seed(data.part_rules(spark, d), root)
    prepared = rules.prepare_rules(raw.read_seed(spark, root, MASTER_RULES), F.col("entity_name"))
    return prepared.withColumnRenamed("value", "entity_name")


@query
def positional_statement(spark, d):
    """Sheets without a header: columns by position, plain decimals, labels from the settings."""
    layout = config_source.AccountConfig(
        "BANK1", "CARD", (), 6, 1, "%d/%m/%Y", ("fecha", "concepto", "importe"), ("concepto",), True, "banco uno", "tarjeta")
    lines = _statement_lines(spark, d).where("account = 'CARD'")
    plain = F.regexp_replace("value", r'"(-?\d+),(\d+)"$', "$1.$2")
    return _statements(lines.withColumn("value", plain), [layout]).transactions


@query
def config_explode(spark, d):
    key = F.col("s_suppkey")
    text = F.format_string(
        '{"BANK_%d": {"ACCOUNT": {"skip_rows": %d, "skip_footer": 0, "date_format": "%%d/%%m/%%Y", '
        '"column_mapping": {"FECHA": "fecha", "IMPORTE %d": "importe"}}, '
        '"CARD": {"skip_rows": 4, "filter_completed": true, "column_mapping": {"A": "fecha"}}}}',
        key, key % 9, key % 3)
    rows = config_source.config_rows(F.col("doc"), table(spark, d, "supplier").select(text.alias("doc")))
    return rows.withColumn("column_mapping", F.array_join(F.array_sort(F.map_keys("column_mapping")), ","))


@query
def config_semi_join(spark, d):
    settings = table(spark, d, "supplier").where(F.col("s_suppkey") % 3 == 0).select(
        F.concat(F.lit("BANK_"), F.col("s_nationkey").cast("string")).alias("bank"), F.lit("ACCOUNT").alias("account"))
    files = table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("BANK_"), F.col("c_nationkey").cast("string")).alias("bank"),
        F.when(F.col("c_custkey") % 4 == 0, "CARD").otherwise("ACCOUNT").alias("account"))
    return config_source.configured_only(files, settings).select("c_custkey", "bank", "account")


@query
def ingest_metrics(spark, d):
    rows = txn(spark, d).select(
        F.col("entidad").alias("bank"), F.col("origen").alias("account"), F.date_format("fecha", "yyyy-MM").alias("path"))
    return metrics.ingest_metrics(rows)


# Rules

@query
def rules_prepare(spark, d):
    prepared = rules.prepare_rules(data.part_rules(spark, d), F.col("entity_name"))
    return prepared.withColumnRenamed("value", "entity_name")


def _class_columns(df: DataFrame) -> DataFrame:
    return df.select("hash_id", "importe", *[F.col(f"clase.{n}").alias(n) for n in rules.CLASS_FIELDS])


@query
def classify_rules(spark, d):
    return _class_columns(rules.classify(movements(spark, d), data.master_rules(spark)))


@query
def classify_one_pass(spark, d):
    return _class_columns(rules.classify(movements(spark, d), data.master_rules(spark), strategy="automaton"))


@query
def classify_part_rules(spark, d):
    return _class_columns(rules.classify(movements(spark, d), data.part_rules(spark, d)))


@query
def classify_anchored(spark, d):
    return _class_columns(rules.classify(movements(spark, d), data.part_rules(spark, d), strategy="anchored"))


@query
def classify_fallback(spark, d):
    return txn(spark, d).select("fecha", "concepto", "importe", rules.fallback_class(F.col("importe")).alias("c")).select(
        "fecha", "concepto", "importe", "c.*")


@query
def standardize_entity(spark, d):
    df = movements(spark, d).select("hash_id", "concepto")
    return rules.standardize_entity(df, data.entity_rules(spark), F.upper("concepto"))


@query
def map_category(spark, d):
    df = movements(spark, d).select("hash_id", "concepto")
    return rules.map_category(df, data.category_rules(spark), F.lit("Otros"))


@query
def rule_conflicts(spark, d):
    return rules.rule_conflicts(data.part_rules(spark, d))


@query
def category_taxonomy(spark, d):
    return rules.category_taxonomy(data.part_rules(spark, d))


@query
def ragged_pad(spark, d):
    padded = maintenance.pad_cells(F.split("text", " "), 8)
    return table(spark, d, "conversations").select(
        "conv_id", "turn", F.array_join(padded, "|").alias("cells"), F.size(padded).alias("width"))


@query
def sync_rules(spark, d):
    key = F.col("p_partkey")
    padded_name = F.concat(F.lit(" "), "p_name", F.lit(" "))
    size = F.when(key % 5 == 0, "alta").when(key % 5 == 1, F.concat(F.col("p_size").cast("string"), F.lit(".7"))).otherwise(F.col("p_size").cast("string"))
    cells = (
        F.when(key % 3 == 0, F.array(padded_name)).when(key % 3 == 1, F.array(padded_name, size, "p_type"))
        .otherwise(F.array(padded_name, size, "p_type", "p_brand", F.lit("sobra")))
    )
    sheet = table(spark, d, "part").select("p_partkey", cells.alias("cells"))
    return maintenance.sync_rules(sheet, ("keyword", "priority", "grupo_categoria", "categoria"))


def _answers(spark, d) -> DataFrame:
    text = F.concat(
        F.lit("```csv\nkeyword,priority,grupo_categoria,categoria,subcategoria,entity_name\n"),
        F.upper("p_name"), F.lit(","), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")).otherwise("?"),
        F.lit(",Gastos Fijos,"), "p_type", F.lit(","), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_brand")),
        F.lit(',"Casa, '), "p_name", F.lit('"\n```\n'))
    return table(spark, d, "part").select("p_partkey", text.alias("text"))


@query
def fence_strip(spark, d):
    return _answers(spark, d).select("p_partkey", strip_fences(F.col("text")).alias("text"))


@query
def suggestions_clean(spark, d):
    return maintenance.parse_suggestions(_answers(spark, d))


@query
def suggestions_check(spark, d):
    taxonomy = rules.category_taxonomy(data.part_rules(spark, d))
    return maintenance.check_suggestions(maintenance.parse_suggestions(_answers(spark, d)), taxonomy)


# Flags

@query
def internal_operation(spark, d):
    return txn(spark, d).withColumn("operativa_interna", flags.internal_operation(HOUSE))


def _labelled(spark, d) -> DataFrame:
    return movements(spark, d).withColumn("operativa_interna", flags.internal_operation(HOUSE))


@query
def shared_flag(spark, d):
    return _labelled(spark, d).select("hash_id", "origen", "operativa_interna", flags.is_shared(HOUSE).alias("es_compartido"))


@query
def personal_amount(spark, d):
    return _labelled(spark, d).select("hash_id", "importe", flags.personal_amount(HOUSE).alias("importe_personal"))


@query
def real_movement_flag(spark, d):
    return _labelled(spark, d).select("hash_id", "operativa_interna", flags.is_real_movement(HOUSE).alias("es_movimiento_real"))


# Incremental loading

def _stored_and_batch(spark, d) -> tuple[DataFrame, DataFrame]:
    df = movements(spark, d)
    return df.where(F.col("fecha") < CUT), df.where(F.col("fecha") >= OVERLAP)


@query
def incremental_new_rows(spark, d):
    stored, batch = _stored_and_batch(spark, d)
    return incremental.new_rows(batch, stored)


@query
def incremental_salted(spark, d):
    """As above, with a key treated as hot on both sides."""
    stored, batch = _stored_and_batch(spark, d)
    hot = [r[0] for r in batch.select(F.max("hash_id")).collect()]
    return incremental.new_rows(batch, stored, hot=hot)


@query
def not_in_null_semantics(spark, d):
    stored, batch = _stored_and_batch(spark, d)
    batch = batch.withColumn("hash_id", F.when(F.col("importe") != 0, F.col("hash_id")))
    holed = stored.withColumn("hash_id", F.when(F.col("importe") != 320, F.col("hash_id")))
    cases = {"none_stored": stored.where(F.col("fecha") < "1900-01-01"), "no_null_stored": stored, "null_stored": holed}
    left = [
        incremental.new_rows(batch, s).select(F.lit(name).alias("stored"), "hash_id", "fecha", "concepto", "importe")
        for name, s in cases.items()
    ]
    return left[0].unionByName(left[1]).unionByName(left[2])


@query
def upsert_by_key(spark, d):
    stored, batch = _stored_and_batch(spark, d)
    return incremental.upsert(stored.withColumn("entidad", F.lit("antes")), batch)


def _stored_table(spark, rows: DataFrame, name: str) -> str:
    """Movements as a table by month, under a name of its own."""
    stored = f"ledger_{uuid.uuid4().hex[:12]}.{name}"
    tables.rebuild(rows.withColumn("anio_mes", F.date_format("fecha", "yyyy-MM")), stored, ("anio_mes",))
    return stored


@query
def incremental_table(spark, d):
    """A second load into a stored table; only the months of the load are searched."""
    stored, batch = _stored_and_batch(spark, d)
    name = _stored_table(spark, stored, "movements")
    tables.append_new(batch.withColumn("anio_mes", F.date_format("fecha", "yyyy-MM")), name, partition_by=("anio_mes",), prune_by="anio_mes")
    return spark.table(name)


@query
def upsert_table(spark, d):
    """An upsert into a stored table; only the months of the batch are rewritten."""
    stored, batch = _stored_and_batch(spark, d)
    name = _stored_table(spark, stored.withColumn("entidad", F.lit("antes")), "movements")
    tables.merge(batch.withColumn("anio_mes", F.date_format("fecha", "yyyy-MM")), name, partition_by=("anio_mes",), fixed_partition=True)
    return spark.table(name)


@query
def lakehouse_totals(spark, d):
    """Two loads through all layers; the second touches only its months of the mart and the totals."""
    stored, batch = _stored_and_batch(spark, d)
    lake = Lakehouse(spark, HOUSE, prefix=f"lake_{uuid.uuid4().hex[:12]}_")
    lake.save_seed("master_mapping", data.master_rules(spark))
    lake.save_seed("manual_adjustments", data.adjustments(movements(spark, d)))
    for rows in (stored, batch):
        lake.refresh({"account": rows.withColumn("fecha", F.col("fecha").cast("string"))})
    return lake.table("gold", "monthly_spend")


@query
def schema_sync(spark, d):
    stored, batch = _stored_and_batch(spark, d)
    stored = stored.drop("origen").withColumn("nota", F.lit("vieja"))
    target = T.StructType(TXN.fields)
    return tables.align(stored, target).unionByName(batch.select(*target.names))


# Layers

def _silver(spark, d) -> DataFrame:
    return silver.enrich(movements(spark, d), data.master_rules(spark), HOUSE)


@query
def merchant_name(spark, d):
    return _silver(spark, d).select("hash_id", "concepto", "comercio")


@query
def silver_transactions(spark, d):
    return _silver(spark, d)


@query
def gold_adjustment(spark, d):
    df = _labelled(spark, d).withColumn("importe_personal", flags.personal_amount(HOUSE))
    return gold.adjust(df, data.adjustments(movements(spark, d))).select("hash_id", "importe", "operativa_interna", "importe_personal")


@query
def gold_transactions(spark, d):
    return gold.gold_transactions(_silver(spark, d), data.adjustments(movements(spark, d)))


@query
def monthly_spend(spark, d):
    return gold.monthly_spend(gold_transactions(spark, d))


@query
def spend_rollup(spark, d):
    return gold.spend_rollup(gold_transactions(spark, d))


@query
def unclassified_concepts(spark, d):
    return maintenance.unclassified_concepts(_silver(spark, d))


@query
def unclassified_by_weight(spark, d):
    return maintenance.unclassified_by_weight(_silver(spark, d))


# Data tests

@query
def dq_unique(spark, d):
    return quality.duplicates(movements(spark, d))


@query
def dq_unique_texts(spark, d):
    return quality.duplicates(movements(spark, d), "concepto")


@query
def dq_not_null(spark, d):
    df = cash_normalize(spark, d)
    return quality.null_counts(df, df.columns)


@query
def dq_suite(spark, d):
    df = movements(spark, d)
    present = {name: bronze_slice(df, name) for name in data.SLICES if name != "cash"}
    return quality.run_tests({**present, "cash": cash_normalize(spark, d), "fct_transactions": df})
