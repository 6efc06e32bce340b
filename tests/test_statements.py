import io
import json
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import hash_id, path_parts
from ledgerlake.sources import config, raw, records, statements
from ledgerlake.sources.config import AccountConfig

from .files import write_text, write_xlsx

MAPPING = (("FECHA", "fecha"), ("TEXTO", "concepto"), ("IMPORTE", "importe"))
ACCOUNT = AccountConfig("NORTE", "ACCOUNT", MAPPING, 3, 0, "%d/%m/%Y")
CARD = AccountConfig("NORTE", "CARD", MAPPING, 1, 1, "%d/%m/%Y")
APP = AccountConfig("APP", "ACCOUNT", (("Fecha", "fecha"), ("Descripción", "concepto"), ("Importe", "importe")), 0, 0, "%Y-%m-%d %H:%M:%S")
SHEET = AccountConfig("NORTE", "SHEET", (), 4, 1, None, ("fecha_contable", "fecha", "concepto", "importe", "saldo"),
                      ("saldo",), True, "norte", "cuenta")
CONFIGS = (ACCOUNT, CARD, APP, SHEET)

ACCOUNT_CSV = (
    'Titular\n\nmás,"cosas",x,y\nFECHA,TEXTO,IMPORTE,SALDO\n1/7/2025,"Café, bar","1.234,56",1\n31/02/2025,x,1,1\n\n'
    '02/07/2025,  con espacio ,-3\n03/07/2025,NA,5,1\n04/07/2025,TV 32" x,"12,5",1\n05/07/2025,"di ""hola""",1.234.567,1\n'
    '06/07/2025,"di ""hola""",7,1\n06/07/2025,"di ""hola""",7,1\n'
)
CARD_CSV = "título\r\nTEXTO,FECHA,IMPORTE\r\nCompra,1/7/2025,-2\r\nOtra,2/7/2025,\"-1,5\"\r\nTOTAL,,-3\r\n"


@pytest.fixture(scope="module")
def inbox():
    root = tempfile.mkdtemp(prefix="ledgerlake-in-")
    write_text(f"{root}/NORTE/ACCOUNT/PENDING/enero ñ+1.csv", ACCOUNT_CSV)
    write_text(f"{root}/NORTE/CARD/PENDING/c.CSV", CARD_CSV)
    write_text(f"{root}/NORTE/CARD/missing.csv", "t\nFECHA,IMPORTE\n1/7/2025,2\nx\n")
    write_text(f"{root}/NORTE/CARD/wide.csv", "t\nFECHA,TEXTO,IMPORTE\n1/7/2025,A,2,4\nx\n")
    write_text(f"{root}/NORTE/CARD/head.csv", "t\nFECHA,TEXTO,IMPORTE\n")
    write_text(f"{root}/NORTE/CARD/latin.csv", "t\nFECHA,TEXTO,IMPORTE\n1/7/2025,ñ,2\nx\n", "latin-1")
    write_text(f"{root}/NORTE/CARD/broken.xlsx", "no zip")
    write_text(f"{root}/OTRO/CARD/x.csv", CARD_CSV)
    write_text(f"{root}/APP/ACCOUNT/app.csv", "﻿Fecha,Descripción,Importe,Estado\n2025-07-01 10:00:00,Vuelo,-99.5,HECHO\n")
    write_xlsx(f"{root}/NORTE/CARD/book.xlsx", [
        ["título"], ["FECHA", "TEXTO", "IMPORTE", None], [(45839,), "Fecha de celda", -12.5, "x"],
        ["2/7/2025", "Fecha de texto", "1.000,25"], [], ["2/7/2025", None, 5], ["TOTAL", None, 1],
    ])
    write_xlsx(f"{root}/NORTE/SHEET/sheet.xlsx", [
        ["a"], [], ["b"], ["c"], ["x", (45839,), "Uno", 1.5, 10.0], ["x", "2025-07-02", "Dos", "2.5", 10],
        ["x", "2025-07-02", "Sin saldo", 2, None], ["x", "2025-07-03", "Coma", "2,5", 10], ["x", "2025-07-04", "Última", 1, 1],
    ])
    return root


def rows_of(batch):
    return sorted(
        (r.path.rsplit("/", 1)[1], r.fecha, r.concepto, r.importe, r.entidad, r.origen) for r in batch.transactions.collect()
    )


EXPECTED = sorted([
    ("enero ñ+1.csv", "2025-07-01", "Café, bar", 1234.56, "Norte", "Account"),
    ("enero ñ+1.csv", "2025-07-02", "  con espacio ", -3.0, "Norte", "Account"),
    ("enero ñ+1.csv", "2025-07-04", 'TV 32" x', 12.5, "Norte", "Account"),
    ("enero ñ+1.csv", "2025-07-06", 'di "hola"', 7.0, "Norte", "Account"),
    ("enero ñ+1.csv", "2025-07-06", 'di "hola"', 7.0, "Norte", "Account"),
    ("c.CSV", "2025-07-01", "Compra", -2.0, "Norte", "Card"),
    ("c.CSV", "2025-07-02", "Otra", -1.5, "Norte", "Card"),
    ("app.csv", "2025-07-01", "Vuelo", -99.5, "App", "Account"),
    ("book.xlsx", "2025-07-01", "Fecha de celda", -12.5, "Norte", "Card"),
    ("book.xlsx", "2025-07-02", "Fecha de texto", 1000.25, "Norte", "Card"),
    ("sheet.xlsx", "2025-07-01", "Uno", 1.5, "norte", "cuenta"),
    ("sheet.xlsx", "2025-07-02", "Dos", 2.5, "norte", "cuenta"),
])
STATUS = {
    "enero ñ+1.csv": ("loaded", 5), "c.CSV": ("loaded", 2), "missing.csv": ("missing_columns", 0), "wide.csv": ("ragged_rows", 0),
    "head.csv": ("empty", 0), "latin.csv": ("not_utf8", 0), "broken.xlsx": ("unreadable", 0), "app.csv": ("loaded", 1),
    "book.xlsx": ("loaded", 2), "sheet.xlsx": ("loaded", 2),
}


@pytest.fixture
def tiny_splits(spark, monkeypatch):
    """Statement files are cut every few bytes, also within quoted fields; what is kept of them is not."""
    def cut(size):
        def kept(df, label):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            try:
                return records.kept(df, label)
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")

        monkeypatch.setattr(statements, "kept", kept)

    return cut


@pytest.mark.parametrize("size", [None, 40])
def test_reads_whole_and_split_files_alike(spark, inbox, tiny_splits, size):
    if size:
        tiny_splits(size)
    batch = statements.read_statements(spark, inbox, CONFIGS)
    assert rows_of(batch) == EXPECTED
    assert {r.path.rsplit("/", 1)[1]: (r.status, r.n_rows) for r in batch.files.collect()} == STATUS
    good = batch.transactions.where(F.col("hash_id") != hash_id(F.col("fecha"), F.col("concepto"), F.col("importe")))
    assert good.count() == 0


def test_agrees_with_pandas(spark, inbox):
    """Skips, blank lines, quotes and footers as pandas' Python reader counts them."""
    root = tempfile.mkdtemp(prefix="ledgerlake-in-")
    text = 'junk\n\n"a\nb",c\n\n \nFECHA,TEXTO,IMPORTE\n1/7/2025,"uno\ndos",1\n\n2/7/2025,tres,2\n3/7/2025,cuatro,3\n\n'
    for skip, footer in ((3, 0), (3, 1), (3, 2), (4, 3), (5, 99)):
        # Logical lines: the quoted break makes lines three and four one record.
        account = f"A{skip}{footer}"
        write_text(f"{root}/B/{account}/f.csv", text)
        frame = pd.read_csv(io.StringIO(text), skiprows=skip, skipfooter=footer, engine="python")
        conf = AccountConfig("B", account, MAPPING, skip, footer, "%d/%m/%Y")
        got = statements.read_statements(spark, f"{root}/B/{account}", [conf]).transactions.collect()
        assert sorted((r.concepto, r.importe) for r in got) == sorted(zip(frame["TEXTO"], frame["IMPORTE"].astype(float)))


def test_lines_are_numbered_across_splits(spark, tiny_splits):
    root = tempfile.mkdtemp(prefix="ledgerlake-in-")
    body = "".join(f"1/7/2025,mov {i},{i}\n" for i in range(3000))
    write_text(f"{root}/NORTE/CARD/big.csv", "t\nFECHA,TEXTO,IMPORTE\n" + body + "TOTAL,,1\n")
    tiny_splits(4096)
    batch = statements.read_statements(spark, root, [CARD])
    assert batch.transactions.agg(F.count("*"), F.countDistinct("concepto"), F.sum("importe")).first() == (3000, 3000, 2999 * 1500.0)


@pytest.mark.parametrize("size", [None, 11, 90])
def test_quoted_line_breaks_in_files_of_any_split(spark, tiny_splits, size):
    """Fields over many lines and splits, quotes at either end of a line, and quotes that are plain characters."""
    root = tempfile.mkdtemp(prefix="ledgerlake-in-")
    texts = ["a\nb", '"', '\n"x"\n', "uno", 'TV 32" x', "largo\n" * 30 + "fin", "\n\n,1/7/2025\n", 'fin"', "dos"]
    lines = [f'1/7/2025,"{t.replace(chr(34), chr(34) * 2)}",{i}' if i != 4 else f"1/7/2025,{t},4" for i, t in enumerate(texts)]
    write_text(f"{root}/NORTE/CARD/m.csv", 'tit,"ulo\ndoble"\nFECHA,TEXTO,IMPORTE\n' + "\n".join(lines) + '\nTOTAL,"x\ny",\n')
    write_text(f"{root}/NORTE/CARD/plain.csv", "t\nFECHA,TEXTO,IMPORTE\n1/7/2025,solo,9\nTOTAL,,\n")
    if size:
        tiny_splits(size)
    batch = statements.read_statements(spark, root, [CARD])
    assert sorted((r.importe, r.concepto) for r in batch.transactions.collect()) == [*((float(i), t) for i, t in enumerate(texts)), (9.0, "solo")]
    assert {r.path.rsplit("/", 1)[1]: (r.status, r.n_rows) for r in batch.files.collect()} == {"m.csv": ("loaded", 9), "plain.csv": ("loaded", 1)}


def test_one_date_format_per_file(spark):
    """03/04 is read as the rest of its file is; a file that fits two formats is read month first and reported."""
    root = tempfile.mkdtemp(prefix="ledgerlake-in-")
    bodies = {"day.csv": ["03/04/2024", "13/04/2024", "mal"], "month.csv": ["03/04/2024", "04/13/2024"], "both.csv": ["03/04/2024", "05/06/2024"],
              "same.csv": ["03/03/2024", "05/05/2024"], "none.csv": ["ayer"], "iso.csv": ["2024-03-04", "2024-03-05", "13/04/2024"]}
    for name, days in bodies.items():
        write_text(f"{root}/N/A/{name}", "FECHA,TEXTO,IMPORTE\n" + "".join(f"{d},x,1\n" for d in days))
    batch = statements.read_statements(spark, root, [AccountConfig("N", "A", MAPPING)])
    days = {}
    for r in batch.transactions.collect():
        days.setdefault(r.path.rsplit("/", 1)[1], []).append(r.fecha)
    assert {k: sorted(v) for k, v in days.items()} == {
        "day.csv": ["2024-04-03", "2024-04-13"], "month.csv": ["2024-03-04", "2024-04-13"], "both.csv": ["2024-03-04", "2024-05-06"],
        "same.csv": ["2024-03-03", "2024-05-05"], "iso.csv": ["2024-03-04", "2024-03-05"]}
    told = {r.path.rsplit("/", 1)[1]: (r.date_format, r.n_texts, r.n_fit, r.ambiguous) for r in batch.dates.collect()}
    assert told == {"day.csv": ("%d/%m/%Y", 3, 2, False), "month.csv": ("%m/%d/%Y", 2, 2, False), "both.csv": ("%m/%d/%Y", 2, 2, True),
                    "same.csv": ("%m/%d/%Y", 2, 2, False), "none.csv": (None, 1, 0, False), "iso.csv": ("%Y-%m-%d", 3, 2, False)}


def test_status_filter_is_opt_in(spark):
    root = tempfile.mkdtemp(prefix="ledgerlake-in-")
    write_text(f"{root}/APP/ACCOUNT/f.csv", "Fecha,Descripción,Importe,Estado\n2025-07-01 10:00:00,A,1,HECHO\n2025-07-01 10:00:00,B,1,PEND\n")
    assert statements.read_statements(spark, root, [APP]).transactions.count() == 2
    strict = AccountConfig("APP", "ACCOUNT", APP.column_mapping, date_format=APP.date_format, status_column="Estado", status_value="HECHO")
    assert [r.concepto for r in statements.read_statements(spark, root, [strict]).transactions.collect()] == ["A"]


def test_raw_landing_is_replaced_per_file(spark, inbox):
    out = tempfile.mkdtemp(prefix="ledgerlake-raw-")
    batch = statements.read_statements(spark, inbox, CONFIGS)
    raw.write_raw(batch.transactions, out)
    raw.write_raw(batch.transactions.where("bank = 'APP'"), out)
    landed = raw.read_raw(spark, out)
    assert landed.count() == len(EXPECTED)
    card = raw.read_raw(spark, out, "NORTE", "CARD")
    assert sorted(r.concepto for r in card.collect()) == ["Compra", "Fecha de celda", "Fecha de texto", "Otra"]
    assert card.columns == ["hash_id", "fecha", "concepto", "importe", "entidad", "origen"]


def test_config_document(spark):
    doc = {"NORTE": {"CARD": {"skip_rows": 1, "column_mapping": {"A": "fecha"}, "date_format": "%d/%m/%Y", "filter_completed": True}, "X": {}}}
    path = tempfile.mkdtemp(prefix="ledgerlake-conf-") + "/c.json"
    write_text(path, json.dumps(doc))
    got = config.load_config(spark, path)
    assert got == [AccountConfig("NORTE", "CARD", (("A", "fecha"),), 1, 0, "%d/%m/%Y"), AccountConfig("NORTE", "X")]
    assert config.load_config(spark, path + ".missing") == []
    assert config.parse_config("{not json") == [] and config.parse_config("[1]") == []


def test_account_without_mapping_is_rejected(spark):
    root = tempfile.mkdtemp(prefix="ledgerlake-in-")
    write_text(f"{root}/N/X/f.csv", "FECHA,TEXTO,IMPORTE\n1/7/2025,a,1\n")
    assert statements.read_statements(spark, root, [AccountConfig("N", "X")]).files.first().status == "no_column_mapping"


def test_cash_casts_after_the_null_filter(spark):
    path = tempfile.mkdtemp(prefix="ledgerlake-cash-")
    write_text(f"{path}/cash.csv", "fecha,concepto,importe\n2025-07-01, pan ,-1.5\nayer,pan,-2\n2025-07-02,pan,dos\n,pan,1\n2025-07-03,pan,\n")
    rows = raw.normalize_cash(raw.read_cash(spark, f"{path}/cash.csv")).collect()
    assert [(str(r.fecha), r.concepto, r.importe, r.hash_id is None) for r in rows] == [
        ("2025-07-01", "pan", -1.5, False), ("None", "pan", -2.0, True), ("2025-07-02", "pan", None, True)]
    assert {(r.entidad, r.origen) for r in rows} == {("Caja", "Cash")}


def test_splits_may_change_between_building_and_running(spark):
    root = tempfile.mkdtemp(prefix="ledgerlake-in-")
    write_text(f"{root}/NORTE/CARD/big.csv", "t\nFECHA,TEXTO,IMPORTE\n" + "".join(f"1/7/2025,mov {i},1\n" for i in range(4000)) + "TOTAL,,1\n")
    batch = statements.read_statements(spark, root, [CARD])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert batch.transactions.count() == 4000 and batch.files.first().n_rows == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("size", [None, 10])
def test_every_listed_file_is_reported(spark, tiny_splits, size):
    root = tempfile.mkdtemp(prefix="ledgerlake-in-")
    for name, text in (("zero.csv", ""), ("blank.csv", "\n \n\n"), ("open.csv", 't\nFECHA,TEXTO,IMPORTE\n1/7/2025,"a,1\n2/7/2025,b,2\nTOTAL,,\n')):
        write_text(f"{root}/NORTE/CARD/{name}", text)
    if size:
        tiny_splits(size)
    batch = statements.read_statements(spark, root, [CARD])
    found = {r.path.rsplit("/", 1)[1]: (r.status, r.n_rows) for r in batch.files.collect()}
    assert found["zero.csv"] == found["blank.csv"] == ("empty", 0)
    assert found["open.csv"] == ("unclosed_quote", 0)
    assert batch.transactions.count() == 0


def test_an_unknown_date_format_rejects_its_account_only(spark):
    from ledgerlake.sources.config import parse_config

    root = tempfile.mkdtemp(prefix="ledgerlake-in-")
    for account in ("ACCOUNT", "CARD"):
        write_text(f"{root}/NORTE/{account}/f.csv", "FECHA,TEXTO,IMPORTE,ESTADO\n01/07/25,a,1,ok\n02/07/25,b,1,no\n")
    mapping = '"column_mapping": {"FECHA": "fecha", "TEXTO": "concepto", "IMPORTE": "importe"}'
    state = '"status_column": "ESTADO", "status_value": "ok", "entidad": "Otro"'
    configs = parse_config(f'{{"NORTE": {{"ACCOUNT": {{{mapping}, {state}, "date_format": "%d/%m/%y"}}, "CARD": {{{mapping}, "date_format": "%d/%Q"}}}}}}')
    batch = statements.read_statements(spark, root, configs)
    assert [(r.fecha, r.concepto, r.entidad) for r in batch.transactions.collect()] == [("2025-07-01", "a", "Otro")]
    assert {r.account: r.status for r in batch.files.collect()} == {"ACCOUNT": "loaded", "CARD": "unknown_date_format"}


def test_places_and_suffixes_need_no_search_through_the_path(spark):
    layout = r"(?:bank=)?([^/]+)/(?:account=)?([^/]+)/(?:PENDING/)?([^/]+)$"
    uris = ["file:/in/N/A/f.csv", "file:/in/N/A/PENDING/f%20+1.csv", "/N/PENDING/f", "N/PENDING/f", "/in/bank=N/account=A/f", "x/bank=/account=/f",
            "/in/N//f", "/N/A/", "f", "/f", "A/f", "", "/in/xbank=N/A/PENDING/PENDING/f", "//A/PENDING/f", "/in/N/A/PENDING", "bank=N/account=A/PENDING/f"]
    df = spark.createDataFrame([(u,) for u in uris], "uri string")
    found = statements._located(df, "uri")
    by_pattern = [F.regexp_extract("path", layout, i) for i in (1, 2)]
    assert found.where((F.col("bank") != by_pattern[0]) | (F.col("account") != by_pattern[1])).collect() == []
    assert "RegExp" not in found._jdf.queryExecution().optimizedPlan().toString()

    names = ["a.csv", "a.CSV2", ".csv", "a..csv", "a.csv.", "a.b.xlsx", "csv", "a.xcsvx", "a.csv.txt", "..csv", "a", "."]
    named = spark.createDataFrame([(n,) for n in names], "file_name string").select(F.struct("file_name").alias("_metadata"))
    suffix = path_parts(F.col("_metadata.file_name"))[2]
    for csv in (True, False):
        told, wanted = statements._metadata_filter(csv), suffix.contains("csv") == csv
        assert named.where(told != wanted).collect() == []
    assert "regexp" not in named.select(told)._jdf.queryExecution().optimizedPlan().toString()


def test_landed_files_are_packed_and_read_back(spark):
    root = tempfile.mkdtemp(prefix="ledgerlake-land-") + "/landing"
    day = "2025-07-01"
    rows = spark.createDataFrame([(day, "Café, 1", -2.5), (day, None, 1.0)], "fecha string, concepto string, importe double").select(
        hash_id(F.col("fecha"), F.col("concepto"), F.col("importe")).alias("hash_id"), "*", F.lit("Norte").alias("entidad"),
        F.lit("Card").alias("origen"), F.lit("NORTE").alias("bank"), F.lit("CARD").alias("account"), F.lit("/in/a.csv").alias("path"))
    raw.write_raw(rows, root)
    landed = raw.read_raw(spark, root)
    assert all(name.endswith(".json.gz") for name in landed.inputFiles())
    wanted = rows.select(*landed.columns).collect()
    assert sorted(map(tuple, landed.collect()), key=str) == sorted(map(tuple, wanted), key=str)
