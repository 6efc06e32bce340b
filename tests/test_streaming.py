import os
import tempfile

from ledgerlake.operators.flags import Household
from ledgerlake.plans.lakehouse import Lakehouse
from ledgerlake.sources.config import AccountConfig
from ledgerlake.sources.raw import read_raw
from ledgerlake.sources.statements import read_statements
from ledgerlake.streaming.ingest import ingest_statements, load_bronze_stream, pending_files, retry_statements

from .files import write_text

CONF = AccountConfig("NORTE", "CARD", (("FECHA", "fecha"), ("TEXTO", "concepto"), ("IMPORTE", "importe")), 0, 0, "%d/%m/%Y")
HEAD = "FECHA,TEXTO,IMPORTE\n"


def test_each_file_and_row_once(spark):
    base = tempfile.mkdtemp(prefix="ledgerlake-stream-")
    inbox, landing = f"{base}/in", f"{base}/raw"
    lake = Lakehouse(spark, Household("Norte", card_bill="CARGO GALAXIA", shared_card_bill="CARGO TERRAZA", transfers=("ENTRE CUENTAS",), person_to_person=("PAGO AMIGO",)), prefix="st_")

    def run():
        query = ingest_statements(spark, inbox, [CONF], landing, "st_ops.files", f"{base}/c1")
        query.awaitTermination()
        if os.path.exists(f"{landing}/bank=NORTE"):
            load_bronze_stream(lake, "card", f"{landing}/bank=NORTE/account=CARD", f"{base}/c2").awaitTermination()

    write_text(f"{inbox}/NORTE/CARD/a.csv", HEAD + "1/7/2025,uno,1\n1/7/2025,uno,1\n")
    write_text(f"{inbox}/NORTE/CARD/bad.csv", "FECHA\n1\n")
    run()
    bronze = lake.name("bronze", "card")
    assert sorted(r.concepto for r in spark.table(bronze).collect()) == ["uno", "uno"]
    run()
    assert spark.table(bronze).count() == 2
    write_text(f"{inbox}/NORTE/CARD/b [1] ñ.csv", HEAD + "1/7/2025,uno,1\n2/7/2025,dos,2\n")
    run()
    assert sorted(r.concepto for r in spark.table(bronze).collect()) == ["dos", "uno", "uno"]
    assert read_raw(spark, landing).count() == 4
    report = {r.path.rsplit("/", 1)[1]: r.status for r in spark.table("st_ops.files").collect()}
    assert report == {"a.csv": "loaded", "bad.csv": "missing_columns", "b [1] ñ.csv": "loaded"}
    assert spark.table("st_ops.files").count() == 3


def test_failed_and_empty_files_return_to_pending_until_loaded(spark):
    base = tempfile.mkdtemp(prefix="ledgerlake-retry-")
    inbox, landing, report = f"{base}/in", f"{base}/raw", "st_ops.retried"
    folder = f"{inbox}/NORTE/CARD"
    write_text(f"{folder}/a.csv", HEAD + "1/7/2025,uno,1\n")
    write_text(f"{folder}/bad ñ.csv", "FECHA\n1\n")
    write_text(f"{folder}/empty.csv", HEAD)
    write_text(f"{folder}/zero.csv", "")  # in no scan, so the stream cannot know of it

    def stream():
        ingest_statements(spark, inbox, [CONF], landing, report, f"{base}/c").awaitTermination()

    def pending():
        return sorted(r.path.rsplit("/", 1)[1] for r in pending_files(spark, report).collect())

    stream()
    assert pending() == ["bad ñ.csv", "empty.csv"]
    retry_statements(spark, inbox, [CONF], landing, report, files_per_batch=1)  # nothing mended yet
    assert pending() == ["bad ñ.csv", "empty.csv"]
    write_text(f"{folder}/bad ñ.csv", HEAD + "2/7/2025,dos,2\n")
    write_text(f"{folder}/zero.csv", HEAD + "3/7/2025,tres,3\n")
    write_text(f"{folder}/late.csv", HEAD + "4/7/2025,cuatro,4\n")  # the retry comes before the stream
    os.remove(f"{folder}/empty.csv")  # no longer there: stays pending, stops nothing
    for _ in range(2):
        retry_statements(spark, inbox, [CONF], landing, report)
        assert pending() == ["empty.csv"]
    stream()
    assert sorted(r.concepto for r in read_raw(spark, landing).collect()) == ["cuatro", "dos", "tres", "uno"]
    rows = {}
    for r in spark.table(report).orderBy("attempt").collect():
        rows.setdefault(r.path.rsplit("/", 1)[1], []).append((r.attempt, r.status))
        assert r.length is not None and r.modified is not None and r.tried_at is not None
    assert rows == {"a.csv": [(1, "loaded")], "empty.csv": [(1, "empty"), (2, "empty")], "zero.csv": [(1, "loaded")],
                    "late.csv": [(1, "loaded")], "bad ñ.csv": [(1, "missing_columns"), (2, "missing_columns"), (3, "loaded")]}
    assert not os.listdir(f"{landing}/_parsed")


def test_rows_and_report_come_from_one_parse(spark):
    base = tempfile.mkdtemp(prefix="ledgerlake-once-")
    write_text(f"{base}/in/NORTE/CARD/a.csv", HEAD + "1/7/2025,uno,1\n2/7/2025,,1\n")
    parses = []

    def keep(rows):
        parses.append(rows)
        rows.write.parquet(f"{base}/kept")
        return spark.read.parquet(f"{base}/kept")

    found = read_statements(spark, f"{base}/in", [CONF], keep)
    assert len(parses) == 1
    for df in (found.transactions, found.files):
        assert df.inputFiles() and all("/kept/" in path for path in df.inputFiles())
    assert [r.concepto for r in found.transactions.collect()] == ["uno"]
    assert [(r.status, r.n_rows) for r in found.files.collect()] == [("loaded", 1)]
