import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import hash_id
from ledgerlake.operators.flags import Household
from ledgerlake.plans.gold import monthly_spend, spend_rollup
from ledgerlake.plans.lakehouse import Lakehouse
from ledgerlake.schemas import ADJUSTMENTS, GOLD_COLUMNS, MASTER_RULES, SILVER

from .files import write_text

HOUSE = Household(
    "Norte", card_bill="CARGO GALAXIA", shared_card_bill="CARGO TERRAZA", transfers=("ENTRE CUENTAS",), person_to_person=("PAGO AMIGO",),
    contributors=(("NOA", "Aportación"), ("TEO", "Aportación Teo")), contribution_amounts=(320.0, 480.0))


def raw_rows(spark, rows):
    df = spark.createDataFrame(rows, "fecha string, concepto string, importe double, entidad string, origen string")
    return df.select(hash_id(F.col("fecha"), F.col("concepto"), F.col("importe")).alias("hash_id"), *df.columns)


ACCOUNT = [
    ("2025-01-03", "CARGO GALAXIA enero", -300.0, "Norte", "Account"),
    ("2025-01-04", "Entre cuentas ahorro", -100.0, "Norte", "Account"),
    ("2025-01-05", "PAN.de*molde", -2.5, "Norte", "Account"),
    ("2025-01-05", "PAN.de*molde", -2.5, "Norte", "Account"),
    ("2025-04-06", "Nómina", 1000.0, "Norte", "Account"),
]
SHARED = [
    ("2025-01-10", "Cargo Terraza", -200.0, "Norte", "Shared"),
    ("2025-01-11", "de Noa", 320.0, "Norte", "Shared"),
    ("2025-01-12", "de Teo", 480.0, "Norte", "Shared"),
    ("2025-01-13", "de Noa", 501.0, "Norte", "Shared"),
    ("2025-01-14", "Cena", -40.0, "Norte", "Shared"),
]
RULES = [("nomina", 10, "Ingresos", "Trabajo", None, "Empresa"), ("cena", 10, "Gastos Variables", "Ocio", "Cenas", "Bar")]


@pytest.fixture(scope="module")
def lake(spark):
    lake = Lakehouse(spark, HOUSE, prefix="lh_")
    lake.save_seed("master_mapping", spark.createDataFrame(RULES, MASTER_RULES).withColumn("rule_id", F.monotonically_increasing_id()))
    visa = raw_rows(spark, SHARED[:1]).select("hash_id", F.lit(50.0).alias("adjustment_amount"), F.lit("x").alias("reason"))
    lake.save_seed("manual_adjustments", visa)
    cash = spark.createDataFrame([("2025-02-01", " café ", "-1.2"), ("2025-02-02", "té", "-2")], "fecha string, concepto string, importe string")
    lake.refresh({"account": raw_rows(spark, ACCOUNT), "shared": raw_rows(spark, SHARED), "cash": cash}, full_refresh=True)
    return lake


def by_text(df):
    return {r.concepto: r for r in df.collect()}


def test_layers_have_their_columns_and_all_rows(lake):
    silver = lake.table("silver", "fct_transactions")
    assert sorted(silver.columns) == sorted(SILVER.names)
    assert sorted(lake.table("gold", "transactions").columns) == sorted(GOLD_COLUMNS)
    assert silver.count() == len(ACCOUNT) + len(SHARED) + 2 == lake.bronze_union().count()


def test_labels_flags_and_amounts(lake):
    r = by_text(lake.table("gold", "transactions"))
    assert (r["CARGO GALAXIA enero"].operativa_interna, r["CARGO GALAXIA enero"].es_movimiento_real) == ("Liquidación Tarjeta", False)
    assert (r["Entre cuentas ahorro"].operativa_interna, r["Entre cuentas ahorro"].es_movimiento_real) == ("Traspaso Interno", False)
    visa = r["Cargo Terraza"]
    assert (visa.operativa_interna, visa.es_compartido, visa.es_movimiento_real, visa.importe_personal) == ("Liquidación Tarjeta Compartida", True, True, -75.0)
    luis = r["de Teo"]
    assert (luis.operativa_interna, luis.es_compartido, luis.es_movimiento_real, luis.importe_personal) == ("Aportación Teo", False, False, 0.0)
    assert r["de Noa"].operativa_interna in ("Aportación", "Movimiento Regular")
    assert (r["Cena"].comercio, r["Cena"].importe_personal) == ("Bar", -20.0)
    assert (r["PAN.de*molde"].comercio, r["PAN.de*molde"].grupo) == ("Pan.De*Molde", "Gastos Variables")
    assert (r["Nómina"].comercio, r["Nómina"].trimestre, r["Nómina"].subcategoria) == ("Empresa", 2, None)
    assert r["café"].entidad == "Caja"


def test_contribution_needs_the_exact_amount(lake):
    labels = sorted(r.operativa_interna for r in lake.table("silver", "fct_transactions").where("concepto = 'de Noa'").collect())
    assert labels == ["Aportación", "Movimiento Regular"]


def test_rerun_adds_nothing_and_new_rows_are_added_once(spark, lake):
    before = lake.table("silver", "fct_transactions").count()
    lake.refresh({"account": raw_rows(spark, ACCOUNT)})
    assert lake.table("silver", "fct_transactions").count() == before
    late = [("2025-05-01", "Cena nueva", -10.0, "Norte", "Account")] * 2
    lake.refresh({"account": raw_rows(spark, ACCOUNT + late)})
    assert lake.table("silver", "fct_transactions").count() == before + 2
    assert lake.table("gold", "transactions").where("concepto = 'Cena nueva' AND comercio = 'Bar'").count() == 2


def test_a_run_can_be_limited_to_months(spark, lake):
    before = lake.table("silver", "fct_transactions").count()
    more = [("2025-06-01", "Junio", -1.0, "Norte", "Account"), ("2025-07-01", "Julio", -1.0, "Norte", "Account")]
    lake.load_bronze("account", raw_rows(spark, ACCOUNT + more))
    lake.build_silver(months=["2025-06"])
    assert lake.table("silver", "fct_transactions").count() == before + 1
    lake.build_silver()
    lake.build_silver(months=["2025-06", "2025-07"])
    assert lake.table("silver", "fct_transactions").count() == before + 2


def test_stored_rows_keep_their_class_until_a_full_refresh(spark, lake):
    more = RULES + [("pan", 1, "Gastos Fijos", "Comida", "Pan", "Horno")]
    lake.save_seed("master_mapping", spark.createDataFrame(more, MASTER_RULES).withColumn("rule_id", F.monotonically_increasing_id()))
    lake.build_silver()
    assert by_text(lake.table("silver", "fct_transactions"))["PAN.de*molde"].comercio == "Pan.De*Molde"
    lake.build_silver(full_refresh=True)
    assert by_text(lake.table("silver", "fct_transactions"))["PAN.de*molde"].comercio == "Horno"


def test_declared_tests(lake):
    results = {(r.table, r.column, r.kind): r.failures for r in lake.test().collect()}
    assert len(results) == 9  # three bronze tables and the fact table
    assert results["account", "hash_id", "unique"] >= 1
    assert results["cash", "importe", "not_null"] == 0


def test_spend_totals(lake):
    gold = lake.table("gold", "transactions")
    real = [r for r in gold.collect() if r.es_movimiento_real]
    total = {r.level: r for r in spend_rollup(gold).where("level = 0").collect()}[0]
    assert total.n_rows == len(real)
    assert total.total == pytest.approx(sum(r.importe_personal for r in real))
    assert sum(r.n_rows for r in monthly_spend(gold).collect()) == len(real)


def test_seed_files(spark, lake):
    path = tempfile.mkdtemp(prefix="ledgerlake-seed-") + "/m.csv"
    write_text(path, 'keyword,priority,grupo_categoria,categoria,subcategoria,entity_name\n"a, b",10,G,,S,E\nc,20,G,C,,"x ""y"""\n')
    lake.load_seed("master_mapping", path)
    got = [tuple(r) for r in lake.table("seeds", "master_mapping").orderBy("rule_id").drop("rule_id").collect()]
    assert got == [("a, b", 10, "G", None, "S", "E"), ("c", 20, "G", "C", None, 'x "y"')]
    path = tempfile.mkdtemp(prefix="ledgerlake-seed-") + "/a.csv"
    write_text(path, 'hash_id,adjustment_amount,reason\nabc,12.5,"uno, dos"\n')
    lake.load_seed("manual_adjustments", path)
    assert tuple(lake.table("seeds", "manual_adjustments").select(*ADJUSTMENTS.names).first()) == ("abc", 12.5, "uno, dos")
