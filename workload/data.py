"""Ledger views over the driver tables, and small invented rule sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.functions import hash_id
from ledgerlake.operators.flags import Household
from ledgerlake.operators.skew import spread_scan
from ledgerlake.schemas import MASTER_RULES
from ledgerlake.session import local_table

HOUSE = Household(
    bank="Bank1", card_bill="CARGO GALAXIA", shared_card_bill="CARGO TERRAZA", transfers=("CAMBIO DE HUCHA", "ENTRE CUENTAS"),
    person_to_person=("PAGO AMIGO",), contributors=(("NOA", "Aportación"), ("TEO", "Aportación Teo")),
    contribution_amounts=(320.0, 480.0),
)
# The same household as the SQL side reads it: order, label, bank, origin, pattern, amount, gift (a
# contribution), moves (money that really moves). NULL fits all.
OPERATIONS = [
    (1, "Liquidación Tarjeta", "Bank1", "Account", "CARGO GALAXIA", None, False, False),
    (2, "Liquidación Tarjeta Compartida", "Bank1", "Shared", "CARGO TERRAZA", None, False, True),
    (3, "Aportación", "Bank1", "Shared", "NOA", 320, True, False),
    (3, "Aportación", "Bank1", "Shared", "NOA", 480, True, False),
    (4, "Aportación Teo", "Bank1", "Shared", "TEO", 320, True, False),
    (4, "Aportación Teo", "Bank1", "Shared", "TEO", 480, True, False),
    (5, "Traspaso Interno", None, None, "CAMBIO DE HUCHA", None, False, False),
    (5, "Traspaso Interno", None, None, "ENTRE CUENTAS", None, False, False),
    (6, "Bizum", None, None, "PAGO AMIGO", None, False, True),
]

# rule_id, keyword, priority, grupo, categoria, subcategoria, entity_name. Invented: equal
# priorities that overlap, a general keyword in front of a specific one, income rules, an accented
# and a mixed-case keyword, blank levels and a blank keyword.
MASTER = [
    (1, "widget promo", 10, "Ingresos", "Ventas", "Promociones", "Widgets"),
    (2, "Blue Widget", 20, "Gastos Fijos", "Taller", "Piezas azules", "Azul Piezas"),
    (3, "widget", 20, "Gastos Variables", "Taller", "Piezas", "Widgets"),
    (4, "red widget", 30, "Gastos Variables", "Taller", "Piezas rojas", "Rojo Piezas"),
    (5, "rod", 40, "Gastos Variables", "Ferretería", "Varillas", "Varillas SL"),
    (6, "rod standard", 10, "Ingresos", "Ventas", "Varillas", "Varillas SL"),
    (7, "gizmo", 30, "Ahorro e Inversión", "Aparatos", None, "Gizmos"),
    (8, "hot gizmo", 30, "Ingresos", "Devoluciones", "Aparatos", "Gizmos"),
    (9, "ring", 50, "Gastos Variables", "Joyería", "Anillos", "Anillos"),
    (10, "COMISIÓN", 5, "Gastos Fijos", "Banco", "Comisiones", "Banco"),
    (11, "pago amigo", 15, "Ingresos", "Otros Ingresos", None, None),
    (12, "entre cuentas", 15, "Movimientos Operativos", "Traspasos ", "Internos", "Propia"),
    (13, "cargo terraza", 15, "Movimientos Operativos", "Tarjeta", "Liquidación", "Tarjeta"),
    (14, "cargo", 16, "Movimientos Operativos", "Recibos", "Varios", "Recibos"),
    (15, "   ", 1, "Gastos Fijos", "Nada", "Nada", "Nada"),
    (16, "cold anvil economy", 25, "Gastos Fijos", "Herrería", "Yunques", "Yunques"),
    (17, "anvil", 45, "Ingresos", "Ventas", "Yunques", "Yunques"),
    (18, "anvil", 45, "Gastos Variables", "Herrería", "Yunques", "Yunques"),
    (19, "plate", 60, "Gastos Variables", "Menaje", "Platos", "Platos"),
    (20, "plate", 60, "Gastos Fijos", "Menaje", "Otros", "Platos bis"),
    (21, "brand#25", 60, "Gastos Variables", "Marcas", "Marca 25", "Marca 25"),
    (22, "brand#2", 60, "Gastos Variables", "Marcas", "Marca 2", "Marca 2"),
    (23, "promo", 55, "Ingresos", "Ventas", "Ofertas", "Ofertas"),
    (24, "gear large", 35, "Gastos Fijos", "Taller", "Engranajes", "Engranajes"),
    (25, "nunca aparece", 10, "Gastos Fijos", "Taller", "Nada", "Nadie"),
]
ENTITIES = [  # rule_id, keyword, entity_name, priority
    (1, "widget", "Casa Widget", 4), (2, "blue widget", "Azul Piezas", 3), (3, "Comisión", "Banco", 3),
    (4, "comision", "Nadie", 3), (5, "rod", "Varillas SL", 5), (6, "hot", "Calor", 6), (7, "ring", "Anillos", 6),
]
CATEGORIES = [  # rule_id, keyword, category, priority
    (1, "economy", "Barato", 25), (2, "gear", "Taller", 10), (3, "gear economy", "Taller barato", 10),
    (4, "promo", "Oferta", 1), (5, "plate", "Menaje", 12), (6, "entre cuentas", "Interno", 2),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread_scan(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))


def master_rules(spark: SparkSession) -> DataFrame:
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MASTER_RULES.fields)
    return local_table(spark, MASTER, f"rule_id long, {names}")


def entity_rules(spark: SparkSession) -> DataFrame:
    return local_table(spark, ENTITIES, "rule_id long, keyword string, entity_name string, priority int")


def category_rules(spark: SparkSession) -> DataFrame:
    return local_table(spark, CATEGORIES, "rule_id long, keyword string, category string, priority int")


def txn(spark: SparkSession, folder: str) -> DataFrame:
    """Bank movements made from order lines and part names."""
    l = spread_scan(table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_shipdate"))
    p = table(spark, folder, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    key = F.col("l_orderkey")
    prefix = (
        F.when(key % 17 == 0, "Entre cuentas ").when(key % 19 == 0, "Un pago amigo ")
        .when(key % 23 == 0, "Cargo Galaxia ").when(key % 29 == 0, "Cargo Terraza ")
        .when(key % 31 == 0, "Noa aporta ").when(key % 37 == 0, "Comisión ").otherwise("")
    )
    source = F.col("l_suppkey") % 5
    return l.join(p, l.l_partkey == p.p_partkey).select(
        F.col("l_shipdate").cast("date").alias("fecha"),
        F.concat(prefix, "p_name", F.lit(" "), "p_type", F.lit(" "), "p_brand").alias("concepto"),
        F.when(key % 31 == 0, 320.0).when(key % 41 == 0, 0.0)
        .when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))
        .otherwise(-F.col("l_extendedprice")).alias("importe"),
        F.when(source <= 2, "Bank1").when(source == 3, "Bank2").otherwise("Caja").alias("entidad"),
        F.when(source == 0, "Account").when(source == 1, "Card").when(source == 2, "Shared")
        .when(source == 3, "Account").otherwise("Cash").alias("origen"),
    )


def movements(spark: SparkSession, folder: str) -> DataFrame:
    """``txn`` with its identity: the canonical transaction columns."""
    df = txn(spark, folder)
    return df.select(hash_id(F.col("fecha"), F.col("concepto"), F.col("importe")).alias("hash_id"), *df.columns)


SLICES = {
    "account": ("Bank1", "Account"), "card": ("Bank1", "Card"), "shared": ("Bank1", "Shared"),
    "app_account": ("Bank2", "Account"), "cash": ("Caja", "Cash"),
}


def bronze_slice(df: DataFrame, name: str) -> DataFrame:
    entidad, origen = SLICES[name]
    return df.where((F.col("entidad") == entidad) & (F.col("origen") == origen))


def part_rules(spark: SparkSession, folder: str) -> DataFrame:
    """One classification rule per part, so the rule table grows with the data."""
    key = F.col("p_partkey")
    noun = F.split_part("p_name", F.lit(" "), F.lit(2))
    return table(spark, folder, "part").select(
        key.alias("rule_id"),
        F.when(key % 4 == 0, F.col("p_name")).when(key % 4 == 1, F.concat_ws(" ", "p_name", "p_type"))
        .when(key % 4 == 2, F.concat_ws(" ", noun, "p_type")).otherwise(F.concat_ws(" ", "p_type", "p_brand"))
        .alias("keyword"),
        F.col("p_size").alias("priority"),
        F.when(key % 5 == 0, "Ingresos").when(key % 5 == 1, "Gastos Fijos").when(key % 5 == 2, "Gastos Variables")
        .when(key % 5 == 3, "Movimientos Operativos").otherwise("Ahorro e Inversión").alias("grupo_categoria"),
        F.col("p_type").alias("categoria"),
        F.when(key % 11 != 0, F.col("p_brand")).alias("subcategoria"),
        F.concat(F.lit("Comercio "), "p_name").alias("entity_name"),
    )


def adjustments(df: DataFrame) -> DataFrame:
    """Manual adjustments for the shared card settlements among movements, some of them twice."""
    settled = df.where(
        (F.col("origen") == "Shared") & F.upper("concepto").contains(HOUSE.shared_card_bill)
        & (F.dayofmonth("fecha") % 2 == 0)
    )
    copies = F.when(F.dayofmonth("fecha") == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return settled.withColumn("copy", F.explode(copies)).select(
        "hash_id", (F.month("fecha") * 1.5 + F.col("copy")).alias("adjustment_amount"),
        F.lit("manual, per receipt").alias("reason"),
    )
