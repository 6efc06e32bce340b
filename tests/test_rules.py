import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import rules
from ledgerlake.schemas import MASTER_RULES

STRATEGIES = ["case", "automaton", "anchored"]
SCHEMA = "rule_id long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MASTER_RULES.fields)


def bare(text):
    return "".join(p for p in unicodedata.normalize("NFD", text.upper()) if not unicodedata.category(p).startswith("M"))


def brute_force(text, amount, table):
    amount = amount or 0
    for rule in sorted(table, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        _, keyword, _, group, *_ = rule
        fits = amount == 0 or (amount > 0) == (group == "Ingresos")
        if keyword.strip() and text is not None and bare(keyword) in bare(text) and fits:
            return tuple(rule[3:])
    return rules.FALLBACK_POSITIVE if amount > 0 else rules.FALLBACK_OTHER


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_classify_equals_first_match_loop(spark, strategy):
    rng = random.Random(7)
    letters = "abcñÁ d"
    table = [
        (i, "".join(rng.choice(letters) for _ in range(rng.randint(1, 6))), rng.choice([10, 20, None]),
         rng.choice(["Ingresos", "Gastos", "Ahorro e Inversión"]), f"c{i}", None if i % 3 == 0 else f"s{i}", f"e{i}")
        for i in range(60)
    ] + [(99, "  ", 1, "Gastos", "no", "no", "no")]
    rows = [
        (i, None if i % 50 == 0 else "".join(rng.choice(letters) for _ in range(rng.randint(0, 12))), rng.choice([5.0, -5.0, 0.0, None]))
        for i in range(600)
    ]
    # One text holds a third of all rows.
    rows += [(1000 + i, "ábc dab", -1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "n int, concepto string, importe double")
    got = rules.classify(df, spark.createDataFrame(table, SCHEMA), strategy=strategy).collect()
    assert len(got) == len(rows)
    found = {r.n: tuple(r.clase) for r in got}
    assert found == {n: brute_force(text, amount, table) for n, text, amount in rows}


def test_more_rules_than_fit_inline_use_the_join(spark, monkeypatch):
    monkeypatch.setattr(rules.inline_rules, "__defaults__", (1,))
    table = [(1, "uno", 10, "Gastos", "a", "b", "Uno"), (2, "dos", 10, "Gastos", "a", "b", "Dos")]
    df = spark.createDataFrame([("uno dos", -1.0), ("dos", -1.0), ("x", -1.0)], "concepto string, importe double")
    out = rules.classify(df, spark.createDataFrame(table, SCHEMA))
    assert "_text" not in out.columns
    assert {r.concepto: r.clase.entity_name for r in out.collect()} == {"uno dos": "Uno", "dos": "Dos", "x": "Desconocido"}


def test_hot_text_is_salted_without_changing_rows(spark, monkeypatch):
    monkeypatch.setattr(rules, "hot_keys", lambda df, key: ["UNO"])
    master = spark.createDataFrame([(1, "uno", 10, "Gastos", "a", "b", "Uno")], SCHEMA)
    df = spark.createDataFrame([("uno", -1.0)] * 100 + [("dos", -1.0), (None, -1.0)], "concepto string, importe double")
    out = rules.classify(df, master, strategy="anchored").groupBy("clase.entity_name").count().collect()
    assert {r[0]: r[1] for r in out} == {"Uno": 100, "Desconocido": 2}


def test_sign_gate_zero_null_and_text_form_of_blanks(spark):
    table = [(1, "nómina", 10, "Ingresos", "n", None, "Empresa")]
    df = spark.createDataFrame([(1, "NOMINA mayo", 1.0), (2, "NOMINA", -1.0), (3, "nomina", 0.0), (4, "nomina", None)], "n int, concepto string, importe double")
    master = spark.createDataFrame(table, SCHEMA)
    got = {r.n: r.clase.entity_name for r in rules.classify(df, master).collect()}
    assert got == {1: "Empresa", 2: "Desconocido", 3: "Empresa", 4: "Empresa"}
    blanks = {r.n: r.clase.subcategoria for r in rules.classify(df, master, null_text="None").collect()}
    assert blanks[1] == "None"


def test_korean_keyword_matches_by_letters(spark):
    master = spark.createDataFrame([(1, "가", 1, "Gastos", "a", "b", "K")], SCHEMA)
    df = spark.createDataFrame([("x각", -1.0)], "concepto string, importe double")
    for strategy in STRATEGIES:
        assert rules.classify(df, master, strategy=strategy).first().clase.entity_name == "K"


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_entities_keep_accents_and_fall_back(spark, strategy):
    entities = spark.createDataFrame([(1, "café", "Cafés", 2), (2, "bar", "Bares", 1)], "rule_id long, keyword string, entity_name string, priority int")
    df = spark.createDataFrame([("CAFÉ BAR",), ("Café",), ("cafe",), (None,)], "concepto string")
    out = rules.standardize_entity(df, entities, F.lit("otro"), strategy=strategy)
    assert {r.concepto: r.entity for r in out.collect()} == {"CAFÉ BAR": "Bares", "Café": "Cafés", "cafe": "otro", None: "otro"}


def test_inline_plans_do_not_shuffle_rows(spark):
    master = spark.createDataFrame([(i, f"k{i}", 1, "Gastos", "a", "b", "c") for i in range(60)], SCHEMA)
    df = spark.range(100).select(F.col("id").cast("string").alias("concepto"), F.lit(1.0).alias("importe"))
    for strategy in ("case", "automaton"):
        plan = rules.classify(df, master, strategy=strategy)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    anchored = rules.classify(df, master, strategy="anchored")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in anchored and "Cartesian" not in anchored


def test_rule_conflicts_and_taxonomy(spark):
    table = [
        (1, "LIQ", 20, "Gastos", "a", "b", "x"), (2, "LIQ CUOTA", 20, "Gastos", "a", "b", "y"),
        (3, "LIQ CUOTA", 30, "Ingresos", "a", "c", "z"), (4, "OTRA LIQ", 50, "Gastos", "a", "b", "w"),
    ]
    master = spark.createDataFrame(table, SCHEMA)
    got = {(r.rule_id, r.shadowed_by, r.tied) for r in rules.rule_conflicts(master).collect()}
    assert got == {(2, 1, True), (4, 1, False)}
    assert {r.subcategoria for r in rules.category_taxonomy(master).collect()} == {"b", "c"}
    assert rules.category_taxonomy(master).count() == 2
