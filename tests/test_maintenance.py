import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import maintenance, metrics, quality
from ledgerlake.schemas import ENTITY_RULES, MASTER_RULES
from ledgerlake.sources.raw import read_seed, read_suggestions, write_seed, write_suggestions

from .files import write_text

HEADER = ("keyword", "priority", "grupo_categoria", "categoria")


def test_sheet_rows_are_padded_cut_and_cleaned(spark):
    rows = [(1, [" PAN "]), (2, ["b", "7.9", "g", "c", "extra"]), (3, ["c", "alta", "g"]), (4, ["d", "-3.9", "", "c"])]
    out = maintenance.sync_rules(spark.createDataFrame(rows, "n int, cells array<string>"), HEADER)
    assert [tuple(r) for r in out.orderBy("n").collect()] == [
        (1, "PAN", 50, "", ""), (2, "b", 7, "g", "c"), (3, "c", 50, "g", ""), (4, "d", -3, "", "c")]


def test_synced_rules_survive_the_seed_file(spark):
    path = tempfile.mkdtemp(prefix="ledgerlake-seed-") + "/seed"
    rules = spark.createDataFrame([("a, b", 1, "g", None, 's "x"', "e")], MASTER_RULES)
    with pytest.raises(ValueError):
        write_seed(rules, path)
    rules = rules.withColumn("rule_id", F.lit(7).cast("long"))
    write_seed(rules, path)
    write_seed(rules, path)
    assert [tuple(r) for r in read_seed(spark, path, MASTER_RULES).drop("rule_id").collect()] == [("a, b", 1, "g", None, 's "x"', "e")]


def test_seed_files_keep_the_order_of_ties(spark):
    path = tempfile.mkdtemp(prefix="ledgerlake-seed-") + "/seed"
    rules = spark.range(500).select(
        F.format_string("k%d", F.lit(499) - F.col("id")).alias("keyword"), F.lit(1).alias("priority"),
        *[F.lit(c).alias(c) for c in MASTER_RULES.names[2:]], F.col("id").alias("rule_id"))
    write_seed(rules.repartition(7), path)
    back = read_seed(spark, path, MASTER_RULES)
    assert back.inputFiles().__len__() > 1 and back.orderBy("rule_id").first()["keyword"] == "k499"
    assert sorted(map(tuple, back.select(rules.columns).collect())) == sorted(map(tuple, rules.collect()))


def test_a_single_seed_file_is_numbered_by_its_rows(spark):
    path = tempfile.mkdtemp(prefix="ledgerlake-seed-")
    write_text(path + "/one.csv", "keyword,entity_name,priority\nb,B,1\na,A,1\n")
    assert [r["keyword"] for r in read_seed(spark, path, ENTITY_RULES).orderBy("rule_id").collect()] == ["b", "a"]
    write_text(path + "/two.csv", "keyword,entity_name,priority\nc,C,1\n")
    with pytest.raises(ValueError):
        read_seed(spark, path, ENTITY_RULES)


def test_suggestions(spark):
    header = ",".join(MASTER_RULES.names)
    text = f"```csv\n{header}\nBAR,50,G,C,S,Bar\nBAR,50,G,C,S,Bar\n\n\"A, B\",x,G,,S,\"El \"\"A\"\"\"\n```\n"
    out = maintenance.parse_suggestions(spark.createDataFrame([(text,)], "text string"))
    assert sorted(tuple(r) for r in out.collect()) == [("A, B", 50, "G", None, "S", 'El "A"'), ("BAR", 50, "G", "C", "S", "Bar")]
    taxonomy = spark.createDataFrame([("G", None, "S")], "grupo_categoria string, categoria string, subcategoria string")
    known = {r.keyword: r.known for r in maintenance.check_suggestions(out, taxonomy).collect()}
    assert known == {"A, B": True, "BAR": False}


def test_suggestion_files(spark):
    path = tempfile.mkdtemp(prefix="ledgerlake-sug-")
    header = ",".join(MASTER_RULES.names)
    write_text(f"{path}/s.csv", f"{header}\n{header}\nBAR,50,G,C,S,Bar\nBAR,50,G,C,S,Bar\nPAN,,G,,S,Pan\n")
    rules = read_suggestions(spark, f"{path}/s.csv")
    expected = [("BAR", 50, "G", "C", "S", "Bar"), ("PAN", 50, "G", None, "S", "Pan")]
    assert sorted(tuple(r) for r in rules.collect()) == expected
    write_suggestions(rules, f"{path}/out")
    assert sorted(tuple(r) for r in read_suggestions(spark, f"{path}/out").collect()) == expected


def test_unclassified(spark):
    rows = [("b", -1.0, "Gastos Variables", "Otros Gastos", "Sin Clasificar"), ("a", -5.0, None, None, None),
            ("b", -2.0, "Gastos Variables", "Otros Gastos", "Sin Clasificar"), ("c", 3.0, "Ingresos", "Otros Ingresos", "Sin Clasificar"),
            ("d", -1.0, "Gastos Variables", "Ocio", "Sin Clasificar")]
    df = spark.createDataFrame(rows, "concepto string, importe double, grupo string, categoria string, subcategoria string")
    assert [r.concepto for r in maintenance.unclassified_concepts(df).collect()] == ["a", "b"]
    assert [r.concepto for r in maintenance.unclassified_concepts(df, 1).collect()] == ["a"]
    assert [tuple(r) for r in maintenance.unclassified_by_weight(df).orderBy(F.desc("n_rows")).collect()] == [("b", 2, 3.0), ("a", 1, 5.0)]


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 1.0), (None, 2.0)], "hash_id string, importe double")
    assert [tuple(r) for r in quality.duplicates(df).collect()] == [("a", 2)]
    assert quality.null_counts(df, ["hash_id", "importe"]).first() == (2, 1)
    got = {(r.table, r.kind, r.column): r.failures for r in quality.run_tests({"cash": df}).collect()}
    assert got == {("cash", "unique", "hash_id"): 1, ("cash", "not_null", "hash_id"): 2, ("cash", "not_null", "importe"): 1}
    assert len(quality.DECLARED_TESTS) == 13


def test_ingest_metrics(spark):
    rows = [("B", "X", "f1"), ("B", "X", "f1"), ("B", "Y", "f2"), ("C", "X", "f1")]
    out = metrics.ingest_metrics(spark.createDataFrame(rows, "bank string, account string, path string"))
    got = {(r.bank, r.account): (r.n_files, r.n_rows) for r in out.collect()}
    assert got == {("B", "X"): (1, 2), ("B", "Y"): (1, 1), ("C", "X"): (1, 1), ("B", None): (2, 3), ("C", None): (1, 1), (None, None): (3, 4)}
