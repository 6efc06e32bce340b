"""Mart, monthly totals and data tests kept up month by month, against whole rebuilds."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import skew
from ledgerlake.operators.quality import run_tests
from ledgerlake.plans.gold import gold_transactions, monthly_spend
from ledgerlake.plans.lakehouse import Lakehouse
from ledgerlake.schemas import MASTER_RULES
from ledgerlake.sources import tables

from .test_lakehouse import ACCOUNT, HOUSE, RULES, SHARED, raw_rows


def rows(df):
    columns = sorted(df.columns)
    return sorted(str([r[c] for c in columns]) for r in df.collect())


def files(lake, table, month):
    df = lake.spark.table(lake.name("gold", table)).where(F.col("anio_mes") == month)
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def as_rebuilt(lake):
    gold = gold_transactions(lake.table("silver", "fct_transactions"), lake.table("seeds", "manual_adjustments"))
    assert rows(lake.table("gold", "transactions")) == rows(gold)
    assert rows(lake.table("gold", "monthly_spend")) == rows(monthly_spend(gold))


@pytest.fixture(scope="module")
def lake(spark):
    lake = Lakehouse(spark, HOUSE, prefix="inc_")
    lake.save_seed("master_mapping", spark.createDataFrame(RULES, MASTER_RULES).withColumn("rule_id", F.monotonically_increasing_id()))
    save_adjustments(lake, [(SHARED[0], 50.0)])
    lake.refresh({"account": raw_rows(spark, ACCOUNT), "shared": raw_rows(spark, SHARED)}, full_refresh=True)
    return lake


def save_adjustments(lake, given):
    of = raw_rows(lake.spark, [r for r, _ in given] or SHARED[:1]).select("hash_id", "fecha")
    amounts = {r[0]: a for r, a in given}
    amount = F.lit(None).cast("double")
    for day, value in amounts.items():
        amount = F.when(F.col("fecha") == day, value).otherwise(amount)
    seed = of.select("hash_id", amount.alias("adjustment_amount"), F.lit("x").alias("reason"))
    lake.save_seed("manual_adjustments", seed if given else seed.limit(0))


def test_gold_and_totals_by_month(lake):
    as_rebuilt(lake)
    kept = {t: files(lake, t, "2025-04") for t in ("transactions", "monthly_spend")}
    first = files(lake, "transactions", "2025-01")
    # New rows of a new month only.
    lake.refresh({"account": raw_rows(lake.spark, [("2025-06-01", "Cena", -12.0, "Norte", "Account")])})
    as_rebuilt(lake)
    assert files(lake, "transactions", "2025-06") and files(lake, "transactions", "2025-01") == first
    # Adjustments change, go and come back.
    for given in ([(SHARED[0], 20.0)], [], [(SHARED[0], 50.0)]):
        save_adjustments(lake, given)
        lake.build_gold()
        as_rebuilt(lake)
    assert files(lake, "transactions", "2025-01") != first
    assert {t: files(lake, t, "2025-04") for t in kept} == kept
    before = files(lake, "monthly_spend", "2025-01")
    lake.build_gold()
    assert files(lake, "monthly_spend", "2025-01") == before


def test_results_of_tests_by_month(lake):
    assert rows(lake.test_new()) == rows(lake.test())
    path = lake.name("gold", "test_results")
    kept = {r[0] for r in lake.spark.table(path).where("anio_mes = '2025-04'").select(F.input_file_name()).distinct().collect()}
    again = [("2025-07-01", "Dos", -1.0, "Norte", "Shared")] * 2
    lake.refresh({"shared": raw_rows(lake.spark, again)})
    new = lake.test_new()
    assert rows(new) == rows(lake.test())
    assert new.where("table = 'shared' and kind = 'unique'").first().failures == 1
    assert {r[0] for r in lake.spark.table(path).where("anio_mes = '2025-04'").select(F.input_file_name()).distinct().collect()} == kept


def test_results_by_group_add_up(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), (None, "z"), ("b", None)], "anio_mes string, hash_id string")
    told = run_tests({"account": df}, by=("anio_mes",))
    total = told.groupBy("table", "column", "kind").agg(F.sum("failures").alias("failures"))
    assert rows(total) == rows(run_tests({"account": df}))
    assert told.count() == 6


def test_layers_that_lie_by_month_are_not_dealt_again(spark, monkeypatch):
    dealt = []
    rebalanced = tables.rebalanced

    def counted(df, *columns):
        if "concepto" in df.columns:
            dealt.append(df.count())
        return rebalanced(df, *columns)

    monkeypatch.setattr(tables, "rebalanced", counted)
    lake = Lakehouse(spark, HOUSE, prefix="dealt_")
    lake.save_seed("master_mapping", spark.createDataFrame(RULES, MASTER_RULES).withColumn("rule_id", F.monotonically_increasing_id()))
    save_adjustments(lake, [(SHARED[0], 50.0), (ACCOUNT[2], 5.0)])  # the second one is held by two rows
    lake.refresh({"account": raw_rows(spark, ACCOUNT), "shared": raw_rows(spark, SHARED)})
    assert dealt == [len(ACCOUNT), len(SHARED), 3]  # both bronze tables, and the rows with an adjustment
    as_rebuilt(lake)
    dealt.clear()
    late = [("2025-01-20", "Cena", -7.0, "Norte", "Account"), ("2025-08-01", "Cena", -8.0, "Norte", "Account")]
    lake.refresh({"account": raw_rows(spark, ACCOUNT + late)})
    # Two new bronze rows, of which one lies in a month that silver has; January's adjusted rows, and August's.
    assert dealt == [2, 1, 3, 0]
    as_rebuilt(lake)
    assert lake.table("silver", "fct_transactions").count() == len(ACCOUNT) + len(SHARED) + 2


def test_rows_of_new_partitions_meet_no_stored_key(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS inc_parts")
    stored = spark.createDataFrame([("a", "m1"), ("b", "m2")], "hash_id string, anio_mes string")
    tables.rebuild(stored, "inc_parts.t", ("anio_mes",))
    batch = spark.createDataFrame(
        [("a", "m1"), ("c", "m1"), ("d", "m3"), ("d", "m3"), ("e", None), (None, "m1"), (None, "m3")], "hash_id string, anio_mes string")
    for prune_by in ("anio_mes", ("anio_mes", ["m1", "m3"])):
        met, others = tables.fresh_parts(batch, "inc_parts.t", prune_by, hot=lambda df: [r[0] for r in df.collect() if r[0] == "c"])
        assert sorted(r[0] for r in met.collect()) == ["c"]
        assert sorted(r[0] for r in others.collect()) == ["d", "d", "e"]
        assert "Exchange" not in others._jdf.queryExecution().executedPlan().toString()
    tables.rebuild(stored.limit(0), "inc_parts.t", ("anio_mes",))
    met, others = tables.fresh_parts(batch, "inc_parts.t", "anio_mes")
    assert met.unionByName(others).count() == 7  # the first load also takes rows without a key


@pytest.mark.parametrize("bits", [1 << 25, 1 << 17, 8])
def test_no_row_with_a_key_goes_unmarked(spark, monkeypatch, bits):
    monkeypatch.setattr(skew, "BITS", bits)
    keys = spark.range(0, 6000, 3).select(F.col("id").cast("string").alias("hash_id"))
    df = spark.range(6000).select(F.col("id").cast("string").alias("hash_id"), "id").unionByName(spark.sql("SELECT string(NULL) hash_id, 9000L id"))
    got = skew.marked(df, keys, "hash_id", "held")
    assert got.columns == ["hash_id", "id", "held"] and got.count() == 6001
    found = {r["id"] for r in got.where("held").collect()}
    assert found >= set(range(0, 6000, 3))
    assert len(found) < 2020 if bits == 1 << 25 else len(found) > 2020
    assert skew.marked(df, keys.limit(0), "hash_id", "held").where("held").count() == 0
