import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import incremental, skew


def frames(spark, batch, stored):
    schema = "hash_id string, n int"
    return spark.createDataFrame(batch, schema), spark.createDataFrame(stored, schema)


BATCH = [("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)]
CASES = {"empty": [], "some": [("b", 0), ("b", 9)], "null": [("b", 0), (None, 0)]}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("hot", [(), ("a", "b")])
def test_equals_sql_not_in(spark, case, hot):
    batch, stored = frames(spark, BATCH, CASES[case])
    batch.createOrReplaceTempView("batch")
    stored.createOrReplaceTempView("stored")
    expected = spark.sql("SELECT * FROM batch WHERE hash_id NOT IN (SELECT hash_id FROM stored)").collect()
    got = incremental.new_rows(batch, stored, hot=hot).select("hash_id", "n").collect()
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_null_policies(spark):
    batch, stored = frames(spark, BATCH, CASES["null"])
    with pytest.raises(incremental.NullKeyError):
        incremental.new_rows(batch, stored, null_policy="raise")
    kept = incremental.new_rows(batch, stored, null_policy="ignore").collect()
    assert sorted(r.n for r in kept) == [1, 2, 5]
    with pytest.raises(ValueError):
        incremental.new_rows(batch, stored, null_policy="maybe")


def test_never_a_nested_loop(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch, stored = frames(spark, BATCH, CASES["some"])
        plan = incremental.new_rows(batch, stored)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "SortMergeJoin" in plan
        # Both sides are shuffled once, by key and salt.
        exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
        assert len(exchanges) == 2 and all("_salt" in e for e in exchanges)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pruned_by_a_column_the_key_implies(spark):
    schema = "hash_id string, m string"
    batch = spark.createDataFrame([("a", "m2"), ("b", "m2"), ("x", "m3")], schema)
    stored = spark.createDataFrame([("a", "m2"), ("z", "m1")], schema)
    got = incremental.new_rows(batch, stored, prune_by=("m", ["m2", "m3"])).collect()
    assert sorted(r.hash_id for r in got) == ["b", "x"]
    # The NULL rules still look at the whole table.
    batch = spark.createDataFrame([(None, "m3")], schema)
    assert incremental.new_rows(batch, stored, prune_by=("m", ["m3"])).count() == 0


def test_upsert_replaces_and_keeps(spark):
    batch, stored = frames(spark, [("a", 1), ("d", 2)], [("a", 7), ("b", 8), (None, 9)])
    got = {(r.hash_id, r.n) for r in incremental.upsert(stored, batch).collect()}
    assert got == {("a", 1), ("d", 2), ("b", 8), (None, 9)}


def test_hot_keys_finds_the_heavy_one(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("hash_id"))
    assert skew.hot_keys(df, "hash_id", rows=2000, fraction=0.1) == ["hot"]
    rows = df.withColumn("n", F.monotonically_increasing_id())  # rows alike in every column would share a salt
    left, _ = skew.salted(rows, df, "hash_id", ["hot"])
    spread = left.where("hash_id = 'hot'").groupBy("_salt").count().collect()
    assert len(spread) == skew.SALTS


def test_spread_scan_only_when_there_are_too_few_pieces(spark):
    assert skew.spread_scan(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 4
    assert skew.spread_scan(spark.range(0, 10, 1, 9)).rdd.getNumPartitions() == 9


def test_stored_partitions_are_pruned_at_run_time(spark):
    """Only the batch's months are read; the plan finds them out by itself."""
    spark.sql("CREATE DATABASE IF NOT EXISTS prune_ns")
    rows = [(f"k{i}", f"2024-{1 + i % 12:02d}") for i in range(240)]
    frame = spark.createDataFrame(rows, "hash_id string, anio_mes string")
    frame.write.mode("overwrite").partitionBy("anio_mes").saveAsTable("prune_ns.t")
    batch = spark.createDataFrame([("k0", "2024-01"), ("new", "2024-01"), ("k13", "2024-02"), ("k14", "2024-03")], frame.schema)
    found = incremental.new_rows(batch.where("anio_mes < '2024-03'"), spark.table("prune_ns.t"), prune_by="anio_mes")
    assert [r.hash_id for r in found.collect()] == ["new"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
