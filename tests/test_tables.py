import pytest
from pyspark.sql import functions as F, types as T

from ledgerlake.schemas import TXN
from ledgerlake.sources import tables


def frame(spark, rows, schema="hash_id string, m string, n int"):
    return spark.createDataFrame(rows, schema)


def rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_names():
    assert tables.table_name("t", "gold") == "gold.t"
    assert tables.table_name("t") == "default.t"
    assert tables.table_name("t", None, "mine") == "mine.t"


def test_first_load_then_only_new_keys(spark):
    name = "tt.inc"
    tables.append_new(frame(spark, [("a", "x", 1), ("a", "x", 2)]), name, partition_by=("m",))
    tables.append_new(frame(spark, [("a", "x", 3), ("b", "y", 4), ("b", "y", 5)]), name, partition_by=("m",))
    assert sorted(r.n for r in spark.table(name).collect()) == [1, 2, 4, 5]
    tables.append_new(frame(spark, [("c", "z", 9)]), name, full_refresh=True, partition_by=("m",))
    assert [r.n for r in spark.table(name).collect()] == [9]


def test_rebuild_may_read_the_table_it_replaces(spark):
    tables.rebuild(frame(spark, [("a", "x", 1)]), "tt.self")
    tables.rebuild(spark.table("tt.self").withColumn("n", F.col("n") + 1), "tt.self")
    assert rows(spark, "tt.self") == [("a", "x", 2)]
    assert not tables._stages(spark, "tt.self") and not tables.exists(spark, "tt.self__old")


def test_interrupted_swap_is_finished(spark):
    tables.rebuild(frame(spark, [("new", "x", 1)]), "tt.swap__stage")
    tables.rebuild(frame(spark, [("old", "x", 1)]), "tt.swap__old")
    tables.recover(spark, "tt.swap")
    assert rows(spark, "tt.swap") == [("new", "x", 1)]
    assert not tables.exists(spark, "tt.swap__old")


def test_schema_sync_adds_and_drops(spark):
    tables.append_new(frame(spark, [("a", "x", 1)]), "tt.sync")
    wider = frame(spark, [("b", "y", 2, True)], "hash_id string, m string, n int, flag boolean")
    tables.append_new(wider, "tt.sync")
    assert spark.table("tt.sync").columns == ["hash_id", "m", "n", "flag"]
    assert sorted(spark.table("tt.sync").collect(), key=str) == sorted([("a", "x", 1, None), ("b", "y", 2, True)], key=str)
    narrower = frame(spark, [("c", True)], "hash_id string, flag boolean")
    tables.append_new(narrower, "tt.sync")
    assert spark.table("tt.sync").columns == ["hash_id", "flag"]
    tables.append_new(frame(spark, [("d", 7)], "hash_id string, n int"), "tt.sync")
    # A column that comes back does not bring its old values with it.
    assert sorted(spark.table("tt.sync").select("hash_id", "n").collect(), key=str) == [("a", None), ("b", None), ("c", None), ("d", 7)]


def test_merge_replaces_by_key(spark):
    tables.merge(frame(spark, [("a", "x", 1), ("b", "x", 1)]), "tt.merge")
    tables.merge(frame(spark, [("a", "x", 2), ("c", "x", 3)]), "tt.merge")
    assert rows(spark, "tt.merge") == [("a", "x", 2), ("b", "x", 1), ("c", "x", 3)]


def test_comments_are_persisted(spark):
    df = spark.createDataFrame([], TXN)
    tables.rebuild(df, "tt.docs", schema=TXN, comment="It's a \\ table.")
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED tt.docs").collect()}
    assert info["Comment"] == "It's a \\ table."
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE tt.docs").collect()}
    assert "equal movements" in comments["hash_id"]


def test_append_goes_by_name(spark):
    tables.rebuild(frame(spark, [("a", "x", 1)]), "tt.byname")
    tables.append(frame(spark, [(2, "b", "y")], "n int, hash_id string, m string"), "tt.byname")
    assert rows(spark, "tt.byname") == [("a", "x", 1), ("b", "y", 2)]


def test_align_types_new_columns():
    stored = T.StructType().add("a", T.IntegerType()).add("b", T.IntegerType())
    incoming = T.StructType().add("a", T.IntegerType()).add("c", T.DoubleType())
    add, drop = tables.schema_changes(stored, incoming)
    assert [f.name for f in add] == ["c"] and drop == ["b"]


def test_null_key_in_store_stops_a_load(spark):
    tables.append_new(frame(spark, [(None, "x", 1)]), "tt.nulls")
    with pytest.raises(ValueError):
        tables.append_new(frame(spark, [("a", "x", 1)]), "tt.nulls")
    tables.append_new(frame(spark, [("a", "x", 1)]), "tt.nulls", null_policy="compat")
    assert spark.table("tt.nulls").count() == 1


def test_wider_types_and_comments_survive(spark):
    schema = T.StructType([T.StructField("k", T.StringType(), True, {"comment": "the key"}), T.StructField("n", T.IntegerType())])
    tables.rebuild(spark.createDataFrame([("a", 1)], "k string, n int"), "tt.wide", schema=schema, comment="kept 'text'")
    tables.append_new(spark.createDataFrame([("b", 2.5)], "k string, n double"), "tt.wide", key="k")
    assert sorted(map(tuple, spark.table("tt.wide").collect())) == [("a", 1.0), ("b", 2.5)]
    tables.append_new(spark.createDataFrame([("c", 3)], "k string, n int"), "tt.wide", key="k")
    assert spark.table("tt.wide").where("k = 'c'").first()["n"] == 3.0
    with pytest.raises(tables.SchemaChangeError):
        tables.append_new(spark.createDataFrame([("d", "x")], "k string, n string"), "tt.wide", key="k")
    tables.sync_schema(spark, "tt.wide", T.StructType([schema["k"], T.StructField("new", T.StringType(), True, {"comment": "fresh"})]))
    after = spark.table("tt.wide")
    assert [f.metadata.get("comment") for f in after.schema.fields] == ["the key", "fresh"] and after.columns == ["k", "new"]
    assert spark.catalog.getTable("tt.wide").description == "kept 'text'"


def test_files_of_a_dead_stage_are_in_nobodys_way(spark):
    import os

    tables.rebuild(frame(spark, [("a", "x", 1)]), "tt.dead")
    place = spark.sql("DESCRIBE DATABASE EXTENDED tt").where("info_name = 'Location'").first()[1].removeprefix("file:")
    os.makedirs(f"{place}/dead__stage")
    open(f"{place}/dead__stage/part-0.parquet", "w").close()
    tables.rebuild(frame(spark, [("b", "x", 1)]), "tt.dead")
    assert [r[0] for r in spark.table("tt.dead").collect()] == ["b"]


def test_upsert_rewrites_only_the_touched_partitions(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS parts_ns")
    table = "parts_ns.t"
    rows = [("a", "2024-01", 1), ("b", "2024-02", 2), ("c", "2024-03", 3), (None, None, 4)]
    tables.rebuild(spark.createDataFrame(rows, "hash_id string, anio_mes string, n int"), table, ("anio_mes",))
    files = lambda: {r[0] for r in spark.table(table).where("anio_mes <> '2024-02'").select("_metadata.file_path").collect()}
    before = files()
    batch = spark.createDataFrame([("b", "2024-02", 20), ("d", "2024-02", 5)], "hash_id string, anio_mes string, n int")
    tables.merge(batch, table, partition_by=("anio_mes",), fixed_partition=True)
    assert files() == before
    got = sorted((str(r.hash_id), r.n) for r in spark.table(table).collect())
    assert got == [("None", 4), ("a", 1), ("b", 20), ("c", 3), ("d", 5)]
    tables.merge(spark.createDataFrame([(None, None, 6)], batch.schema), table, partition_by=("anio_mes",), fixed_partition=True)
    assert sorted(r.n for r in spark.table(table).where("anio_mes IS NULL").collect()) == [4, 6]


def test_a_torn_partition_upsert_is_finished(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS parts_ns")
    table, schema = "parts_ns.torn", "hash_id string, anio_mes string, n int"
    tables.rebuild(spark.createDataFrame([("a", "2024-01", 1), ("b", "2024-02", 2)], schema), table, ("anio_mes",))
    with monkeypatch.context() as m:
        def dies(*args):
            raise RuntimeError("gone")

        m.setattr(tables, "_overwrite_parts", dies)
        with pytest.raises(RuntimeError):
            tables.merge(spark.createDataFrame([("b", "2024-02", 9)], schema), table, partition_by=("anio_mes",), fixed_partition=True)
    assert sorted(r.n for r in spark.table(table).collect()) == [1, 2]
    for _ in range(2):
        tables.recover(spark, table)
        assert sorted(r.n for r in spark.table(table).collect()) == [1, 9]
    assert not [t for t in spark.catalog.listTables("parts_ns") if "__part" in t.name]
