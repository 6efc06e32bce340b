from types import SimpleNamespace

import pytest

from ledgerlake import session


class Context:
    def __init__(self, master, current=None):
        self.master, self.folder = master, current

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, setting=None, current=None):
    return SimpleNamespace(sparkContext=Context(master, current), conf={"spark.checkpoint.dir": setting})


def test_checkpoint_folder_comes_from_the_session():
    s = fake("spark://x", "hdfs:///ckpt")
    session.ensure_checkpoint_dir(s)
    assert s.sparkContext.folder == "hdfs:///ckpt"
    s = fake("spark://x", "hdfs:///ckpt", "hdfs:///already")
    session.ensure_checkpoint_dir(s)
    assert s.sparkContext.folder == "hdfs:///already"


def test_only_local_sessions_get_a_temporary_folder():
    s = fake("local[2]")
    session.ensure_checkpoint_dir(s)
    assert "ledgerlake-ckpt-" in s.sparkContext.folder
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(fake("yarn"))


def test_local_tables_hold_nested_and_missing_values(spark):
    inner = spark.createDataFrame([(("a", None),)], "s struct<x:string,y:int>").first().s
    df = session.local_table(spark, [(1, inner), (2, None)], "n int, s struct<x:string,y:int>")
    assert [(r.n, r.s) for r in df.orderBy("n").collect()] == [(1, inner), (2, None)]
    assert session.local_table(spark, [], "n int").count() == 0


def test_settled_is_broadcast_only_when_small(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    for rows, expected in ((100, True), (5, False)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            joined = spark.range(20).withColumnRenamed("id", "k").join(session.settled(small, rows), "k")
            assert joined.count() == 10
            assert ("BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()) is expected
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
