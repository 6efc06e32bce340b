from pyspark.sql import functions as F

from ledgerlake.functions.identity import pack, unpack
from ledgerlake.operators.incremental import unseen
from ledgerlake.sources import tables


def test_packed_identities_come_back_and_stay_apart(spark):
    sha = "0123456789abcdef" * 4
    texts = [sha, sha.upper(), sha + "\n", sha[:63], "", "\x01", "\x00", "ñ", None, sha[:62], "a" * 31, "a" * 32, "a" * 33]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", pack(F.col("t")))
    assert df.where(~unpack(F.col("p")).eqNullSafe(F.col("t"))).collect() == []
    assert df.select("p").distinct().count() == len(texts)
    assert df.where(F.col("t") == sha).select(F.octet_length("p")).first()[0] == 33


def test_dealt_rows_are_the_rows_and_identities_travel_packed(spark):
    rows = spark.range(50).select(
        F.sha2(F.col("id").cast("string"), 256).alias("hash_id", metadata={"comment": "c"}), (F.col("id") % 3).cast("string").alias("m"))
    dealt = tables.rebalanced(rows, "m")
    assert dealt.schema == rows.schema
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, rows.collect()))
    sent = dealt._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
    assert len(sent) == 2 and "unhex" in sent[1] and "unhex" not in sent[0]
    numbered = spark.range(4).select(F.col("id").alias("hash_id"), F.lit("x").alias("m"))
    assert sorted(r[0] for r in tables.rebalanced(numbered, "m").collect()) == [0, 1, 2, 3]


def test_rows_not_yet_stored_keep_their_key(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("b", 4)], "hash_id string, n int")
    out = unseen(batch, spark.createDataFrame([("a",), ("c",)], "hash_id string"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("b", 2), ("b", 4), (None, 3)], key=str)
    assert out.schema == batch.schema
