import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import quality

from . import brute


def corpus(spark):
    rng = random.Random(8)
    good = ["river", "stone", "walks", "under", "quiet", "green", "light", "often"]
    rows, labels = [], []
    for i in range(240):
        n = rng.randrange(40, 120)
        if i % 3:
            text = " ".join(rng.choice(good) + rng.choice(good) for _ in range(n))
        else:
            text = " ".join(rng.choice(good).upper() + rng.choice(["!!", "$$$", "|"]) for _ in range(n))
        rows.append((i, text))
        labels.append((i, int(bool(i % 3)), 0))
    labels += [(0, None, 0), (None, 1, 0), (5, 0, 0)]  # unusable: null, null id, contradiction
    return (spark.createDataFrame(rows, "doc_id long, text string"), rows,
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_learns_and_is_calibrated(spark):
    docs, rows, labels = corpus(spark)
    model = quality.train(docs, labels)
    got = quality.judge(docs, model).collect()
    wrong = [r["doc_id"] for r in got if r["kept"] != bool(r["doc_id"] % 3)]
    assert len(wrong) <= 2
    likely = [r["quality_score"] for r in got if r["doc_id"] % 3]
    assert 0.8 < np.mean(likely) <= 1


def test_facts_equal_a_loop(odd_docs, odd_rows):
    got = quality.judge(odd_docs.withColumn("kept", odd_docs["source"]), quality.KEEP_ALL).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        want = brute.facts(r["text"])
        assert tuple(r[f] for f in quality.FACTS) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and r["kept"] == (not r["base_failed"])


def test_score_does_not_depend_on_the_batch(spark):
    docs, rows, labels = corpus(spark)
    model = quality.train(docs, labels)
    whole = {r["doc_id"]: r["quality_score"] for r in quality.judge(docs.coalesce(1), model).collect()}
    apart = {r["doc_id"]: r["quality_score"] for r in quality.judge(docs.repartition(40), model).collect()}
    assert whole == apart


def test_no_labels_keep_all(spark, odd_docs, no_docs):
    _, _, labels = corpus(spark)
    assert quality.train(odd_docs, labels.limit(0)) is quality.KEEP_ALL
    assert quality.train(no_docs, labels) is quality.KEEP_ALL
    assert quality.judge(no_docs, quality.KEEP_ALL).count() == 0


def test_clashing_columns(spark, odd_docs):
    docs = odd_docs.withColumns({c: F.lit(c) for c in ("_text", "_own", "n_words", "kept")})
    got = quality.judge(docs, quality.KEEP_ALL)
    assert {tuple(r) for r in got.select("_text", "_own").collect()} == {("_text", "_own")}
    names = ["doc_id", "text", *quality.FACTS, "base_failed", "kept"]
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, quality.judge(odd_docs, quality.KEEP_ALL).select(names).collect()))


def test_training_in_blocks_is_the_training_as_a_whole(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa
    r = np.random.default_rng(3)
    rows = [np.sort(r.choice(1 << quality.BITS, int(r.integers(0, 2000)), replace=False)).astype(np.int32) for _ in range(600)]
    table = pa.table({
        "_key": pa.array(r.permutation(600)), "_good": pa.array(r.random(600) > 0.5), "buckets": pa.array(rows, pa.list_(pa.int32())),
        "values": pa.array([r.random(len(x)).astype(np.float32) for x in rows], pa.list_(pa.float32()))})
    monkeypatch.setattr(quality, "_sample", lambda *args: table)
    peaks, models = [], []
    for size in (16, 600):
        monkeypatch.setattr(quality, "TRAIN_ROWS", size)
        tracemalloc.start()
        models.append(quality.train(None, None, rounds=5))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert (models[0].weights == models[1].weights).all() and models[0].slope == models[1].slope and models[0].shift == models[1].shift
    assert peaks[0] < 0.7 * peaks[1]


def test_the_driver_gets_the_model_and_not_the_sample(spark, monkeypatch):
    docs, _, labels = corpus(spark)
    table = quality._sample(docs, labels, "doc_id", "text", "quality").toArrow()
    here = quality.fit_sample(table, 120)
    monkeypatch.setattr(type(docs), "toArrow", lambda self: pytest.fail("rows sent to the driver"))
    model = quality.train(docs, labels)
    assert (model.weights == here.weights).all() and (model.slope, model.shift) == (here.slope, here.shift)
