import math

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import ann


def brute(rows, k, every):
    good = {}
    for key, v in rows:
        if key is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good.setdefault(key, v)
    out = {}
    for q, v in good.items():
        if q % every == 0:
            found = sorted((-float(np.dot(np.float64(v), np.float64(w))), key) for key, w in good.items() if key != q and len(w) == len(v))
            out[q] = [(key, -s) for s, key in found[:k]]
    return out


def run(spark, rows, k=5, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 4 == 0, k=k, **more).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    return got


def same(got, want):
    assert set(got) == {q for q, found in want.items() if found}
    for q, found in got.items():
        assert [r for _, _, r in found] == list(range(1, len(found) + 1))
        assert [v for v, _, _ in found] == [v for v, _ in want[q]]
        np.testing.assert_allclose([s for _, s, _ in found], [s for _, s in want[q]], rtol=1e-12, atol=1e-15)


def test_odd_rows_with_every_bucket_probed(spark):
    rng = np.random.default_rng(1)
    rows = [(i, np.float32(rng.normal(size=6)).tolist()) for i in range(60)]
    rows += [(100 + i, rows[8][1]) for i in range(20)]  # one vector many times
    rows += [rows[4], rows[8], (200, None), (204, []), (208, [0.0] * 6), (212, [float("nan")] * 6), (216, [1.0, None] * 3),
             (220, [float("inf")] * 6), (None, rows[0][1]), (224, [1.0, 2.0]), (225, [2.0, 1.0]), (228, [5.0])]
    for block in (4096, 7):
        same(run(spark, rows, probes=10**6, tables=2, block=block), brute(rows, 5, 4))


def test_recall(spark):
    rng = np.random.default_rng(2)
    for scale in (np.ones(2000), rng.uniform(0.5, 2, 2000)):
        x = rng.normal(size=(2000, 24))
        x = np.float32(x / np.linalg.norm(x, axis=1, keepdims=True) * scale[:, None])
        rows = [(i, v.tolist()) for i, v in enumerate(x)]
        got, want = run(spark, rows, k=10), brute(rows, 10, 4)
        hits = sum(len({v for v, _, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
        assert hits >= 0.9 * sum(map(len, want.values()))


def test_recall_where_norms_differ(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(5000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    outlier = np.ones(5000)
    outlier[0] = 10
    for norms in (outlier, np.exp(0.5 * rng.normal(size=5000))):
        rows = [(i, v.tolist()) for i, v in enumerate(np.float32(x * norms[:, None]))]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        stored = np.float64([v for _, v in rows])
        hits = 0
        got = {}
        for r in ann.search(df, F.col("vec_id") % 50 == 0, k=20).collect():
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
        for q in range(0, 5000, 50):
            score = stored @ stored[q]
            score[q] = -np.inf
            hits += len(got[q] & set(np.argsort(-score)[:20].tolist()))
        assert hits >= 0.97 * 100 * 20


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_rotation_keeps_products():
    x = np.random.default_rng(0).normal(size=(9, 5))
    for y in ann.turned(x, 3, 1):
        np.testing.assert_allclose(y @ y.T, x @ x.T, atol=1e-12)
