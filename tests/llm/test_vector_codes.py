import hashlib
import math
import random

import duckdb
import pytest

from ledgerlake.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """Plain loops over Python integers."""
    kept = sorted([(k is None, k or 0, [float(x) for x in v], label) for k, v, label in rows
                   if v is not None and all(x is not None and math.isfinite(x) for x in v)], key=lambda r: r[:3])
    if not kept:
        return []
    width = len(kept[0][2])
    vectors = [([math.floor(4096 * x) for x in v], None if no else k, label) for no, k, v, label in kept if len(v) == width]
    cuts = [(width * p // parts, width * (p + 1) // parts) for p in range(parts)]
    first = [[math.floor(4096 * x) for x in v] for _, _, v, _ in kept[:entries] if len(v) == width]
    books = [[v[a:b] for v in first] for a, b in cuts]

    def nearest(v, p):
        a, b = cuts[p]
        return min((sum((x - y) ** 2 for x, y in zip(v[a:b], entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            chosen = [(nearest(v, p)[1], v[a:b]) for v, _, _ in vectors]
            fresh = []
            for e, entry in enumerate(books[p]):
                mine = [v for at, v in chosen if at == e]
                fresh.append([sum(c) // len(mine) for c in zip(*mine)] if mine else entry)
            books[p] = fresh
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    found, sums = [], {}
    for v, k, label in vectors:
        best = [nearest(v, p) for p in range(parts)]
        error = sum(d for d, _ in best)
        sums[label] = sums.get(label, 0) + error
        found.append((str(k), "".join("%02x" % e for _, e in best), error, label))
    return sorted((k, code, error, sums[label], digest) for k, code, error, label in found)


def rows_of(frame):
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in frame.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = [(i, [rng.uniform(-1, 1) * (1 + i % 3) for _ in range(24)], [0, 1, 2, None][i % 4]) for i in range(300)]
    out += [out[0], out[0], (5, out[7][1], 1), (None, out[8][1], 2), (None, None, 1), (900, [], 1), (901, [1.0] * 23, 1)]
    out += [(902, [None, *[0.5] * 23], 0), (903, [float("nan"), *[0.5] * 23], 0), (904, [float("inf"), *[0.5] * 23], 0), (905, [0.0] * 24, None)]
    return out


def test_against_plain_loops(spark, rows):
    as_floats = [(k, v, la) for k, v, la in rows]
    frame = spark.createDataFrame(as_floats, SCHEMA).repartition(7)
    back = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.collect()]
    assert rows_of(vector_codes.encode(frame)) == brute(back)


@pytest.mark.parametrize("factor", [1e6, 1e30])
def test_wide_components(spark, rows, factor):
    """Beyond 64 bits the arithmetic is still exact; errors that do not fit are null."""
    wide = [(k, [x * factor for x in v], la) for k, v, la in rows[:40]]
    frame = spark.createDataFrame(wide, SCHEMA.replace("float", "double"))
    want = [(k, code, e if e < 2**63 else None, s if s < 2**63 else None, d) for k, code, e, s, d in brute(wide)]
    got = rows_of(vector_codes.encode(frame))
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]


def test_parts_that_do_not_divide_and_small_tables(spark):
    for rows in ([(1, [0.25, -0.5, 1.0], 1), (2, [0.5, 0.5, 0.5], None)], [(1, [], 1), (2, [], 1)]):
        frame = spark.createDataFrame(rows, SCHEMA)
        assert rows_of(vector_codes.encode(frame)) == brute(rows)


def test_empty_table_and_clashing_columns(spark, rows):
    assert vector_codes.encode(spark.createDataFrame([], SCHEMA)).count() == 0
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows[:30]], SCHEMA + ", id int, v int, code int, of int")
    assert len(rows_of(vector_codes.encode(frame))) == 30


def test_oracle(spark):
    folder = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{folder}/embeddings.parquet")
    base = duckdb.connect()
    base.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    got = base.execute("SELECT vec_id, code, error, label_error, codebooks_sha256 FROM (" + vector_codes.oracle("embeddings") + ")").fetchall()
    assert rows_of(vector_codes.encode(frame)) == sorted((str(r[0]), *r[1:]) for r in got)
