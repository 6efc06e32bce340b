import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard_join, linking
from ledgerlake.llm.common import Workspace
from ledgerlake.llm.components import connected

from . import brute


def rows_of(frame):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in frame.collect())


def wanted(rows, n, percent):
    return sorted((str(k), size, str(least)) for k, size, least in brute.components(rows, n, percent))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_odd_rows(odd_docs, odd_rows, n, percent):
    assert rows_of(jaccard_join.components(odd_docs, words=n, percent=percent)) == wanted([r[:2] for r in odd_rows], n, percent)


@pytest.mark.parametrize("few", [linking.FEW_PRODUCTS, 0])
def test_large_group_of_near_copies(spark, monkeypatch, few):
    """Links between members matter where a pivot is not linked to all; without ``few``, pivots come first."""
    monkeypatch.setattr(linking, "FEW_PRODUCTS", few)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + i, passage + " " + " ".join(f"q{i}-{j}" for j in range(30 + i % 9))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jaccard_join.components(docs)) == wanted(rows, 4, 85)


def test_one_of_each_group_stays(odd_docs, odd_rows):
    kept = jaccard_join.keep_one(odd_docs, words=4, percent=85)
    assert kept.columns == odd_docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted({k for k, _, least in brute.components([r[:2] for r in odd_rows], 4, 85) if k is not None and k == least})


def test_empty_table(no_docs):
    assert jaccard_join.components(no_docs).count() == 0


def test_components_of_a_path(spark):
    space = Workspace(spark, "test")
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in connected(space, edges, "path").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_unlike_texts_of_one_id_both_stay(spark):
    a, b, c = (" ".join(f"{p}{i}" for i in range(30)) for p in "abc")
    rows = [(1, a), (1, b), (2, c), (2, c), (3, a + " end"), (None, c + " end"), (None, "")]
    docs = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], "doc_id long, text string, _id int, node int, label int")
    kept = jaccard_join.keep_one(docs, words=4, percent=85)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == sorted([("1", a), ("1", b), ("2", c), ("None", "")])


def test_pairs_that_share_many_columns_leave_the_join_once(spark):
    """Every column is met through its first entries; a spent one (not first there) is met by others only."""
    rng = random.Random(7)
    rows = [(c, node, rng.random() < 0.8) for node in range(30) for c in rng.sample(range(40), 30)]
    entries = spark.createDataFrame(rows, "column long, node long, first boolean")
    got = [(r["a"], r["b"]) for r in linking.met_once(entries, F.col("x.node") != F.col("y.node")).collect()]
    columns = {}
    for c, node, first in rows:
        columns.setdefault(c, []).append((node, first))
    want = {(min(m, n), max(m, n)) for c in columns.values() for m, f in c for n, g in c if m != n and (f or g)}
    assert set(got) == want and len(got) <= 1.1 * len(want)


def test_no_link_is_lost_beyond_the_compared_columns(spark, monkeypatch):
    monkeypatch.setattr(linking, "LOWEST", 1)
    monkeypatch.setattr(linking, "MAX_PIVOTS", 0)
    test_large_group_of_near_copies(spark, monkeypatch, 0)
