import random

import numpy as np
import pytest

from ledgerlake.llm import linking, minhash

from . import brute


def rows_of(frame):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in frame.collect())


def wanted(rows, n, percent):
    return sorted((str(k), size, str(least), k == least) for k, size, least in brute.components(rows, n, percent))


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_odd_rows(odd_docs, odd_rows, n, percent):
    assert rows_of(minhash.near_duplicates(odd_docs, words=n, percent=percent)) == wanted([r[:2] for r in odd_rows], n, percent)


@pytest.mark.parametrize("few", [linking.FEW_PRODUCTS, 0])
def test_group_of_near_copies(spark, monkeypatch, few):
    """Links between members matter where a pivot is not linked to all; without ``few``, pivots come first."""
    monkeypatch.setattr(linking, "FEW_PRODUCTS", few)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + i, passage + " " + " ".join(f"q{i}-{j}" for j in range(30 + i % 9))) for i in range(60)]
    rows += [(2000 + i, " ".join(f"{i}-{j}" for j in range(1 + i % 5))) for i in range(40)] + [(3000 + i, f"{i}-0") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(minhash.near_duplicates(docs, words=3, percent=85)) == wanted(rows, 3, 85)


def test_clashing_columns(spark, odd_rows):
    rows = [r[:2] for r in odd_rows]
    names = ["_id", "_h", "n", "node", "label", "signed", "column", "s0", "b0", "key"]
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, " + ", ".join(f"{c} int" for c in names))
    assert rows_of(minhash.near_duplicates(docs, words=3, percent=85)) == wanted(rows, 3, 85)


def test_empty_table(no_docs):
    found = minhash.near_duplicates(no_docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"] and found.count() == 0


def test_threshold_and_match_rate():
    """Agreeing coordinates estimate the similarity; nibbles never count fewer collisions."""
    least = minhash.matches(128, 85)
    assert least == 81
    rng = np.random.default_rng(1)
    shared, own = rng.integers(0, 2**63, 1700, np.uint64), rng.integers(0, 2**63, (2, 150), np.uint64)
    signed = minhash.signatures([np.unique(np.append(shared, o)) for o in own], 128)
    agree = int((signed[0] == signed[1]).sum())
    assert abs(agree / 128 - 0.85) < 0.12
    x = minhash.nibbles(signed).view(np.uint64)
    same = sum(int(x[0, i] >> np.uint64(4 * j)) & 15 == int(x[1, i] >> np.uint64(4 * j)) & 15 for i in range(8) for j in range(16))
    assert same >= agree


def test_sets_that_share_few_coordinates_are_not_posted(spark, monkeypatch):
    """Neighbours share a fifth of their text, which never links; only the near copies may reach the lists."""
    posted = []
    inner = minhash.links_of

    def spy(space, entries, *rest):
        posted.extend(r["node"] for r in entries.select("node").distinct().collect())
        return inner(space, entries, *rest)

    monkeypatch.setattr(minhash, "links_of", spy)
    rows = [(i, " ".join([f"s{i // 2}-{j}" for j in range(25)] + [f"o{i}-{j}" for j in range(100)])) for i in range(60)]
    rows += [(100 + i, " ".join(f"n{i // 2}-{j}" for j in range(100)) + f" e{i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(minhash.near_duplicates(docs, words=3, percent=85)) == wanted(rows, 3, 85)
    assert len(posted) == 20
