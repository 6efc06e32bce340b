import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import substring_dedup, suffix_dedup
from ledgerlake.llm.repeats import anchor_table, byte_units
from ledgerlake.llm.rolling import BYTE_VALUES, Rolled, anchors, words_of

from . import brute


def word_result(rows, window):
    lists = [brute.words(t) for _, t in rows]
    return sorted(
        (str(k), len(w), sum(g), hashlib.sha256(b" ".join(x for x, gone in zip(w, g) if not gone)).hexdigest())
        for (k, _), w, g in zip(rows, lists, brute.covered(lists, window)))


def byte_result(rows, window):
    lists = [(t or "").encode() for _, t in rows]
    return sorted(
        (str(k), len(w), sum(g), brute.runs(g), hashlib.sha256(bytes(x for x, gone in zip(w, g) if not gone)).hexdigest())
        for (k, _), w, g in zip(rows, lists, brute.covered(lists, window)))


@pytest.mark.parametrize("window", [1, 4, 12, 35])
def test_word_windows(spark, odd_docs, odd_rows, window):
    got = substring_dedup.remove_repeats(odd_docs, window, digest=True).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == \
        word_result([r[:2] for r in odd_rows], window)


@pytest.mark.parametrize("window,limit", [(30, 2048), (200, 2048), (60, 2)])
def test_byte_strings(spark, odd_docs, odd_rows, window, limit):
    got = suffix_dedup.remove_repeats(odd_docs, window, digest=True, branch_limit=limit).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == \
        byte_result([r[:2] for r in odd_rows], window)


def test_random_small_alphabet(spark):
    rng = random.Random(9)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, 24, digest=True).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == \
        byte_result(rows, 24)


def test_texts_and_columns_are_kept(spark, odd_docs):
    out = suffix_dedup.remove_repeats(odd_docs, 200)
    assert set(odd_docs.columns) | {"n_bytes", "n_removed", "n_spans", "removed"} == set(out.columns)
    for r in out.collect():
        assert sum(s["last"] - s["first"] + 1 for s in r["removed"]) == r["n_removed"] and len(r["removed"]) == r["n_spans"]
    words = substring_dedup.remove_repeats(odd_docs, 35)
    assert all(len(brute.words(r["text"])) == r["n_words"] - r["n_removed"] for r in words.collect())


def test_empty_tables(no_docs):
    assert substring_dedup.remove_repeats(no_docs, digest=True).count() == 0
    assert suffix_dedup.remove_repeats(no_docs, digest=True).count() == 0


def test_interval_tree():
    #   suffixes with common prefixes 0 3 5 5 2 of neighbours: {2..4} share 5, {1..4} 3, {1..5} 2
    assert list(suffix_dedup.intervals([0, 3, 5, 5, 2], 1)) == [(5, 1, 3), (3, 0, 3), (2, 0, 4)]


def test_every_window_has_one_anchor():
    rng = np.random.default_rng(4)
    raw = rng.integers(97, 100, 3000).astype(np.uint8)
    offsets = np.array([0, 900, 900, 910, 3000])
    found = anchors(Rolled(BYTE_VALUES[raw]), offsets, 10, 50)
    windows = np.concatenate([np.arange(f, f + c) for f, c in zip(found.first, found.count)])
    want = np.concatenate([np.arange(a, b - 49) for a, b in zip(offsets, offsets[1:]) if b - a >= 50])
    assert np.array_equal(windows, want)
    reach = np.repeat(found.at, found.count)
    assert ((reach >= windows) & (reach + 10 <= windows + 50)).all()


def test_long_texts_come_in_blocks(spark, monkeypatch):
    from ledgerlake.llm import repeats

    monkeypatch.setattr(repeats, "BLOCK", 64)
    rng = random.Random(1)
    text = "".join(rng.choice("abc") for _ in range(1000))
    raw, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, 1000])
    blocks = list(repeats.unit_blocks(__import__("pyarrow").array([text]), byte_units, 19))
    starts = [base + i for units, rows, low, base in blocks for i in range(len(units) - 19) if i < 64]
    assert starts == list(range(981)) and raw.size == offsets[-1]
    assert anchor_table.__module__.endswith("repeats")


def test_words_do_not_cross_texts():
    begin, end, rows = words_of(np.frombuffer(b"ab cd" + b"ef" + b" g ", np.uint8), np.array([0, 5, 5, 7, 10]))
    assert list(zip(begin, end)) == [(0, 2), (3, 5), (5, 7), (8, 9)] and rows.tolist() == [0, 2, 2, 3, 4]


CLASHES = ["_id", "_h", "_own", "_text", "_ranges", "key", "first", "left", "marks", "text_"]


@pytest.mark.parametrize("remove,window", [(substring_dedup.remove_repeats, 12), (suffix_dedup.remove_repeats, 60)])
def test_clashing_columns(spark, odd_docs, remove, window):
    added = ["n_words", "n_removed", "N_BYTES", "n_spans", "removed"]
    docs = odd_docs.withColumns({c: F.lit(c) for c in [*CLASHES, *added]})
    plain = remove(odd_docs, window)
    got = remove(docs, window)
    new = [c for c in plain.columns if c not in odd_docs.columns or c == "text"]
    assert set(CLASHES) < set(got.columns)
    for r in got.select(*CLASHES).distinct().collect():
        assert list(r) == CLASHES
    assert sorted(map(str, got.select("doc_id", *new).collect())) == sorted(map(str, plain.select("doc_id", *new).collect()))


def test_one_anchor_in_ever_different_surroundings(spark):
    """A common line whose half windows differ everywhere but in two texts."""
    rng = random.Random(4)

    def noise(n):
        return "".join(rng.choice("abcdefghij klmnop") for _ in range(n))

    line = noise(45)
    rows = [(i, noise(150) + line + noise(150)) for i in range(80)]
    whole = noise(120) + line + noise(70)
    rows += [(100, noise(40) + whole + noise(30)), (101, noise(90) + whole), (102, whole[:130] + noise(200)), (103, whole[60:] + noise(99))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, 200, digest=True).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == byte_result(rows, 200)
