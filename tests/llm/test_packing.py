import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers

from ledgerlake.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def check(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(held)


def test_pieces_and_sequences(spark, odd_docs, odd_rows):
    pieces = packing.cut_pieces(odd_docs, PATH, PATTERN, capacity=64)
    rows = packing.pack(pieces, capacity=64, block_items=40).collect()
    encoding = bpe.load_ranks(PATH, PATTERN)
    want = []
    for key, text, *_ in odd_rows:
        ids = encoding.encode_ordinary(text or "") + [0]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((str(key), n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    least = -(-sum(w[3] for w in want) // 64)
    assert check(rows, 64) <= 1.15 * least + 2


def test_deals_over_blocks_and_levels(spark):
    rng = np.random.default_rng(2)
    pieces = spark.createDataFrame(
        [(i, 0, 0, int(n), 7) for i, n in enumerate(rng.integers(1, 500, 3000))],
        "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(pieces, capacity=500, block_items=300).collect()
    assert len(rows) == 3000 and len({r["doc_id"] for r in rows}) == 3000
    assert check(rows, 500) <= 1.02 * sum(r["length"] for r in rows) / 500 + 2


def test_children_are_whole_packings():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 100, 200)
    for seeds in ([], [np.arange(200)]):
        out = packing.evolve(sizes, 128, 1, seeds)
        assert np.bincount(out, sizes).max() <= 128
    # A perfect packing that greedy filling misses: 4 x (60 + 40), 4 x (51 + 49).
    exact = np.array([60, 40] * 4 + [51, 49] * 4)
    assert packing.evolve(exact, 100, 3).max() + 1 == 8


def test_empty_table(no_docs):
    assert packing.pack(packing.cut_pieces(no_docs, PATH, PATTERN)).count() == 0
