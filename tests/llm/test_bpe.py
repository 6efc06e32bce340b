import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from ledgerlake.llm import bpe

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PLAIN = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TEXTS = [
    None, "", " ", "\n\n", "a", " a", "a  b", "a \n b", "\n\nfoo\n\n bar", "it's we'll 'tis ''s", "!!'s it", "日本語 テキスト😀",
    " x\x85y\x1c z", "tab\t\tend  ", "x" * 400, "ab12cd 34  ef...gh", "<|endoftext|> plain",
]


def ids_of(frame):
    return sorted((r[0], r["ids"]) for r in frame.collect())


def expected(rows, path, special=()):
    encoding = bpe.load_ranks(path, PATTERN, special)
    names = {n for n, _ in special}
    return sorted((k, np.array(encoding.encode(t or "", allowed_special=names, disallowed_special=()), "<u4").tobytes())
                  for k, t in rows)


@pytest.mark.parametrize("chunk,overlap", [(1 << 16, 1 << 10), (60, 30), (16, 8)])
def test_same_ids_whole_or_in_chunks(spark, chunk, overlap):
    rng = random.Random(3)
    alphabet = ["word", " ", "  ", "\n", "'s", "é", "12", "...", "\t", "long" * 9, "日本", "'"]
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(120)) for _ in range(25)]
    rows = list(enumerate(texts)) + [(3, TEXTS[3]), (14, TEXTS[14])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = bpe.encode(docs, MULTI, PATTERN, chunk_chars=chunk, overlap_chars=overlap)
    assert ids_of(got) == expected(rows, MULTI)


def test_units_equal_the_tokenizers_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = (("<|endoftext|>", 50256),)
    units = bpe.Units(bpe.load_ranks(PLAIN, PATTERN, special), special)
    for text in TEXTS[1:] + ["a<|endoftext|>b", "a <|endoftext|> b  <|endoftext|>"]:
        assert np.frombuffer(units.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_cache_does_not_change_ids():
    encoding = bpe.load_ranks(MULTI, PATTERN)
    small, large = bpe.Units(encoding, entries=2), bpe.Units(encoding)
    text = "one two three one two  four\nfive one"
    assert small.ids(text) == large.ids(text)


def test_round_trip(spark, odd_docs, odd_rows):
    back = bpe.decode(bpe.encode(odd_docs, MULTI, PATTERN, chunk_chars=200, overlap_chars=50), MULTI)
    got = sorted((str(r["doc_id"]), hashlib.md5(r["raw"]).hexdigest()) for r in back.collect())
    assert got == sorted((str(r[0]), hashlib.md5((r[1] or "").encode()).hexdigest()) for r in odd_rows)


def test_empty_table(no_docs):
    assert bpe.encode(no_docs, MULTI, PATTERN).count() == 0
