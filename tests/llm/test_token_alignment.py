import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlake.llm import token_alignment

ODD = ["<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", " ▁", "  two  spaces   and\ttabs\r\n\n  lines ", "日本語 テキスト 😀 🙂", "\x00 \x01", "x" * 3000,
       " ", "ab" * 2000 + " z", "é é    x \x85 \x1c y", "1,234.56 don't", "� ﻿"]


def brute(rows):
    """Whole texts through the libraries, all links in one table."""
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    # The printable stand-ins of bytes in the vocabulary (fixed by the public format).
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    out, counts, kept = [], Counter(), []
    for key, text in rows:
        raw = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_bytes = [bytes(stand[c] for c in first.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            kept.append((key, [], [], [], []))
            continue
        ends = [[0], [0]]
        for side, parts in zip(ends, (a_bytes, b_bytes)):
            for part in parts:
                side.append(side[-1] + len(part))
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b))
                 if max(ends[0][i], ends[1][j]) < min(ends[0][i + 1], ends[1][j + 1])] if len(raw) < 5000 else None
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [",".join(str(t) for t, e in zip(a, ends[0][1:]) if lo < e <= hi) + "|" + ",".join(str(t) for t, e in zip(b, ends[1][1:]) if lo < e <= hi)
                  for lo, hi in zip(cuts, cuts[1:])]
        kept.append((key, a, b, links, groups))
        counts.update(links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    for key, a, b, links, groups in kept:
        out.append((str(key), len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    return sorted(out)


def rows_of(frame):
    return sorted((str(r["doc_id"]), *[r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")]) for r in frame.collect())


def aligned(docs):
    return token_alignment.align(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                                 public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def rows(odd_rows):
    return [r[:2] for r in odd_rows] + [(2000 + i, t) for i, t in enumerate(ODD)]


@pytest.mark.parametrize("links,fan,cache", [(1 << 20, 64, 300_000), (200, 3, 50)])
def test_against_whole_texts(spark, rows, monkeypatch, links, fan, cache):
    """Also with many small runs merged on several levels and a cache that starts again."""
    for name, value in (("RUN_LINKS", links), ("FAN", fan), ("CACHE_ENTRIES", cache), ("SLICE_CHARS", 500 if fan == 3 else 1 << 20)):
        monkeypatch.setattr(token_alignment, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(aligned(docs)) == brute(rows)


def test_blocks_merge_in_steps(monkeypatch):
    import numpy as np

    monkeypatch.setattr(token_alignment, "MERGE_STEP", 3)
    rng, total, blocks = np.random.default_rng(3), Counter(), []
    for n in (0, 1, 5, 40, 200):
        keys = np.unique(rng.integers(0, 300, n).astype(np.uint64))
        times = rng.integers(1, 9, len(keys))
        total.update(dict(zip(keys.tolist(), times.tolist())))
        blocks.append(token_alignment.pack_sums(keys, times))
    keys, times = token_alignment.merged(blocks)
    assert list(zip(keys.tolist(), times.tolist())) == sorted(total.items())


def test_empty_table_and_clashing_columns(spark, no_docs, rows):
    assert aligned(no_docs).count() == 0
    few = rows[:12]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in few], "doc_id long, text string, key int, run int, radix int, doc int, n_a int")
    assert rows_of(aligned(docs)) == brute(few)
