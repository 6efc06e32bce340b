"""Language identification as a mixture: how much of each language a text holds.

Training counts hashed byte n-grams of labelled texts per language. A word's likelihood under a language
is the product of its n-grams' smoothed probabilities. Expectation-maximisation then estimates, per text,
the proportions of the languages that its words come from. The languages are ordered by proportion; of the
sets holding the first one, two, ... all the one of the best likelihood less a penalty (half the logarithm of
the number of words for each further language, times ``penalty``) is taken, and its largest member is
the prediction, its proportion the score.

Null texts and texts without a letter are ``und`` with score 0, and so is every text if nothing was
learned. Null labels are not learned from. Ties go to the language that sorts first. The model holds
languages x ``2 ** bits`` numbers, whatever the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import mix, own_columns, own_schema, slices, text_bytes, with_own
from ledgerlake.llm.rolling import words_of

BITS = 16
ORDER = 3
PENALTY = 4.0
ROUNDS = 12
PART_BYTES = 1 << 18

_LETTER = re.compile(r"[^\W\d_]")


def _folded(raw: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the two-byte Latin letters À-Þ."""
    out = raw + np.where((raw >= 65) & (raw <= 90), 32, 0).astype(np.uint8)
    if len(raw) > 1:
        out[1:] += np.where((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97), 32, 0).astype(np.uint8)
    return out


def word_grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the n-gram that ends at each byte of a word, the words' first entries, and words per text.

    An n-gram begins with one space before the word at most.
    """
    begin, end, rows = words_of(raw, offsets)
    size = end - begin
    first = np.cumsum(size) - size
    at = np.repeat(begin - first, size) + np.arange(size.sum())
    low = _folded(raw).astype(np.uint64)
    within = at - np.repeat(begin, size)
    value = low[at]
    for back in range(1, ORDER):
        before = np.where(within >= back, low[np.maximum(at - back, 0)], np.where(within == back - 1, 32, 0))
        value = value | (before.astype(np.uint64) << np.uint64(8 * back))
    return (mix(value) >> np.uint64(64 - BITS)).astype(np.int32), first, rows


@dataclass
class LanguageModel:
    languages: list[str]
    logs: np.ndarray  # buckets x languages

    @classmethod
    def fit(cls, docs: DataFrame, where: Column, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
        """Counts over all labelled rows that satisfy ``where``."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[str, np.ndarray] = {}
            for batch in batches:
                langs = batch["lang"].to_pylist()
                raw, offsets = text_bytes(batch["text"])
                for low, high in slices(offsets, PART_BYTES):
                    part = offsets[low:high + 1] - offsets[low]
                    bucket, first, rows = word_grams(raw[offsets[low]:offsets[high]], part)
                    edge = np.append(first, len(bucket))[rows]
                    for i in range(high - low):
                        found = np.bincount(bucket[edge[i]:edge[i + 1]], minlength=1 << BITS)
                        held = totals.get(langs[low + i])
                        totals[langs[low + i]] = found if held is None else held + found
            for lang, total in totals.items():
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(total[some])],
                    ["lang", "bucket", "n"])

        chosen = docs.where(where & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        rows = (
            chosen.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
        )
        encoded = rows["lang"].combine_chunks().dictionary_encode()
        names = encoded.dictionary.to_pylist()
        order = sorted(range(len(names)), key=lambda i: names[i])
        place = np.argsort(order) if order else np.zeros(0, int)
        counts = np.full((1 << BITS, len(names)), 0.1)
        if names:
            counts[rows["bucket"].to_numpy(), place[encoded.indices.to_numpy()]] += rows["n"].to_numpy()
        return cls([names[i] for i in order], np.log(counts / counts.sum(axis=0)).astype(np.float32))

    def predict(self, raw: np.ndarray, offsets: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
        """Index of the predicted language (-1 without a word) and its proportion, per text."""
        n_texts, n_langs = len(offsets) - 1, len(self.languages)
        best, score = np.full(n_texts, -1), np.zeros(n_texts)
        bucket, first, rows = word_grams(raw, offsets)
        words = np.diff(rows)
        some = np.flatnonzero(words)
        if not len(some) or not n_langs:
            return best, score
        each = np.add.reduceat(self.logs[bucket], first, axis=0)
        top = each.max(axis=1)
        each = np.exp(each - top[:, None], dtype=np.float32)
        starts = rows[:-1][some]
        count = words[some].astype(np.float64)
        owner = np.repeat(np.arange(len(some)), words[some])

        def mixture(allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            share = allowed / allowed.sum(axis=1, keepdims=True)
            for _ in range(ROUNDS if allowed.shape[1] > 1 else 1):
                part = each * share.astype(np.float32)[owner]
                total = part.sum(axis=1)
                part /= np.maximum(total, 1e-30)[:, None]
                share = np.add.reduceat(part, starts, axis=0) / count[:, None]
            total = (each * share.astype(np.float32)[owner]).sum(axis=1)
            return share, np.add.reduceat(np.log(np.maximum(total, 1e-30)), starts)

        share, _ = mixture(np.ones((len(some), n_langs)))
        rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1)
        value = np.full(len(some), -np.inf)
        for k in range(1, n_langs + 1):
            if k == 1:
                kept = (rank == 0).astype(np.float64)
                likely = np.add.reduceat(
                    np.log(np.maximum((each * kept.astype(np.float32)[owner]).sum(axis=1), 1e-30)), starts)
            else:
                kept, likely = mixture((rank < k).astype(np.float64))
            likely = likely - penalty * 0.5 * (k - 1) * np.log(count + 1)
            better = likely > value
            value = np.where(better, likely, value)
            best[some] = np.where(better, kept.argmax(axis=1), best[some])
            score[some] = np.where(better, kept.max(axis=1), score[some])
        return best, np.clip(score, 0.0, 1.0)


def learnable(id_col: str = "doc_id") -> Column:
    """Rows to learn from: four of five by a checksum of the id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


def identify(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``. Columns of these names are replaced."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    base = docs.drop("lang_pred", "score")
    columns = base.columns
    keyed = base.select(own_columns(columns), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch["text"]
            raw, offsets = text_bytes(texts)
            best, score = [], []
            for low, high in slices(offsets, PART_BYTES):
                found, sure = model.predict(raw[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
                best.append(found)
                score.append(sure)
            best, score = np.concatenate([[], *best]).astype(int), np.concatenate([[], *score])
            letters = np.array([t is not None and _LETTER.search(t) is not None for t in texts.to_pylist()], bool)
            best = np.where(letters, best, -1)
            names = [model.languages[i] if i >= 0 else "und" for i in best.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch["_own"], pa.array(names, pa.string()), pa.array(np.where(best >= 0, score, 0.0))],
                ["_own", "lang_pred", "score"])

    told = keyed.mapInArrow(run, own_schema(base, columns, "lang_pred string, score double"))
    return with_own(told, columns, "lang_pred", "score")
