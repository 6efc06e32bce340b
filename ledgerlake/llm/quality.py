"""Quality rules: counted facts of a text and a calibrated classifier over hashed n-grams.

The classifier is a logistic regression over hashed frequencies of words, word pairs and byte n-grams,
trained by one task on labelled rows: at most ``SAMPLE_ROWS`` of them, those of least hash of their id, with at most
``SAMPLE_CHARS`` characters. A fifth of the sample, unseen in training, calibrates its probability. Texts
are scored in Arrow batches against the fixed ``THRESHOLD``. Facts cover every whole text.

Null texts have no words: all facts 0, base_failed. Equal rows get equal results. Labels that are null, or
name an id twice with different values, do not train; without rows of both classes the classifier keeps
everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import mix, own_columns, own_schema, slices, text_bytes, with_own
from ledgerlake.llm.rolling import BYTE_VALUES, SPACE, Rolled, word_units, words_of

BITS = 18
SAMPLE_ROWS = 4000
SAMPLE_CHARS = 20_000
THRESHOLD = 0.3
MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
PART_BYTES = 1 << 18
TRAIN_ROWS = 128  # rows of the sample whose entries are held at full width at once

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def text_features(raw: np.ndarray, offsets: np.ndarray, begin, end, rows) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket of each entry, n + 1 offsets per text) of each family: words, word pairs, byte n-grams."""
    units = word_units(raw, begin, end)
    pairs = units * np.uint64(3)
    pairs[:-1] += units[1:]
    last = rows[1:][np.diff(rows) > 0] - 1
    pairs[last] = units[last] * np.uint64(3)  # the last word of a text has no follower
    values = BYTE_VALUES[raw]
    grams = values.copy()
    into = np.arange(len(raw)) - np.repeat(offsets[:-1], np.diff(offsets))
    for back, times in ((1, 3), (2, 5), (3, 7)):
        grams[back:] += np.where(into[back:] >= back, values[:-back], np.uint64(0)) * np.uint64(times)
    families = [(units, rows), (mix(pairs), rows), (mix(grams), offsets)]
    return [((mix(v + np.uint64(i)) >> np.uint64(64 - BITS)).astype(np.int32), at) for i, (v, at) in enumerate(families)]


@dataclass
class QualityModel:
    weights: np.ndarray
    slope: float
    shift: float

    def probability(self, raw, offsets, begin, end, rows) -> np.ndarray:
        total = np.zeros(len(offsets) - 1)
        for bucket, at in text_features(raw, offsets, begin, end, rows):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[bucket], dtype=np.float64)])
            total += (sums[at[1:]] - sums[at[:-1]]) / np.maximum(np.diff(at), 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * total + self.shift, -40, 40)))


KEEP_ALL = QualityModel(np.zeros(1 << BITS, np.float32), 0.0, 40.0)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.min(label_col).alias("low"), F.max(label_col).alias("high")).where("low = high")
    chosen = known.select(F.col(id_col).alias("_key"), (F.col("low") > 0).alias("_good")).orderBy(
        F.xxhash64("_key"), "_key").limit(SAMPLE_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch["_text"])
            begin, end, rows = words_of(raw, offsets)
            found = text_features(raw, offsets, begin, end, rows)
            buckets, values = [], []
            for i in range(batch.num_rows):
                row = np.zeros(1 << BITS, np.float32)
                for bucket, at in found:
                    part = bucket[at[i]:at[i + 1]]
                    np.add.at(row, part, 1 / max(1, len(part)))
                some = np.flatnonzero(row)
                buckets.append(some.astype(np.int32))
                values.append(row[some])
            yield pa.RecordBatch.from_arrays(
                [batch["_key"], batch["_good"], pa.array(buckets, pa.list_(pa.int32())),
                 pa.array(values, pa.list_(pa.float32()))], ["_key", "_good", "buckets", "values"])

    texts = docs.where((F.length(text_col) > 0) & (F.length(text_col) <= SAMPLE_CHARS)).select(
        F.col(id_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_key")  # at most SAMPLE_ROWS small rows
    kind = dict(rows.dtypes)["_key"]
    return rows.select("_key", "_good", "_text").mapInArrow(
        run, f"_key {kind}, _good boolean, buckets array<int>, values array<float>").dropDuplicates(["_key"])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rounds: int = 120) -> QualityModel:
    """The model of the sample. A task fits it, as the sample is bounded; the driver gets the weights alone."""

    def fit(rows: pa.Table) -> pa.Table:
        model = fit_sample(rows, rounds)
        some = [] if model is KEEP_ALL else [model]
        return pa.table(
            [pa.array([m.weights.tobytes() for m in some], pa.binary()), pa.array([m.slope for m in some], pa.float64()),
             pa.array([m.shift for m in some], pa.float64())], ["weights", "slope", "shift"])

    sample = _sample(docs, labels, id_col, text_col, label_col)
    if isinstance(sample, pa.Table):  # rows at hand need no task
        return fit_sample(sample, rounds)
    found = sample.withColumn("_all", F.lit(0)).groupBy("_all").applyInArrow(fit, "weights binary, slope double, shift double").first()
    return KEEP_ALL if found is None else QualityModel(np.frombuffer(found["weights"], np.float32), found["slope"], found["shift"])


def fit_sample(table: pa.Table, rounds: int) -> QualityModel:
    table = table.sort_by("_key")
    good = table["_good"].to_numpy().astype(float)
    if len(good) < 10 or good.min() == good.max():
        return KEEP_ALL
    lists, values = table["buckets"].combine_chunks(), table["values"].combine_chunks()
    del table
    offsets = lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    bucket, value = lists.flatten().to_numpy(), values.flatten().to_numpy()
    # Entries are taken a few rows at a time, in order: sums come out the same and no temporary is as long as the sample.
    blocks = [(low, min(low + TRAIN_ROWS, len(good))) for low in range(0, len(good), TRAIN_ROWS)]

    def entries(low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        part = slice(offsets[low], offsets[high])
        return np.repeat(np.arange(high - low), np.diff(offsets[low:high + 1])), bucket[part], value[part]

    def row_sums(scale: np.ndarray, w: np.ndarray) -> np.ndarray:
        sums = []
        for low, high in blocks:
            row, at, part = entries(low, high)
            sums.append(np.bincount(row, part * scale[at] * w[at], high - low))
        return np.concatenate(sums)

    held = np.arange(len(good)) % 5 == 4
    # Frequencies differ by orders of magnitude; scaling by their spread makes the rare ones learnable.
    squares = np.zeros(1 << BITS)
    for low, high in blocks:
        _, at, part = entries(low, high)
        np.add.at(squares, at, (part * part).astype(float))
    spread = np.sqrt(squares / len(good))
    scale = np.where(spread > 0, 1 / (spread + 1e-3), 0.0) * 0.02
    weight = np.where(held, 0.0, np.where(good > 0, 0.5 / max(1, good[~held].sum()), 0.5 / max(1, (1 - good[~held]).sum())))
    w, bias = np.zeros(1 << BITS), 0.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    mb = vb = 0.0
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(row_sums(scale, w) + bias, -40, 40)))
        error = weight * (p - good)
        gradient = np.zeros(1 << BITS)
        for low, high in blocks:
            row, at, part = entries(low, high)
            np.add.at(gradient, at, part * scale[at] * error[low:high][row])
        gradient += 1e-6 * w
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient * gradient
        mb, vb = 0.9 * mb + 0.1 * error.sum(), 0.99 * vb + 0.01 * error.sum() ** 2
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
        bias -= 0.1 * (mb / (1 - 0.9 ** step)) / (np.sqrt(vb / (1 - 0.99 ** step)) + 1e-6)
    logit = row_sums(scale, w) + bias
    slope, shift = _calibrate(logit[held], good[held])
    return QualityModel((w * scale).astype(np.float32), slope, shift + slope * bias)


def _calibrate(logit: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through smoothed targets, by Newton steps."""
    if not len(good):
        return 1.0, 0.0
    ones = good.sum()
    target = np.where(good > 0, (ones + 1) / (ones + 2), 1 / (len(good) - ones + 2))
    center, width = logit.mean(), logit.std() + 1e-9
    x = np.stack([(logit - center) / width, np.ones(len(logit))], axis=1)
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta -= np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * theta)
    return float(theta[0] / width), float(theta[1] - theta[0] * center / width)


def _line_repeats(text: bytes) -> int:
    seen, repeats = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            repeats += 1
        elif line.strip(b" \t\n\v\f\r"):
            seen.add(line)
    return repeats


def _repeat_words(rolled: Rolled, low: int, high: int, grams: np.ndarray) -> int:
    n = high - low
    if n <= REPEAT_WINDOW:
        return 0
    part = grams[low:high - REPEAT_WINDOW + 1]
    order = np.argsort(part, kind="stable")
    ranked = part[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(part), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(twice)
    step[at] += 1
    step[at + REPEAT_WINDOW] -= 1
    return int((np.cumsum(step[:-1]) > 0).sum())


FACTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_facts(raw: np.ndarray, offsets: np.ndarray, begin, end, rows) -> dict[str, np.ndarray]:
    if not len(raw):
        return {name: np.zeros(len(offsets) - 1, np.int64) for name in FACTS}
    point = np.append(0, np.cumsum((~SPACE[raw]) & ((raw & 0xC0) != 0x80)))
    symbol = np.append(0, np.cumsum(_SYMBOL[raw]))
    rolled = Rolled(word_units(raw, begin, end))
    grams = rolled.grams(REPEAT_WINDOW)
    data = raw.tobytes()
    return {
        "n_words": np.diff(rows),
        "word_chars": point[offsets[1:]] - point[offsets[:-1]],
        "n_symbols": symbol[offsets[1:]] - symbol[offsets[:-1]],
        "n_dup_lines": np.array([_line_repeats(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]),
        "n_repeat_words": np.array(
            [_repeat_words(rolled, a, b, grams) for a, b in zip(rows[:-1].tolist(), rows[1:].tolist())]),
    }


def judge(docs: DataFrame, model: QualityModel, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the facts, ``base_failed``, ``quality_score`` and ``kept``. Columns of these names are replaced."""
    added = [*FACTS, "base_failed", "quality_score", "kept"]
    base = docs.drop(*added)
    columns = base.columns
    keyed = base.select(own_columns(columns), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            parts, scores = [], []
            for low, high in slices(offsets, PART_BYTES):
                sub, at = raw[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
                words = words_of(sub, at)
                parts.append(text_facts(sub, at, *words))
                scores.append(model.probability(sub, at, *words))
            facts = {f: np.concatenate([[], *(p[f] for p in parts)]).astype(np.int64) for f in FACTS}
            score = np.concatenate([[], *scores])
            failed = (facts["n_words"] < MIN_WORDS) | (100 * facts["n_repeat_words"] > REPEAT_PERCENT * facts["n_words"])
            yield pa.RecordBatch.from_arrays(
                [batch["_own"], *(pa.array(facts[f]) for f in FACTS), pa.array(failed), pa.array(np.round(score, 6)),
                 pa.array(~failed & (score >= threshold))], ["_own", *added])

    schema = ", ".join([*(f"{f} long" for f in FACTS), "base_failed boolean, quality_score double, kept boolean"])
    return with_own(keyed.mapInArrow(run, own_schema(base, columns, schema)), columns, *added)
