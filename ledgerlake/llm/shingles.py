"""Word shingles of texts, and how rare hashed items are over a whole corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ledgerlake.llm.repeats import text_words, unit_blocks
from ledgerlake.llm.rolling import Rolled

COUNT_BITS = 21  # the rarity of items is counted in so many buckets (2 MB on the driver, whatever the input)
SLICE = 4096

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return text_words(_LOWER[raw], offsets)


def shingle_hashes(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and n-gram hashes (with repeats) of each text that has words."""
    held: tuple[int, list[np.ndarray]] = (-1, [])
    for units, offsets, low, base in unit_blocks(texts, lower_words, words - 1):
        rolled = Rolled(units)
        grams = rolled.grams(words)
        if base or len(offsets) == 2 and held[0] == low:  # a further block of a long text
            held[1].append(grams[:offsets[1] - words + 1])
            continue
        if held[0] >= 0:
            yield held[0], np.concatenate(held[1])
        held = (-1, [])
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            if b - a >= words:
                found = grams[a:b - words + 1]
            elif b > a:
                found = rolled.runs(np.array([a]), np.array([b]))
            else:
                continue
            if len(offsets) == 2:
                held = (low, [found])
            else:
                yield low + i, found
    if held[0] >= 0:
        yield held[0], np.concatenate(held[1])


def bucket(items: np.ndarray) -> np.ndarray:
    """The bucket that each 64-bit item is counted in."""
    return (items & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64)


def rarity_classes(rows: DataFrame, items: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> np.ndarray:
    """A class per bucket of items, lower for rarer ones; counted over all rows."""
    size = 1 << COUNT_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            found = list(items(batch))
            if found:
                total += np.bincount(bucket(np.concatenate(found)), minlength=size)
        total = np.minimum(total, 65535).astype("<u2").reshape(-1, SLICE)
        part = TaskContext.get().partitionId() // 128
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(total), part, np.int32)), pa.array(np.arange(len(total), dtype=np.int32)),
             pa.array([row.tobytes() for row in total], pa.binary())], ["part", "slice", "n"])

    def add(kind: str, classes: bool):
        def run(key, rows):
            total = sum(np.frombuffer(n.as_py(), kind).astype(np.int64) for n in rows["n"])
            if classes:
                out = np.minimum(6 * np.log2(np.maximum(total, 1)), 255).astype(np.uint8).tobytes()
            else:
                out = total.astype("<i8").tobytes()
            return pa.table([rows["slice"].combine_chunks()[:1], pa.array([out], pa.binary())], ["slice", "n"])

        return run

    # A row per task and slice; slices of up to 128 tasks are added up before all of a slice meet.
    counted = rows.mapInArrow(count, "part int, slice int, n binary")
    counted = counted.groupBy("slice", "part").applyInArrow(add("<u2", False), "slice int, n binary")
    table = counted.groupBy("slice").applyInArrow(add("<i8", True), "slice int, n binary").toArrow().sort_by("slice")
    found = np.frombuffer(b"".join(table["n"].to_pylist()), np.uint8)
    return found if len(found) == size else np.zeros(size, np.uint8)
