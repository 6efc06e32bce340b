"""Windows that occur more than once in a corpus, found through content-chosen anchors.

Steps shared by the two removers of repeated passages:

1. ``anchor_table``: one row per anchor with the hash of its gram (``key``) and of everything its windows
   cover (``span``). About one unit in a hundred (bytes) or fourteen (words) is an anchor.
2. ``hits``: anchors whose key occurs again. If all spans under a key are alike, every window there is
   repeated and the anchor is settled; so whole copies cost one row per anchor, however many there are.
3. Under a mixed key, equal spans are settled too, and one row stands for each distinct span
   (``representatives``). What is repeated among distinct spans is the caller's to resolve.

Counting reduces in the map tasks before any shuffle, and rows meet only in joins of two kept tables,
which adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import Workspace, mix, slices, text_bytes
from ledgerlake.llm.rolling import BLOCK, BYTE_VALUES, Anchors, Rolled, anchors, word_units, words_of

Block = tuple[np.ndarray, np.ndarray, int, int]


def byte_units(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUES[raw], offsets


def text_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin, end, rows = words_of(raw, offsets)
    return word_units(raw, begin, end), rows


def unit_blocks(texts: pa.Array, to_units: Callable, overlap: int) -> Iterator[Block]:
    """Units and text offsets of groups of texts, with the first row and its first unit.

    A long text comes as several blocks that overlap, so that every window lies within one of them.
    """
    raw, offsets = text_bytes(texts)
    for low, high in slices(offsets, BLOCK):
        units, rows = to_units(raw[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
        if len(units) <= 2 * BLOCK:
            yield units, rows, low, 0
            continue
        for at in range(0, len(units), BLOCK):
            part = units[at:at + BLOCK + overlap]
            yield part, np.array([0, len(part)]), low, at


def _row_of(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, at, "right") - 1


ANCHOR_SCHEMA = "_id long, _h long, key long, span long, first long, count int, shift int"


def anchor_table(docs: DataFrame, to_units: Callable, gram: int, window: int, side: int = 0) -> DataFrame:
    """Anchors of ``docs`` (``_id``, ``_h``, ``text``).

    Windows ``first .. first + count - 1`` hold the gram, which begins ``shift`` units after ``first``.
    With ``side``, the hashes of two longer runs are added where they lie within the span: the gram with the
    ``side`` units before it, and with the ``side`` units after it. A window of at least ``gram + 2 * side - 1``
    units that holds the gram holds one of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch["_id"].to_numpy(), batch["_h"].to_numpy()
            for units, offsets, low, base in unit_blocks(batch["text"], to_units, window - 1):
                rolled = Rolled(units)
                found = anchors(rolled, offsets, gram, window)
                if len(found.at):
                    yield _anchor_rows(found, rolled, offsets, low, base, ids, hashes, gram, window, side)

    more = ", before long, after long" if side else ""
    return docs.select("_id", "_h", "text").mapInArrow(run, ANCHOR_SCHEMA + more)


def _anchor_rows(found: Anchors, rolled: Rolled, offsets, low, base, ids, hashes, gram, window, side):
    row = _row_of(offsets, found.first)
    columns = [
        ids[low + row], hashes[low + row], found.gram.view(np.int64), found.span.view(np.int64),
        found.first - offsets[row] + base, found.count.astype(np.int32), (found.at - found.first).astype(np.int32),
    ]
    columns = [pa.array(c) for c in columns]
    names = ["_id", "_h", "key", "span", "first", "count", "shift"]
    if side:
        for name, begin in (("before", found.at - side), ("after", found.at)):
            end = begin + gram + side
            inside = (begin >= found.first) & (end <= found.first + found.count - 1 + window)
            begin, end = np.where(inside, begin, 0), np.where(inside, end, 0)
            columns.append(pa.array(rolled.runs(begin, end).view(np.int64), mask=~inside))
            names.append(name)
    return pa.RecordBatch.from_arrays(columns, names)


def hits(space: Workspace, table: DataFrame) -> DataFrame:
    """Anchors whose key occurs again; ``same`` tells that all spans under the key are alike."""
    table = space.keep(table, "anchors")
    keys = space.keep(
        table.groupBy("key").agg(F.count("*").alias("n"), F.min("span").alias("low"), F.max("span").alias("high"))
        .where("n > 1").select("key", F.expr("low = high").alias("same")), "keys")
    found = table.join(keys, "key")
    if "before" in table.columns:  # settled keys need no neighbouring runs
        found = found.withColumns({c: F.when(~F.col("same"), F.col(c)) for c in ("before", "after")})
    found = space.keep(found, "hits")
    space.drop("anchors", "keys")
    return found


def representatives(space: Workspace, found: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct span of a mixed key, with ``alone`` (no other like it) and ``spans`` (per key)."""
    carried = ["_id", "_h", "first", "count", "shift", *extra]
    spans = space.keep(
        found.where("not same").groupBy("key", "span")
        .agg((F.count("*") == 1).alias("alone"), *[F.first(c).alias(c) for c in carried]), "spans")
    sizes = space.keep(spans.groupBy("key").agg(F.count("*").alias("spans")), "sizes")
    rows = space.keep(spans.join(sizes, "key"), "representatives")
    space.drop("sizes", "spans")
    return rows


def settled(found: DataFrame, reps: DataFrame) -> DataFrame:
    """Window ranges (``_id``, ``_h``, ``first``, ``count``) that are repeated as a whole, with their ``group``."""
    shared = reps.where("not alone").select("key", "span")
    mixed = found.where("not same").join(shared, ["key", "span"])
    columns = ["_id", "_h", "first", "count", F.col("span").alias("group")]
    return found.where("same").select(*columns).unionByName(mixed.select(*columns))


def meeting_ranges(space: Workspace, reps: DataFrame, gram: int, window: int, side: int) -> DataFrame:
    """Representatives cut down to the windows that may occur in another span of their key.

    A window equal to one of another span shares with it the run before or the run after the anchor that lies
    within (see ``anchor_table``), so a span goes unless one of its two runs occurs in another span, and of
    its windows those stay that hold such a run. ``spans`` counts what is left of each key.
    """
    sides = reps.select(
        "key", "span", "alone", "_id", "_h", "first", "count", "shift",
        F.explode(F.array(F.struct(F.lit(True).alias("left"), F.col("before").alias("run")),
                          F.struct(F.lit(False).alias("left"), F.col("after").alias("run")))).alias("side"),
    ).select("*", "side.left", "side.run").drop("side").where("run is not null")
    twice = space.keep(
        sides.groupBy("key", "left", "run").agg(F.count("*").alias("n")).where("n > 1").select("key", "left", "run"),
        "doubled")
    # Offsets of the anchor in a window that the repeated run lies within.
    low = F.when(F.col("left"), F.lit(side)).otherwise(F.lit(0))
    high = F.when(F.col("left"), F.lit(window)).otherwise(F.lit(window - gram - side))
    alive = space.keep(
        sides.join(twice, ["key", "left", "run"])
        .withColumn("from", F.greatest(F.col("first"), F.col("first") + F.col("shift") - high))
        .withColumn("to", F.least(F.col("first") + F.col("count") - 1, F.col("first") + F.col("shift") - low))
        .where("from <= to")
        .groupBy("key", "span").agg(
            *[F.first(c).alias(c) for c in ("_id", "_h", "alone")], F.first(F.col("first") + F.col("shift")).alias("at"),
            F.min("from").alias("first"), F.max("to").alias("last"))
        .select("key", "span", "_id", "_h", "alone", "first", (F.col("last") - F.col("first") + 1).cast("int").alias("count"),
                (F.col("at") - F.col("first")).cast("int").alias("shift")), "alive")
    sizes = space.keep(alive.groupBy("key").agg(F.count("*").alias("spans")), "alive-sizes")
    return alive.join(sizes, "key")


def marked_texts(docs: DataFrame, marks: DataFrame, fields: list[str]) -> DataFrame:
    """Texts that hold marks, with the marks of each as a list. Only the marks are held for the join."""
    lists = marks.groupBy("_id", "_h").agg(F.collect_list(F.struct(*fields)).alias("marks"))
    return docs.select("_id", "_h", "text").join(lists.hint("shuffle_hash"), ["_id", "_h"])


def window_rows(docs: DataFrame, marks: DataFrame, to_units: Callable, window: int) -> DataFrame:
    """One row per window of the marked ranges: its hash, place, and whether its span stands alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            ids, hashes = batch["_id"].to_numpy(), batch["_h"].to_numpy()
            lists = batch["marks"]
            for row in range(batch.num_rows):
                units, _ = to_units(raw[offsets[row]:offsets[row + 1]], np.array([0, offsets[row + 1] - offsets[row]]))
                flat = lists.slice(row, 1).flatten()
                first, count = flat.field("first").to_numpy(), flat.field("count").to_numpy().astype(np.int64)
                alone = flat.field("alone").to_numpy(zero_copy_only=False)
                starts = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
                value = Rolled(units).runs(starts, starts + window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(starts), ids[row])), pa.array(np.full(len(starts), hashes[row])),
                     pa.array(starts), pa.array(np.repeat(alone, count)), pa.array(value.view(np.int64))],
                    ["_id", "_h", "first", "alone", "value"])

    texts = marked_texts(docs, marks, ["first", "count", "alone"])
    return texts.mapInArrow(run, "_id long, _h long, first long, alone boolean, value long")


def repeated_windows(space: Workspace, windows: DataFrame, name: str) -> DataFrame:
    """Ranges of one window each for the windows whose content occurs in another span as well."""
    windows = space.keep(windows, f"{name}-windows")
    twice = space.keep(windows.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value"), f"{name}-twice")
    return windows.where("alone").join(twice, "value").select(
        "_id", "_h", "first", F.lit(1).alias("count"), F.col("value").alias("group"))


def range_lists(ranges: DataFrame) -> DataFrame:
    """The ranges of each text as one list of numbers, ``first * 65536 + count``."""
    return ranges.groupBy("_id", "_h").agg(
        F.collect_list(F.col("first") * 65536 + F.col("count")).alias("_ranges"))


def with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its list of ranges, null if none."""
    return docs.join(range_lists(ranges).hint("shuffle_hash"), ["_id", "_h"], "left")


def covered(ranges: np.ndarray | None, n: int, window: int) -> np.ndarray:
    """Which of ``n`` units the windows of the listed ranges cover."""
    step = np.zeros(n + 1, np.int32)
    if ranges is not None and len(ranges):
        first, count = ranges >> 16, ranges & 0xFFFF
        np.add.at(step, first, 1)
        np.add.at(step, np.minimum(first + count - 1 + window, n), -1)
    return np.cumsum(step[:-1]) > 0


__all__ = [
    "anchor_table", "byte_units", "covered", "hits", "marked_texts", "meeting_ranges", "mix", "range_lists", "repeated_windows",
    "representatives", "settled", "text_words", "unit_blocks", "window_rows", "with_ranges",
]
