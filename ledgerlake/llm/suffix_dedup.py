"""Repeated byte strings by the common-prefix interval tree of an enhanced suffix array.

The array is sparse: it holds the suffixes that begin at anchors, of which every string of the least length
has one at a place its content alone decides (see ``rolling``). Suffixes with the same anchor form a
branch; branches are dealt over the tasks. Within a branch, suffixes are sorted, their common-prefix
lengths scanned with a stack, and each interval of the tree is tested for how far its members agree to
the left of the anchor: an interval is a maximal repeat where its members' left extensions part. A member
whose left and right agreement with any other reaches the least length is repeated there, so all
occurrences are found, not only neighbours in the array.

Equal stretches are settled before by counting, and enter the array once. A suffix enters only if the half
window before or behind its anchor occurs elsewhere too, since no window around it could be repeated otherwise. A branch of more than
``branch_limit`` distinct suffixes (a very common line in ever different surroundings) does not go to one
task: its windows are compared by hash instead, which spreads over all tasks and gives the same result.

Null texts count as empty. Matches never cross texts. A repeated row repeats all its strings. Tables
without rows give none. Other columns of the input are kept, whatever their names, but for ``n_bytes``,
``n_removed``, ``n_spans`` and ``removed``, which are replaced. Where a cut falls inside a character, the kept
text drops the broken rest of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm import repeats
from ledgerlake.llm.common import Workspace, doc_keys, own_columns, own_schema, text_bytes, with_own

GRAM_BYTES = 40
BRANCH_LIMIT = 2048  # below 1 MB of suffixes
BATCH_SUFFIXES = 4096


def _contexts(docs: DataFrame, marks: DataFrame, window: int) -> DataFrame:
    """The bytes that each marked range of windows covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            data, lists = raw.tobytes(), batch["marks"]
            flat = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = (flat.field("first").to_numpy() + offsets[row]).tolist()
            until = (np.array(at, np.int64) + flat.field("count").to_numpy() - 1 + window).tolist()
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [flat.field("key"), batch["_id"].take(row), batch["_h"].take(row), flat.field("first"),
                 flat.field("count"), flat.field("shift"), flat.field("alone"),
                 pa.array([data[a:b] for a, b in zip(at, until)], pa.binary())],
                ["key", "_id", "_h", "first", "count", "shift", "alone", "context"])

    texts = repeats.marked_texts(docs, marks, ["key", "first", "count", "shift", "alone"])
    return texts.mapInArrow(
        run, "key long, _id long, _h long, first long, count int, shift int, alone boolean, context binary")


def _matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(b"".join([p[:width].ljust(width, b"\0") for p in parts]), np.uint8).reshape(len(parts), width),
            np.array([min(len(p), width) for p in parts]))


def _neighbour_prefix(parts: list[bytes], width: int) -> np.ndarray:
    """Length of the common prefix of each entry with the one before it; 0 for the first."""
    table, length = _matrix(parts, width)
    out = np.zeros(len(parts), np.int64)
    if len(parts) > 1:
        differ = table[1:] != table[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        out[1:] = np.minimum(out[1:], np.minimum(length[1:], length[:-1]))
    return out


def intervals(prefix: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of each interval of the tree, by one scan with a stack."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(prefix) + 1):
        value = prefix[i] if i < len(prefix) else -1
        begin = i - 1
        while stack and stack[-1][0] > value:
            depth, begin = stack.pop()
            if depth >= least:
                yield depth, begin, i - 1
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, begin))


def branch_matches(contexts: list[bytes], shifts: list[int], counts: list[int], window: int,
                   right_order: list[int], right_prefix: list[int], left_order: list[int],
                   left_prefix: list[int]) -> Iterator[tuple[int, int, int]]:
    """(member, first, last): windows of a branch's members, from the start of each context, that occur again.

    ``right_order`` sorts the members by what follows the anchor, ``left_order`` by what precedes it,
    read backwards; the prefix lists give the agreement with the entry before.
    """
    rank = {member: r for r, member in enumerate(left_order)}
    reach = max(shifts)
    for depth, low, high in intervals(right_prefix, window - reach):
        ranks = sorted(rank[m] for m in right_order[low:high + 1])
        agree = [min(left_prefix[a + 1:b + 1]) for a, b in zip(ranks, ranks[1:])]
        for i, r in enumerate(ranks):
            left = max(agree[i - 1] if i else 0, agree[i] if i < len(agree) else 0)
            if left + depth < window:
                continue  # its left extension parts from all others too early
            member = left_order[r]
            shift = shifts[member]
            begin = shift - min(left, shift)
            end = min(counts[member] - 1, shift - (window - depth))
            if begin <= end:
                yield member, begin, end


def _scan_branches(window: int):
    schema = ["_id", "_h", "first", "count", "group"]

    def solve(rows: dict[str, list]) -> pa.RecordBatch:
        key, context, shift, count = rows["key"], rows["context"], rows["shift"], rows["count"]
        n = len(key)
        after = [c[s:] for c, s in zip(context, shift)]
        before = [c[:s][::-1] for c, s in zip(context, shift)]
        right = sorted(range(n), key=lambda i: (key[i], after[i]))
        left = sorted(range(n), key=lambda i: (key[i], before[i]))
        right_prefix = _neighbour_prefix([after[i] for i in right], window).tolist()
        left_prefix = _neighbour_prefix([before[i] for i in left], window).tolist()
        bounds = [i for i in range(n) if not i or key[right[i]] != key[right[i - 1]]] + [n]
        ids, hashes, first, many, group = [], [], [], [], []
        for a, b in zip(bounds, bounds[1:]):
            if b - a < 2:
                continue
            local = {g: i for i, g in enumerate(right[a:b])}
            members = right[a:b]
            found = branch_matches(
                [context[m] for m in members], [shift[m] for m in members], [count[m] for m in members], window,
                list(range(b - a)), [0, *right_prefix[a + 1:b]], [local[g] for g in left[a:b]],
                [0, *left_prefix[a + 1:b]])
            for member, low, high in found:
                m = members[member]
                if rows["alone"][m]:
                    ids.append(rows["_id"][m])
                    hashes.append(rows["_h"][m])
                    first.append(rows["first"][m] + low)
                    many.append(high - low + 1)
                    group.append(int.from_bytes(
                        hashlib.blake2b(context[m][low:high + window], digest_size=8).digest(), "little", signed=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(first, pa.int64()),
             pa.array(many, pa.int32()), pa.array(group, pa.int64())], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # rows of branches that may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < BATCH_SUFFIXES:
                continue
            keys = held["key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield solve(held.slice(0, cut).to_pydict())
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield solve(held.to_pydict())

    return run


def repeated_ranges(docs: DataFrame, window: int, space: Workspace, gram: int = GRAM_BYTES,
                    branch_limit: int = BRANCH_LIMIT) -> DataFrame:
    """Occurrences of repeated strings: starts ``first .. first + count - 1`` in text (``_id``, ``_h``).

    Occurrences of the same maximal repeat share ``group``. ``docs`` has ``_id``, ``_h`` and ``text``.
    """
    gram = min(gram, window)
    side = (window - gram + 1) // 2
    found = repeats.hits(space, repeats.anchor_table(docs, repeats.byte_units, gram, window, side))
    if side:
        every = repeats.representatives(space, found, ("before", "after"))
        reps = repeats.meeting_ranges(space, every, gram, window, side)
    else:
        every = reps = repeats.representatives(space, found)
    ranges = repeats.settled(found, every)

    contexts = _contexts(docs, reps.where(F.col("spans") <= branch_limit), window)
    scanned = space.keep(
        contexts.repartition("key").sortWithinPartitions("key").mapInArrow(
            _scan_branches(window), "_id long, _h long, first long, count int, group long"), "scanned")
    ranges = ranges.unionByName(scanned)

    large = reps.where(F.col("spans") > branch_limit)
    if not large.isEmpty():
        windows = repeats.window_rows(docs, large, repeats.byte_units, window)
        ranges = ranges.unionByName(repeats.repeated_windows(space, windows, "large"))
    return ranges


def remove_repeats(docs: DataFrame, window: int = 200, *, id_col: str = "doc_id", text_col: str = "text",
                   branch_limit: int = BRANCH_LIMIT, digest: bool = False) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``removed`` (spans) and the kept text.

    ``digest`` returns the id, the counts and ``kept_sha256`` instead.
    """
    space = Workspace(docs.sparkSession, "suffix-dedup")
    added = ["n_bytes", "n_removed", "n_spans", *([] if digest else ["removed"])]
    kept = [id_col] if digest else [c for c in docs.columns if c.lower() not in (text_col.lower(), *added)]
    keyed = docs.select(own_columns(kept), *doc_keys(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    plain = keyed.select("_id", "_h", "text")
    ranges = repeated_ranges(plain, window, space, branch_limit=branch_limit)
    rows = repeats.with_ranges(keyed, ranges).drop("_id", "_h")
    span = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            lists, size, removed, runs, spans, out = batch["_ranges"], [], [], [], [], []
            for row in range(batch.num_rows):
                part = raw[offsets[row]:offsets[row + 1]]
                gone = repeats.covered(lists[row].values.to_numpy() if lists[row].is_valid else None, len(part), window)
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                left = part[~gone].tobytes()
                size.append(len(part))
                removed.append(int(gone.sum()))
                runs.append(len(edge) // 2)
                spans.append([{"first": a, "last": b - 1} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())])
                out.append(hashlib.sha256(left).hexdigest() if digest else left.decode(errors="ignore"))
            columns = [batch["_own"], pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                       pa.array(runs, pa.int64())]
            columns += [] if digest else [pa.array(spans, pa.list_(span))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.string())], ["_own", *added, "left"])

    spans_type = "" if digest else "removed array<struct<first: long, last: long>>, "
    done = rows.mapInArrow(run, own_schema(docs, kept, f"n_bytes long, n_removed long, n_spans long, {spans_type}left string"))
    return with_own(done, kept, *added, F.col("left").alias("kept_sha256" if digest else text_col))
