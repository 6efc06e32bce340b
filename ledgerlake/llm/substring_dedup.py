"""Removal of word windows that occur again, by level-wise doubling.

Level 1 compares anchors of a quarter of the window's length; level 2 extends those repeated there alone to
twice that length, towards either side; the last level compares whole windows where a run of level 2 is
repeated. A window that holds no repeated run of a lower level is never built. Nothing is left to extend
when no run of the next length survives.

Null and empty texts have no words and lose none. Words are compared as bytes. A repeated row repeats all
its windows, so both rows lose them. Tables without rows give none. Other columns of the input are kept,
whatever their names, but for ``n_words`` and ``n_removed``, which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm import repeats
from ledgerlake.llm.common import Workspace, doc_keys, own_columns, own_schema, text_bytes, with_own
from ledgerlake.llm.rolling import words_of


def repeated_ranges(docs: DataFrame, window: int, space: Workspace) -> DataFrame:
    """Ranges of window starts (``_id``, ``_h``, ``first``, ``count``, ``group``) whose windows occur again.

    ``docs`` has ``_id``, ``_h`` (see ``common.doc_keys``) and ``text``.
    """
    gram = max(1, -(-window // 4))
    table = repeats.anchor_table(docs, repeats.text_words, gram, window, gram)
    found = repeats.hits(space, table)
    reps = repeats.representatives(space, found, ("before", "after"))
    done = repeats.settled(found, reps)

    # Level 2: a window begins at least `gram` words before its anchor or ends as far behind it.
    alive = repeats.meeting_ranges(space, reps, gram, window, gram)
    windows = repeats.window_rows(docs, alive, repeats.text_words, window)
    return done.unionByName(repeats.repeated_windows(space, windows, "full"))


def remove_repeats(docs: DataFrame, window: int = 35, *, id_col: str = "doc_id", text_col: str = "text",
                   digest: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and the kept words as ``text_col``, joined by one space.

    ``digest`` returns the id, the counts and ``kept_sha256`` instead.
    """
    space = Workspace(docs.sparkSession, "substring-dedup")
    kept = [id_col] if digest else [c for c in docs.columns if c.lower() not in (text_col.lower(), "n_words", "n_removed")]
    out_col = "kept_sha256" if digest else text_col
    keyed = docs.select(own_columns(kept), *doc_keys(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    plain = keyed.select("_id", "_h", "text")
    ranges = repeated_ranges(plain, window, space)
    rows = repeats.with_ranges(keyed, ranges).drop("_id", "_h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch["text"])
            data, words, removed, out = raw.tobytes(), [], [], []
            lists = batch["_ranges"]
            for row in range(batch.num_rows):
                low, high = offsets[row], offsets[row + 1]
                begin, end, _ = words_of(raw[low:high], np.array([0, high - low]))
                ranges = lists[row].values.to_numpy() if lists[row].is_valid else None
                gone = repeats.covered(ranges, len(begin), window)
                keep = ~gone
                text = b" ".join(
                    [data[low + a:low + b] for a, b in zip(begin[keep].tolist(), end[keep].tolist())])
                words.append(len(begin))
                removed.append(int(gone.sum()))
                out.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
            yield pa.RecordBatch.from_arrays(
                [batch["_own"], pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.string())],
                ["_own", "n_words", "n_removed", "left"])

    done = rows.mapInArrow(run, own_schema(docs, kept, "n_words long, n_removed long, left string"))
    return with_own(done, kept, "n_words", "n_removed", F.col("left").alias(out_col))
