"""Short codes for vectors: each part of a vector becomes the number of the nearest entry of a codebook.

Components become integers, ``floor(scale * x)``. Vectors are kept in blocks, and a block holds, for each
dimension, a dictionary of the distinct integers there and every vector's place in it. A round of training
tabulates, per dimension, the squared difference of each dictionary value to every entry; the distance of a
part is then gathered from these tables by the codes and added up. Entries are replaced by the rounded-down
mean of their parts, summed in the map tasks first; the books, of ``parts * entries`` vectors' parts, travel
with the tasks. All arithmetic is on integers, also on ones beyond 64 bits.

Vectors that are null or hold null or non-finite components take no part and give no row, nor do vectors of
another length than the first kept one, which no book fits. A length that ``parts`` does not divide gives
parts as equal as can be. The books begin with the first ``entries`` rows by id, then by vector, null ids
last; equal rows are rows of their own, and fewer rows give shorter books. Null labels count as one label.
An ``error`` or ``label_error`` beyond 64 bits is null. Other columns may have any name; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import Workspace
from ledgerlake.session import settled

BLOCK_CELLS = 1 << 20
SMALL = 1 << 26  # below, squares and their sums stay in 64 bits
FAN = 128


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` exactly: 64-bit where that is safe, else Python integers."""
    values = values.astype(np.float64)
    if not values.size or np.abs(values).max() < SMALL / scale:
        return np.floor(values * scale).astype(np.int64)
    exact = np.empty(values.size, object)
    for i, x in enumerate(values.ravel().tolist()):
        up, down = x.as_integer_ratio()
        exact[i] = up * scale // down
    return exact.reshape(values.shape)


def bounds(width: int, parts: int) -> list[tuple[int, int]]:
    return [(width * p // parts, width * (p + 1) // parts) for p in range(parts)]


_BLOCK = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())),
                    ("values", pa.list_(pa.string())), ("codes", pa.binary())])


def _blocks(width: int, scale: int):
    """Rows to blocks; a block's codes are one column of numbers per dimension."""

    def block(ids: list, labels: list, matrix: np.ndarray) -> pa.RecordBatch:
        sizes, values, codes = [], [], []
        for d in range(width):
            distinct, places = np.unique(matrix[:, d], return_inverse=True)
            sizes.append(len(distinct))
            values += map(str, distinct.tolist())
            codes.append(places.astype("<u4" if len(matrix) > 65536 else "<u2").tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array([x], f.type) for x, f in zip((ids, labels, sizes, values, b"".join(codes)), _BLOCK)], schema=_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, held = [], [], []
        most = max(1, min(BLOCK_CELLS // max(width, 1), 65536))
        for batch in batches:
            flat = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            for low in range(0, batch.num_rows, most):
                part = flat[low:low + most]
                if len(ids) + len(part) > most:
                    yield block(ids, labels, integers(np.concatenate(held), scale))
                    ids, labels, held = [], [], []
                ids += batch["id"].slice(low, len(part)).to_pylist()
                labels += batch["label"].slice(low, len(part)).to_pylist()
                held.append(part)
        if ids:
            yield block(ids, labels, integers(np.concatenate(held), scale))

    return run


def _dictionaries(row: dict, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per dimension the distinct values, and the places of all rows: dimensions x rows."""
    n = len(row["ids"])
    values, ends = row["values"], np.cumsum([0, *row["sizes"]])
    out = []
    for d in range(width):
        own = [int(x) for x in values[ends[d]:ends[d + 1]]]
        out.append(np.array(own, np.int64 if max(map(abs, own)) <= SMALL else object))
    return out, np.frombuffer(row["codes"], "<u4" if n > 65536 else "<u2").reshape(width, n)


def assign(values: list[np.ndarray], codes: np.ndarray, book: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Per row the nearest entry (the first on ties) of one part's book, and its squared distance."""
    far = [np.array([entry[d] for entry in book], np.int64 if all(abs(e[d]) <= SMALL for e in book) else object)
           for d in range(len(values))]
    total = np.zeros((codes.shape[1], len(book)), np.int64)
    for d in range(len(values)):
        wide = values[d].dtype == object or far[d].dtype == object
        own, entries = (values[d].astype(object), far[d].astype(object)) if wide else (values[d], far[d])
        table = (own[:, None] - entries[None, :]) ** 2
        total = total + table[codes[d]]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(best)), best]


def _sums(books: list[list[list[int]]], width: int):
    """Per task, entry and part: how many parts chose it and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                values, codes = _dictionaries(row, width)
                for p, (low, high) in enumerate(bounds(width, len(books))):
                    best, _ = assign(values[low:high], codes[low:high], books[p])
                    for e in np.unique(best).tolist():
                        mine = best == e
                        # Counts per distinct value: the sum of a dimension needs no row's value again.
                        sums = [sum(int(v) * c for v, c in zip(values[d].tolist(), np.bincount(codes[d][mine], minlength=len(values[d])).tolist()) if c)
                                for d in range(low, high)]
                        n, old = total.get(p * 65536 + e, (0, [0] * (high - low)))
                        total[p * 65536 + e] = (n + int(mine.sum()), [a + b for a, b in zip(old, sums)])
        part = TaskContext.get().partitionId() // FAN
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(total), pa.int64()), pa.array(list(total), pa.int64()),
             pa.array([n for n, _ in total.values()], pa.int64()),
             pa.array([[str(x) for x in s] for _, s in total.values()], pa.list_(pa.string()))], ["part", "slot", "n", "sums"])

    return run


def _add(key, rows):
    sums = [sum(map(int, column)) for column in zip(*rows["sums"].to_pylist())]
    n = sum(rows["n"].to_pylist())
    return pa.table({"slot": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([n], pa.int64()),
                     "sums": pa.array([[str(x) for x in sums]], pa.list_(pa.string()))})


def _coded(books: list[list[list[int]]], width: int):
    names = ["id", "label", "code", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, codes = _dictionaries(row, width)
                n = len(row["ids"])
                text, error = np.zeros((n, len(books)), np.uint8), np.zeros(n, np.int64)
                for p, (low, high) in enumerate(bounds(width, len(books))):
                    text[:, p], far = assign(values[low:high], codes[low:high], books[p])
                    error = error + far
                flat, step = text.tobytes().hex(), 2 * len(books)
                fits = [int(e) if e < 2**63 else None for e in error.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.string()),
                     pa.array([flat[i * step:(i + 1) * step] for i in range(n)]), pa.array(fits, pa.int64())], names)

    return run


def books_digest(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def train(blocks: DataFrame, books: list[list[list[int]]], width: int, rounds: int) -> list[list[list[int]]]:
    """The books after ``rounds`` rounds; one that no part chose stays as it is."""
    for _ in range(rounds):
        partial = blocks.mapInArrow(_sums(books, width), "part long, slot long, n long, sums array<string>")
        # A row per task and entry; up to ``FAN`` tasks are added up before all of an entry meet.
        for keys in (["slot", "part"], ["slot"]):
            partial = partial.groupBy(*keys).applyInArrow(_add, "slot long, n long, sums array<string>")
        books = [list(book) for book in books]
        for row in partial.collect():  # one row per entry of a book
            books[row["slot"] // 65536][row["slot"] % 65536] = [int(x) // row["n"] for x in row["sums"]]
    return books


def encode(vectors: DataFrame, *, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
           id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """The id column, ``code``, ``error``, ``label_error``, ``codebooks_sha256`` of every kept row; at most 256 entries."""
    space = Workspace(vectors.sparkSession, "vector-codes")
    kinds = dict(vectors.dtypes)
    v = F.col("v")
    kept = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v")
    ).where(v.isNotNull()).where(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    # At most ``entries`` rows reach the driver: the beginning of the books.
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    width = len(first[0]["v"]) if first else 0
    begin = integers(np.array([r["v"] for r in first if len(r["v"]) == width], np.float64), scale).tolist()
    books = [[row[low:high] for row in begin] for low, high in bounds(width, parts)]
    fitting = kept.where(F.size(v) == width)
    blocks = space.keep(fitting.mapInArrow(
        _blocks(width, scale), "ids array<long>, labels array<string>, sizes array<int>, values array<string>, codes binary"), "blocks")
    if first:
        books = train(blocks, books, width, rounds)
    coded = space.keep(blocks.mapInArrow(_coded(books, width), "id long, label string, code string, error long"), "coded")
    # One row per label, kept; broadcast only if their number allows it.
    errors = settled(coded.groupBy(F.col("label").alias("of")).agg(
        F.when(F.count_if(F.col("error").isNull()) == 0, F.try_sum("error")).alias("label_error")))
    return coded.join(errors, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").cast(kinds[id_col]).alias(id_col), "code", "error", "label_error",
        F.lit(books_digest(books)).alias("codebooks_sha256"))


def oracle(table: str, *, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same in plain SQL, over unnested components."""
    steps = [
        f"kept AS (SELECT vec_id, label, embedding AS v FROM {table} WHERE embedding IS NOT NULL AND"
        " len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "width AS (SELECT len(v) AS w FROM kept ORDER BY vec_id LIMIT 1)",
        "cells AS MATERIALIZED (SELECT vec_id, label, i // (w // {parts}) AS p, i % (w // {parts}) AS i, x FROM (SELECT vec_id, label, w,"
        " unnest(range(len(v))) AS i, unnest(list_transform(v, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))) AS x"
        " FROM kept, width))".format(parts=parts, scale=scale),
        f"first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries})",
        "book0 AS MATERIALIZED (SELECT p, e, i, x FROM cells JOIN first USING (vec_id))",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"near{n} AS MATERIALIZED (SELECT vec_id, p, arg_min(e, d * 256 + e) AS e, min(d) AS d FROM (SELECT c.vec_id, c.p, b.e,"
            f" sum((c.x - b.x) * (c.x - b.x)) AS d FROM cells c JOIN book{n} b ON c.p = b.p AND c.i = b.i GROUP BY 1, 2, 3)"
            " GROUP BY 1, 2)")
        if n < rounds:
            steps.append(
                f"book{n + 1} AS MATERIALIZED (SELECT b.p, b.e, b.i, coalesce(m.x, b.x) AS x FROM book{n} b LEFT JOIN (SELECT c.p, n.e,"
                f" c.i, CAST(floor(CAST(sum(c.x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM cells c JOIN near{n} n ON c.vec_id = n.vec_id"
                " AND c.p = n.p GROUP BY 1, 2, 3) m ON b.p = m.p AND b.e = m.e AND b.i = m.i)")
    steps.append(
        f"coded AS MATERIALIZED (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code,"
        f" CAST(sum(d) AS BIGINT) AS error FROM near{rounds} JOIN kept USING (vec_id) GROUP BY vec_id)")
    return (
        "WITH " + ", ".join(steps)
        + " SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,"
        f" (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) FROM book{rounds}) AS codebooks_sha256 FROM coded")
