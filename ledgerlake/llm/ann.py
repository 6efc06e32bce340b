"""Nearest neighbours by inner product through cross-polytope hashing.

Each table turns a unit vector by pseudo-rotations (random signs, then a fast Hadamard transform, three
times) and names its nearest signed axis: its bucket. A query looks, over all tables together, into the
``probes`` buckets whose axes it leans to most. Candidates are reranked exactly by their inner product in
double precision. Where norms differ, stored vectors are split into bands of nearly equal norm and every
band is searched: within a band the largest inner products have nearly the smallest angles. The nearest
of a band of few vectors may lie at wide angles, so bands of at most ``SCAN`` are compared whole.

Equal vectors are one candidate, kept with as many of its smallest ids as an answer can hold, which loses
nothing. Buckets are dealt into blocks of at most ``block`` candidates and ``block`` queries, so none needs
more memory than that; no bucket is capped.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows with
a null id; vectors of another length than the query are no candidates. Rows with the query's own id are
not its neighbours. Equal rows count once. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.llm.common import Workspace

TABLES = 16
PROBES = 128
BLOCK = 4096
UNEQUAL = 1e-3
BANDS = 4  # bands per doubling of the norm
SCAN = 4096


def _signs(width: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed + width).choice([-1.0, 1.0], (tables, 3, width))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        half *= 2
    return x.reshape(n, width) / np.sqrt(width)


def turned(vectors: np.ndarray, tables: int, seed: int) -> np.ndarray:
    """tables x vectors x axes: coordinates after each table's pseudo-rotation."""
    width = 1 << max(0, int(vectors.shape[1] - 1).bit_length())
    padded = np.zeros((len(vectors), width))
    padded[:, :vectors.shape[1]] = vectors
    out = []
    for signs in _signs(width, tables, seed):
        x = padded
        for s in signs:
            x = _hadamard(x * s)
        out.append(x)
    return np.stack(out)


def nearest_axes(vectors: np.ndarray, tables: int, seed: int) -> np.ndarray:
    """vectors x tables: the nearest signed axis, twice its number plus one if negative."""
    x = turned(vectors, tables, seed)
    axis = np.abs(x).argmax(axis=2)
    negative = np.take_along_axis(x, axis[:, :, None], axis=2)[:, :, 0] < 0
    return (2 * axis + negative).T


def probed_axes(vectors: np.ndarray, tables: int, probes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """vectors x probes: tables and signed axes that each vector leans to most."""
    x = turned(vectors, tables, seed)
    both = np.stack([x, -x], axis=3).reshape(tables, len(vectors), -1).transpose(1, 0, 2)
    flat = both.reshape(len(vectors), -1)
    probes = min(probes, flat.shape[1])
    best = np.argpartition(-flat, probes - 1, axis=1)[:, :probes]
    return best // both.shape[2], best % both.shape[2]


def _by_length(batch: pa.RecordBatch):
    """Rows of equal vector length, as (row numbers, matrix)."""
    lists = batch["v"]
    size = np.diff(lists.offsets.to_numpy())
    values, start = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(size) - size
    for length in np.unique(size):
        rows = np.flatnonzero(size == length)
        yield rows, values[start[rows][:, None] + np.arange(length)]


def _bucket(length: int, table: np.ndarray, axis: np.ndarray) -> np.ndarray:
    return (np.int64(length) << 40) | (table.astype(np.int64) << 32) | axis.astype(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hashed(tables: int, seed: int):
    """Rows (rep, band, bucket); a vector of a band that is compared whole has one bucket, after all tables."""

    def run(batches):
        for batch in batches:
            whole = batch["whole"].to_numpy(zero_copy_only=False)
            for rows, x in _by_length(batch):
                axis = nearest_axes(_unit(x), tables, seed)
                table = np.broadcast_to(np.arange(tables), axis.shape)
                bucket, apart = _bucket(x.shape[1], table, axis), whole[rows]
                once = np.full(apart.sum(), _bucket(x.shape[1], np.array(tables), np.array(0)))
                at = pa.array(np.concatenate([np.repeat(rows[~apart], tables), rows[apart]]))
                yield pa.RecordBatch.from_arrays(
                    [batch["rep"].take(at), batch["band"].take(at), pa.array(np.concatenate([bucket[~apart].ravel(), once]))],
                    ["rep", "band", "bucket"])

    return run


def _probing(tables: int, probes: int, seed: int):
    def run(batches):
        for batch in batches:
            for rows, x in _by_length(batch):
                table, axis = probed_axes(_unit(x), tables, probes, seed)
                bucket = np.hstack([_bucket(x.shape[1], table, axis),
                                    np.full((len(x), 1), _bucket(x.shape[1], np.array(tables), np.array(0)))])
                yield pa.RecordBatch.from_arrays(
                    [batch["rep"].take(pa.array(np.repeat(rows, bucket.shape[1]))), pa.array(bucket.ravel())],
                    ["rep", "bucket"])

    return run


def _matrix(table: pa.Table) -> np.ndarray:
    lists = table["v"].combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _rerank(k: int):
    names = ["query", "rep", "score"]

    def run(queries, stored):
        if not queries.num_rows or not stored.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        q, x = _matrix(queries), _matrix(stored)
        score = q @ x.T
        many = min(k, x.shape[0])
        best = np.argpartition(-score, many - 1, axis=1)[:, :many] if many < x.shape[0] else \
            np.broadcast_to(np.arange(many), (len(q), many))
        row = np.repeat(np.arange(len(q)), many)
        # The sum in component order, so that the score does not depend on the block.
        exact = np.add.accumulate(q[row] * x[best.ravel()], axis=1)[:, -1]
        return pa.table([queries["rep"].combine_chunks().take(pa.array(row)),
                         stored["rep"].combine_chunks().take(pa.array(best.ravel())), pa.array(exact)], names)

    return run


def search(vectors: DataFrame, queries: Column, *, k: int = 20, tables: int = TABLES, probes: int = PROBES,
           block: int = BLOCK, seed: int = 7, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found of each row that ``queries`` selects."""
    space = Workspace(vectors.sparkSession, "ann")
    v = F.col("v")
    usable = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"),
                          F.coalesce(queries, F.lit(False)).alias("asked"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull()).where(usable).withColumn(
        "h", F.xxhash64(F.transform(v, lambda x: x + F.lit(0.0))))
    distinct = space.keep(rows.groupBy("h", "id").agg(F.max("asked").alias("asked"), F.first("v").alias("v")), "rows")
    groups = distinct.groupBy("h").agg(F.min("id").alias("rep"), F.max("asked").alias("asked"), F.first("v").alias("v"))
    least = Window.partitionBy("h").orderBy("id")
    listed = (
        distinct.select("h", "id").withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
        .groupBy("h").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    reps = space.keep(groups, "groups")
    listed = space.keep(listed, "ids")

    peak = F.array_max(F.transform(v, lambda x: F.abs(x.cast("double"))))
    square = F.aggregate(v, F.lit(0.0), lambda a, x: a + (x.cast("double") / F.col("peak")) * (x.cast("double") / F.col("peak")))
    lengths = reps.select("rep", "v", F.size("v").alias("width"), peak.alias("peak")).withColumn(
        "log", F.log2("peak") + F.log2(square) / 2)
    norms = lengths.agg((F.max("log") - F.min("log")).alias("spread")).first()
    if (norms["spread"] or 0.0) > -np.log2(1 - UNEQUAL):
        # Half a band off, so that the noise of unit norms does not fall on an edge.
        banded = lengths.withColumn("band", F.floor(F.col("log") * BANDS + 0.5).cast("int"))
        few = space.keep(
            banded.groupBy("width", "band").agg(F.count("*").alias("n")).select("width", "band", (F.col("n") <= SCAN).alias("whole")),
            "bands")
        banded = banded.join(F.broadcast(few), ["width", "band"])
    else:
        banded = lengths.withColumns({"band": F.lit(0), "whole": F.lit(False)})
    stored = space.keep(
        banded.select("rep", "v", "band", "whole").mapInArrow(_hashed(tables, seed), "rep long, band int, bucket long"), "stored")
    probing = space.keep(
        reps.where("asked").select("rep", "v").mapInArrow(_probing(tables, probes, seed), "rep long, bucket long"), "probing")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    of_stored = stored.groupBy("bucket", "band").agg(F.count("*").alias("n")).select("bucket", "band", blocks.alias("parts"))
    of_queries = probing.groupBy("bucket").agg(F.count("*").alias("n")).select("bucket", blocks.alias("asks"))
    sizes = space.keep(of_stored.join(of_queries, "bucket"), "sizes")
    own = F.xxhash64("rep", "bucket")
    asked_v, stored_v = (reps.select(F.col("rep"), F.col("v").alias("v")) for _ in range(2))
    right = (
        stored.join(sizes, ["bucket", "band"]).join(stored_v, "rep")
        .select("bucket", "band", F.pmod(own, "parts").cast("int").alias("part"),
                F.explode(F.sequence(F.lit(0), F.col("asks") - 1)).alias("ask"), "rep", "v")
    )
    left = (
        probing.join(sizes, "bucket").join(asked_v, "rep")
        .select("bucket", "band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                F.pmod(own, "asks").cast("int").alias("ask"), "rep", "v")
    )
    keys = ["bucket", "band", "part", "ask"]
    found = space.keep(
        left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_rerank(k + 1), "query long, rep long, score double")
        .dropDuplicates(["query", "rep"]), "found")

    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ids = listed.join(reps.select("h", "rep"), "h").select("rep", F.explode("ids").alias("id"))
    ranked = space.keep(
        found.join(ids, "rep").withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
        .select("query", "id", "score"), "ranked")
    asked = distinct.where("asked").select("h", F.col("id").alias("query_id")).join(
        reps.select("h", F.col("rep").alias("query")), "h").select("query", "query_id")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "id")
    return (
        asked.join(ranked, "query").where(F.col("id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
