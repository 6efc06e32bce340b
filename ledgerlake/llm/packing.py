"""Best-fit packing of documents into token sequences by a grouping genetic algorithm.

``cut_pieces`` encodes documents and cuts only those longer than a sequence. ``pack`` deals the pieces
into blocks of bounded size; several islands evolve a packing of each block. A child takes whole
well-filled sequences of one parent, keeps the other parent's sequences that share no document with
them, and best-fits the documents set free. Between epochs each island passes its elite to the next one
of its block. The best packing of a block wins; documents of its poorly filled sequences are dealt anew
into mixed blocks on the next level, so that what stays unfilled is a few sequences per last block.

Pieces of full length are sequences of their own. Null texts count as empty and hold the end id only.
Equal rows are separate documents. Empty tables give no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm import bpe
from ledgerlake.llm.common import Workspace

BLOCK_ITEMS = 4096
ISLANDS = 2
POPULATION = 5
CHILDREN = 14
LEVELS = 3
WELL_FILLED = 0.995


def _piece_fold(capacity: int, end_id: int):
    tail = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def fold(batch: pa.RecordBatch, packed: list[bytes]) -> pa.RecordBatch:
        row, piece, start, length, crc = [], [], [], [], []
        for i, ids in enumerate(packed):
            ids = ids + tail
            at, n, end = 0, 0, len(ids) % step or step
            while at < len(ids):
                row.append(i)
                piece.append(n)
                start.append(at // 4)
                length.append((end - at) // 4)
                crc.append(zlib.crc32(ids[at:end]))
                at, n, end = end, n + 1, end + step
        key = batch["_key"].take(pa.array(row, pa.int64()))
        return pa.RecordBatch.from_arrays(
            [key, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
             pa.array(crc, pa.int64())], ["_key", "piece", "start", "length", "ids_crc32"])

    return fold


def cut_pieces(docs: DataFrame, path: str, pattern: str, *, capacity: int = 2048, end_id: int = 0,
               special: tuple[tuple[str, int], ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` tokens: all of a longer document's are full but the first."""
    return bpe.encode(
        docs, path, pattern, id_col=id_col, text_col=text_col, special=special,
        fold=_piece_fold(capacity, end_id),
        fold_schema="piece int, start long, length long, ids_crc32 long")


class _Bins:
    """Sequences under construction, found by the room they have left."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.items: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, items: list[int], room: int) -> None:
        self.by_room[room].append(len(self.items))
        self.mask |= 1 << room
        self.items.append(items)
        self.room.append(room)

    def best_fit(self, order: list[int]) -> None:
        sizes, by_room, items, room = self.sizes, self.by_room, self.items, self.room
        for item in order:
            size = sizes[item]
            fits = self.mask >> size
            if fits:
                left = size + (fits & -fits).bit_length() - 1
                stack = by_room[left]
                at = stack.pop()
                if not stack:
                    self.mask ^= 1 << left
                left -= size
                items[at].append(item)
                room[at] = left
                by_room[left].append(at)
                self.mask |= 1 << left
            else:
                self.add([item], self.capacity - size)


def _fitness(bins: _Bins) -> tuple[int, float]:
    """Fewer sequences first, then more uneven filling, which leaves larger gaps to fill."""
    fill = 1 - np.array(bins.room) / bins.capacity
    return -len(bins.room), float((fill * fill).sum())


def _cross(a: _Bins, b: _Bins, rng: np.random.Generator, well: int) -> _Bins:
    good = [i for i, room in enumerate(b.room) if room <= well]
    if good:
        good = [good[i] for i in np.flatnonzero(rng.random(len(good)) < 0.5)]
    taken = {item for i in good for item in b.items[i]}
    child, free = _Bins(a.sizes, a.capacity), []
    for i in good:
        child.add(list(b.items[i]), b.room[i])
    # Mutation: the least filled sequences of the other parent are dissolved as well.
    loose = set(np.argsort(a.room)[-max(1, len(a.room) // 50):].tolist())
    for i, items in enumerate(a.items):
        if i in loose or not taken.isdisjoint(items):
            free += [item for item in items if item not in taken]
        else:
            child.add(list(items), a.room[i])
    sizes = a.sizes
    free.sort(key=lambda item: -sizes[item])
    child.best_fit(free)
    return child


def evolve(sizes: np.ndarray, capacity: int, seed: int, seeds: list[np.ndarray] = (),
           population: int = POPULATION, children: int = CHILDREN) -> np.ndarray:
    """Sequence number of each item after some generations; ``seeds`` are packings to start from."""
    rng = np.random.default_rng(seed)
    listed = sizes.tolist()
    pool: list[_Bins] = []
    for given in seeds:
        bins = _Bins(listed, capacity)
        order = np.argsort(given, kind="stable")
        cuts = np.flatnonzero(np.diff(given[order])) + 1
        for group in np.split(order, cuts):
            bins.add(group.tolist(), capacity - int(sizes[group].sum()))
        pool.append(bins)
    while len(pool) < population:
        noise = 0.0 if not pool else 0.08
        order = np.argsort(-sizes * (1 + noise * rng.random(len(sizes))), kind="stable")
        bins = _Bins(listed, capacity)
        bins.best_fit(order.tolist())
        pool.append(bins)
    least = -(-int(sizes.sum()) // capacity)
    scored = sorted(((_fitness(x), i, x) for i, x in enumerate(pool)), reverse=True)
    well = int(capacity * (1 - WELL_FILLED))
    for n in range(children):
        if -scored[0][0][0] <= least:
            break
        i, j = rng.choice(len(scored), 2, replace=False)
        child = _cross(scored[min(i, j)][2], scored[max(i, j)][2], rng, well)
        scored[-1] = (_fitness(child), population + n, child)
        scored.sort(reverse=True)
    out = np.zeros(len(sizes), np.int64)
    for n, items in enumerate(scored[0][2].items):
        out[items] = n
    return out


_KEYS = ["length", "_key", "piece", "start", "ids_crc32"]


def _seed_of(*parts: int) -> int:
    return zlib.crc32(",".join(map(str, parts)).encode())


def _epoch(capacity: int, epoch: int):
    def run(key, rows):
        block, island = int(key[0]), int(key[1])
        own = rows[rows["_from"] == island].sort_values(_KEYS, kind="stable", ignore_index=True)
        seeds = [own["_bin"].to_numpy()] if epoch else []
        for other, part in rows[rows["_from"] != island].groupby("_from"):
            seeds.append(part.sort_values(_KEYS, kind="stable")["_bin"].to_numpy())
        sizes = own["length"].to_numpy()
        own["_bin"] = evolve(sizes, capacity, _seed_of(block, island, epoch), seeds)
        return own[["_block", "_island", "_from", "_bin", *_KEYS]]

    return run


def _choose(capacity: int, level: int, last: bool):
    def run(key, rows):
        counts = rows.groupby("_island")["_bin"].max()
        best = rows[rows["_island"] == counts.idxmin()].sort_values(["_bin", *_KEYS], kind="stable", ignore_index=True)
        grouped = best.groupby("_bin")["length"]
        best["offset"] = grouped.cumsum() - best["length"]
        done = last | (grouped.transform("sum") >= capacity * WELL_FILLED)
        best["sequence_id"] = np.where(
            done, (np.int64(level) << 58) | (np.int64(key[0]) << 16) | best["_bin"].to_numpy(), -1)
        return best[["sequence_id", "offset", *_KEYS]]

    return run


def pack(pieces: DataFrame, *, capacity: int = 2048, id_col: str = "doc_id", block_items: int = BLOCK_ITEMS,
         islands: int = ISLANDS, levels: int = LEVELS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (id, piece, start, length, ids_crc32)."""
    spark = pieces.sparkSession
    space = Workspace(spark, "packing")
    kind = dict(pieces.dtypes)[id_col]
    columns = f"length long, _key {kind}, piece int, start long, ids_crc32 long"
    pieces = space.keep(pieces.withColumnRenamed(id_col, "_key"), "pieces")
    full = pieces.where(F.col("length") == capacity).select(
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *_KEYS)
    packed = [space.keep(full, "full")]
    items = pieces.where(F.col("length") < capacity)
    for level in range(levels):
        n = items.count()
        if not n:
            break
        last = level == levels - 1 or n <= block_items
        blocks = -(-n // block_items)
        spread = F.xxhash64(F.lit(level), *_KEYS)
        dealt = items.withColumn("_block", F.pmod(spread, F.lit(blocks)).cast("long"))
        state = (
            dealt.withColumn("_island", F.explode(F.array(*[F.lit(i) for i in range(islands)])))
            .withColumn("_from", F.col("_island")).withColumn("_bin", F.lit(0).cast("long"))
        )
        schema = f"_block long, _island int, _from int, _bin long, {columns}"
        for epoch in range(2):
            state = space.keep(
                state.groupBy("_block", "_island").applyInPandas(_epoch(capacity, epoch), schema), f"state{level}{epoch}")
            if epoch == 0 and islands > 1:
                own, elite = state, state.withColumn("_island", F.pmod(F.col("_island") + 1, F.lit(islands)))
                state = own.unionByName(elite)
        chosen = space.keep(
            state.groupBy("_block").applyInPandas(_choose(capacity, level, last),
                                                  f"sequence_id long, offset long, {columns}"), f"chosen{level}")
        space.drop(f"state{level}0", f"state{level}1")
        packed.append(chosen.where("sequence_id >= 0"))
        items = chosen.where("sequence_id < 0").select(*_KEYS)
        if last:
            break
    result = packed[0]
    for more in packed[1:]:
        result = result.unionByName(more)
    return result.withColumnRenamed("_key", id_col)
