"""Near duplicates by MinHash signatures and a join of inverted signature coordinates.

A signature holds, per coordinate, the least hash of the set's shingles under that coordinate's hash. Two
sets of similarity s agree in a coordinate with probability s, so ``matches`` of ``coordinates`` are asked
for, the most that a pair at the threshold misses with a probability below 1e-9 (81 of 128 for 0.85).

Every set is posted under its coordinate-value pairs. Sets with that many matches share one of the
``coordinates - matches + 1`` rarest pairs of either (prefix); the longer lists are skipped, and there a
pair's collisions are counted from the signatures, four bits of each coordinate, which are never fewer than
the true ones. In a prefix longer by ``SPARE`` they share ``SPARE`` pairs more; a set that shares fewer there
with all others together has no link and is not posted. That spares most sets, as nearly each shares a pair or two with
some other by chance. The posting lists are met through pivots (see ``linking``), so that a group of near copies
costs as many pairs as it has members and lists. Pairs above the match threshold are confirmed on whole sets.

Null texts and texts without words have an empty set: size 0, linked with nothing, kept. A text of fewer
words than ``words`` is one shingle. Equal sets are one posting. A component is named by its smallest id; rows
with a null id are members but name it only if there is no other. Rows that repeat an id all keep it. Only the
id and the text column are read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import NO_ID, Workspace, doc_keys, mix
from ledgerlake.llm.linking import MAP, Confirm, bitmap, links_of, may_reach, named_components, per_row, set_tokens, signature
from ledgerlake.llm.shingles import bucket, rarity_classes, shingle_hashes

COORDINATES = 128
MISS = 1e-9
SPARE = 8
SEED = 11
TILE = 1 << 14  # shingles hashed at once


def matches(coordinates: int, percent: int, miss: float = MISS) -> int:
    """The most matches that a pair at the threshold has but for a probability of ``miss``."""
    p, below = percent / 100, 0.0
    for m in range(coordinates + 1):
        below += math.comb(coordinates, m) * p**m * (1 - p)**(coordinates - m)
        if below > miss:
            return m
    return coordinates


def _factors(coordinates: int) -> np.ndarray:
    """One odd multiplier per coordinate."""
    return mix(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED)) | np.uint64(1)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """sets x coordinates: the least 32-bit hash of each set."""
    factors = _factors(coordinates)
    out = np.empty((len(sets), coordinates), np.uint32)
    low = 0
    while low < len(sets):
        high, size = low, 0
        while high < len(sets) and (high == low or size + len(sets[high]) <= TILE):
            size += len(sets[high])
            high += 1
        items = mix(np.concatenate(sets[low:high]))
        starts = np.cumsum([0, *[len(s) for s in sets[low:high - 1]]])
        for k, factor in enumerate(factors):
            out[low:high, k] = np.minimum.reduceat(((items * factor) >> np.uint64(32)).astype(np.uint32), starts)
        low = high
    return out


def nibbles(rows: np.ndarray) -> np.ndarray:
    """Four bits of every coordinate, sixteen coordinates in a number."""
    small = (mix(rows.astype(np.uint64)) & np.uint64(15)).reshape(len(rows), -1, 16)
    shifted = small << (np.arange(16, dtype=np.uint64) * np.uint64(4))
    return np.bitwise_or.reduce(shifted, axis=2).view(np.int64)


def _items(rows: np.ndarray) -> np.ndarray:
    """Coordinate-value pairs as 64-bit numbers."""
    return mix((rows.astype(np.uint64) << np.uint64(16)) | np.arange(rows.shape[1], dtype=np.uint64))


def _profiles(texts: DataFrame, words: int, coordinates: int) -> DataFrame:
    nib = [f"s{i}" for i in range(coordinates // 16)]
    flat = np.zeros(1, np.uint8)  # no rarity is needed to name sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.broadcast_to(flat, 1 << 21)
        for batch in batches:
            found = [(row, set_tokens(grams, classes)) for row, grams in shingle_hashes(batch["text"], words)]
            rows = np.array([row for row, _ in found], np.int64)
            size = np.zeros(batch.num_rows, np.int64)
            node = np.zeros(batch.num_rows, np.int64)
            longs = np.zeros((batch.num_rows, len(MAP) + len(nib)), np.int64)
            packed: list = [None] * batch.num_rows
            if found:
                size[rows] = [len(s) for _, s in found]
                node[rows] = [signature(s) for _, s in found]
                signed = signatures([s for _, s in found], coordinates)
                longs[rows] = np.hstack([np.stack([bitmap(s) for _, s in found]), nibbles(signed)])
                for row, one in zip(rows, signed):
                    packed[row] = one.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["_h"], pa.array(size), pa.array(node), pa.array(packed, pa.binary()),
                 *[pa.array(longs[:, i]) for i in range(longs.shape[1])]], ["_id", "_h", "n", "node", "signed", *MAP, *nib])

    return texts.mapInArrow(
        run, "_id long, _h long, n long, node long, signed binary, " + ", ".join(f"{c} long" for c in [*MAP, *nib]))


def _signed(batch: pa.RecordBatch, coordinates: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch["signed"].to_pylist()), np.uint32).reshape(-1, coordinates)


def _postings(nodes: DataFrame, coordinates: int, many: int, rarity) -> DataFrame:
    """Each node under its ``many`` rarest coordinate-value pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = _items(_signed(batch, coordinates))
            order = np.lexsort((items, rarity.value[bucket(items)]), axis=1)[:, :many]
            column = np.take_along_axis(items, order, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column.ravel()), batch["node"].take(pa.array(np.repeat(np.arange(len(items)), many)))], ["column", "node"])

    return nodes.select("node", "signed").mapInArrow(run, "column long, node long")


def _entries(space: Workspace, nodes: DataFrame, coordinates: int, least: int, rarity) -> DataFrame:
    """The prefixes of the nodes that share enough of their longer prefixes with others to have a link."""
    spare = min(SPARE, least - 1)
    many = coordinates - least + 1
    wide = _postings(nodes, coordinates, many + spare, rarity)
    shared = space.keep(wide.groupBy("column").agg(F.count("*").alias("m")).where("m > 1").select("column"), "wide-shared")
    able = wide.join(shared, "column", "left_semi").groupBy("node").agg(F.count("*").alias("k")).where(F.col("k") > spare)
    chosen = space.keep(nodes.select("node", "signed").join(able, "node", "left_semi"), "chosen")
    space.drop("wide-shared")
    return _postings(chosen, coordinates, many, rarity).withColumn("first", F.lit(True))


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, coordinates: int = COORDINATES,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs``.

    ``coordinates`` is a multiple of 16.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "minhash")
    kind = dict(docs.dtypes)[id_col]
    least = matches(coordinates, percent)
    nib = [f"s{i}" for i in range(coordinates // 16)]
    texts = docs.select(*doc_keys(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    profiles = space.keep(_profiles(texts, words, coordinates), "profiles")
    nodes = space.keep(
        profiles.where("n > 0").groupBy("node").agg(
            *[F.first(c).alias(c) for c in ("n", "_id", "_h", "signed", *MAP, *nib)],
            F.min(F.when(F.col("_id") != NO_ID, F.col("_id"))).alias("least")), "nodes")
    rarity = spark.sparkContext.broadcast(
        rarity_classes(nodes.select("signed"), lambda batch: [_items(_signed(batch, coordinates)).ravel()]))
    entries = _entries(space, nodes, coordinates, least, rarity)

    # Nibbles of a coordinate that differ leave a bit in their exclusive or.
    differ = []
    for c in nib:
        odd = F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))
        odd = odd.bitwiseOR(F.shiftrightunsigned(odd, 1))
        odd = odd.bitwiseOR(F.shiftrightunsigned(odd, 2))
        differ.append(F.bit_count(odd.bitwiseAND(F.lit(0x1111111111111111))))
    collisions = coordinates - sum(differ[1:], differ[0])
    may_link = (F.col("x.node") != F.col("y.node")) & (collisions >= least) & may_reach(percent)
    same = spark.sparkContext.broadcast(np.zeros(1 << 21, np.uint8))
    confirm = Confirm(space, texts, nodes, words, percent, same)
    links = links_of(space, entries, nodes.select("node", "n", *MAP, *nib), may_link, confirm.links)
    found = per_row(profiles.select("_id", "_h", "n", "node"), named_components(space, nodes, links), kind, id_col)
    kept = F.col("component_id").isNull() | F.col("_id").eqNullSafe(F.col("component_id"))
    return found.select(id_col, "n_shingles", "component_id", kept.alias("kept"))
