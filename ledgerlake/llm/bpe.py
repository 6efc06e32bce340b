"""Byte-level BPE: parallel chunk encoding with resynchronised boundaries, and decoding.

``encode`` returns one row per document row: the id column, ``ids`` (binary, little-endian unsigned
32-bit) and ``n_tokens``. Texts longer than ``chunk_chars`` are cut into overlapping chunks that
different tasks pre-tokenise. A chunk's pre-tokens are wrong only until they meet a true boundary, as a
match depends on nothing before it; where the boundaries of two neighbouring chunks coincide behind a
non-space character, both continue alike, so the text is stitched there. The stitched pieces are
encoded in parallel and joined in order. Two chunks without such a place are joined into one.

Inside a piece, a space after a non-space character always begins a pre-token, so pieces are looked up
by these smaller units in a bounded cache.

Null texts count as empty: no ids. Empty tables give no rows. Repeated rows are each encoded. Special
tokens are ordinary text unless ``special`` names them.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import doc_keys

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
CACHE_ENTRIES = 400_000

# A space right after a non-space begins a pre-token whatever precedes it.
_UNIT = re.compile(r"(?<=\S) ")
_LOOSE = re.compile(r"\s ")


@functools.lru_cache(maxsize=4)
def load_ranks(path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


class Units(dict):
    """Ids of a text unit as packed bytes; filled on demand and emptied when full."""

    def __init__(self, encoding: tiktoken.Encoding, special: tuple[tuple[str, int], ...] = (),
                 entries: int = CACHE_ENTRIES):
        super().__init__()
        self.encoding, self.entries = encoding, entries
        self.special = {name for name, _ in special}

    def __missing__(self, unit: str) -> bytes:
        ids = (self.encoding.encode(unit, allowed_special=self.special, disallowed_special=())
               if self.special else self.encoding.encode_ordinary(unit))
        packed = np.array(ids, "<u4").tobytes()
        if len(self) >= self.entries:
            self.clear()
        if len(unit) <= 64:
            self[unit] = packed
        return packed

    def ids(self, text: str) -> bytes:
        """Packed ids of a whole text."""
        if not text:
            return b""
        if text[0] == " " or _LOOSE.search(text):
            units = _UNIT.split(text)
        else:
            units = text.split(" ")
        get = self.__getitem__
        first = get(units[0]) if units[0] else b""
        return first + b"".join([get(" " + unit) for unit in units[1:]])


def boundaries(text: str, pattern: str) -> list[int]:
    """Where pre-tokens begin, behind a non-space character."""
    exact = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return [m.start() for m in regex.finditer(exact, text) if m.start() and not text[m.start() - 1].isspace()]


def _chunk_rows(pattern: str, chunk: int, overlap: int):
    """Pre-tokenise each chunk on its own: boundaries near its two ends, relative to the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for base, lead, text in zip(batch["_base"].to_pylist(), batch["_lead"].to_pylist(),
                                        batch["_part"].to_pylist()):
                found = boundaries(text, pattern)
                heads.append([base + b for b in found if b < overlap])
                # The last match may go on beyond this chunk, so its end is no boundary.
                tails.append([base + b for b in found if lead <= b < len(text) - 1])
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["_h"], batch["_chunk"], pa.array(heads, pa.list_(pa.int32())),
                 pa.array(tails, pa.list_(pa.int32()))],
                ["_id", "_h", "_chunk", "_heads", "_tails"])

    return run


def long_cuts(docs: DataFrame, pattern: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Cut places (``_id``, ``_h``, ``_cuts``) of the long texts among ``docs`` (``_id``, ``_h``, ``text``).

    Chunk c covers ``[c * chunk, (c + 1) * chunk + overlap)`` characters. The junction of chunks c - 1
    and c is the first place in their overlap at which both have a boundary. That place is a true
    boundary if chunk c - 1 has met its own predecessor; behind the first junction without such a place
    the text stays in one piece.
    """
    last = F.floor((F.length("text") - 1) / F.lit(chunk)).cast("int")
    parts = (
        docs.dropDuplicates(["_id", "_h"])
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), last)))
        .select("_id", "_h", "_chunk", (F.col("_chunk") * chunk).alias("_base"), F.lit(chunk).alias("_lead"),
                F.expr(f"substring(text, _chunk * {chunk} + 1, {chunk + overlap})").alias("_part"))
    )
    seen = parts.mapInArrow(
        _chunk_rows(pattern, chunk, overlap),
        "_id long, _h long, _chunk int, _heads array<int>, _tails array<int>")
    heads = seen.where("_chunk > 0").select("_id", "_h", "_chunk", "_heads")
    tails = seen.select("_id", "_h", (F.col("_chunk") + 1).alias("_chunk"), "_tails")
    met = heads.join(tails, ["_id", "_h", "_chunk"]).select(
        "_id", "_h", "_chunk", F.array_min(F.array_intersect("_heads", "_tails")).alias("cut"))
    lists = met.groupBy("_id", "_h").agg(
        F.sort_array(F.collect_list(F.struct("_chunk", "cut"))).alias("all"),
        F.min(F.when(F.col("cut").isNull(), F.col("_chunk"))).alias("torn"))
    whole = F.filter("all", lambda x: F.col("torn").isNull() | (x["_chunk"] < F.col("torn")))
    return lists.select("_id", "_h", F.transform(whole, lambda x: x["cut"]).alias("_cuts"))


def _encode_batches(path: str, pattern: str, special: tuple, text: str, keep: list[str], fold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(load_ranks(path, pattern, special), special)
        for batch in batches:
            packed = [units.ids(t) if t else b"" for t in batch[text].to_pylist()]
            yield fold(batch.select(keep), packed)

    return run


def _as_ids(batch: pa.RecordBatch, packed: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(packed, pa.binary())], [*batch.schema.names, "ids"])


def _fold_ids(fold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fold(batch.select(["_key"]), batch["ids"].to_pylist())

    return run


def encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
           special: tuple[tuple[str, int], ...] = (), chunk_chars: int = CHUNK_CHARS,
           overlap_chars: int = OVERLAP_CHARS, fold=_as_ids, fold_schema: str = "ids binary") -> DataFrame:
    """The id column and ``ids`` of every row of ``docs``.

    ``fold`` may reduce the ids where they are made: it gets a batch with the id column (named
    ``_key``) and the packed ids of its rows, and returns a batch of ``_key`` and ``fold_schema``.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = f"_key {kind}, {fold_schema}"
    plain = docs.select(F.col(id_col).alias("_key"), F.col(text_col).cast("string").alias("text"))
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk_chars
    short_rows = plain.where(~long).mapInArrow(
        _encode_batches(path, pattern, special, "text", ["_key"], fold), schema)

    texts = plain.where(long).select("_key", *doc_keys("_key"), "text")
    cuts = long_cuts(texts, pattern, chunk_chars, overlap_chars)
    ends = F.concat(F.array(F.lit(0)), F.coalesce("_cuts", F.array().cast("array<int>")), F.array(F.length("text")))
    pieces = (
        texts.groupBy("_key", "_id", "_h").agg(F.count("*").alias("_copies"), F.first("text").alias("text"))
        .join(cuts, ["_id", "_h"], "left").withColumn("_ends", ends)
        .withColumn("_n", F.explode(F.sequence(F.lit(0), F.size("_ends") - 2)))
        .select("_key", "_id", "_h", "_copies", "_n",
                F.expr("substring(text, _ends[_n] + 1, _ends[_n + 1] - _ends[_n])").alias("text"))
    )
    coded = pieces.mapInArrow(
        _encode_batches(path, pattern, special, "text", ["_key", "_id", "_h", "_copies", "_n"], _as_ids),
        f"_key {kind}, _id long, _h long, _copies long, _n int, ids binary")
    joined = (
        coded.groupBy("_key", "_id", "_h", "_copies")
        .agg(F.sort_array(F.collect_list(F.struct("_n", "ids"))).alias("parts"))
        .withColumn("ids", F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.ids))"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .select("_key", "ids").mapInArrow(_fold_ids(fold), schema)
    )
    return short_rows.unionByName(joined).withColumnRenamed("_key", id_col)


def decode_bytes(packed: bytes, table: list[bytes]) -> bytes:
    """Raw bytes of packed ids; they need not form whole characters."""
    return b"".join([table[i] for i in np.frombuffer(packed, "<u4").tolist()])


@functools.lru_cache(maxsize=4)
def load_table(path: str) -> list[bytes]:
    """Bytes of each id, in id order."""
    with open(path, "rb") as lines:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}
    return [ranks.get(i, b"") for i in range(max(ranks) + 1)]


def decode(coded: DataFrame, path: str, *, id_col: str = "doc_id") -> DataFrame:
    """Columns ``doc_id``, ``raw`` (binary): the bytes that ``ids`` stand for. Null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load_table(path)
        for batch in batches:
            raw = [None if ids is None else decode_bytes(ids, table) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[id_col], pa.array(raw, pa.binary())], [id_col, "raw"])

    return coded.select(id_col, "ids").mapInArrow(run, f"{id_col} {dict(coded.dtypes)[id_col]}, raw binary")
