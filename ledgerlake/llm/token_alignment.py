"""Alignment of two tokenizers over a corpus, with corpus-wide counts of the token pairs that overlap.

``align`` gives every text's tokens by a byte-level BPE (A) and a piece BPE with byte fallback (B), both of
the text behind one space. Places where tokens of both end cut the text into groups; an A and a B token
whose bytes overlap are linked. A pair's count is the number of links, over all texts, between its two ids.

Counting spills to the shared folder in runs. A run holds the pair-document records of some texts, ordered
by B id, then A id, then text, and compressed with zstd, one block for each radix of the B id. Runs are
merged through a heap of their blocks, ``FAN`` at a time and level by level, until each radix is one list of
pairs with their counts. As the list is ordered by B id, one pass over it finds the highest count of each B
id. Counts and marks then go back down the same levels, every run getting those of its own pairs only, and
are summed per text. No task holds more than ``FAN`` blocks, and a frequent pair is one entry of a block.

Both tokenizers begin a token at a space behind a non-space character, so a text is the sequence of its
units cut at those places, and a unit's alignment is looked up in a bounded cache. B's vocabulary is checked
for this: a piece with a space inside would be refused.

Null and empty texts have no tokens, nor do texts whose tokens of either kind do not spell the text again
(a literal U+2581): zeros and an empty digest. Strings of special tokens are plain text. Repeated rows, also
with equal ids, are texts of their own and each gives a row. Rows with a null id are counted and returned.
Only the id and the text column are read, so other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.bpe import load_ranks, load_table
from ledgerlake.llm.common import Workspace, mix

RADIX = 64  # parts of the B ids
FAN = 64  # blocks merged at once
RUN_LINKS = 1 << 20  # links of a run, unless one text alone has more
SLICE_CHARS = 1 << 20
CACHE_ENTRIES = 300_000
MERGE_STEP = 1 << 14  # keys taken from a block at a time

_UNIT = re.compile(r"(?<=\S) ")


@functools.lru_cache(maxsize=2)
def load_pieces(path: str) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    """The piece tokenizer and each id's bytes."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            table.append(bytes([int(piece[3:5], 16)]))
            continue
        if re.search("[^▁]▁", piece):
            raise ValueError(f"piece {i} goes on behind a space")
        table.append(piece.replace("▁", " ").encode())
    return model, table


class Units(dict):
    """Numbers of text units, with the alignment of each in arrays by number."""

    def __init__(self, ranks: str, pattern: str, pieces: str):
        super().__init__()
        self.first, self.second = load_ranks(ranks, pattern), load_pieces(pieces)[0]
        self.second_bytes = load_pieces(pieces)[1]
        self.first_size = np.array([len(x) for x in load_table(ranks)])
        self.second_size = np.array([len(x) for x in self.second_bytes])
        self.names = [str(i) for i in range(max(len(self.first_size), len(self.second_size)))]
        self.restart()

    def restart(self) -> None:
        self.clear()
        # ``a1,a2|b1;a3|b2`` of each unit; None if its tokens do not spell it.
        self.texts: list[str | None] = []
        self.shapes = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links
        self.keys = np.zeros(0, np.uint64)  # one per link: B id above A id

    def of(self, texts: list[str]) -> list[list[int]]:
        """The units of each text; ones not seen before are aligned together."""
        lists = []
        for text in texts:
            head, *rest = _UNIT.split(" " + text)
            lists.append([head, *[" " + unit for unit in rest]])
        new = [u for u in dict.fromkeys(u for units in lists for u in units) if u not in self]
        if new:
            self._align(new)
        get = self.__getitem__
        return [list(map(get, units)) for units in lists]

    def _align(self, units: list[str]) -> None:
        """Add units. A space behind a non-space begins a token of A, so most units are encoded as one text."""
        units.sort(key=lambda u: u[-1].isspace())
        closed = next((i for i, u in enumerate(units) if u[-1].isspace()), len(units))
        a_ids = self.first.encode_ordinary("".join(units[:closed])) if closed else []
        for u in units[closed:]:
            a_ids = a_ids + self.first.encode_ordinary(u)
        # B puts a space in front by itself, but not in front of nothing.
        found = self.second.encode([u[1:] for u in units], num_threads=1)
        blank = [self.second.piece_to_id("▁")]
        b_lists = [ids if len(u) > 1 else blank for u, ids in zip(units, found)]
        raw = [u.encode() for u in units]
        spelled = [b"".join([self.second_bytes[i] for i in ids]) == r for ids, r in zip(b_lists, raw)]
        ends = np.cumsum([len(r) for r in raw])
        a, a_end = np.array(a_ids, np.int64), np.cumsum(self.first_size[a_ids])
        if not all(spelled):  # stands for a text that B cannot spell: one token over all of it
            sizes = np.concatenate([self.second_size[ids] if s else [len(r)] for ids, s, r in zip(b_lists, spelled, raw)])
            b_lists = [ids if s else [0] for ids, s in zip(b_lists, spelled)]
        b = np.array([i for ids in b_lists for i in ids], np.int64)
        b_end = np.cumsum(self.second_size[b] if all(spelled) else sizes)
        # Between two neighbouring ends of either kind lie one A and one B token: a link.
        stops = np.union1d(a_end, b_end)
        links = (b[np.searchsorted(b_end, stops)].astype(np.uint64) << np.uint64(32)) | a[np.searchsorted(a_end, stops)].astype(np.uint64)
        cuts = np.intersect1d(a_end, b_end)
        count = lambda x: np.diff(np.searchsorted(x, np.append(0, ends), "right"))
        shapes = np.stack([count(a_end), count(b_end), count(cuts), count(stops)], axis=1)
        a_names, b_names = [self.names[i] for i in a_ids], [self.names[i] for i in b.tolist()]
        to_a, to_b = np.searchsorted(a_end, cuts).tolist(), np.searchsorted(b_end, cuts).tolist()
        groups, i, j = [], 0, 0
        for x, y in zip(to_a, to_b):
            groups.append(",".join(a_names[i:x + 1]) + "|" + ",".join(b_names[j:y + 1]))
            i, j = x + 1, y + 1
        low = 0
        for n, fine, unit in zip(shapes[:, 2].tolist(), spelled, units):
            self[unit] = len(self.texts)
            self.texts.append(";".join(groups[low:low + n]) if fine else None)
            low += n
        keep = np.repeat(np.array(spelled), shapes[:, 3])
        shapes[~np.array(spelled)] = 0
        self.shapes = np.concatenate([self.shapes, shapes])
        self.keys = np.concatenate([self.keys, links[keep]])


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join([a.tobytes() for a in arrays]))


def _unpack(block: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(block)


def pack_sums(keys: np.ndarray, totals: np.ndarray) -> bytes:
    """Ascending keys, as differences, and a number for each."""
    return _pack(np.diff(keys, prepend=np.uint64(0)), totals.astype("<i8"))


def unpack_sums(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = _unpack(block)
    half = len(raw) // 2
    return np.cumsum(np.frombuffer(raw[:half], "<u8"), dtype=np.uint64), np.frombuffer(raw[half:], "<i8")


def _radix(keys: np.ndarray) -> np.ndarray:
    return (mix(keys >> np.uint64(32)) & np.uint64(RADIX - 1)).astype(np.uint8)


def run_blocks(keys: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Radix, pair sums and records of the links of a run; ``docs`` ascends."""
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    fresh = np.append(True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1]))
    at = np.flatnonzero(fresh)
    times = np.diff(np.append(at, len(keys))).astype("<u4")
    keys, docs = keys[at], docs[at].astype("<u4")
    radix = _radix(keys)
    order = np.argsort(radix, kind="stable")
    ends = np.searchsorted(radix[order], np.arange(RADIX + 1))
    for r in range(RADIX):
        rows = order[ends[r]:ends[r + 1]]
        if not len(rows):
            continue
        own = keys[rows]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        many = np.diff(np.append(first, len(own))).astype("<u4")
        yield (r, pack_sums(own[first], np.add.reduceat(times[rows].astype(np.int64), first)),
               _pack(many, docs[rows], times[rows]))


def records(block: bytes, n_keys: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per record: the number of its pair in the block, its text, its links."""
    flat = np.frombuffer(_unpack(block), "<u4")
    n = (len(flat) - n_keys) // 2
    return np.repeat(np.arange(n_keys), flat[:n_keys]), flat[n_keys:n_keys + n], flat[n_keys + n:]


def merged(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all blocks in ascending order with their summed numbers, by a heap of the blocks' next keys.

    The block with the least bound ends a step: up to that bound, all keys of all blocks are known.
    """
    lists = [unpack_sums(b) for b in blocks]
    places = [0] * len(lists)
    bound = lambda i: int(lists[i][0][min(places[i] + MERGE_STEP, len(lists[i][0])) - 1])
    heap = [(bound(i), i) for i in range(len(lists)) if len(lists[i][0])]
    heapq.heapify(heap)
    keys_out, totals_out = [], []
    while heap:
        limit = heap[0][0]
        parts = []
        for i in [i for _, i in heap]:
            end = int(np.searchsorted(lists[i][0], np.uint64(limit), "right"))
            if end > places[i]:
                parts.append((lists[i][0][places[i]:end], lists[i][1][places[i]:end]))
                places[i] = end
        while heap and heap[0][0] <= limit:
            i = heapq.heappop(heap)[1]
            if places[i] < len(lists[i][0]):
                heapq.heappush(heap, (bound(i), i))
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys, kind="stable")
        keys, totals = keys[order], np.concatenate([t for _, t in parts])[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys_out.append(keys[at])
        totals_out.append(np.add.reduceat(totals, at))
    if not keys_out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys_out), np.concatenate(totals_out)


def answers(keys: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Per pair its count, negative where it is the highest of its B id; B ids are adjacent."""
    side = keys >> np.uint64(32)
    at = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
    best = np.repeat(np.maximum.reduceat(totals, at), np.diff(np.append(at, len(side))))
    return np.where(totals == best, -totals, totals)


_FACTS = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]


def _spill(ranks: str, pattern: str, pieces: str, kind: pa.DataType):
    """Rows of two kinds: a text's own facts (``radix`` null), and blocks of a run."""
    schema = pa.schema([("run", pa.int64()), ("radix", pa.int32()), ("sums", pa.binary()), ("records", pa.binary()),
                        ("key", kind), ("doc", pa.int32()), *_FACTS])

    def batch_of(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(ranks, pattern, pieces)
        number = TaskContext.get().partitionId() << 32
        keys, docs, n_docs, n_links = [], [], 0, 0
        for batch in batches:
            texts = batch["text"].to_pylist()
            low = 0
            while low < len(texts):
                high, chars = low, 0
                while high < len(texts) and (high == low or chars < SLICE_CHARS):
                    chars += len(texts[high] or "")
                    high += 1
                if len(units) > CACHE_ENTRIES:
                    units.restart()
                full = [i for i, t in enumerate(texts[low:high]) if t]
                lists: list[list[int]] = [[] for _ in range(high - low)]
                for i, found in zip(full, units.of([texts[low + i] for i in full])):
                    lists[i] = found
                digests, whole = [], []
                for found in lists:
                    spelled = [units.texts[u] for u in found]
                    fine = bool(spelled) and None not in spelled
                    whole.append(found if fine else [])
                    digests.append(hashlib.sha256(";".join(spelled).encode()).hexdigest() if fine else "")
                shapes = units.shapes
                start = np.cumsum(shapes[:, 3]) - shapes[:, 3]
                at = np.array([u for found in whole for u in found], np.int64)
                ends = np.cumsum([len(found) for found in whole])
                sums = np.vstack([np.zeros(4, np.int64), np.cumsum(shapes[at], axis=0)])[np.append(0, ends)]
                facts = np.diff(sums, axis=0)
                size = shapes[at, 3]
                picked = np.repeat(start[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
                keys.append(units.keys[picked])
                docs.append(np.repeat(np.arange(n_docs, n_docs + high - low), facts[:, 3]))
                yield batch_of(
                    high - low, run=np.full(high - low, number), key=batch["key"].slice(low, high - low),
                    doc=np.arange(n_docs, n_docs + high - low, dtype=np.int32), groups_sha256=digests,
                    **{name: facts[:, i] for i, (name, _) in enumerate(_FACTS[:4])})
                n_docs, n_links, low = n_docs + high - low, n_links + len(picked), high
                if n_links >= RUN_LINKS:
                    for r, sums_block, record_block in run_blocks(np.concatenate(keys), np.concatenate(docs)):
                        yield batch_of(1, run=[number], radix=[r], sums=[sums_block], records=[record_block])
                    number, keys, docs, n_docs, n_links = number + 1, [], [], 0, 0
        if n_links:
            for r, sums_block, record_block in run_blocks(np.concatenate(keys), np.concatenate(docs)):
                yield batch_of(1, run=[number], radix=[r], sums=[sums_block], records=[record_block])

    return run


_SUMS = pa.schema([("radix", pa.int32()), ("slot", pa.int64()), ("sums", pa.binary())])


def _merge(key, rows):
    """The blocks of one slot as one."""
    block = pack_sums(*merged(rows["sums"].to_pylist()))
    return pa.table([[key[0].as_py()], [key[1].as_py()], [block]], schema=_SUMS)


def _own_answers(blocks: list[bytes], parent: bytes) -> list[np.ndarray]:
    """Answers for the keys of each block, out of those of the slot that they were merged into."""
    keys, found = unpack_sums(parent)
    return [found[np.searchsorted(keys, unpack_sums(b)[0])] for b in blocks]


def _descend(key, rows, parent):
    blocks = rows["sums"].to_pylist()
    out = [pack_sums(unpack_sums(b)[0], a) for b, a in zip(blocks, _own_answers(blocks, parent["sums"][0].as_py()))]
    return pa.table([rows["radix"], rows["slot"], pa.array(out, pa.binary())], schema=_SUMS)


_SHARES = pa.schema([("run", pa.int64()), ("doc", pa.binary()), ("best", pa.binary()), ("total", pa.binary())])


def _contribute(key, rows, parent):
    """What the pairs of a radix give to each text of a run."""
    blocks, out = rows["sums"].to_pylist(), []
    for b, r, found in zip(blocks, rows["records"].to_pylist(), _own_answers(blocks, parent["sums"][0].as_py())):
        pair, doc, times = records(r, len(found))
        count, times = found[pair], times.astype(np.int64)
        docs, place = np.unique(doc, return_inverse=True)
        best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        np.add.at(best, place, np.where(count < 0, times, 0))
        np.add.at(total, place, np.abs(count) * times)
        out.append([_pack(x.astype("<i8")) for x in (docs, best, total)])
    columns = [pa.array([row[i] for row in out], pa.binary()) for i in range(3)]
    return pa.table([rows["run"], *columns], schema=_SHARES)


_TOTALS = pa.schema([("run", pa.int64()), ("doc", pa.int32()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _per_text(key, rows):
    doc, best, total = (np.concatenate([np.frombuffer(_unpack(b), "<i8") for b in rows[c].to_pylist()])
                        for c in ("doc", "best", "total"))
    docs, place = np.unique(doc, return_inverse=True)
    sums = [np.zeros(len(docs), np.int64) for _ in range(2)]
    for out, values in zip(sums, (best, total)):
        np.add.at(out, place, values)
    return pa.table([np.full(len(docs), key[0].as_py()), docs.astype(np.int32), *sums], schema=_TOTALS)


def align(docs: DataFrame, ranks: str, pattern: str, pieces: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256`` of every row."""
    spark = docs.sparkSession
    space = Workspace(spark, "token-alignment")
    texts = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text"))
    spilled = space.keep(texts.mapInArrow(
        _spill(ranks, pattern, pieces, pa.int64()),
        "run long, radix int, sums binary, records binary, key long, doc int, n_a long, n_b long, n_groups long,"
        "n_links long, groups_sha256 string"), "runs")
    blocks = spilled.where("radix is not null").select("radix", F.col("run").alias("slot"), "run", "sums", "records")
    of_slot = lambda n: F.pmod(F.xxhash64("slot"), F.lit(n))

    n = spilled.where("radix is not null").select("run").distinct().count()
    levels, sizes = [blocks.select(*_SUMS.names)], []
    while n > 1 or not sizes:
        n = -(-n // FAN) or 1
        sizes.append(n)
        levels.append(space.keep(
            levels[-1].withColumn("slot", of_slot(n)).groupBy("radix", "slot").applyInArrow(_merge, "radix int, slot long, sums binary"),
            f"level{len(levels)}"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [pack_sums(keys, answers(keys, totals)) for keys, totals in map(unpack_sums, batch["sums"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["radix"], batch["slot"], pa.array(out, pa.binary())], schema=_SUMS)

    told = space.keep(levels[-1].mapInArrow(answer, "radix int, slot long, sums binary"), "told")
    for depth in range(len(sizes) - 1, 0, -1):
        children = levels[depth].withColumn("parent", of_slot(sizes[depth]))
        told = space.keep(
            children.groupBy("radix", "parent").cogroup(told.groupBy("radix", "slot"))
            .applyInArrow(_descend, "radix int, slot long, sums binary"), f"told{depth}")
    shares = space.keep(
        blocks.withColumn("parent", of_slot(sizes[0])).groupBy("radix", "parent").cogroup(told.groupBy("radix", "slot"))
        .applyInArrow(_contribute, "run long, doc binary, best binary, total binary"), "shares")
    sums = shares.groupBy("run").applyInArrow(_per_text, "run long, doc int, n_best long, count_sum long")
    none = F.lit(0).cast("long")
    return (
        spilled.where("radix is null").join(sums, ["run", "doc"], "left")
        .select(F.col("key").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
                F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
    )
