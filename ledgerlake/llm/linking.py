"""Links between distinct shingle sets that share columns, and the components that the links form.

A column is anything under which two sets that link are sure to meet at least once. Within a column, only
entries marked ``first`` need be met by all others. Columns are not multiplied out as a whole: in each, one
first entry (a pivot) is compared with all others, linked sets become one component, and pairs within a
component are finished. Columns are dealt into kinds that prefer different pivots, so that each set of a group
that shares many columns meets several of them: ``KINDS`` in the first round, which finishes the large groups of
copies, and eight times as many in each further one, for groups whose sets link only here and there. A round makes
no more rows than it has entries, however many kinds. It is repeated with other pivots as long as pairs
are many and links are found; what is left between different components is then joined. Rows leave that join only if the bounds of ``may_link``,
evaluated in it, let them; among these is the number of bits that one set's bitmap has alone, each of which
stands for a shingle that the other set lacks. A pair that shares many columns leaves it once: at a column the join
sees whether the pair has met in a smaller one, as far as the ``LOWEST`` columns of both tell. So the bounds must
not let a pair pass in a column and not in a smaller one that it shares. No link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import NO_ID, Workspace, mix
from ledgerlake.llm.components import connected
from ledgerlake.llm.shingles import bucket, shingle_hashes

MAX_PIVOTS = 4
LOWEST = 16  # the columns of a set that the last join compares
KINDS = 8
FEW_PRODUCTS = 50_000
MAP_LONGS = 8
MAP = [f"b{i}" for i in range(MAP_LONGS)]


def set_tokens(found: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """The set of a text as sorted numbers, rare shingles first."""
    return np.unique((rarity[bucket(found)].astype(np.uint64) << np.uint64(55)) | (found >> np.uint64(9)))


def signature(tokens: np.ndarray) -> int:
    """A number for the set as a whole."""
    return int((mix(tokens).sum(dtype=np.uint64) ^ np.uint64(len(tokens))).astype(np.int64))


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """The set hashed into ``64 * MAP_LONGS`` bits."""
    flags = np.zeros(64 * MAP_LONGS, np.uint8)
    flags[(tokens & np.uint64(64 * MAP_LONGS - 1)).astype(np.int64)] = 1
    return np.packbits(flags).view(np.int64)


def may_reach(percent: int) -> Column:
    """Whether the bitmaps of x and y allow the threshold."""

    def alone(a: str, b: str) -> Column:
        bits = [F.bit_count(F.col(f"{a}.{c}").bitwiseAND(F.bitwise_not(F.col(f"{b}.{c}")))) for c in MAP]
        return sum(bits[1:], bits[0])

    overlap = F.least(F.col("x.n") - alone("x", "y"), F.col("y.n") - alone("y", "x"))
    return (100 + percent) * overlap >= percent * (F.col("x.n") + F.col("y.n"))


class Confirm:
    """Exact overlaps of pairs; the whole set of a row is built once, when a pair first asks for it."""

    def __init__(self, space: Workspace, texts: DataFrame, nodes: DataFrame, words: int, percent: int, rarity: Broadcast):
        self.space, self.texts, self.nodes = space, texts, nodes
        self.words, self.percent, self.rarity = words, percent, rarity
        self.sets: DataFrame | None = None

    def _whole(self, chosen: DataFrame) -> DataFrame:
        """The whole set of each chosen row (``node``, ``_id``, ``_h``); repeated rows of the texts repeat it."""
        words, rarity = self.words, self.rarity

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, sets = [], []
                for row, found in shingle_hashes(batch["text"], words):
                    rows.append(row)
                    sets.append(set_tokens(found, rarity.value).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch["node"].take(pa.array(rows, pa.int64())), pa.array(sets, pa.list_(pa.int64()))], ["node", "tokens"])

        texts = self.texts.join(chosen.hint("shuffle_hash"), ["_id", "_h"]).select("node", "text")
        return texts.mapInArrow(run, "node long, tokens array<long>").dropDuplicates(["node"])

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (``a``, ``b``) whose whole sets reach the threshold."""
        asked = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node")
        if self.sets is not None:
            asked = asked.join(self.sets.select("node"), "node", "left_anti")
        chosen = self.space.keep(asked.join(self.nodes.select("node", "_id", "_h"), "node"), f"chosen-{name}")
        more = self.space.keep(self._whole(chosen), f"sets-{name}")
        self.sets = more if self.sets is None else self.sets.unionByName(more)
        left = self.sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
        right = self.sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
        overlap = F.size(F.array_intersect("ta", "tb"))
        union = F.size("ta") + F.size("tb") - overlap
        met = pairs.join(left, "a").join(right, "b").where(100 * overlap >= self.percent * union)
        return self.space.keep(met.select("a", "b"), f"links-{name}")


def met_once(entries: DataFrame, met: Column) -> DataFrame:
    """Pairs (``a`` < ``b``) of ``entries`` that meet in a column in which one is first, all but always once."""

    def lowest(column: Column) -> Column:
        return F.slice(F.sort_array(F.collect_list(column)), 1, LOWEST)

    low = entries.groupBy("node").agg(
        lowest(F.col("column")).alias("low"), lowest(F.when(F.col("first"), F.col("column"))).alias("low_first"))
    known = entries.join(low, "node")
    x, y = known.alias("x"), known.where("first").alias("y")
    one_side = ~F.col("x.first") | (F.col("x.node") < F.col("y.node"))
    before = F.least(F.array_min(F.array_intersect("x.low", "y.low_first")), F.array_min(F.array_intersect("x.low_first", "y.low")))
    # ``before`` is named once: what a condition names twice is computed ahead of all its parts, for every two entries.
    fresh = F.coalesce(before, F.col("x.column")) >= F.col("x.column")
    return x.join(y, F.col("x.column") == F.col("y.column")).where(one_side & met & fresh).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def links_of(space: Workspace, entries: DataFrame, more: DataFrame, may_link: Column,
             confirm: Callable[[DataFrame, str], DataFrame], few: int | None = None) -> DataFrame | None:
    """All links between components of ``entries`` (``column``, ``node``, ``first`` and others), or None.

    ``more`` has what ``may_link`` needs of each node. ``few`` pairs are multiplied without pivots.
    """
    few = FEW_PRODUCTS if few is None else few
    shared = space.keep(
        entries.groupBy("column").agg(F.count("*").alias("m"), F.count_if("first").alias("s")).where("m > 1 and s > 0"), "shared")
    left = shared.agg(F.sum(F.col("s") * (F.col("m") - 1))).first()[0] or 0
    if not left:
        return None
    open_entries = space.keep(
        entries.join(shared.select("column"), "column").join(more, "node").withColumn("label", F.col("node")), "open")
    space.drop("shared")
    enough = max(few, 2 * open_entries.select("node").distinct().count()) if few else 0
    links, turn, merging = None, 0, True
    while left:
        last = left <= enough or turn == MAX_PIVOTS or not merging
        met = (F.col("x.label") != F.col("y.label")) & may_link
        if last:
            pairs = met_once(open_entries, met)
        else:
            own = [c for c in open_entries.columns if c != "column"]
            order = F.xxhash64("node", F.pmod(F.xxhash64("column"), F.lit(KINDS << 3 * turn)), F.lit(turn))
            firsts = space.keep(
                open_entries.where("first").groupBy("column").agg(F.min_by(F.struct(*own), order).alias("p")).select("column", "p.*"),
                f"pivots{turn}")
            pairs = open_entries.alias("x").join(firsts.alias("y"), F.col("x.column") == F.col("y.column")).where(met).select(
                F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        pairs = space.keep(pairs.distinct(), f"pairs{turn}")
        fresh = confirm(pairs, str(turn))
        links = fresh if links is None else links.unionByName(fresh)
        if last:
            return links
        merging = not fresh.isEmpty()
        labels = connected(space, links, f"labels{turn}")
        # A pivot has met all of its column. It stays to be met by others, but is no pivot there again.
        spent = firsts.select("column", "node", F.lit(True).alias("spent"))
        labelled = space.keep(
            open_entries.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            .join(spent, ["column", "node"], "left").withColumn("first", F.col("first") & F.col("spent").isNull()).drop("spent"),
            f"labelled{turn}")
        columns = labelled.groupBy("column", "label").agg(F.count("*").alias("k"), F.count_if("first").alias("f")).groupBy("column").agg(
            F.sum("k").alias("m"), F.sum("f").alias("s"), F.sum(F.col("k") * F.col("f")).alias("inner"))
        # Columns whose first entries are in one component with all others, or spent, are finished.
        columns = space.keep(columns.where("m * s > inner"), f"columns{turn}")
        left = columns.agg(F.sum(F.col("m") * F.col("s") - F.col("inner"))).first()[0] or 0
        space.drop(f"pairs{turn}", f"pivots{turn}", f"chosen-{turn}")
        turn += 1
        open_entries = space.keep(labelled.join(columns.select("column"), "column"), f"open{turn}")
        space.drop(f"labelled{turn - 1}", "open" if turn == 1 else f"open{turn - 1}", f"columns{turn - 1}")
    return links


def named_components(space: Workspace, nodes: DataFrame, links: DataFrame | None) -> DataFrame:
    """``node``, ``label`` of its component, ``component_id``: the least ``least`` of the component."""
    single = nodes.select("node", F.col("node").alias("label"), F.col("least").alias("component_id"))
    if links is None or links.isEmpty():
        return single
    labels = connected(space, links, "final")
    members = space.keep(nodes.select("node", "least").join(labels, "node"), "linked")
    names = members.groupBy("label").agg(F.min("least").alias("name"))
    linked = members.join(names, "label").select("node", F.col("label").alias("joint"), "name")
    return space.keep(
        single.join(linked, "node", "left").select(
            "node", F.coalesce("joint", "label").alias("label"),
            F.when(F.col("joint").isNull(), F.col("component_id")).otherwise(F.col("name")).alias("component_id")), "named")


def per_row(profiles: DataFrame, named: DataFrame, kind: str, id_col: str) -> DataFrame:
    """Id, set size and component of every row of ``profiles`` (``_id``, ``n``, ``node``)."""
    own = F.when(F.col("_id") != NO_ID, F.col("_id"))
    return (
        profiles.withColumn("node", F.when(F.col("n") > 0, F.col("node"))).join(named.drop("label"), "node", "left")
        .select("_id", "_h", own.cast(kind).alias(id_col), F.col("n").alias("n_shingles"),
                F.when(F.col("n") > 0, F.col("component_id")).otherwise(own).cast("long").alias("component_id"))
    )
