"""N-gram Jaccard join as a blocked sparse product of documents by n-grams.

Rows of the incidence matrix are distinct n-gram sets (documents with equal sets are one row), columns
are n-grams ordered by how rare they are. Two rows of sizes a and b reach the threshold t only if their
product, the overlap, is at least t (a + b) / (1 + t). So it is enough to multiply the first
``n - ceil(t n) + 1`` columns of each row, and of the shorter row only those behind which
``2 t n / (1 + t)`` n-grams are left; a pair that first meets in a column is discarded if what is left of
either row behind it is below the bound, or if the rows' bitmaps differ too much. Rows leave a column only
within these bounds, and columns without a row that may be the shorter one are not multiplied. The overlap
of the others is then taken from the whole rows.

Components need no product of every two rows of a group: columns are met through pivots (see ``linking``).
No link between components is lost.

Null texts and texts without words have no n-grams: size 0, linked with nothing. A text of fewer words
than ``words`` is one n-gram. Repeated rows and ties are equal rows of the matrix. A component is named
by its smallest id; rows with a null id count as members but name it only if there is no other. Other columns
may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import NO_ID, Workspace, doc_keys
from ledgerlake.llm.linking import MAP, Confirm, bitmap, links_of, may_reach, named_components, per_row, set_tokens, signature
from ledgerlake.llm.shingles import rarity_classes, shingle_hashes


def _profiles(texts: DataFrame, words: int, rarity, percent: int) -> DataFrame:
    """Per row: size, name (``node``) and bitmap of its set, and the columns that have to be multiplied."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longs = np.zeros((batch.num_rows, 2 + len(MAP)), np.int64)
            prefix: list = [None] * batch.num_rows
            for row, found in shingle_hashes(batch["text"], words):
                tokens = set_tokens(found, rarity.value)
                size = len(tokens)
                longs[row] = [size, signature(tokens), *bitmap(tokens)]
                prefix[row] = tokens[:size - -(-percent * size // 100) + 1].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["_h"], *[pa.array(longs[:, i]) for i in range(longs.shape[1])],
                 pa.array(prefix, pa.list_(pa.int64()))], ["_id", "_h", "n", "node", *MAP, "prefix"])

    return texts.mapInArrow(
        run, "_id long, _h long, n long, node long, " + ", ".join(f"{c} long" for c in MAP) + ", prefix array<long>")


def _meets(percent: int):
    """Whether a pair that first meets in this column can reach the threshold."""
    return (100 + percent) * F.least("x.rest", "y.rest") >= percent * (F.col("x.n") + F.col("y.n"))


def _matched(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows' profiles, and the component of each distinct set."""
    spark = docs.sparkSession
    space = Workspace(spark, "jaccard-join")
    texts = docs.select(*doc_keys(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    rarity = spark.sparkContext.broadcast(
        rarity_classes(texts.select("text"), lambda batch: (grams for _, grams in shingle_hashes(batch["text"], words))))
    profiles = space.keep(_profiles(texts, words, rarity, percent), "profiles")
    nodes = space.keep(
        profiles.where("n > 0").groupBy("node").agg(
            *[F.first(c).alias(c) for c in ("n", "_id", "_h", *MAP, "prefix")],
            F.min(F.when(F.col("_id") != NO_ID, F.col("_id"))).alias("least")), "nodes")
    entries = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "column")).select(
        "column", "node", (F.col("n") - F.col("pos")).alias("rest"),
        ((100 + percent) * (F.col("n") - F.col("pos")) >= 2 * percent * F.col("n")).alias("first"))
    confirm = Confirm(space, texts, nodes, words, percent, rarity)
    links = links_of(space, entries, nodes.select("node", "n", *MAP), _meets(percent) & may_reach(percent), confirm.links)
    return profiles.select("_id", "_h", "n", "node"), named_components(space, nodes, links)


def components(docs: DataFrame, *, words: int = 4, percent: int = 85, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The id column, ``n_shingles``, ``component_id`` of every row of ``docs``."""
    profiles, named = _matched(docs, words, percent, id_col, text_col)
    return per_row(profiles, named, dict(docs.dtypes)[id_col], id_col).select(id_col, "n_shingles", "component_id")


def keep_one(docs: DataFrame, *, words: int = 4, percent: int = 85, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, the one of smallest id (null ids last; then by the text's hash).

    Rows alike in id and text count as one, and one of them stays. Unlike texts of one id both stay. Texts
    without words stay.
    """
    profiles, named = _matched(docs, words, percent, id_col, text_col)
    rows = profiles.groupBy("_id", "_h").agg(F.first("n").alias("n"), F.first("node").alias("node"), F.count("*").alias("copies"))
    order = F.struct(F.col("_id") == NO_ID, "_id", "_h")
    best = rows.where("n > 0").join(named, "node").groupBy("label").agg(
        F.min_by(F.struct("_id", "_h", "copies"), order).alias("best")).select("best.*")
    chosen = best.unionByName(rows.where("n = 0").select("_id", "_h", "copies"))
    own_id, own_h = doc_keys(id_col, text_col)
    names = [c for c in ("_keep_id", "_keep_h", "_keep_copies")]
    while set(names) & {c.lower() for c in docs.columns}:
        names = [f"{c}_" for c in names]
    marked = docs.withColumns({names[0]: own_id, names[1]: own_h}).join(
        chosen.toDF(*names), names[:2])
    once = marked.where(F.col(names[2]) == 1)
    again = marked.where(F.col(names[2]) > 1).dropDuplicates(names[:2])
    return once.unionByName(again).select(docs.columns)
