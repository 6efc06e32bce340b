"""CSV records of text files, whatever their size and however they are split.

A quoted field may hold line breaks, so whether a line begins a record depends on all lines before it. Each
line is a step between two states, outside and inside a quoted field, known for either state it may begin
in. Steps compose, so a split of a file is one such step as well, with the number of records it begins in
either case. Only these few numbers per split meet in order; no file is sorted or held by one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import ensure_checkpoint_dir, settled

# A CSV field; quotes count only where a field starts. Possessive, hence linear.
FIELD = r'(?:"(?:[^"]++|"")*+"[^,\n]*+|[^,\n]*+)'
_CLOSED_FIELD = r'(?:"(?:[^"]++|"")*+"[^,\n]*+|(?!")[^,\n]*+)'
OPEN_QUOTE = rf'^(?:{_CLOSED_FIELD},)*+"(?:[^"]++|"")*+$'


def leaves_open(text: Column) -> Column:
    """Whether a text that begins outside of quotes ends inside of them."""
    return text.contains('"') & text.rlike(OPEN_QUOTE)


def with_steps(lines: DataFrame) -> DataFrame:
    """``opens`` and ``stays``: whether a line ends inside quotes if it begins outside, or inside, of them."""
    return lines.withColumns({
        "opens": leaves_open(F.col("value")),
        "stays": ~F.col("value").contains('"') | leaves_open(F.concat(F.lit('"'), "value")),
    })


def kept(df: DataFrame, label: str) -> DataFrame:
    """Rows written once to the shared checkpoint folder, and read from there however often they are needed.

    Unlike a checkpoint of the rows as such, a later reader takes only the columns it needs.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_lines(spark: SparkSession, root: str | list[str], wanted: Column) -> DataFrame:
    """Lines of the files that ``wanted`` selects: ``file`` (encoded address), ``block``, ``seq``, ``value``.

    ``block`` is where the split begins; ``seq`` grows within it. Where files are split depends on the
    session at the time of reading, so whoever reads the lines more than once keeps them first.
    """
    lines = spark.read.text(root, recursiveFileLookup=True).where(wanted).select("value", "_metadata")
    block = F.col("_metadata.file_block_start")
    # A mark of the byte order, if any; other bytes stay as they are, also ones that are not valid text.
    marked = (block == 0) & F.col("value").startswith("﻿")
    value = F.when(marked, F.col("value").substr(F.lit(2), F.length("value"))).otherwise(F.col("value"))
    return lines.select(
        F.col("_metadata.file_path").alias("file"), block.alias("block"),
        F.monotonically_increasing_id().alias("seq"), value.alias("value"))


def _number_lines(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Where no line ends inside quotes, every line is a record."""
    joined = lines.join(splits, ["path", "block"])
    return joined.withColumn("line_no", F.col("before") + F.col("seq") - F.col("first_seq"))


def _odd(c: Column) -> Column:
    return F.pmod(c, F.lit(2))


def _states(rows: DataFrame, part: list[str], order: str, exit0: Column, exit1: Column, start: Column) -> DataFrame:
    """The state before every row (``state``: 1 inside quotes) when the first begins in ``start``.

    A step forgets the state (both exits alike), keeps it or turns it round. So the state follows from the
    last step that forgot, or else from the start, and the number of turns since.
    """
    ahead = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_turns", F.coalesce(F.sum((exit0 & ~exit1).cast("int")).over(ahead), F.lit(0)))
    forgot = F.when(exit0 == exit1, F.struct(F.col(order), _odd(exit0.cast("int") + F.col("_turns")).alias("s")))
    rows = rows.withColumn("_last", F.max(forgot).over(ahead))
    return rows.withColumn("state", _odd(F.coalesce(F.col("_last.s"), start) + F.col("_turns")))


def _assembled(lines: DataFrame) -> DataFrame:
    """Records of files in which some line ends inside quotes."""
    within = Window.partitionBy("path", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    opens, stays = F.col("opens"), F.col("stays")
    rows = _states(lines, ["path", "block"], "seq", opens, stays, F.lit(0)).withColumns({
        "inside0": F.col("state"), "inside1": _odd(F.coalesce(F.col("_last.s"), F.lit(1)) + F.col("_turns")),
    }).drop("_turns", "_last", "state")
    rows = kept(rows.withColumns({f"begun{e}": F.count_if(F.col(f"inside{e}") == 0).over(within) for e in (0, 1)}), "line-states")
    after = [F.when(F.col(f"inside{e}") == 0, opens).otherwise(stays) for e in (0, 1)]

    splits = rows.groupBy("path", "block").agg(
        *[F.max(f"begun{e}").alias(f"starts{e}") for e in (0, 1)], *[F.max_by(after[e], "seq").alias(f"exit{e}") for e in (0, 1)])
    splits = _states(splits, ["path"], "block", F.col("exit0"), F.col("exit1"), F.lit(0))
    starts = F.when(F.col("state") == 0, F.col("starts0")).otherwise(F.col("starts1"))
    ordered = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "path", "block", F.col("state").alias("entry"), F.coalesce(F.sum(starts).over(ordered), F.lit(0)).alias("before"),
        F.sum(starts).over(Window.partitionBy("path")).alias("total"))

    rows = rows.join(settled(splits), ["path", "block"])
    outside = F.col("entry") == 0
    rows = rows.withColumns({
        "line_no": F.col("before") - 1 + F.when(outside, F.col("begun0")).otherwise(F.col("begun1")),
        "inside": F.when(outside, F.col("inside0")).otherwise(F.col("inside1")) == 1,
    })
    longer = F.col("inside") | F.when(F.col("inside"), stays).otherwise(opens)
    columns = ["path", "bank", "account", "value", "line_no", "total"]
    several = rows.where(longer).groupBy("path", "bank", "account", "line_no", "total").agg(
        F.sort_array(F.collect_list(F.struct("block", "seq", "value"))).alias("lines"))
    several = several.withColumn("value", F.array_join(F.transform("lines", lambda x: x["value"]), "\n"))
    return rows.where(~longer).select(*columns).unionByName(several.select(*columns))


def number_records(lines: DataFrame) -> DataFrame:
    """Records (``path``, ``bank``, ``account``, ``value``) with their number in the file and the file's count.

    ``lines`` has path, bank, account, block, seq, value and can be read several times with the same outcome.
    """
    lines = lines if "opens" in lines.columns else with_steps(lines)
    ordered = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per_file = Window.partitionBy("path")
    splits = settled(
        lines.groupBy("path", "block").agg(
            F.count("*").alias("n"), F.min("seq").alias("first_seq"), F.max("opens").alias("opened"))
        .select("path", "block", "first_seq", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("before"),
                F.sum("n").over(per_file).alias("total"), F.max("opened").over(per_file).alias("opened")))
    columns = ["path", "bank", "account", "value", "line_no", "total"]
    plain = _number_lines(lines, splits.where("not opened")).select(*columns)
    if splits.where("opened").isEmpty():
        return plain
    opened = lines.join(splits.where("opened").select("path", "block"), ["path", "block"], "left_semi")
    return plain.unionByName(_assembled(opened).select(*columns))
