"""The layers put together: seeds, bronze, silver, gold, tests."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.flags import Household
from ..operators.quality import BRONZE_TABLES, DECLARED_TESTS, run_tests
from ..operators.rules import classified_in_place
from ..operators.skew import hot_keys, marked
from ..schemas import ADJUSTMENTS, CATEGORY_RULES, ENTITY_RULES, GOLD, MASTER_RULES, SILVER, TABLE_COMMENTS, TXN
from ..session import local_table, settled
from ..sources import tables
from ..sources.raw import bronze_rows, normalize_cash, read_seed
from .gold import gold_parts, monthly_spend
from .silver import enrich, union_sources

MONTH = "anio_mes"
# Beside the bronze tables: months that got rows since the last silver build, gold build and pass of the tests.
PENDING, PENDING_GOLD, PENDING_TESTS = "pending_months", "pending_gold", "pending_tests"
EVERY = "*"  # noted in place of a month: all of them

SEED_SCHEMAS = {
    "master_mapping": MASTER_RULES,
    "map_entities": ENTITY_RULES,
    "map_categories": CATEGORY_RULES,
    "manual_adjustments": ADJUSTMENTS,
}


@dataclass
class Lakehouse:
    """``null_policy`` says what a stored NULL identity does to a load: ``raise`` an error, block
    it like SQL's NOT IN (``compat``), or ``ignore`` it. ``prefix`` keeps several lakehouses apart.
    """

    spark: SparkSession
    house: Household
    prefix: str = ""
    null_policy: str = "raise"
    null_text: str | None = None
    namespaces: dict[str, str] = field(default_factory=lambda: {
        "bronze": "bronze_standard", "silver": "silver", "gold": "gold", "seeds": "mappings",
    })

    def name(self, layer: str, table: str) -> str:
        return tables.table_name(table, self.prefix + self.namespaces[layer])

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def load_seed(self, table: str, path: str) -> None:
        tables.rebuild(read_seed(self.spark, path, SEED_SCHEMAS[table]), self.name("seeds", table))

    def save_seed(self, table: str, rows: DataFrame) -> None:
        tables.rebuild(rows, self.name("seeds", table))

    def load_bronze(self, table: str, raw: DataFrame, full_refresh: bool = False) -> None:
        """Landed rows (for ``cash`` the sheet's text rows) into a bronze table, which is kept by month.

        An identity holds the date, so stored ones are searched only in the months that the batch has.
        The months are noted for the next silver build before the rows are there, so that a run that dies
        in between leaves a month too many and never one too few.
        """
        if table not in BRONZE_TABLES:
            raise ValueError(f"unknown bronze table {table!r}")
        rows = normalize_cash(raw) if table == "cash" else bronze_rows(raw)
        rows = rows.withColumn(MONTH, F.date_format("fecha", "yyyy-MM"))
        held = [(r[0],) for r in rows.select(MONTH).distinct().collect()]  # as few as there are months
        months = local_table(self.spark, held, f"{MONTH} string")
        self._note_months(months, PENDING)
        self._note_months(self._every() if full_refresh else months, PENDING_TESTS)
        tables.append_new(
            rows, self.name("bronze", table), full_refresh=full_refresh, null_policy=self.null_policy,
            schema=TXN, comment=TABLE_COMMENTS[table], hot=lambda met: hot_keys(met, "hash_id"), partition_by=(MONTH,), prune_by=MONTH,
        )
        # A streaming batch writes through a session of its own; this one may hold an old file list.
        self.spark.catalog.refreshTable(self.name("bronze", table))

    def _every(self) -> DataFrame:
        return self.spark.range(1).select(F.lit(EVERY).alias(MONTH))

    def _note_months(self, months: DataFrame, log: str) -> None:
        pending = self.name("bronze", log)
        noted = months.select(MONTH).withColumn("load_id", F.lit(uuid.uuid4().hex))
        if tables.exists(self.spark, pending):
            tables.append(noted, pending)
        else:
            tables.rebuild(noted, pending)
        self.spark.catalog.refreshTable(pending)

    def _noted(self, log: str) -> list:
        """At most one row per month and load since the log was last cleared."""
        pending = self.name("bronze", log)
        if not tables.exists(self.spark, pending):
            return []
        self.spark.catalog.refreshTable(pending)
        return self.spark.table(pending).collect()

    def _clear(self, log: str, noted: list) -> None:
        """Take out what was read before; what came since stays."""
        if noted:
            pending = self.name("bronze", log)
            done = sorted({r["load_id"] for r in noted})
            tables.rebuild(self.spark.table(pending).where(~F.col("load_id").isin(done)), pending)

    def bronze_union(self, months: Sequence[str] | None = None) -> DataFrame:
        """All bronze rows, or those of some months (None among them: rows without a date)."""
        present = [t for t in BRONZE_TABLES if tables.exists(self.spark, self.name("bronze", t))]
        sources = [self.table("bronze", t) for t in present]
        if months is not None:
            held = F.coalesce(F.col(MONTH).isin([m for m in months if m is not None]), F.lit(False))
            if None in months:
                held = held | F.col(MONTH).isNull()
            sources = [s.where(held) for s in sources]
        return union_sources(sources)

    def build_silver(self, full_refresh: bool = False, months: Sequence[str] | None = None) -> None:
        """Classify and store the bronze rows that are not stored yet.

        The key filter comes first, so only new rows are classified. Rows stored earlier keep
        their classification until a full refresh. An identity contains the date, so only ``months``
        (yyyy-MM) are read and searched; by default those that bronze loads have noted since the last build.
        """
        target = self.name("silver", "fct_transactions")
        tables.recover(self.spark, target)
        first = full_refresh or not tables.exists(self.spark, target)
        noted = self._noted(PENDING)
        given = months is not None
        if not given and noted:
            months = sorted({r[MONTH] for r in noted}, key=str)
        rows = self.bronze_union(None if first else months)
        master = self.table("seeds", "master_mapping")
        in_place = classified_in_place(master)  # bronze rows lie by month, as silver's will
        if not first and months is None:
            rows, in_place = tables.new_rows(
                rows, self.spark.table(target), null_policy=self.null_policy, hot=hot_keys(rows, "hash_id")), False
        elif not first:
            met, others = tables.fresh_parts(
                rows.withColumn(MONTH, F.date_format("fecha", "yyyy-MM")), target, (MONTH, [m for m in months if m is not None]),
                null_policy=self.null_policy, hot=lambda met: hot_keys(met, "hash_id"))
            if in_place:
                met = tables.rebalanced(met, MONTH)
            rows = met.unionByName(others).drop(MONTH)
        if first or months is None:
            changed = self._every()
        else:
            changed = local_table(self.spark, [(m,) for m in months], f"{MONTH} string")
        for log in (PENDING_GOLD, PENDING_TESTS):
            self._note_months(changed, log)
        fresh = enrich(rows, master, self.house, self.null_text)
        if first:
            tables.rebuild(fresh, target, ("anio_mes",), SILVER, TABLE_COMMENTS["fct_transactions"], in_place)
        else:
            tables.sync_schema(self.spark, target, fresh.schema, ("anio_mes",))
            tables.append(fresh, target, ("anio_mes",), in_place)
        if first or not given:
            self._clear(PENDING, noted)

    def build_gold(self, full_refresh: bool = False) -> None:
        """The mart and its monthly totals, for the months that got rows or whose adjustments came, changed or went.

        Rows are compared with the adjustments applied last time, which are kept beside the mart, so adjustments
        and their removal reach old rows too. Stored movements never leave silver but by a full refresh, so a month
        that had rows has rows again. A build that dies is done again by the next one.
        """
        silver, adjustments = self.table("silver", "fct_transactions"), self.table("seeds", "manual_adjustments")
        target, totals, applied = (self.name("gold", t) for t in ("transactions", "monthly_spend", "applied_adjustments"))
        for table in (target, totals, applied):
            tables.recover(self.spark, table)
        noted = self._noted(PENDING_GOLD)
        months = {r[MONTH] for r in noted}
        given = adjustments.select("hash_id", "adjustment_amount")

        def mart(rows: DataFrame) -> DataFrame:
            adjusted, others = gold_parts(rows, adjustments)
            return tables.rebalanced(adjusted, MONTH).unionByName(others)

        if full_refresh or EVERY in months or not all(tables.exists(self.spark, t) for t in (target, totals, applied)):
            tables.rebuild(
                mart(silver), target, (MONTH,), GOLD, TABLE_COMMENTS["transactions"], dealt=True)
            tables.rebuild(monthly_spend(self.spark.table(target)), totals, (MONTH,))
        else:
            before = self.spark.table(applied)
            changed = settled(given.exceptAll(before).unionByName(before.exceptAll(given)).select("hash_id").distinct())
            if not changed.isEmpty():
                met = marked(silver.select("hash_id", MONTH), changed, "hash_id", "_changed").where("_changed")
                # As few as there are months.
                months |= {r[0] for r in met.join(changed, "hash_id", "left_semi").select(MONTH).distinct().collect()}
            if months:
                mine = tables.among(MONTH, sorted(months, key=str))
                there = months & {r[0] for r in self.spark.table(target).select(MONTH).distinct().collect()}
                if there:
                    old = silver.where(tables.among(MONTH, sorted(there, key=str)))
                    tables.replace_parts(mart(old), target, (MONTH,), dealt=True)
                if months - there:  # these replace nothing, so they need no stage
                    new = silver.where(tables.among(MONTH, sorted(months - there, key=str)))
                    tables.append(mart(new), target, (MONTH,), dealt=True)
                tables.replace_parts(monthly_spend(self.spark.table(target).where(mine)), totals, (MONTH,))
        tables.rebuild(given, applied)
        self._clear(PENDING_GOLD, noted)

    def refresh(self, sources: dict[str, DataFrame], full_refresh: bool = False) -> None:
        """All layers, from the landed rows of each bronze table."""
        for table, raw in sources.items():
            self.load_bronze(table, raw, full_refresh)
        self.build_silver(full_refresh)
        self.build_gold(full_refresh)

    def _present(self) -> dict[str, DataFrame]:
        present = {
            t: self.table("bronze", t) for t in BRONZE_TABLES
            if tables.exists(self.spark, self.name("bronze", t))
        }
        if tables.exists(self.spark, self.name("silver", "fct_transactions")):
            present["fct_transactions"] = self.table("silver", "fct_transactions")
        return present

    def test(self) -> DataFrame:
        """Results of the declared tests on the tables present."""
        return run_tests(self._present())

    def test_new(self) -> DataFrame:
        """The same, reading only the months that got rows since this was last called; other months' results are kept.

        Equal identities lie in the same month, so what fails in a table is the sum over its months.
        """
        kept = self.name("gold", "test_results")
        tables.recover(self.spark, kept)
        noted = self._noted(PENDING_TESTS)
        months = sorted({r[MONTH] for r in noted}, key=str)
        present = self._present()
        if EVERY in months or not tables.exists(self.spark, kept):
            tables.rebuild(run_tests(present, by=(MONTH,)), kept, (MONTH,))
        elif months:
            mine = tables.among(MONTH, months)
            tables.replace_parts(run_tests({t: df.where(mine) for t, df in present.items()}, by=(MONTH,)), kept, (MONTH,))
        self._clear(PENDING_TESTS, noted)
        declared = local_table(
            self.spark, [(t.table, t.column, t.kind) for t in DECLARED_TESTS if t.table in present], "table string, column string, kind string")
        results = self.spark.table(kept).groupBy("table", "column", "kind").agg(F.sum("failures").alias("failures"))
        return declared.join(results, ["table", "column", "kind"], "left").withColumn("failures", F.coalesce("failures", F.lit(0)))
