"""Keyword rules: the first rule in priority order whose keyword is part of the text wins.

Three physical ways, all with the same result (see README for the measurements):

* ``case``: few rules are compiled into one CASE over native ``contains``; no shuffle.
* ``automaton``: up to ``MAX_INLINE_RULES`` rules are shipped with the task and all keywords are
  found in one pass over the text (Aho-Corasick, Arrow batches); no shuffle.
* ``anchored``: any number of rules. Distinct texts are cut into short grams, equi-joined with one
  rare gram per keyword, verified, reduced to the best rule and joined back.

The two inline ways read at most ``MAX_INLINE_RULES`` + 1 rules to the driver; that check decides
whether they may be used at all.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fold, trim_ws
from ..session import local_table
from .skew import hot_keys, salted

MAX_CASE_RULES = 40
MAX_INLINE_RULES = 20_000
GRAM = 4

# Group that only takes positive amounts, and the two fallback classifications.
INCOME_GROUP = "Ingresos"
FALLBACK_POSITIVE = ("Ingresos", "Otros Ingresos", "Sin Clasificar", "Desconocido")
FALLBACK_OTHER = ("Gastos Variables", "Otros Gastos", "Sin Clasificar", "Desconocido")
UNKNOWN_ENTITY = "Desconocido"

CLASS_FIELDS = ("grupo", "categoria", "subcategoria", "entity_name")


def _with_rule_id(rules: DataFrame) -> DataFrame:
    return rules if "rule_id" in rules.columns else rules.withColumn("rule_id", F.monotonically_increasing_id())


def prepare_rules(
    rules: DataFrame, value: Column, accents: bool = True, income_gate: bool = True,
) -> DataFrame:
    """Rule table in matching form: rule_id, priority, needle, gate, value.

    The needle is the keyword, upper-cased and (``accents``) without accents. The gate is 1 for
    rules that take positive amounts, -1 for the others, 0 when amounts play no part. Rules with a
    blank keyword are dropped, since they would match every text. ``rule_id`` breaks priority ties
    in favour of the earlier row; a table without one is numbered in file order.
    """
    needle = fold(F.col("keyword"), hangul=True) if accents else F.upper("keyword")
    gate = F.when(F.col("grupo_categoria") == INCOME_GROUP, 1).otherwise(-1) if income_gate else F.lit(0)
    return (
        _with_rule_id(rules)
        .where(trim_ws(F.col("keyword")) != "")
        .select(
            F.col("rule_id").cast("long").alias("rule_id"),
            F.col("priority").cast("int").alias("priority"),
            needle.alias("needle"),
            gate.cast("int").alias("gate"),
            value.alias("value"),
        )
    )


def winners_only(rules: DataFrame) -> DataFrame:
    """Of the rules with equal needle and gate only the first can ever win; keep that one."""
    return (
        rules.groupBy("needle", "gate")
        .agg(F.min(F.struct("priority", "rule_id", "value")).alias("r"))
        .select("r.rule_id", "r.priority", "needle", "gate", "r.value")
    )


@dataclass
class InlineRules:
    """Rules small enough to travel with a task, in winning order."""

    order: list[tuple[str, int]]  # (needle, gate)
    table: DataFrame  # _rule (position in the order), value


def inline_rules(rules: DataFrame, limit: int = MAX_INLINE_RULES) -> InlineRules | None:
    """The rules in winning order, or None when there are more than ``limit``."""
    rows = rules.select("rule_id", "priority", "needle", "gate", "value").limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    # NULL priorities come first, as in an ascending sort.
    rows.sort(key=lambda r: (r.priority is not None, r.priority or 0, r.rule_id))
    # Of equal needle and gate only the first can win.
    first = {}
    for r in rows:
        first.setdefault((r.needle, r.gate), r.value)
    schema = rules.select(F.lit(0).alias("_rule"), "value").schema
    table = local_table(rules.sparkSession, list(enumerate(first.values())), schema)
    return InlineRules(list(first), table)


def _case_position(order: list[tuple[str, int]], text: Column, sign: Column) -> Column:
    position = None
    for i, (needle, gate) in enumerate(order):
        hit = text.contains(F.lit(needle))
        if gate:
            hit = hit & sign.isin(0, gate)
        position = F.when(hit, F.lit(i)) if position is None else position.when(hit, F.lit(i))
    return position if position is not None else F.lit(None).cast("int")


def _automaton_position(order: list[tuple[str, int]]):
    # Self-contained, so that it travels to executors by value.
    @F.pandas_udf("int")
    def position(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        import ahocorasick

        rules_of: dict[str, list[tuple[int, int]]] = {}
        for i, (needle, gate) in enumerate(order):
            rules_of.setdefault(needle, []).append((i, gate))
        machine = ahocorasick.Automaton()
        for needle, entries in rules_of.items():
            machine.add_word(needle, entries)
        machine.make_automaton()

        for texts, signs in batches:
            found, known = [], {}
            for key in zip(texts, signs):
                if key not in known:
                    text, sign = key
                    best = None
                    if text is not None:
                        for _, entries in machine.iter(text):
                            for i, gate in entries:
                                if (best is None or i < best) and (not gate or sign in (0, gate)):
                                    best = i
                    known[key] = best
                found.append(known[key])
            yield pd.Series(found, dtype="Int32")

    return position


def _has_automaton() -> bool:
    return importlib.util.find_spec("ahocorasick") is not None


def classified_in_place(master: DataFrame) -> bool:
    """Whether ``classify`` with these rules leaves every row in its task."""
    n = master.limit(MAX_INLINE_RULES + 1).count()
    return n <= MAX_CASE_RULES or n <= MAX_INLINE_RULES and _has_automaton()


def _grams(text: Column, size: int) -> Column:
    return F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - (size - 1)),
        lambda i: F.substring(text, i, F.lit(size)),
    ))


def _all_grams(text: Column, sizes: list[int]) -> Column:
    """Grams of the given sizes; a size beyond the text's length gives none."""
    empty = F.array().cast("array<string>")
    return F.flatten(F.array(*[
        F.when(F.length(text) >= n, _grams(text, n)).otherwise(empty) for n in sizes
    ]))


def anchor_rules(rules: DataFrame) -> DataFrame:
    """Each rule with one gram of its needle as ``anchor``: the one fewest needles share."""
    size = F.least(F.length("needle"), F.lit(GRAM))
    grams = rules.select(
        "needle", "gate", "rule_id",
        F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.length("needle") - size + 1),
            lambda i: F.substring(F.col("needle"), i, size),
        ))).alias("gram"),
    )
    use = grams.groupBy("gram").agg(F.count("*").alias("uses"))
    rarest = grams.join(use, "gram").groupBy("rule_id").agg(F.min(F.struct("uses", "gram")).alias("g"))
    return rules.join(rarest.select("rule_id", F.col("g.gram").alias("anchor")), "rule_id")


def anchored_matches(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """Best rule of every (_text, _sign) key that has one: _text, _sign, value and the rule's id.

    Only texts sharing a keyword's anchor gram meet that keyword, so work follows the true
    candidates and not texts times rules.
    """
    # At most GRAM distinct values, so this read is bounded.
    size = F.least(F.length("needle"), F.lit(GRAM))
    sizes = [r[0] for r in rules.select(size).distinct().limit(GRAM).collect()]
    anchored = anchor_rules(winners_only(rules))
    # Texts travel once; grams carry two hashes of theirs instead, and only grams that are anchors go on.
    texts = keys.where(F.col("_text").isNotNull()).withColumns({
        "_k1": F.xxhash64("_text", "_sign"), "_k2": F.xxhash64(F.lit(1), "_text", "_sign")})
    pieces = texts.select("_k1", "_k2", F.explode(_all_grams(F.col("_text"), sorted(sizes))).alias("anchor"))
    pieces = pieces.join(anchored.select("anchor").distinct(), "anchor", "left_semi")
    needles = anchored.select("anchor", "needle", "gate", "priority", "rule_id", "value")
    return (
        pieces.join(needles, "anchor").join(texts, ["_k1", "_k2"])
        .where(F.col("_text").contains(F.col("needle")))
        .where((F.col("gate") == 0) | (F.col("_sign") == 0) | (F.col("_sign") == F.col("gate")))
        .groupBy("_text", "_sign")
        .agg(F.min(F.struct("priority", "rule_id", "value")).alias("m"))
        .select("_text", "_sign", F.col("m.value").alias("value"), F.col("m.rule_id").alias("rule_id"))
    )


def first_match(
    df: DataFrame, rules: DataFrame, text: Callable[[bool], Column], sign: Column | None = None,
    out: str = "match", strategy: str = "auto",
) -> DataFrame:
    """``df`` with the winning rule's value in ``out``, NULL where no rule matches.

    ``text`` gives the text normalised the way the needles were; its argument tells whether Korean
    syllables must be decomposed, which only needles with Korean letters ask for. ``sign`` is -1,
    0 or 1; zero passes every gate. Every input row comes out once.
    """
    sign = (sign if sign is not None else F.lit(0)).cast("int")
    inline = inline_rules(rules) if strategy != "anchored" else None
    text = text(inline is None or any("\u1100" <= ch <= "\u11ff" for n, _ in inline.order for ch in n))
    many = inline is not None and len(inline.order) > MAX_CASE_RULES
    if inline is None or (strategy == "auto" and many and not _has_automaton()):
        keyed = df.withColumn("_text", text).withColumn("_sign", sign)
        best = anchored_matches(keyed.select("_text", "_sign").distinct(), rules)
        best = best.select("_text", "_sign", F.col("value").alias(out))
        # Rows of a very common text, and those without text, are spread over many tasks.
        keyed, best = salted(keyed, best, "_text", hot_keys(keyed, "_text"))
        return keyed.join(best, ["_text", "_sign", "_salt"], "left").select(*df.columns, out)
    if strategy == "auto":
        strategy = "automaton" if many else "case"
    if strategy == "case":
        position = _case_position(inline.order, F.col("_text"), F.col("_sign"))
    else:
        position = _automaton_position(inline.order)(F.col("_text"), F.col("_sign"))
    table = inline.table.withColumnRenamed("value", out)
    return (
        df.withColumn("_text", text).withColumn("_sign", sign).withColumn("_rule", position)
        .join(F.broadcast(table), "_rule", "left")  # at most MAX_INLINE_RULES rows
        .select(*df.columns, out)
    )


def classification(null_text: str | None = None) -> Column:
    """A rule's result as a struct; blank levels are NULL, or the given text."""
    def level(name: str) -> Column:
        c = F.col(name)
        return F.coalesce(c, F.lit(null_text)) if null_text is not None else c

    return F.struct(
        level("grupo_categoria").alias("grupo"),
        level("categoria").alias("categoria"),
        level("subcategoria").alias("subcategoria"),
        level("entity_name").alias("entity_name"),
    )


def fallback_class(amount: Column) -> Column:
    """Classification of an unmatched row: other income above zero, other expense otherwise."""
    def constant(values: tuple[str, ...]) -> Column:
        return F.struct(*[F.lit(v).alias(n) for n, v in zip(CLASS_FIELDS, values)])

    return F.when(amount > 0, constant(FALLBACK_POSITIVE)).otherwise(constant(FALLBACK_OTHER))


def classify(
    df: DataFrame, master: DataFrame, text: str = "concepto", amount: str = "importe",
    out: str = "clase", null_text: str | None = None, strategy: str = "auto",
) -> DataFrame:
    """Classify transactions with the master rules; a NULL amount counts as zero.

    ``null_text='None'`` writes blank rule levels as that text, as a template that renders NULL
    would; by default they stay NULL.
    """
    rules = prepare_rules(master, classification(null_text))
    amount_or_zero = F.coalesce(F.col(amount), F.lit(0.0))
    sign = F.when(amount_or_zero > 0, 1).when(amount_or_zero < 0, -1).otherwise(0)
    matched = first_match(df, rules, lambda hangul: fold(F.col(text), hangul), sign, "_match", strategy)
    return matched.withColumn(out, F.coalesce("_match", fallback_class(amount_or_zero))).drop("_match")


def lookup_keyword(
    df: DataFrame, rules: DataFrame, value: str, fallback: Column, text: str = "concepto",
    out: str = "valor", strategy: str = "auto",
) -> DataFrame:
    """Value of the first rule whose upper-cased keyword is in the upper-cased text, or a fallback.

    Accents count here and amounts play no part: entity names and flat categories.
    """
    prepared = prepare_rules(rules, F.col(value), accents=False, income_gate=False)
    matched = first_match(df, prepared, lambda _: F.upper(text), None, "_match", strategy)
    return matched.withColumn(out, F.coalesce("_match", fallback)).drop("_match")


def standardize_entity(
    df: DataFrame, entities: DataFrame, fallback: Column, text: str = "concepto", out: str = "entity",
    strategy: str = "auto",
) -> DataFrame:
    return lookup_keyword(df, entities, "entity_name", fallback, text, out, strategy)


def map_category(
    df: DataFrame, categories: DataFrame, fallback: Column, text: str = "concepto", out: str = "category",
    strategy: str = "auto",
) -> DataFrame:
    return lookup_keyword(df, categories, "category", fallback, text, out, strategy)


def rule_conflicts(master: DataFrame, strategy: str = "auto") -> DataFrame:
    """Rules that can never fire on their own keyword: an earlier rule of the same gate takes it.

    One row per shadowed rule, with the rule that wins instead and whether only the row order
    decided between them.
    """
    rules = prepare_rules(master, F.struct(F.col("rule_id").alias("winner"), F.col("priority").alias("winner_priority")))
    probes = rules.select("rule_id", "priority", "needle", "gate")
    won = first_match(probes, rules, lambda _: F.col("needle"), F.col("gate"), "w", strategy)
    return won.where(F.col("w.winner") != F.col("rule_id")).select(
        "rule_id", "needle", "priority",
        F.col("w.winner").cast("long").alias("shadowed_by"),
        F.coalesce(F.col("w.winner_priority") == F.col("priority"), F.lit(True)).alias("tied"),
    )


def category_taxonomy(master: DataFrame) -> DataFrame:
    """Distinct classification triples in use."""
    return master.select("grupo_categoria", "categoria", "subcategoria").dropDuplicates()
