"""URL filters: path rules per host, and a link graph for hosts that no rule covers.

Rules name a host suffix and a path prefix (``example.com/de/``); the longest that fits decides. Other
pages get the verdict of their host. Trust is a personalised PageRank along the links between hosts,
starting from hosts of whose pages rules allow more than half; distrust runs against the links, from hosts
of whose pages rules block more than half, as linking to blocked hosts is what discredits. A rule for one
corner of a host so says nothing about the rest. A host is blocked if its distrust exceeds ``threshold``
and its trust. A seed's mass is its share of ruled pages, whatever the number of seeds, so a verdict does not
change with unrelated hosts. Ranks are iterated until all hosts together can gain no more than a hundredth of
``threshold``, or for ``rounds`` if given.

Only DataFrame functions are used. Edges are counted per pair of hosts before anything is shuffled by one
host. Null URLs and URLs without ``://`` have an empty host and path, fit no rule and are allowed. Equal
rows are judged alike. Pages without html have no links. Links without a host (within a site) are no edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import Workspace
from ledgerlake.session import local_table

DAMPING = 0.85
THRESHOLD = 1e-6
EXACT = 0.01
SEED_SHARE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column) -> Column:
    """The host and every domain above it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str]], space: Workspace, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``_verdict`` (of the rule).

    Rules meet the distinct hosts on their suffixes; a page then looks through its host's few rules.
    """
    spark = pages.sparkSession
    table = local_table(
        spark, [(rule.partition("/")[0], "/" + rule.partition("/")[2], rule, verdict) for verdict, rule in rules],
        "suffix string, prefix string, rule string, given string")
    pages = pages.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    hosts = pages.select("host").where("host <> ''").distinct()
    order = F.struct((-F.length("rule")).alias("least"), "rule", "prefix", "given")
    listed = space.keep(
        hosts.withColumn("suffix", F.explode(_suffixes(F.col("host")))).join(table, "suffix")
        .groupBy("host").agg(F.sort_array(F.collect_list(order)).alias("_rules")), "rules")
    fits = F.filter("_rules", lambda r: F.startswith(F.col("path"), r["prefix"]))
    return (
        pages.join(listed, "host", "left").withColumn("_first", F.get(fits, F.lit(0)))
        .withColumn("rule", F.col("_first.rule")).withColumn("_verdict", F.col("_first.given")).drop("_rules", "_first")
    )


def _spread(space: Workspace, edges: DataFrame, seeds: DataFrame, name: str, rounds: int | None, damping: float,
            tolerance: float) -> DataFrame:
    """Personalised PageRank (``host``, ``mass``) along ``edges`` (a, b, w) from ``seeds`` (host, seed).

    Mass that reaches a host without outgoing edges ends there. Masses only grow, and each round adds at most
    ``damping`` times what the last one added, which bounds what is still to come.
    """
    start = seeds.select("host", (F.lit(1 - damping) * F.col("seed")).alias("mass"))
    if edges.isEmpty():
        return start
    out = edges.groupBy("a").agg(F.sum("w").alias("out"))
    shares = space.keep(edges.join(out, "a").select("a", "b", (F.col("w") / F.col("out")).alias("share")), f"{name}-shares")
    mass, held = start, start.agg(F.sum("mass")).first()[0] or 0.0
    for turn in count() if rounds is None else range(rounds):
        sent = mass.join(shares, mass["host"] == shares["a"]).groupBy("b").agg(
            F.sum(F.col("mass") * F.col("share") * damping).alias("mass")).withColumnRenamed("b", "host")
        mass = space.keep(start.unionByName(sent).groupBy("host").agg(F.sum("mass").alias("mass")), f"{name}-{turn}")
        if turn:
            space.drop(f"{name}-{turn - 1}")
        if rounds is None:
            before, held = held, mass.agg(F.sum("mass")).first()[0] or 0.0
            # Below the rounding of the sum itself nothing more can be told.
            if (held - before) * damping / (1 - damping) <= max(tolerance, 1e-15 * held):
                break
    return mass


def host_scores(pages: DataFrame, space: Workspace, *, html_col: str = "html", rounds: int | None = None,
                damping: float = DAMPING, tolerance: float = EXACT * THRESHOLD) -> DataFrame:
    """``host``, ``trust``, ``distrust`` of hosts that either reaches. ``pages`` comes from ``ruled``."""
    counts = space.keep(
        pages.where("host <> ''").groupBy("host").agg(
            F.count("*").alias("n"), F.count_if(F.col("_verdict") == "allow").alias("allowed"),
            F.count_if(F.col("_verdict") == "block").alias("blocked")), "counts")
    trusted, blocked = F.col("allowed") / F.col("n"), F.col("blocked") / F.col("n")
    trusted, blocked = (F.when(share > SEED_SHARE, share).otherwise(0.0) for share in (trusted, blocked))
    links = pages.where("host <> ''").select(
        F.col("host").alias("a"), F.explode(F.regexp_extract_all(F.col(html_col), F.lit(_LINK), F.lit(1))).alias("b"))
    links = links.withColumn("b", F.translate("b", _UPPER, _LOWER)).where("a <> b")
    edges = space.keep(links.groupBy("a", "b").agg(F.count("*").cast("double").alias("w")), "edges")
    trust = _spread(
        space, edges, counts.select("host", trusted.alias("seed")).where("seed > 0"), "trust", rounds, damping, tolerance)
    distrust = _spread(
        space, edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"),
        counts.select("host", blocked.alias("seed")).where("seed > 0"), "distrust", rounds, damping, tolerance)
    return space.keep(
        trust.select("host", F.col("mass").alias("trust"), F.lit(0.0).alias("distrust"))
        .unionByName(distrust.select("host", F.lit(0.0).alias("trust"), F.col("mass").alias("distrust")))
        .groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "scores")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], *, threshold: float = THRESHOLD, url_col: str = "url",
          html_col: str = "html", rounds: int | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust``. Columns of these names are replaced.

    ``rules`` are pairs of ``allow`` or ``block`` and ``host/path``; of two equally long, the first in
    alphabetical order decides.
    """
    space = Workspace(pages.sparkSession, "url-graph")
    base = pages.drop("host", "path", "rule", "verdict", "trust", "distrust")
    found = ruled(base, rules, space, url_col)
    scores = host_scores(found, space, html_col=html_col, rounds=rounds, tolerance=EXACT * threshold)
    bad = (F.col("distrust") > threshold) & (F.col("distrust") > F.col("trust"))
    return (
        found.join(scores, "host", "left")
        .withColumn("verdict", F.coalesce("_verdict", F.when(bad, "block").otherwise("allow")))
        .select(*base.columns, "host", "path", "rule", "verdict", F.coalesce("trust", F.lit(0.0)).alias("trust"),
                F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    )
