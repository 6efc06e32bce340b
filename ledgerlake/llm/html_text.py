"""Main text of web pages: markup first, then a suffix array over the pages of a host.

A page's markup is cut into blocks. Blocks in menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments are known by their tags, roles and class names and never kept. If the
page marks its article (``article``, else ``main`` or what is named so), the text is what the host leaves of that.

The token streams of a host's marked articles are concatenated, shard by shard, with separators between
blocks, and a suffix array over each shard finds the runs of ``min_tokens`` tokens and the distinct articles
that hold them. A block is boilerplate (a licence, an author line or an appeal on every page) if at least
``min_pages`` and ``share`` of the host's distinct articles hold each of its runs. Whole blocks go or stay: a run
inside a sentence, or a block that fewer articles hold, is text that they share. Copies do not count: an article of
which runs that another one of its shard holds cover ``COPY_PERCENT`` or more, of all of it or of what is left without
boilerplate, is left out of both numbers. Blocks of fewer tokens than a run stay, and an article that would lose all
its blocks keeps them. Articles are dealt to shards by their content. Of a host with several shards, each first names
the runs that ``share`` of its own articles hold: a run that ``share`` of all hold is named by one shard at least. Then
every shard counts all the runs that any of the host's shards has named, and these numbers are added up.

On pages that mark no article, the host's other text decides. The token streams of a host's pages (all blocks
outside marked articles) are concatenated, shard by shard, and a suffix array over each shard finds the runs of
``min_tokens`` tokens and the distinct streams that hold them; the counts of the shards are added up per host.
Tokens covered by a run that at least two distinct streams hold are boilerplate, unique runs are kept. Equal pages
are one stream, so that a copied page does not erase its original; nor do near copies: a page of which runs on just
two pages cover ``COPY_PERCENT`` or more, after those on more pages are gone, keeps them. Hosts whose pages all
mark their article send no such stream.

Null and empty html give an empty text. Comments, declarations and what is in no body are dropped; unclosed
tags end with their parents; an article opened inside an unclosed side part ends that part. Character
references are decoded, white space (Unicode) in a block becomes one space, blocks are joined in page
order. Equal rows get equal texts. Null URLs form a host of their own.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import Workspace, mix, own_columns, own_schema, with_own
from ledgerlake.llm.rolling import Rolled
from ledgerlake.llm.url_graph import host_of

MIN_TOKENS = 6
MIN_PAGES = 3  # from here on a run is boilerplate whatever its share of a page
COPY_PERCENT = 80
SHARE = 0.5  # of a host's articles that hold a run, from which on it is boilerplate in them
SHARD_PAGES = 256
SHARD_BYTES = 32 << 20

# HTML's element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|noscript|template|iframe|xmp|svg|math"
SIDE = frozenset("nav header footer aside form dialog menu button select option fieldset head object audio video canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output progress q ruby rb "
    "rp rt s samp small span strike strong sub sup time tt u var wbr".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
SIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe signup login register sidebar sidenav aside menu menus "
    "nav navbar navigation topnav subnav breadcrumb breadcrumbs header masthead footer footnav colophon comment comments "
    "commentlist respond reply replies disqus share sharing social related recommended widget widgets toolbar pagination pager "
    "skip search searchbox form".split())
MAIN_NAMES = frozenset("article articlebody main maincontent entry post story".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[!?/][^>]*>?"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE)
_ATTR = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")

OUT, LOOSE, SIDE_PART, ARTICLE, MAIN = range(5)


def _kind(name: str, attrs: str) -> int:
    """What an element begins: a side part, an article, a main part, or nothing of its own (0)."""
    if name == "article":
        return ARTICLE
    side = name in SIDE
    main = name == "main"
    if attrs and not attrs.isspace():
        for key, value in _ATTR.findall(attrs):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "role":
                side |= value in SIDE_ROLES
                main |= value in ("main", "article")
            elif key == "itemprop":
                main |= value == "articlebody"
            elif key == "hidden" or key == "aria-hidden":
                side |= key == "hidden" or value == "true"
            elif name not in ("body", "html", "main"):
                words = _NAME.findall(value)
                side |= not SIDE_NAMES.isdisjoint(words)
                main |= any(part.replace("-", "").replace("_", "") in MAIN_NAMES for part in value.split())
    return SIDE_PART if side else MAIN if main else OUT


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(part, text) of every block of a page in order; the part is LOOSE, SIDE_PART, ARTICLE or MAIN."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []  # open elements and the part their content belongs to
    open_names: dict[str, int] = {}
    part, held = LOOSE, []

    def flush() -> None:
        if held:
            text = " ".join(_html.unescape("".join(held)).split())
            if text:
                out.append((part, text))
            held.clear()

    for m in _PIECE.finditer(page):
        text = m["text"]
        if text is not None:
            held.append(text)
            continue
        name = m["name"]
        if name is None:
            if m["raw"] and m["raw"].lower() not in ("svg", "math"):
                flush()
            continue
        name = name.lower()
        if name == "br" or name == "hr":
            held.append(" ") if name == "br" else flush()
            continue
        if name in VOID:
            continue
        inline = name in INLINE
        if m["end"]:
            if not inline:
                flush()
            if open_names.get(name):
                while True:
                    last, _ = stack.pop()
                    open_names[last] -= 1
                    if last == name:
                        break
                now = stack[-1][1] if stack else LOOSE
                if now != part:
                    flush()
                    part = now
            continue
        kind = _kind(name, m["attrs"])
        if not inline or kind:
            flush()
        if not inline and stack and stack[-1][0] == "p":  # a block ends an open paragraph
            open_names["p"] -= 1
            stack.pop()
            part = stack[-1][1] if stack else LOOSE
        if m["attrs"].endswith("/") and not inline and name not in ("div", "p", "article"):
            continue
        if kind == ARTICLE and (part == SIDE_PART or part == MAIN):
            now = ARTICLE
        elif part == SIDE_PART:
            now = SIDE_PART
        elif kind == SIDE_PART and name == "header" and part == ARTICLE:
            now = part  # an article's own header holds its heading
        elif kind == MAIN and part == ARTICLE:
            now = part
        else:
            now = kind or part
        stack.append((name, now))
        open_names[name] = open_names.get(name, 0) + 1
        if now != part:
            flush()
            part = now
    flush()
    return out


def marked_blocks(blocks: list[tuple[int, str]]) -> list[str] | None:
    """Blocks of the marked article, or None if the page marks none."""
    for wanted in (ARTICLE, MAIN):
        found = [text for part, text in blocks if part == wanted]
        if found:
            return found
    return None


def marked_text(blocks: list[tuple[int, str]]) -> str | None:
    """Text of the marked article, or None if the page marks none."""
    found = marked_blocks(blocks)
    return None if found is None else " ".join(found)


def _stream(blocks: list[tuple[int, str]]) -> tuple[list[str], list[bool]]:
    """Tokens of all blocks outside marked articles, and which of them could be kept."""
    tokens, loose = [], []
    for part, text in blocks:
        if part in (LOOSE, SIDE_PART):
            words = text.split(" ")
            tokens += words
            loose += [part == LOOSE] * len(words)
    return tokens, loose


def _hashes(tokens: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], np.uint64)


def article_stream(article: list[str]) -> np.ndarray:
    """Tokens of an article in four bytes each, with 0 (never a token) behind every block."""
    return np.array([unit for text in article for unit in (*[xxhash.xxh32_intdigest(t) or 1 for t in text.split(" ")], 0)], np.uint32)


def block_keys(article: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(text) for text in article], np.uint64).view(np.int64)


def run_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` tokens."""
    return Rolled(mix(tokens)).grams(length)


def _suffix_ranks(whole: np.ndarray, length: int) -> np.ndarray:
    """Rank of every suffix by its first ``length`` tokens, found by doubling the prefix that decides."""
    rank = np.unique(whole, return_inverse=True)[1].astype(np.uint64)
    have = 1
    while have < length:
        more = min(have, length - have)
        pair = (rank[:len(rank) - more] << np.uint64(32)) | rank[more:]
        rank, have = np.unique(pair, return_inverse=True)[1].astype(np.uint64), have + more
    return rank


def _intervals(rank: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array (ties by stream), where each interval of equal ranks begins, and its distinct streams."""
    order = np.lexsort((owner, rank))
    ranked, owned = rank[order], owner[order]
    fresh = np.append(True, ranked[1:] != ranked[:-1])
    distinct = fresh | np.append(True, owned[1:] != owned[:-1])
    low = np.flatnonzero(fresh)
    return order, low, np.add.reduceat(distinct.astype(np.int64), low)


def _held(rank: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """How many distinct streams hold the run of every suffix."""
    order, low, n = _intervals(rank, owner)
    held = np.empty(len(rank), np.int64)
    held[order] = np.repeat(n, np.diff(np.append(low, len(rank))))
    return held


def shard_runs(streams: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of distinct streams of every run of ``length`` tokens, by a suffix array.

    The streams are concatenated with separators; suffixes are ranked by prefixes of doubled length until
    ``length`` tokens decide, and equal ranks are the intervals of the array with so long a common prefix.
    """
    size = np.array([len(s) for s in streams], np.int64)
    fit = size >= length
    if not fit.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = np.concatenate(streams)
    begin = np.cumsum(size) - size
    rank = _suffix_ranks(whole, length)
    starts = np.concatenate([np.arange(b, b + s - length + 1) for b, s in zip(begin[fit], size[fit])])
    owner = np.repeat(np.flatnonzero(fit), size[fit] - length + 1)
    order, low, n = _intervals(rank[starts], owner)
    return Rolled(mix(whole)).grams(length)[starts[order[low]]], n


def article_runs(streams: list[np.ndarray], keys: list[np.ndarray], length: int, share: float,
                 min_pages: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct article streams: how many are no copies, and of every run in a block of those its block and the block's key,
    the run's hash, and how many of those hold the run.

    ``keys`` has a key for every block of a stream. Runs are in the order of the streams.
    """
    none = np.zeros(0, np.int64)
    whole, key = np.concatenate(streams), np.concatenate(keys)
    owner_of = np.repeat(np.arange(len(streams)), [len(s) for s in streams])
    token = whole != 0
    block = np.cumsum(~token) - ~token  # a separator belongs to the block before it
    inside = np.append(0, np.cumsum(token))
    starts = np.flatnonzero(inside[length:] - inside[:-length] == length) if len(whole) >= length else none
    if not len(starts):
        return len(streams), none, none, none.view(np.uint64), none
    rank, owner = _suffix_ranks(whole, length)[starts], owner_of[starts]

    def tokens_of(mask: np.ndarray) -> np.ndarray:
        return np.bincount(owner_of[mask], minlength=len(streams))

    held = _held(rank, owner)
    shared = _covered(starts[held > 1], len(whole), length)
    common = _covered(starts[(held >= min_pages) & (held >= share * len(streams))], len(whole), length)
    left = token & (np.bincount(block[token & ~common], minlength=len(key)) > 0)[block]
    copy = 100 * tokens_of(shared) >= COPY_PERCENT * tokens_of(token)
    copy |= 100 * tokens_of(shared & left) >= COPY_PERCENT * tokens_of(left)
    articles, own = int(np.count_nonzero(~copy)), ~copy[owner]
    at = block[starts[own]]
    n = _held(rank[own], owner[own]) if own.any() else none
    return articles, at, key[at], run_hashes(whole, length)[starts[own]], n


def article_blocks(streams: list[np.ndarray], keys: list[np.ndarray], length: int, share: float, min_pages: int,
                   shards: int = 1) -> tuple[int, np.ndarray, np.ndarray]:
    """Of a host's distinct article streams: how many are no copies, and the blocks many of those hold, with their numbers.

    A block's number is that of its rarest run, which lies within a block wherever it is held. If the streams are one of
    several ``shards`` of a host, half of ``share`` is enough; ``named_runs`` and ``counted_runs`` give whole numbers there.
    """
    articles, at, key, _, n = article_runs(streams, keys, length, share, min_pages)
    if not len(at):
        return articles, key, n
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    found, where = np.unique(key[first], return_index=True)
    n = np.minimum.reduceat(n, first)[where]
    many = (n >= min_pages) & (n >= share * articles) if shards == 1 else 2 * n >= share * articles
    return articles, found[many], n[many]


def named_runs(streams: list[np.ndarray], keys: list[np.ndarray], length: int, share: float, min_pages: int) -> tuple[int, np.ndarray]:
    """Of one of a host's shards: how many articles are no copies, and the runs that ``share`` of those hold.

    What holds of all shards together holds of one of them, so no run that ``share`` of the host's articles hold is missing.
    """
    articles, _, _, run, n = article_runs(streams, keys, length, share, min_pages)
    return articles, np.unique(run[n >= share * articles])


def counted_runs(streams: list[np.ndarray], keys: list[np.ndarray], length: int, share: float, min_pages: int,
                 named: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one of a host's shards: the named runs it holds and their numbers; and the blocks that have named runs only, with each run."""
    _, at, key, run, n = article_runs(streams, keys, length, share, min_pages)
    told = np.isin(run, named)
    runs, where = np.unique(run[told], return_index=True)
    whole = told & ~np.isin(at, at[~told])
    pairs = np.unique(np.stack([key[whole], run[whole].view(np.int64)], 1), axis=0)
    return runs, n[told][where], pairs[:, 0], pairs[:, 1].view(np.uint64)


def _article_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream of each page's marked article, null where there is none and the host has to decide; a task sends equal ones once."""
    sent = set()
    for batch in batches:
        hosts, same, streams, keys = [], [], [], []
        for host, page in zip(batch["_host"].to_pylist(), batch["_html"].to_pylist()):
            blocks = blocks_of(page) if page else []
            article = marked_blocks(blocks)
            if article is None and not any(_stream(blocks)[1]):
                continue
            of_blocks = b"" if article is None else block_keys(article).tobytes()
            key = xxhash.xxh3_64_intdigest(of_blocks) - 2**63
            if (host, key) not in sent:
                sent.add((host, key))
                hosts.append(host)
                same.append(key)
                streams.append(None if article is None else article_stream(article).tobytes())
                keys.append(of_blocks)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(same, pa.int64()), pa.array(streams, pa.binary()), pa.array(keys, pa.binary())],
            ["_host", "same", "stream", "keys"])


def _distinct_articles(rows: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Streams and block keys of a shard's distinct articles."""
    distinct = {same: (np.frombuffer(stream, np.uint32), np.frombuffer(keys, np.int64)) for same, stream, keys in
                zip(rows["same"].to_pylist(), rows["stream"].to_pylist(), rows["keys"].to_pylist()) if stream is not None}
    return [s for s, _ in distinct.values()], [k for _, k in distinct.values()]


def _article_shard(min_tokens: int, share: float, min_pages: int):
    """Rows (host, block, n) of a host's articles, or (host, run) of the runs that one of its shards names; and one without
    either: how many articles, and whether a page marks none."""

    def run(key, rows):
        streams, keys = _distinct_articles(rows)
        articles, blocks, n, runs = 0, [], [], []
        if streams and rows["shards"][0].as_py() == 1:
            articles, blocks, n = article_blocks(streams, keys, min_tokens, share, min_pages)
        elif streams:
            articles, runs = named_runs(streams, keys, min_tokens, share, min_pages)
        size = 1 + len(blocks) + len(runs)
        named = np.asarray(runs, np.uint64).view(np.int64).tolist()
        return pa.table(
            [pa.array([key[0].as_py()] * size, pa.string()), pa.array([None, *blocks, *[None] * len(named)], pa.int64()),
             pa.array([None] * (size - len(named)) + named, pa.int64()), pa.array([articles, *n, *[None] * len(named)], pa.int64()),
             pa.array([rows["stream"].null_count > 0] + [None] * (size - 1), pa.bool_())], ["_host", "block", "run", "n", "open"])

    return run


def _count_named(min_tokens: int, share: float, min_pages: int):
    """Rows (host, run, n) of the host's named runs in a shard, and (host, block, run) of the blocks that have no other ones."""

    def run(key, rows, named):
        streams, keys = _distinct_articles(rows)
        runs, n, blocks, of_block = counted_runs(
            streams, keys, min_tokens, share, min_pages, named["run"].to_numpy().view(np.uint64)) if streams else [np.zeros(0, np.int64)] * 4
        return pa.table(
            [pa.array([key[0].as_py()] * (len(runs) + len(blocks)), pa.string()), pa.array([None] * len(runs) + blocks.tolist(), pa.int64()),
             pa.array(np.concatenate([runs.view(np.int64), of_block.view(np.int64)])), pa.array(n.tolist() + [None] * len(blocks), pa.int64())],
            ["_host", "block", "run", "n"])

    return run


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each page's marked article and their keys, null where there is none and the host has to decide."""
    for batch in batches:
        texts, keys = [], []
        for page in batch["_html"].to_pylist():
            blocks = blocks_of(page) if page else []
            article = marked_blocks(blocks)
            if article is None and not any(_stream(blocks)[1]):
                article = []
            texts.append(article)
            keys.append(block_keys(article or []))
        yield pa.RecordBatch.from_arrays(
            [batch["_own"], batch["_row"], batch["_host"], pa.array(texts, pa.list_(pa.string())), pa.array(keys, pa.list_(pa.int64()))],
            ["_own", "_row", "_host", "texts", "keys"])


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token stream of each page, and its tokens that could be kept where the host has to decide."""
    for batch in batches:
        streams, loose, same = [], [], []
        for page in batch["_html"].to_pylist():
            blocks = blocks_of(page) if page else []
            tokens, free = _stream(blocks)
            hashed = _hashes(tokens)
            streams.append(hashed.view(np.int64))
            same.append(xxhash.xxh3_64_intdigest(hashed.tobytes()) - 2**63)
            undecided = marked_text(blocks) is None and any(free)
            loose.append([t if f else None for t, f in zip(tokens, free)] if undecided else None)
        yield pa.RecordBatch.from_arrays(
            [batch["_row"], batch["_host"], pa.array(same, pa.int64()), pa.array(streams, pa.list_(pa.int64())),
             pa.array(loose, pa.list_(pa.string()))], ["_row", "_host", "same", "stream", "loose"])


def _count_shard(min_tokens: int):
    def run(key, rows):
        lists = rows["stream"].combine_chunks()
        streams = [np.asarray(s.values).astype(np.int64).view(np.uint64) for s in lists]
        run_hash, n = shard_runs(streams, min_tokens)
        return pa.table([pa.array([key[0].as_py()] * len(n), pa.string()), pa.array(run_hash.view(np.int64)), pa.array(n)],
                        ["_host", "run", "n"])

    return run


def _runs_of(min_tokens: int):
    """Rows (page, run, place) of the pages that are still undecided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, runs, places = [], [], []
            for i, stream in enumerate(batch["stream"]):
                found = run_hashes(np.asarray(stream.values).astype(np.int64).view(np.uint64), min_tokens)
                rows += [i] * len(found)
                runs.append(found.view(np.int64))
                places.append(np.arange(len(found)))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["_row"].take(at), batch["_host"].take(at), pa.array(np.concatenate([np.zeros(0, np.int64), *runs])),
                 pa.array(np.concatenate([np.zeros(0, np.int64), *places]))], ["_row", "_host", "run", "place"])

    return run


def _covered(places: list[int] | np.ndarray, n: int, length: int) -> np.ndarray:
    places = np.asarray(places, np.int64)
    step = np.bincount(places, minlength=n + 1) - np.bincount(places + length, minlength=n + 1)
    return np.cumsum(step[:-1]) > 0


def _unique_runs(min_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for words, found in zip(batch["loose"].to_pylist(), batch["places"].to_pylist()):
                free = np.array([w is not None for w in words], bool)
                keep = free & ~_covered([f["place"] for f in found or [] if f["many"]], len(words), min_tokens)
                unique = keep & ~_covered([f["place"] for f in found or [] if not f["many"]], len(words), min_tokens)
                copied = 100 * (keep.sum() - unique.sum()) >= COPY_PERCENT * keep.sum()
                texts.append(" ".join([words[i] for i in np.flatnonzero(keep if copied else unique)]))
            yield pa.RecordBatch.from_arrays([batch["_row"], pa.array(texts, pa.string())], ["_row", "text"])

    return run


def _boilerplate(keyed: DataFrame, space: Workspace, min_tokens: int, min_pages: int, share: float) -> tuple[DataFrame, DataFrame]:
    """Rows (host, gone) of the boilerplate blocks of marked articles, and the hosts with a page that marks none."""
    shards = F.ceil(F.greatest(F.count("*") / F.lit(SHARD_PAGES), F.sum(F.octet_length("_html")) / F.lit(SHARD_BYTES))).cast("int")
    large = space.keep(keyed.groupBy("_host").agg(shards.alias("shards")).where("shards > 1"), "large-hosts")

    def dealt(pages: DataFrame) -> DataFrame:
        return (
            pages.select("_host", "_html").mapInArrow(_article_streams, "_host string, same long, stream binary, keys binary")
            .join(large, "_host", "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
            .withColumn("shard", F.pmod(F.xxhash64("same"), "shards").cast("int")).groupBy("_host", "shard"))

    sent = space.keep(
        dealt(keyed).applyInArrow(
            _article_shard(min_tokens, share, min_pages), "_host string, block long, run long, n long, open boolean"), "article-blocks")
    articles = sent.where("open is not null").groupBy("_host").agg(F.sum("n").alias("articles"))
    counted = sent.where("block is not null").select("_host", "block", "n")
    named = sent.where("run is not null").select("_host", "run").distinct()
    if not named.isEmpty():  # the pages of these hosts are read again
        named = space.keep(named, "named-runs")
        asked = named.join(large, "_host").select("_host", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "run")
        told = space.keep(
            dealt(keyed.join(named.select("_host").distinct(), "_host", "left_semi")).cogroup(asked.groupBy("_host", "shard"))
            .applyInArrow(_count_named(min_tokens, share, min_pages), "_host string, block long, run long, n long"), "told-runs")
        numbers = told.where("block is null").groupBy("_host", "run").agg(F.sum("n").alias("n"))
        of_blocks = told.where("block is not null").select("_host", "block", "run").distinct()
        counted = counted.unionByName(of_blocks.join(numbers, ["_host", "run"]).groupBy("_host", "block").agg(F.min("n").alias("n")))
    counted = counted.where(F.col("n") >= min_pages)
    blocks = space.keep(
        counted.join(articles, "_host").where(F.col("n") >= share * F.col("articles"))
        .groupBy("_host").agg(F.collect_list("block").alias("gone")), "boilerplate")
    return blocks, space.keep(sent.where("open").select("_host").distinct(), "hosts")


def main_texts(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", min_tokens: int = MIN_TOKENS,
               min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars`` (code points). Columns of these names are replaced."""
    space = Workspace(pages.sparkSession, "html-text")
    base = pages.drop("text", "n_chars")
    others = [c for c in base.columns if c.lower() != html_col.lower()]
    row = F.xxhash64(F.coalesce(F.col(url_col), F.lit("")), F.col(html_col), F.length(html_col))
    keyed = base.select(own_columns(others), row.alias("_row"), host_of(F.col(url_col)).alias("_host"), F.col(html_col).alias("_html"))
    boilerplate, hosts = _boilerplate(keyed, space, min_tokens, min_pages, share)

    def marked(rows: DataFrame) -> DataFrame:
        return rows.mapInArrow(_marked, own_schema(base, others, "_row long, _host string, texts array<string>, keys array<long>"))

    # Only the pages of hosts with an undecided page are read again.
    pages_of = space.keep(
        keyed.select("_row", "_host", "_html").join(hosts, "_host", "left_semi").select("_row", "_host", "_html")
        .mapInArrow(_streams, "_row long, _host string, same long, stream array<long>, loose array<string>")
        .dropDuplicates(["_row"]), "page-streams")
    undecided = pages_of.where("loose is not null")
    streams = pages_of.where(F.size("stream") >= min_tokens)
    streams = space.keep(
        streams.groupBy("_host", "same").agg(F.first("stream").alias("stream")), "streams")
    sizes = space.keep(
        streams.groupBy("_host").agg(F.ceil(F.count("*") / F.lit(SHARD_PAGES)).cast("int").alias("shards")), "sizes")
    counted = space.keep(
        streams.join(sizes, "_host").withColumn("shard", F.pmod(F.xxhash64("same"), "shards").cast("int"))
        .select("_host", "shard", "stream").groupBy("_host", "shard")
        .applyInArrow(_count_shard(min_tokens), "_host string, run long, n long"), "counted")
    common = space.keep(
        counted.groupBy("_host", "run").agg(F.sum("n").alias("n")).where("n > 1")
        .select("_host", "run", (F.col("n") >= min_pages).alias("many")), "common")
    runs = space.keep(
        undecided.select("_row", "_host", "stream").mapInArrow(
            _runs_of(min_tokens), "_row long, _host string, run long, place long"), "runs")
    places = runs.join(common, ["_host", "run"]).groupBy("_row").agg(
        F.collect_list(F.struct("place", "many")).alias("places"))
    texts = space.keep(
        undecided.select("_row", "loose").join(places, "_row", "left").mapInArrow(
            _unique_runs(min_tokens), "_row long, text string"), "texts")
    told = marked(keyed.join(hosts, "_host", "left_semi")).where("texts is null").select("_own", "_row")
    kept = F.filter("texts", lambda _, i: ~F.array_contains("gone", F.get("keys", i)))
    found = (
        marked(keyed).where("texts is not null").join(boilerplate, "_host", "left")
        .withColumn("kept", F.when(F.col("gone").isNotNull(), kept))
        .select("_own", F.array_join(F.when(F.size("kept") > 0, F.col("kept")).otherwise(F.col("texts")), " ").alias("text"))
        .unionByName(told.join(texts, "_row", "left").select("_own", "text")))
    text = F.coalesce("text", F.lit(""))
    return with_own(found, others, text.alias("text"), F.length(text).cast("long").alias("n_chars"))
