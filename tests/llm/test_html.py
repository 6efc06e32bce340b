import numpy as np
import pytest

from ledgerlake.llm import html_text

PAGES = [
    ("<article><h1>T</h1><p>One <b>bo</b>ld<br>two<p>a&nbsp;&amp;&#233; b</article><footer>f</footer>", "T One bold two a &é b"),
    ("<nav><li>x</nav><main><p>text</p><div class='post-comments'><p>reply</p></div></main>", "text"),
    ("<article><header><h2>Own</h2></header>body<aside>s</aside><form>f<input></form><section id=comments>c</section></article>", "Own body"),
    ("<div class=ad>unclosed<article>real</article>", "real"),
    ("<article>a<script>if (x < 1) '</p>'</script><style>p{}</style><!-- n --> b<noscript>no</noscript></article>", "a b"),
    ("<article>a <a title='x>y' href=q>link</a>, c</article>", "a link, c"),
    ("<div role=dialog>cookie</div><div role='main'>m <span hidden>h</span></div>", "m"),
    ("<article>1 < 2 &lt; 3</article>", "1 < 2 < 3"),
    ("<article>cut of", "cut of"), ("", ""), (None, ""), ("<<<>>>", "<<<>>>"), ("just text", "just text"),
]


@pytest.mark.parametrize("page,text", PAGES[:9])
def test_marked_articles(page, text):
    assert html_text.marked_text(html_text.blocks_of(page)) == text


def test_suffix_array_counts_streams():
    rng = np.random.default_rng(3)
    streams = [rng.integers(0, 3, n).astype(np.uint64) for n in (30, 0, 4, 25, 40)]
    got = dict(zip(*(x.tolist() for x in html_text.shard_runs(streams, 5))))
    want = {}
    for i, s in enumerate(streams):
        for run in {h for h in html_text.run_hashes(s, 5).tolist()}:
            want.setdefault(run, set()).add(i)
    assert got == {k: len(v) for k, v in want.items()}


def site(spark):
    menu = "<div>Home News Sport Weather Travel Culture About</div>"
    foot = "<p>All rights reserved by the owners of this site</p>"
    rows = [(i, f"http://a.test/{i}", f"{menu}<p>w{i} x{i} tells of y{i} z{i}</p>{foot}") for i in range(5)]
    rows += [(9, "http://a.test/9", rows[0][2])]  # a copy is the same stream
    rows += [(10, "http://b.test/1", rows[1][2]), (11, None, PAGES[0][0]), (12, "x", None), (13, "http://a.test/13", "")]
    rows += [(11, None, PAGES[0][0])]
    return rows


def test_hosts_decide_unmarked_pages(spark):
    rows = site(spark)
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {}
    for r in html_text.main_texts(docs).collect():
        assert r["n_chars"] == len(r["text"])
        got.setdefault(r["page_id"], []).append(r["text"])
    for i in range(5):
        assert got[i] == [f"w{i} x{i} tells of y{i} z{i}"]
    assert got[9] == got[0]
    assert got[10][0].startswith("Home News") and got[10][0].endswith("of this site")  # alone on its host
    assert got[11] == [PAGES[0][1]] * 2 and got[12] == [""] and got[13] == [""]


def test_all_pages_and_empty_table(spark):
    rows = [(i, "http://h.test/", p) for i, (p, _) in enumerate(PAGES)]
    docs = spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {r["page_id"]: r["text"] for r in html_text.main_texts(docs).collect()}
    assert [got[i] for i in range(len(PAGES))] == [t for _, t in PAGES]
    assert html_text.main_texts(docs.limit(0)).count() == 0


def test_two_pages_share_a_menu_and_near_copies_stay(spark):
    menu = "<div>Home News Sport Weather Travel Culture About</div>"
    story = " ".join(f"s{i}" for i in range(60))
    rows = [(1, "http://two.test/1", f"{menu}<p>one tells of this and that and more of it</p>"),
            (2, "http://two.test/2", f"{menu}<p>two has other things to say about the rest</p>"),
            (3, "http://copy.test/1", f"<p>{story} first</p>"), (4, "http://copy.test/2", f"<p>{story} second</p>")]
    got = {r["page_id"]: r["text"] for r in html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "one tells of this and that and more of it", 2: "two has other things to say about the rest",
                   3: f"{story} first", 4: f"{story} second"}


def test_clashing_columns(spark):
    rows = [(1, "http://a.test/", PAGES[0][0], "h", 5, "o")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string, _host string, _row int, _own string")
    got = html_text.main_texts(docs).collect()[0]
    assert (got["_host"], got["_row"], got["_own"], got["text"]) == ("h", 5, "o", PAGES[0][1])


LICENCE = "Texts of this house may be shared under its open licence."


def article(*blocks):
    return "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"


def house(n):
    """Articles of one host: their own text, one sentence that all hold inside a block, and a licence."""
    said = "as everybody in the house has always said"
    return [f"w{i} x{i} {said} y{i} z{i} a{i} b{i} c{i} d{i} e{i} f{i} g{i} h{i}" for i in range(n)]


def texts_of(spark, rows):
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r["page_id"]: r["text"] for r in html_text.main_texts(docs).collect()}


@pytest.mark.parametrize("shard_pages", [html_text.SHARD_PAGES, 10])
def test_host_decides_on_blocks_of_marked_articles(spark, monkeypatch, shard_pages):
    monkeypatch.setattr(html_text, "SHARD_PAGES", shard_pages)
    own = house(40)
    rows = [(i, f"http://a.test/{i}", article(own[i], LICENCE, f"more{i}")) for i in range(40)]
    want = {i: f"{own[i]} more{i}" for i in range(40)}
    rows += [(40, "http://a.test/0?again", rows[0][2]), (41, "http://a.test/licence", article(LICENCE))]
    want |= {40: want[0], 41: LICENCE}  # an equal page, and one that would lose all
    rows += [(50 + i, f"http://b.test/{i}", article(own[i], LICENCE)) for i in range(2)]  # two articles share it
    want |= {50 + i: f"{own[i]} {LICENCE}" for i in range(2)}
    rows += [(60 + i, f"http://c.test/{i}", article(own[i], *[LICENCE] * (i < 9))) for i in range(30)]  # few articles hold it
    want |= {60 + i: own[i] + f" {LICENCE}" * (i < 9) for i in range(30)}
    assert texts_of(spark, rows) == want


def test_near_copies_are_no_boilerplate(spark):
    parts = [" ".join(f"{c}{i}" for i in range(20)) for c in "pqrstu"]
    rows, want = [], {}
    for i in range(8):
        mine = [p.replace(f"{p[0]}9", f"edit{i}") if k == i % 6 else p for k, p in enumerate(parts)]
        rows.append((i, f"http://copy.test/{i}", article(*mine)))
        want[i] = " ".join(mine)
    assert texts_of(spark, rows) == want


def test_article_blocks_against_a_loop():
    rng = np.random.default_rng(4)
    articles = [[" ".join(f"t{x}" for x in rng.integers(0, 12, k)) for k in rng.integers(1, 30, 3)] for _ in range(20)]
    licence, short = "l0 l1 l2 l3 l4 l5 l6", "s0 s1 s2 s3"
    articles = [a + [licence] * (i % 3 > 0) + [licence + " now"] * (i == 0) + [short] for i, a in enumerate(articles)]
    holders = {}
    for i, a in enumerate(articles):
        for words in (text.split() for text in a):
            for j in range(len(words) - 4):
                holders.setdefault(tuple(words[j:j + 5]), set()).add(i)
    n = {}
    for words in (text.split() for a in articles for text in a):
        if len(words) >= 5:
            n[" ".join(words)] = min(len(holders[tuple(words[j:j + 5])]) for j in range(len(words) - 4))
    streams, keys = [html_text.article_stream(a) for a in articles], [html_text.block_keys(a) for a in articles]
    assert n[licence] == 14
    for shards, least in ((1, 10), (2, 5)):
        got = html_text.article_blocks(streams, keys, 5, 0.5, 3, shards)
        want = {text: k for text, k in n.items() if k >= least}
        assert got[0] == 20 and dict(zip(got[1].tolist(), got[2].tolist())) == dict(zip(html_text.block_keys(list(want)).tolist(), want.values()))


def test_shards_leave_no_article_uncounted(spark, monkeypatch):
    """A block that half of a host's articles hold goes however they are dealt, also where a shard has few or none of them."""
    monkeypatch.setattr(html_text, "SHARD_PAGES", 4)
    own = house(40)
    for held in (19, 20, 21):
        rows = [(i, f"http://a.test/{i}", article(own[i], *[LICENCE] * (i < held))) for i in range(40)]
        assert texts_of(spark, rows) == {i: own[i] + f" {LICENCE}" * (i < held and held < 20) for i in range(40)}


def test_named_and_counted_runs_against_the_whole_host():
    rng = np.random.default_rng(5)
    words = lambda k: " ".join(f"t{x}" for x in rng.integers(0, 500, k))
    licence, tail = "l0 l1 l2 l3 l4 l5 l6", "m0 m1 m2 m3 m4 m5"
    for share, holders in ((0.5, 30), (0.5, 29), (0.3, 20)):
        articles = [[words(20), words(9), *[licence] * (i < holders), words(7) + " " + tail if i % 2 else tail, "s0 s1"] for i in range(60)]
        streams, keys = [html_text.article_stream(a) for a in articles], [html_text.block_keys(a) for a in articles]
        _, found, n = html_text.article_blocks(streams, keys, 5, share, 3)
        cuts = [0, 1, 3, 25, 60]  # uneven shards; the licence is in the first ones
        parts = [(streams[a:b], keys[a:b]) for a, b in zip(cuts, cuts[1:])]
        told = [html_text.named_runs(*p, 5, share, 3) for p in parts]
        assert sum(a for a, _ in told) == 60
        named = np.unique(np.concatenate([r for _, r in told]))
        number, runs_of = {}, {}
        for p in parts:
            runs, k, blocks, of_block = html_text.counted_runs(*p, 5, share, 3, named)
            for r, x in zip(runs.tolist(), k.tolist()):
                number[r] = number.get(r, 0) + x
            for b, r in zip(blocks.tolist(), of_block.tolist()):
                runs_of.setdefault(b, set()).add(r)
        got = {b: min(number[r] for r in rs) for b, rs in runs_of.items()}
        assert {b: k for b, k in got.items() if k >= share * 60 and k >= 3} == dict(zip(found.tolist(), n.tolist()))
        assert len(found) == (2 if holders != 29 else 1)
