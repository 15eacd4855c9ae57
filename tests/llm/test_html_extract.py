"""Main text of pages: markup, host repeats against brute force, awkward tables."""

import random

import numpy as np
import pytest

from tripflow.llm import html_extract
from tripflow.llm.html_blocks import ARTICLE, PLAIN, blocks

CASES = [
    ("<p class=ad>x</p><p>Hi <b>bold <i>it</b> more</i><p>next &amp; &lt;p&gt; &nbsp; &#233;", ["Hi bold it more", "next & <p> é"]),
    ('<div title="a>b">x</div>', ["x"]),
    ("a < b and c <3 d", ["a < b and c <3 d"]),
    ("<!-- x", []),
    ("text<script>\"</p>\"</script>tail<style>", ["texttail"]),
    ("<article><header><h1>T</h1></header><p>One<br>two<p>three<aside>no</aside><section class='comments'><p>c</p></section>"
     "<footer>f</footer></article><p>out", ["T", "One two", "three"]),
    ("<nav><ul><li>menu</nav><main><h1>T</h1><p>a</p><form><input>b</form><div id=cookie-notice>c</div></main><p>x", ["T", "a"]),
    ("<body class='has-sidebar'><div class='post-content'><p>hello</p></div><div id=sidebar><p>side</p></div>", ["hello"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("<article><p>a <span class='advert'>buy</span>b</p><ol class=commentlist><li><article>reader</article></ol></article>", ["a b"]),
    ("<header><h1>Site</h1></header><p>text <p hidden>no</p><p style='display: none'>no", ["text"]),
    ("<p><a href='/x'>all link</a></p><p>see <a>this</a> longer text", ["see this longer text"]),
    ("<title>t</title><TEXTAREA><p>no</TextArea ><P>yes", ["yes"]),
    ("", []), (None, []), ("\n \t", []), ("&copy &notit; &#x110000; &amp;amp;", ["© ¬it; \ufffd &amp;"]),
]


@pytest.mark.parametrize(("html", "want"), CASES)
def test_region(html, want):
    assert html_extract.region(html)[1] == want


def test_long_and_deep_pages_are_read_whole():
    assert [b.text for b in blocks("<div>" * 50_000 + "x" + "</div>" * 50_000)] == ["x"]
    assert len(blocks("<p>word" * 50_000)) == 50_000
    assert blocks("<" * 50_000)[0].text == "<" * 50_000
    assert blocks("<b class='" * 20_000 + "x") is not None


def brute(pages, run):
    """Blocks that go, by counting the pages of every string of ``run`` tokens."""
    if len(pages) < html_extract.PAGES:
        return [[False] * len(t) for _, t in pages]
    streams = [[(w, b) for b, t in enumerate(texts) for w in [*t.split(), None]] for _, texts in pages]
    on = {}
    for p, s in enumerate(streams):
        for i in range(len(s) - run + 1):
            on.setdefault(tuple(w for w, _ in s[i:i + run]), set()).add(p)
    out = []
    for (role, texts), s in zip(pages, streams, strict=True):
        share = html_extract.DECLARED if role >= 2 else html_extract.LOOSE
        need = max(html_extract.PAGES, -int(-share * len(pages) // 1))
        gone = set()
        for i in range(len(s) - run + 1):
            if len(on[tuple(w for w, _ in s[i:i + run])]) >= need:
                gone |= set(range(i, i + run))
        size = [len(t.split()) + 1 for t in texts]
        drop = [2 * sum(1 for i in gone if s[i][1] == b) > size[b] for b in range(len(texts))]
        if role >= 2 and 2 * sum(n for n, d in zip(size, drop, strict=True) if d) > sum(size):
            drop = [False] * len(texts)
        out.append(drop)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_boilerplate_against_brute_force(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(15 if seed % 2 else 200)]
    some = lambda a, b: " ".join(r.choice(words) for _ in range(r.randint(a, b)))
    common = [some(3, 14) for _ in range(4)]
    pages = []
    for _ in range(r.choice([2, 12, 40])):
        texts = [some(1, 30) for _ in range(r.randint(0, 4))] + [c for c in common if r.random() < .6]
        if r.random() < .3:
            texts.append(common[0] + " " + some(1, 20))
        r.shuffle(texts)
        pages.append((r.choice([PLAIN, ARTICLE]), texts))
    got = html_extract.boilerplate(pages, 5)
    assert [list(map(bool, g)) for g in got] == brute(pages, 5)


def test_suffix_ranks_sort_suffixes():
    tokens = np.array(random.Random(1).choices(range(3), k=400))
    rank = html_extract.suffix_ranks(tokens, 8)
    keys = [tuple(tokens[i:i + 8]) for i in range(len(tokens))]
    order = sorted(set(keys))
    assert rank.tolist() == [order.index(k) for k in keys]


def page(i, body, extra=""):
    return (i, f"http://h.example/{i}", f"<html><body><nav>menu</nav>{body}{extra}</body></html>")


def test_hosts(spark):
    r = random.Random(3)
    some = lambda n: " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    bar = "<div>Read our terms of use and the privacy policy of this site today</div>"
    rows, want = [], {}
    for i in range(40):  # repeated blocks go, unique ones stay
        a, b = some(20), some(30)
        rows.append(page(i, f"<div>{a}</div>{bar}<div>{b}</div>"))
        want[i] = f"{a}\n{b}"
    body = some(50)
    for i in range(100, 120):  # copies on a host of their own are one page
        rows.append((i, "https://copy.example/x?y", f"<article><p>{body}</p></article>"))
        want[i] = body
    own = [some(40) for _ in range(10)]
    for i in range(200, 210):  # a declared article that others share stays whole
        rows.append((i, "https://Near.example", f"<article><p>{body}</p><p>{some(5)}</p></article>"))
        want[i] = rows[-1][2].replace("</p><p>", "\n").removeprefix("<article><p>").removesuffix("</p></article>")
    for i in range(300, 310):  # a notice inside each article goes
        rows.append((i, "https://note.example/a", f"<article><p>{own[i - 300]}</p><p>Sign up now for our weekly letter "
                     "with all the latest stories</p></article>"))
        want[i] = own[i - 300]
    rows += [(400, None, None), (401, "no host", ""), (None, None, "<p>x"), (402, "a://b", "<p>y"), (402, "a://b", "<p>y")]
    df = spark.createDataFrame([(*x, "t", 1, 0) for x in rows],
                               "page_id long, url string, html string, text string, n_chars long, role int").repartition(6)
    for kw in ({}, {"group_pages": 20}):
        got = html_extract.extract(df, **kw).collect()
        assert sorted((repr(x["page_id"]), x["url"]) for x in got if x["url"]) == sorted((repr(x[0]), x[1]) for x in rows if x[1])
        assert len(got) == len(rows)
        assert {x["page_id"]: x["text"] for x in got if x["page_id"] in want} == want
        assert all(x["n_chars"] == len(x["text"]) for x in got)
        assert sorted((repr(x["page_id"]), x["text"]) for x in got if x["page_id"] not in want) == [
            ("400", ""), ("401", ""), ("402", "y"), ("402", "y"), ("None", "x")]
    assert html_extract.extract(df.limit(0)).collect() == []


def test_shares_of_a_hot_host_are_of_all_its_pages(spark):
    """A notice on 5 of 60 pages is no boilerplate, one on 8 is, however the
    host is cut into groups."""
    r = random.Random(8)
    some = lambda n: " ".join(f"w{r.randrange(9000)}" for _ in range(n))
    rare, often = some(12), some(12)
    rows = [(i, "http://hot.example/x", f"<div>{some(30)}</div>" + (f"<div>{rare}</div>" if i < 5 else "")
             + (f"<div>{often}</div>" if i % 8 == 7 or i == 0 else "")) for i in range(60)]
    rows += [(100 + i, *rows[9][1:]) for i in range(50)]  # copies are one page
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    whole = sorted(html_extract.extract(df).collect())
    assert sorted(html_extract.extract(df, group_pages=9).collect()) == whole
    texts = {x["page_id"]: x["text"] for x in whole}
    assert sum(rare in t for t in texts.values()) == 5 and not any(often in t for t in texts.values())
