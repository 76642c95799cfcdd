import random
from itertools import product

import numpy as np
import pytest

from tidemill.llm import ann, quotes
from tidemill.llm.html_text import extract, main_text, minimum_cut
from tidemill.session import table


def cut_cost(keep, terminals, edges):
    cost = sum(c for k, c in zip(keep, terminals) if c > 0 and not k) - sum(c for k, c in zip(keep, terminals) if c < 0 and k)
    return cost + sum(c for a, b, c in edges if keep[a] != keep[b])


def test_minimum_cut_against_all_labellings():
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randint(1, 8)
        terminals = [rng.uniform(-4, 4) for _ in range(n)]
        edges = [(i, i + 1, rng.uniform(0, 3)) for i in range(n - 1)] + [(*rng.sample(range(n), 2), rng.uniform(0, 2)) for _ in range(n // 2) if n > 1]
        best = min(cut_cost(k, terminals, edges) for k in product((False, True), repeat=n))
        assert cut_cost(minimum_cut(terminals, edges), terminals, edges) == pytest.approx(best)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><div id="header"><h1>Site</h1><ul class="menu"><li><a href=/>Home</a>
<li><a>News</a></ul></div><div class="cookie-notice">We use cookies. Please agree to that.</div><div id="content"><h2>Title &amp; more</h2>
<p>First   para with <a href=x>a link</a> in it. It is long enough.</p><div class="ad">Buy now cheap things! Really very cheap.</div>
<p>Second<br>para&nbsp;x.</p><blockquote>Quoted text.</blockquote><ul><li>one<li>two</ul><form><label>Name</label><input><button>Send</button></form></div>
<aside><h3>Related</h3><p>Other story here, quite long text with a sentence.</p></aside><section id="comments"><h3>Comments</h3>
<div class=comment><p>Great article, I really enjoyed reading it. Thanks a lot for this.</p></div></section><footer>&copy; 2020 Site</footer>
<script>if(a<b){"</p>"}</script></body></html>"""


def test_page_by_hand():
    assert main_text(PAGE) == "Title & more\nFirst para with a link in it. It is long enough.\nSecond para x.\nQuoted text.\none\ntwo"


def test_given_pages(spark, sf):
    import html
    import re

    pages = table(spark, sf, "pages")
    got = {r["page_id"]: r for r in extract(pages).collect()}
    for r in pages.collect():
        article = r["html"].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p"), (3, "u", PAGE), (3, "u", PAGE), (4, "u", "<article>" + "<p>Hello there.</p>" * 20_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = extract(df).collect()
    assert sorted((repr(r["page_id"]), r["n_chars"]) for r in got) == sorted([("1", 0), ("2", 0), ("None", 0), ("3", len(main_text(PAGE))), ("3", len(main_text(PAGE))), ("4", 13 * 20_000 - 1)])
    assert extract(df.limit(0)).count() == 0


# nearest neighbours


def test_search_against_brute_force(spark, sf):
    vectors = table(spark, sf, "embeddings")
    rows = vectors.select("vec_id", "embedding").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    got = {}
    for r in ann.nearest(vectors).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        score = x @ x[ids == q][0]
        best = [i for i in ids[np.lexsort((ids, -score))] if i != q][:20]
        hits += len({i for i, _ in found} & set(best))
        assert all(s == pytest.approx(score[ids == i][0], abs=1e-12) for i, s in found)
    assert hits >= 0.9 * 20 * len(got)


def test_recall_where_only_a_share_is_reranked(monkeypatch):
    monkeypatch.setattr(ann, "LEAST_RERANKED", 0)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 24))
    ids = np.arange(6000)
    reach = np.sqrt((x**2).sum(axis=1).max())
    points = x[:256]
    pivots = ann.Pivots(np.hstack([points, np.sqrt(np.maximum(reach**2 - (points**2).sum(axis=1), 0))[:, None]]), reach)
    queries = (ids[:40], x[:40], pivots.near(x[:40], query=True))
    q, v, _ = ann.search_block(ids, x, pivots.near(x, query=False), queries, 256, 20)
    hits = 0
    for i in range(40):
        score = x @ x[i]
        score[i] = -np.inf
        hits += len(set(v[q == i]) & set(np.argsort(-score)[:20]))
    assert hits >= 0.9 * 800


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, [-2.0, 0.0]), (20, [0.0, 3.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score int, near int")
    got = sorted(map(tuple, ann.nearest(df, k=3).collect()))
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 20, 0.0), (20, 1, 1, 1.5), (20, 2, 2, 1.5), (20, 3, 0, 0.0)]
    assert ann.nearest(df.limit(0)).count() == 0


# quotation linking

MESSAGES = [
    (1, 0, "user", "Hello there.\nHow are you?"), (1, 1, "a", "> Hello there.\n> How are you?\nFine, thanks."), (1, 2, "user", "Other thing."),
    (1, 3, "a", "On Monday X wrote:\n> how are YOU\nAgain fine."), (1, 4, "u", ">> Hello there.\n>> How are you?\n> Fine, thanks.\nGood to hear."),
    (None, 1, "u", "> x\ny"), (2, 5, "u", None), (2, 6, None, ""), (2, 6, None, ""), (3, 0, "u", "a"), (3, 7, "u", "no turn before"),
]


def test_quotes_are_linked_and_cut(spark):
    df = spark.createDataFrame([(*m, 1, 2) for m in MESSAGES], "conv_id long, turn long, role string, text string, depth int, hash int")
    got = [(r["conv_id"], r["thread"], r["turn"], r["level"], r["reply_to"], r["linked"], r["n_quotes"], r["body"]) for r in quotes.link_quotes(df).collect()]
    want = [
        (1, 0, 0, 0, None, False, 0, "Hello there.\nHow are you?"), (1, 0, 1, 1, 0, True, 1, "Fine, thanks."), (1, 0, 2, 2, 1, False, 0, "Other thing."),
        (1, 0, 3, 1, 0, True, 1, "Again fine."), (1, 0, 4, 2, 1, True, 2, "Good to hear."), (None, 1, 1, 0, None, False, 1, "y"),
        (2, 5, 5, 0, None, False, 0, ""), (2, 5, 6, 1, 5, False, 0, ""), (2, 5, 6, 1, 5, False, 0, ""), (3, 0, 0, 0, None, False, 0, "a"),
        (3, 7, 7, 0, None, False, 0, "no turn before"),
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert quotes.link_quotes(df.limit(0)).count() == 0


def test_long_chain_of_answers(spark):
    rows = [(1, i, "u", f"> message number {i - 1}\nmessage number {i}") for i in range(1, 40)] + [(1, 0, "u", "message number 0")]
    got = {r["turn"]: r for r in quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert all(got[i]["level"] == i and got[i]["thread"] == 0 and got[i]["reply_to"] == (i - 1 if i else None) for i in range(40))


LONG = "A long text of many words that is an article for sure, as it goes on."


def test_scripts_icons_and_formulas_stay_inside_their_block():
    for inside in ("<script>if (a < b) {}</script>", "<svg><text>icon</text></svg>", "<noscript><p>x</p></noscript>", "<iframe src='x'>y</iframe>", "<style>p {}</style>"):
        assert main_text(f"<article><p>{LONG}{inside} And more.</p><p>{LONG}</p></article>") == f"{LONG} And more.\n{LONG}"
    formula = "<math><mrow><mi>x</mi><mo>+</mo><msup><mn>1</mn><mn>2</mn></msup></mrow><annotation>x+1^2</annotation></math>"
    assert main_text(f"<article><p>We see {formula} here. {LONG}</p></article>") == f"We see x+12 here. {LONG}"


def test_odd_names_keep_their_articles():
    for name in ("legal-guide", "tags-explained", "alert-free-travel", "notice-of-intent-story", "popularScience"):
        assert main_text(f'<div class="{name}"><article><h1>T</h1><p>{LONG}</p></article></div>') == f"T\n{LONG}", name
        assert main_text(f'<article><div class="{name}"><p>{LONG}</p></div></article>') == LONG, name
    for name in ("site-footer", "footer-links", "adSlot3", "cookie_notice", "user-comments-list", "newsletter-box", "related"):
        assert main_text(f'<body><p>{LONG}</p><div class="{name}"><p>Some words.</p></div></body>') == LONG, name
