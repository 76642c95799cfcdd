import random
import re

import pytest

from tidemill.llm import divergence, url_rules
from tidemill.llm.queries import RULES


def as_regex(glob):
    """The glob as a regular expression."""
    out = re.sub(r"\*\*+|\*|\?|[^*?]+", lambda m: {"**": "(?:.|\n)*", "*": "[^/]*", "?": "[^/]"}.get("**" if m[0].startswith("**") else m[0], re.escape(m[0])), glob)
    return re.compile(out)


def test_automaton_against_regular_expressions():
    rng = random.Random(4)
    letters = ["a", "b", ".", "/", "é", "中", "😀"]
    globs = ["".join(rng.choices([*letters, "*", "**", "?"], k=rng.randint(0, 9))) for _ in range(150)] + ["a" * 70 + "*b", "***", "", "*", "a*/**", "*/?"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(600)] + ["", "a" * 200 + "b", "a" * 70 + "b", "x" * 5000, "a\nb"]
    automaton = url_rules.Automaton(globs)
    assert automaton.words > 4
    found = automaton.run(texts)
    for k, g in enumerate(globs):
        pattern = as_regex(g)
        assert [bool(pattern.fullmatch(t)) for t in texts] == found[:, k].tolist(), g


def plain_judge(url, rules):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host, tail = re.match(r"([^/?#]*)((?:.|\n)*)", rest).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    path = re.match(r"[^?#]*", tail)[0]
    best = max((r for r in rules if ("." + host).endswith("." + r[0]) and path.startswith(r[1])), key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else None


def test_judge_odd_urls(spark, monkeypatch):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    urls = [None, "", "no scheme", "http://", "://net/", "HTTP://WWW.Example.NET/en/x?q=1#f", "https://net", "https://net/", "https://net?x/", "http://notexample.net/en/",
            "http://x.example.com/de/", "http://xexample.com/de/", "http://example.com/DE/", "http://example.com/de", "a://b://example.com/de/", "http://org/fr/", "http://a.org/x/fr/",
            "http://u@example.com:80/de/", "http:///net/", "http://É.NET/é", "http://x.com/a.net/", "http://a\n.net/b\nc", "ftp://m.casino-win.org/x", "http://casino.org/fr/", "http://x.org/casino",
            "http://" + "a." * 20_000 + "net/" + "b/" * 20_000]
    rows = [(i, u, "h", "p") for i, u in enumerate(urls)] + [(3, urls[5], "h", "p"), (None, urls[6], "h", "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = {(r["page_id"], r["host"], r["path"], r["rule"]): r["verdict"] for r in url_rules.judge(pages, RULES).collect()}
    want = [(i, *plain_judge(u, rules)) for i, u, _, _ in rows]
    assert sorted(got, key=repr) == sorted({w[:4] for w in want}, key=repr)
    for i, host, path, rule, verdict in want:
        assert got[i, host, path, rule] == (verdict or ("block" if "casino" in host else "allow"))
    assert url_rules.judge(pages.limit(0), RULES).collect() == []
    monkeypatch.setattr(url_rules, "CELLS", 50)
    monkeypatch.setattr(url_rules, "STATE_BYTES", 64)
    assert {(r["page_id"], r["host"], r["path"], r["rule"]): r["verdict"] for r in url_rules.judge(pages.where("length(url) < 100 OR url IS NULL"), RULES).collect()}.items() <= got.items()


def plain_audit(rows, least, top):
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    out = []
    for lang in {w[0] for w in words}:
        docs = [w for w in words if w[0] == lang]
        vocab = [t for t in {t for w in docs for t in w[2]} if sum(t in w[2] for w in docs) >= least]
        count = lambda source: {t: sum(w[2].count(t) for w in docs if source in (None, w[1])) for t in vocab}  # noqa: B023, E731
        share = lambda c: {t: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(vocab)) for t, n in c.items()}  # noqa: B023, E731
        q, counts = share(count(None)), {s: count(s) for s in {w[1] for w in docs}}
        p = {s: share(c) for s, c in counts.items()}
        for s in p:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in vocab), o) for o in p if o != s]
            terms = [(p[s][t] - q[t], t) for t in vocab if counts[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, t, v, k) for k, (v, t) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


@pytest.mark.parametrize("cells", [3, 200_000])
def test_audit_against_plain_sums(spark, monkeypatch, cells):
    rng = random.Random(9)
    words = ["the", "The", "of", "été", "ÉTÉ", "中文", "x1y", "don't", "a_b", "😀", "z"]
    rows = [(rng.choice(["en", "fr"]), rng.choice(["s", "t", "u", "é", None]), " ".join(rng.choices(words, weights=range(1, 12), k=rng.randint(0, 12)))) for _ in range(80)]
    rows += [(None, "s", "the"), ("xx", "a", "rare"), ("xx", "b", None), ("xx", "\x00c", ""), ("yy", None, "of " * 40), ("en", "only", None), ("en", "s", "the " * 5000), ("en", "s", "the " * 5000)]
    docs = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string, n int")
    monkeypatch.setattr(divergence, "CELLS", cells)
    got = divergence.audit(docs, least_docs=8, top=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, 8, 3)
    assert divergence.audit(docs.limit(0)).collect() == []


def test_shares_of_large_counts_are_exact():
    import numpy as np

    counts = np.array([0, 10**12, 3 * 10**13])
    assert divergence.shares(counts, 10**14, 1000).tolist() == [1 + 10**9 * (n + 5) // (10**14 + 5000) for n in counts.tolist()]
