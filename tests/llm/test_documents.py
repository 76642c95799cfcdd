import random
from itertools import combinations

import pytest
from compare import differences, duck

from tidemill.llm import cotrain, decontaminate, langid, minhash, toxicity
from tidemill.llm.graph import components
from tidemill.llm.queries import QUERIES, SQL
from tidemill.session import table

from .conftest import ODD, documents


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), duck(sf), SQL[name]) is None


# decontamination


def plain_hits(words, items, window):
    """Word by word: what is inside an occurrence of a window, and which items have one."""
    hit, which = set(), set()
    for name, item in items:
        k = min(window, len(item))
        for i in range(len(words) - k + 1 if k else 0):
            if any(words[i : i + k] == item[j : j + k] for j in range(len(item) - k + 1)):
                hit.update(range(i, i + k))
                which.add(name)
    return hit, which


@pytest.mark.parametrize("window", [1, 2, 4])
def test_automaton_against_plain_search(window):
    rng = random.Random(window)
    for _ in range(60):
        items = [(str(i), [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 9))]) for i in range(6)]
        machine = decontaminate.SuffixAutomaton([w for _, w in items], window)
        for _ in range(8):
            words = [rng.choice([b"a", b"b", b"c", b"d", b"e"]) for _ in range(rng.randint(0, 30))]
            spans, which = machine.hits(words)
            hit, names = plain_hits(words, items, window)
            assert {p for a, b in spans for p in range(a, b)} == hit and {items[i][0] for i in which} == names
            assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_blocks_give_what_one_automaton_gives(spark, odd, none):
    bench = spark.createDataFrame([(1, "alpha beta gamma"), (2, "two words"), (3, None), (4, "!?"), (5, "with the same id"), (5, "beta GAMMA delta")], "item_id long, text string")
    one = decontaminate.contamination(odd, bench, window=3)
    rows = sorted(map(tuple, one.collect()), key=repr)
    whole = decontaminate.scan_documents(odd, bench, window=3)
    parts = decontaminate.scan_documents(odd, bench, window=3, block_words=4)
    key = lambda df: sorted((repr(r["doc_id"]), r["text"] or "", r["n_words"], [list(s) for s in r["spans"]], list(r["items"])) for r in df.collect())
    assert key(whole) == key(parts)
    assert {r[0] for r in rows if r[5]} == {4, 5, 9} and len(rows) == len(ODD)
    assert decontaminate.contamination(none, bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contamination(odd, bench.limit(0)).collect())


def test_spans_are_cut_and_covered_documents_go(spark):
    bench = spark.createDataFrame([(1, "the secret answer is forty two")], "item_id long, text string")
    docs = documents(spark, [(1, "He said: The SECRET, answer is forty-two! Then many other words followed on and on here."), (2, "the secret answer is forty two"), (3, None), (4, "clean text")])
    kept = decontaminate.decontaminate(docs, bench, window=6, span_limit=6)
    assert kept.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert got == {1: "He said: ! Then many other words followed on and on here.", 3: None, 4: "clean text"}
    assert {r["doc_id"] for r in decontaminate.decontaminate(docs, bench, window=6, coverage_limit=0.0).collect()} == {3, 4}


# near-duplicates


def plain_sets(rows, k):
    out = []
    for i, t in rows:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        out.append((i, {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()))
    return out


def plain_components(rows, k, percent):
    sets = plain_sets(rows, k)
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, (_, x)), (b, (_, y)) in combinations(enumerate(sets), 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            up[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        ids = [i] if i is not None else []
        least[root(a)] = min([*ids, *([least[root(a)]] if least.get(root(a)) is not None else [])], default=None)
    return sorted(((i, len(s), least[root(a)] if s else i, i == (least[root(a)] if s else i)) for a, (i, s) in enumerate(sets)), key=repr)


def group_of(rng, base, size, most):
    """Copies of a text with up to ``most`` words changed: many of them are just similar or just not."""
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(40)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 8)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(5)
    texts = [t for g in range(3) for t in group_of(rng, [f"g{g}w{i}" for i in range(60)], 60, 7)]
    texts += [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randint(1, 8))) for _ in range(60)]
    rows = list(enumerate(texts, 10)) + ODD
    got = minhash.near_duplicates(documents(spark, rows), k=3, percent=85).drop("content")
    assert sorted(map(tuple, got.collect()), key=repr) == plain_components(rows, 3, 85)


def test_one_of_each_group_stays(spark, odd, none):
    kept = minhash.keep_first(odd, k=3, percent=85)
    assert kept.columns == odd.columns
    assert sorted((repr(r["doc_id"]), r["text"]) for r in kept.collect() if r["text"]) == sorted({(repr(i), t) for i, t in ODD if t and i != 5})
    assert minhash.keep_first(none).count() == 0 and minhash.near_duplicates(none).count() == 0


def test_signature_shares_follow_the_similarity():
    import numpy as np

    rng = np.random.default_rng(2)
    for size, share in ((8, 0.8), (400, 0.6)):
        equal = []
        for _ in range(60):
            x = rng.integers(0, 2**63, size=2 * size, dtype=np.uint64)
            common = int(round(2 * share * size / (1 + share)))
            a, b = np.unique(x[:size]), np.unique(np.r_[x[:common], x[size : 2 * size - common]])
            equal.append((minhash.signature(a, 192) == minhash.signature(b, 192)).mean())
        assert abs(np.mean(equal) - common / (2 * size - common)) < 0.05


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}


# classifiers


def test_language_of_held_out_rows(spark, sf, odd, none):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    got = langid.identify(docs).join(docs, "doc_id").where("held_out").collect()
    assert len(got) > 20 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)
    rows = langid.identify(odd).collect()
    assert len(rows) == len(ODD) and {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert langid.identify(none).count() == 0
    kept = langid.keep_identified(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {4, 5, 6, 7, 8, 9, None}


def test_kernel_weights_equal_the_kernel(spark):
    """The weights per n-gram give what the landmarks' kernel values give."""
    import numpy as np

    texts = ["the cat sat on the mat", "le chat est sur la table", "the dog and the cat", "la table et le chien", "a man on a mat", "le soleil et la lune"]
    langs = ["en", "fr", "en", "fr", "en", "fr"]
    sets = [langid.grams(t) for t in texts]
    model = langid.fit(langs, sets)
    s = model.scores(texts)
    assert [model.classes[i] for i in s.argmax(axis=1)] == langs
    vocab = set(np.concatenate(sets).tolist())
    row = np.zeros(len(model.weights) + 1)
    model.present(texts[0], row)
    assert row[:-1].sum() == len(set(sets[0].tolist()) & vocab)


def test_quality_of_held_out_labels(spark, sf, odd, none):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = cotrain.score(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert len(got) > 20 and sum(r["kept"] == bool(r["quality"]) for r in got) >= 0.9 * len(got)
    rows = cotrain.score(odd, labels).collect()
    assert len(rows) == len(ODD) and all(r["score"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert cotrain.score(none, labels).count() == 0
    assert all(r["score"] == 1 for r in cotrain.score(odd, labels.limit(0)).collect() if r["doc_id"] == 4)
    assert cotrain.keep_good(odd, labels).columns == odd.columns


def test_views_exchange_labels():
    import numpy as np

    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 40)
    text = rng.normal(size=(40, 3)) + 3 * y[:, None]
    meta = np.c_[y * 5 + 1, np.full(40, 100.0)]
    pool_y = rng.integers(0, 2, 600)
    pool_text, pool_meta = rng.normal(size=(600, 3)) + 3 * pool_y[:, None], np.c_[pool_y * 5 + 1, np.full(600, 100.0)]
    model = cotrain.cotrain(text, meta, y.astype(float), pool_text, pool_meta)
    assert model.rounds[-1][0] + model.rounds[-1][1] > model.rounds[0][0] + model.rounds[0][1] > 0
    assert ((model.probabilities(pool_text, pool_meta)[2] > 0.5) == pool_y).mean() > 0.97


def test_every_sure_row_is_exchanged(spark):
    """The whole table is the pool: Spark's rounds are those of one pass over all unlabelled rows, also of a source seen nowhere else."""
    import numpy as np

    rng = random.Random(3)
    rows = []
    for i in range(3_000):
        good = i % 2 == 0
        words = [f"w{rng.randrange(90)}" if good else rng.choice(["$$$", "###", "BUY"]) for _ in range(30)]
        rows.append((i, " ".join(words), "en", "rare" if i == 2_999 else "a" if good else "b", 100))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(60)], "doc_id long, quality int")
    found = cotrain.featured(cotrain.prepared(docs, "doc_id", "text", ("source", "lang"), "n_chars"))
    model = cotrain.learn(found, labels)
    local = sorted(found.collect(), key=lambda r: (str(r["doc_id"]),))
    part = lambda test: [np.array([r[c] for r in local if test(r["doc_id"])], dtype=float) for c in ("content", "meta")]
    marked = sorted(range(60), key=str)
    want = cotrain.cotrain(*part(lambda i: i < 60), np.array([1.0 - i % 2 for i in marked]), *part(lambda i: i >= 60))
    assert model.rounds == want.rounds and model.rounds[0][1] > 2_900
    assert model.rounds[-1][1] == 2_940  # in the end the text view is sure of every row, the rare one too
    for a, b in ((model.text, want.text), (model.meta, want.meta)):
        assert np.allclose(a.beta, b.beta, atol=1e-6) and np.allclose(a.mean, b.mean) and np.allclose(a.scale, b.scale)


def test_toxic_rows_are_found_and_graded(spark, odd, none):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        words = [f"w{rng.randrange(200)}" for _ in range(40)]
        bad = i % 8 == 0
        for _ in range(rng.choice([1, 5]) if bad else 0):
            words.insert(rng.randrange(40), rng.choice(["nastyone", "nastytwo", "vilest"]))
        rows.append((i, " ".join(words).title()))
        labels.append((i, int(bad)))
    docs = documents(spark, rows + [(900, "a nastythree text"), (901, "w1 w2 w3"), (902, None)])
    marks = spark.createDataFrame([*labels, (3, None), (None, 1), (901, 7)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, marks).collect()}
    assert all(got[i]["toxic"] == bool(y) for i, y in labels)
    assert got[900]["p_toxic"] > 20 * got[901]["p_toxic"] and not got[902]["toxic"]
    uses = {i: sum(w.startswith(("nasty", "vile")) for w in t.lower().split()) for i, t in rows}
    assert all(0 <= r["severity"] <= 2 for r in got.values())
    mild = [got[i]["severity"] for i, u in uses.items() if u == 1]
    assert min(got[i]["severity"] for i, u in uses.items() if u > 4) > sum(mild) / len(mild)
    assert len(toxicity.score(odd, marks.limit(0)).collect()) == len(ODD) and toxicity.score(none, marks).count() == 0
    assert not any(r["toxic"] for r in toxicity.score(odd, marks.limit(0)).collect())
