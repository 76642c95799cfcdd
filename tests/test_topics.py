import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import texts as T
from tidemill.operators import topics as O

THEMES = ["sun rain wind snow cloud storm fog hail".split(), "bread milk egg rice salt oil fish corn".split()]


@pytest.fixture(scope="module")
def df(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.choice(THEMES[i % 2]) for _ in range(30)]) for i in range(400)] + [(None, []), (None, None)]
    return spark.createDataFrame(rows, "doc_id long, w array<string>")


def test_derivatives_of_the_gamma_function():
    assert np.allclose(O.digamma([0.01, 0.5, 1, 7.5]), [-100.5608854578687, -1.9635100260214235, -0.5772156649015329, -1.9635100260214235 + sum(1 / (0.5 + i) for i in range(7))], atol=1e-8)
    assert np.allclose(O.trigamma([0.5, 1, 10]), [4.934802200544679, 1.6449340668482264, 0.10516633568168575], atol=1e-7)


def test_start_weights_follow_from_the_word():
    w = O.start_weights(np.array([f"w{i}" for i in range(4000)], dtype=object), 5, 42)
    assert np.allclose(w.mean(axis=0), 1, atol=0.01) and np.allclose(w.std(axis=0), 0.1, atol=0.01)
    assert (O.start_weights(np.array(["w7"], dtype=object), 5, 42)[0] == w[7]).all()
    assert abs(np.corrcoef(w.T)[0, 1]) < 0.06 and (w[7] != O.start_weights(np.array(["w7"], dtype=object), 5, 43)[0]).all()


def test_weights_are_those_of_the_plain_method(df):
    """Totals, and words that only some or no batches held, against matrices of all words."""
    model = O.fit(T.vectorize(df, "w"), [2, 3], passes=3)
    words = [r["word"] for r in model.bags.words.orderBy("word").collect()]
    plain = O.start_weights(np.array(words, dtype=object), 5, 42)
    for folder, rho, scale, _ in model.batches:
        sums = {r["word"]: r["sums"] for r in df.sparkSession.read.schema(O.SUMS).parquet(folder).collect()}
        plain = (1 - rho) * plain + rho * (scale * np.array([sums.get(w, [0.0] * 5) for w in words]) + model.eta)
    assert np.allclose(plain.sum(axis=0), model._totals())
    for (k, t), top in model.top(4).items():
        share = plain[:, (0 if k == 2 else 2) + t] / model._totals()[(0 if k == 2 else 2) + t]
        assert np.allclose([x for _, x in top], np.sort(share)[::-1][:4]) and [share[words.index(w)] for w, _ in top] == pytest.approx([x for _, x in top])


def test_themes_are_found_and_models_side_by_side_are_the_same(df):
    bags = T.vectorize(df, "w")
    assert bags.n_docs == 402 and bags.n_words == 16
    alone = T.topic_words(T.topics(bags, 2, passes=20), 8)
    assert sorted(sorted(w for w, _ in ws) for ws in alone.values()) == sorted(sorted(t) for t in THEMES)
    assert len(T.topic_scan(df, "w", [2, 3], passes=2, n=4).collect()) == 2


def test_no_vocabulary_in_the_driver(df):
    """What the driver holds of a model doesn't grow with the words."""
    more = df.union(df.sparkSession.range(3000).select("id", F.array(F.concat(F.lit("x"), "id"), F.lit("sun"))))
    model = T.topics(T.vectorize(more, "w"), 2, passes=2)
    assert model.bags.n_words == 3016
    assert all(np.size(v) <= 4 for b in model.batches for v in b) and np.size(model.first) == 2


def test_documents_of_a_group_settle_together_as_they_do_alone():
    """Sums, shares and their number are those of one document and one model after the other, in far fewer rounds of calls."""
    rnd = random.Random(7)
    bags = [{f"w{rnd.randrange(300)}": float(rnd.randint(1, 5)) for _ in range(rnd.choice([1, 3, 20, 70, 150]))} for _ in range(40)]
    model = object.__new__(O.TopicModel)
    model.ks, model.seed, model.batches = [2, 3, 7], 42, []
    model.alpha = [np.full(k, 1 / k) for k in model.ks]
    model.eta, model.parts = np.concatenate(model.alpha), [slice(0, 2), slice(2, 5), slice(5, 12)]
    edge, none = O.digamma(np.full(12, 300.0)), O.pd.DataFrame({"word": [], "held": []})
    asked, plain = [], O.digamma
    O.digamma = lambda x: asked.append(0) or plain(x)
    try:
        got = O._learn(model, 1, edge, O.pd.DataFrame({"bag": bags}), none)
    finally:
        O.digamma = plain
    sums = dict(zip(got["word"], got["sums"]))
    want, logs, rounds = {w: np.zeros(12) for b in bags for w in b}, np.zeros(12), 0
    for b in bags:
        words, n = list(b), np.array(list(b.values()))
        beta = np.exp(plain(O.start_weights(np.array(words, dtype=object), 12, 42)) - edge)
        start = O.start_weights(np.array([f"{min(b)} {len(b)}"], dtype=object), 12, 43)[0]
        for part, alpha in zip(model.parts, model.alpha):
            rows, gamma, change = beta[:, part], start[part], 1.0
            whole = plain(n.sum() + alpha.sum())
            theta = np.exp(plain(gamma) - whole)
            while change > 1e-3:
                last, rounds = gamma, rounds + 1
                gamma = theta * ((n / (rows @ theta + 1e-100)) @ rows) + alpha
                theta, change = np.exp(plain(gamma) - whole), np.abs(gamma - last).mean()
            found = rows * np.outer(n / (rows @ theta + 1e-100), theta)
            logs[part] += plain(gamma) - whole
            for w, s in zip(words, found):
                want[w][part] += s
    assert sums.keys() == want.keys() | {None} and all(np.allclose(sums[w], want[w]) for w in want)
    assert np.allclose(sums[None], np.concatenate([sum(want.values()), logs, [40]]))
    assert len(asked) < rounds / 10
