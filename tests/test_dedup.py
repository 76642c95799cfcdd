import hashlib
import random

import pytest
from plain import greedy, similarity
from pyspark.sql import functions as F

from tidemill.operators import dedup as D
from tidemill.operators import pairs as P

WORDS = "red blue green small large old new rod ring plate widget bolt nut hot cold steel".split()


def items(n, seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        t = " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 4)))
        if rnd.random() < 0.3:
            t = t.replace("e", "", 1) or "x"
        if rnd.random() < 0.1:
            t = rnd.choice(["", "--", "!"])
        out.append(t.title() if rnd.random() < 0.3 else t)
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, t string")


@pytest.mark.parametrize("threshold,block", [(0.45, 2000), (0.6, 3), (0.8, 2000), (0.9, 4)])
def test_pairs_lose_nothing(spark, threshold, block):
    texts = items(90, 11)
    values = P.distinct_values(frame(spark, texts), "id", ["t"])
    got = {(r.a, r.b): r.similarity for r in P.similar_pairs(values, "t", threshold, block=block).collect()}
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(t if similarity(t, t) else (i, t), i)
    ids = sorted(first.values())
    want = {(a, b): similarity(texts[a], texts[b]) for a in ids for b in ids if a < b and similarity(texts[a], texts[b]) >= threshold}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


@pytest.mark.parametrize("block_chars", [10**7, 2000])
def test_long_texts_in_blocks_lose_nothing(spark, block_chars):
    """Whole texts, near copies among them, in one and in many blocks; blanks of all kinds, and texts without words."""
    rnd = random.Random(9)
    words = lambda n: [rnd.choice(WORDS) + rnd.choice(["", "s", "é"]) for _ in range(n)]
    base = [words(rnd.randint(40, 90)) for _ in range(25)]
    near = [[w if rnd.random() < p else "x" for w in rnd.choice(base)] for p in (0.95, 0.8, 0.7, 0.6) for _ in range(6)]
    texts = [rnd.choice([" ", "\u3000", "\t"]).join(t) for t in base + near] + ["- -", "", "one\x1ctwo three"]
    values = P.distinct_values(frame(spark, texts), "id", ["t"])
    assert P._mean_words(P._prepared(values, "t")) > P.LONG
    got = {(r.a, r.b): r.similarity for r in P.similar_pairs(values, "t", 0.6, block_chars=block_chars).collect()}
    every = {(a, b): similarity(texts[a], texts[b]) for b in range(len(texts)) for a in range(b)}
    want = {k: s for k, s in every.items() if s >= 0.6}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_long_texts_travel_once_per_block(spark):
    """A text does not go to each of its words (with all the others beside it): the rows that meet are blocks x texts."""
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(WORDS) for _ in range(60)) for _ in range(40)]
    pairs = P.similar_pairs(P.distinct_values(frame(spark, texts), "id", ["t"]), "t", 0.6)
    assert pairs.count() <= 40 * 39 / 2
    forms = P._prepared(frame(spark, texts).withColumnRenamed("id", "vid"), "t").select("vid", "rec.form", "rec.code")
    plan = P._near_in_blocks(forms, 0.6, 10**7)._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" in plan and "Join" not in plan


def test_edit_distance_in_bits():
    rnd = random.Random(1)
    for _ in range(300):
        x, y = ("".join(rnd.choice("abé ") for _ in range(rnd.randint(0, 90))) for _ in range(2))
        row = list(range(len(y) + 1))
        for i, a in enumerate(x):
            row, before = [i + 1], row
            for j, b in enumerate(y):
                row.append(min(before[j + 1] + 1, row[j] + 1, before[j] + (a != b)))
        for most in (0, row[-1] - 1, row[-1], row[-1] + 3):
            assert P.edit_within(x, P._bits(x), y, most) == (row[-1] if row[-1] <= most else None)


def test_whole_texts_are_compared(spark, tmp_path):
    """Texts that differ only behind a long common beginning, or only in accents, are not alike as their beginnings are."""
    from __spark_entry__ import queries

    rnd = random.Random(5)
    accents = "été élève forêt naïve größe straße señal niño über garçon".split()
    words = lambda n: " ".join(rnd.choice(WORDS + accents) for _ in range(n))
    start, end = words(18), words(30)
    numbers = " ".join(f"{rnd.choice(WORDS)}{rnd.randrange(99)}" for _ in range(90))
    texts = [f"{start} {words(90)}", f"{start} {numbers}"] + [f"{words(12)} {end} {words(k)}" for k in (1, 2, 3)]
    texts += [words(30), texts[0], texts[4] + " été", "é à ü", "e a u", "ö ß ñ"]
    assert len(start) > 80
    path = str(tmp_path)
    docs = [(i, t, "fr", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    got = {(r.a, r.b): r.similarity for r in queries()["similar_texts"](spark, path).collect()}
    ids = [i for i in range(len(texts)) if i != 6]  # a copy of the first
    near = {(a, b): similarity(texts[a], texts[b]) for a in ids for b in ids if a < b}
    want = {k: s for k, s in near.items() if s >= 0.6}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-8 for k in want)
    cut80 = {(a, b) for a in ids for b in ids if a < b and similarity(texts[a][:80], texts[b][:80]) >= 0.6}
    assert want and cut80 - want.keys() and want.keys() - cut80  # beginnings give pairs too many and too few


def test_few_candidates_on_real_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id AS id", "substring(text, 1, 80) AS t")
    prep = P._prefixes(P._prepared(P.distinct_values(docs, "id", ["t"]), "t"), (0.6 - P.LOWEST) / 0.6).collect()
    load = {}
    for r in prep:
        for t in r.prefix:
            load[t] = load.get(t, 0) + 1
    assert sum(n * (n - 1) // 2 for n in load.values()) < 0.35 * len(prep) * (len(prep) - 1) / 2


def test_pairs_refuse_low_threshold(spark):
    with pytest.raises(ValueError):
        P.similar_pairs(P.distinct_values(frame(spark, ["a"]), "id", ["t"]), "t", 0.3)


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_greedy_equals_sequential_pass(spark, threshold):
    texts = items(80, 3)
    texts = texts + [texts[0]] * 40 + ["--"] * 10  # a hot value and texts without words
    kept, lead = greedy(texts, lambda a, b: similarity(a, b) >= threshold)
    df = frame(spark, texts)
    assert sorted(r.id for r in D.dedup_fuzzy(df, "id", "t", threshold).collect()) == kept
    assert {r.id: r.leader for r in D.duplicate_groups(df, "id", "t", threshold).collect()} == lead


def test_fuzzy_column(spark):
    texts = items(60, 8)
    kept, _ = greedy(texts, lambda a, b: similarity(a, b) >= 0.8)
    mapped = {t: next((texts[k] for k in kept if similarity(t, texts[k]) >= 0.6), t) for t in texts}
    df = frame(spark, texts).withColumn("g", F.col("id") % 3)
    got = sorted(tuple(r) for r in D.dedup_fuzzy_column(df, "id", "t", 0.6, survivors=0.8).select("g", "t").collect())
    assert got == sorted({(i % 3, mapped[t]) for i, t in enumerate(texts)})


def record_rows():
    rnd = random.Random(2)
    names, lines = items(25, 21), items(25, 22)
    rows = [(i, rnd.choice(names) or None, rnd.choice(lines) or None) for i in range(70)]
    return rows + [(100 + i, names[0], lines[0]) for i in range(20)]


def record_similarity(a, b):
    parts = [similarity(x, y) for x, y in zip(a[1:], b[1:]) if x is not None and y is not None]
    return sum(parts) / len(parts) if parts else 0.0


def test_similar_records_with_nulls(spark):
    rows = record_rows()
    df = spark.createDataFrame(rows, "id long, a string, b string")
    _, lead = greedy(rows, lambda x, y: record_similarity(x, y) >= 0.75)
    got = {r.original_index: r.duplicate_group for r in D.similar_record_groups(df, "id", ["a", "b"], 0.75).collect()}
    groups = {}
    for i, k in lead.items():
        groups.setdefault(k, []).append(rows[i][0])
    want, no = {}, 0
    for k in sorted(groups):
        if len(groups[k]) > 1:
            want |= {m: no for m in groups[k]}
            no += 1
    assert got == want


def test_confidence(spark):
    rows = record_rows()
    df = spark.createDataFrame(rows, "id long, a string, b string")
    _, lead = greedy(rows, lambda x, y: record_similarity(x, y) > 0.8)
    got = {r.id: (r.confidence_score, r.is_likely_duplicate) for r in D.with_confidence(df, "id", ["a", "b"]).collect()}
    for i, k in lead.items():
        score, flag = got[rows[i][0]]
        assert flag == (i != k)
        assert score == pytest.approx(1.0 if i == k else 1 - record_similarity(rows[k], rows[i]), abs=1e-12)


def test_customer_fixture(spark):
    rows = [(1, "john@email.com"), (2, "john@email.com"), (3, "jane@email.com"), (4, "jane@email.com"), (5, "bob@email.com"), (6, None)]
    df = spark.createDataFrame(rows, "id long, email string")
    assert sorted(r.id for r in D.dedup_by_keys(df, ["email"], "id").collect()) == [1, 3, 5, 6]
    assert sorted(r.id for r in D.dedup_subset(df, ["email"], "id", None).collect()) == [5, 6]


def test_bloom(spark):
    assert D.bloom_size(10_000, 0.01) == (95850, 6)
    bits, k = D.bloom_size(50, 0.2)
    seen, other = [f"s{i}" for i in range(50)], [f"o{i}" for i in range(200)]
    pos = lambda w: {int(hashlib.md5(f"{w}{i}".encode()).hexdigest(), 16) % bits for i in range(k)}
    filled = set().union(*map(pos, seen))
    s, o = (spark.createDataFrame([(w,) for w in ws], "t string") for ws in (seen, seen + other))
    got = {r.t: r.maybe_seen for r in D.bloom_probe(o, "t", D.bloom_build(s, "t", bits, k), bits, k).collect()}
    assert got == {w: pos(w) <= filled for w in seen + other}
    assert any(got[w] for w in other), "the small filter must give false alarms"
    fresh = spark.createDataFrame(list(enumerate(seen + other + other)), "id long, t string")
    kept = D.dedup_probabilistic(fresh, "t", "id", s, 0.2).collect()
    assert sorted(r.t for r in kept) == sorted(other)


def test_minhash(spark):
    texts = ["a b c", "A  B c", "x y", "", None, "a b c d e f g"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {r.id: r.signature for r in D.minhash_signature(df, "t", hashes=20).collect()}
    for i, t in enumerate(texts):
        words = set(t.lower().split()) if t else set()
        want = [min(hashlib.md5(f"{w}{h}".encode()).hexdigest() for w in words) for h in range(20)] if words else None
        assert got[i] == want


def test_auto_and_sharded(spark):
    df = spark.createDataFrame([(i, f"text {i % 30}") for i in range(300)], "id long, t string")
    kept, method = D.dedup_auto(df, "id", "t", "exact")
    assert method == "exact" and kept.count() == 30
    assert sorted(r.id for r in D.dedup_sharded(df, "t", "id", 8).collect()) == list(range(30))
    assert sorted(r.id for r in D.dedup_auto(df, "id", "t", "probabilistic")[0].collect()) == list(range(30))
    for n in (30, 1200):  # near copies go at every size
        rows = [(i, f"the quick brown fox number {i % 3} jumps over the lazy dog") for i in range(n)]
        assert D.dedup_auto(spark.createDataFrame(rows, "id long, t string"), "id", "t")[0].count() == 1
    report = D.dedup_report(df, kept, method).first()
    assert (report.original, report.kept, report.removed, report.rate) == (300, 30, 270, 0.9)


def test_probabilistic_with_nulls_and_empty_tables(spark):
    kind = "id long, t string, digest int"
    rows = [(1, "a", 0), (2, None, 0), (3, "b", 0), (4, "a", 0), (5, None, 0), (6, "c", 0)]
    df, ids = spark.createDataFrame(rows, kind), lambda d: sorted(r.id for r in d.collect())
    seen = lambda *texts: spark.createDataFrame([(0, t, 0) for t in texts], kind)
    assert ids(D.dedup_probabilistic(df, "t", "id", seen("b"))) == [1, 2, 6]
    assert ids(D.dedup_probabilistic(df, "t", "id", seen("b", None))) == [1, 6]
    assert ids(D.dedup_probabilistic(df, "t", "id", seen())) == [1, 2, 3, 6]
    assert ids(D.dedup_probabilistic(df.limit(0), "t", "id", seen("b"))) == []
    bits, k = D.bloom_size(10, 0.01)
    probe = D.bloom_probe(df, "t", D.bloom_build(seen("b", None), "t", bits, k), bits, k)
    assert sorted((r.t or "", r.maybe_seen) for r in probe.collect()) == [("", False), ("a", False), ("b", True), ("c", False)]


def test_exact_on_texts_and_numbers(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 1.0), (3, "a", 2.0), (4, None, 1.0), (5, None, 1.0), (6, "", 1.0)], "id long, t string, x double")
    assert sorted(map(tuple, D.dedup_exact(df, ["t", "x"], "id").collect()), key=str) == [(1, "a", 1.0), (3, "a", 2.0), (4, None, 1.0), (6, "", 1.0)]


def test_signatures_of_more_tokens_than_a_worker_remembers(monkeypatch, spark):
    """Tokens that are forgotten and met again, texts longer than a chunk, and an answer of several pieces."""
    from hashlib import md5

    monkeypatch.setattr(D, "_CACHE", 40)
    monkeypatch.setattr(D, "_CHUNK", 16)
    monkeypatch.setattr(D, "_OUT", 7)
    rnd = random.Random(3)
    texts = [" ".join(f"w{rnd.randrange(300)}" for _ in range(rnd.randrange(60))) for _ in range(60)] + [None, " ", "ÄÖ x " + "y" * 90]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").coalesce(1)
    got = {r.id: r.signature for r in D.minhash_signature(df, "t", hashes=12).collect()}
    for i, t in enumerate(texts):
        tokens = (t or "").lower().split()
        want = [min(md5(f"{w}{h}".encode()).hexdigest() for w in tokens) for h in range(12)] if tokens else None
        assert got[i] == want


def test_digests_of_many_tokens_are_made_together(monkeypatch):
    """The beginnings of md5(token + number), without a call per token and number; only tokens beyond one block go one by one."""
    import hashlib

    rnd = random.Random(2)
    tokens = [bytes(rnd.randrange(256) for _ in range(n % 64)) for n in range(500)] + ["é".encode(), b""]
    numbers = [str(i).encode() for i in range(0, 120, 7)]
    asked = []
    monkeypatch.setattr(D, "md5", lambda x: asked.append(x) or hashlib.md5(x))
    monkeypatch.setattr(D, "_LANES", 60)  # several portions
    got = D.digest_starts(tokens, numbers)
    want = [[int.from_bytes(hashlib.md5(t + n).digest()[:8], "big") for n in numbers] for t in tokens]
    assert got.tolist() == want and D.digest_starts([], numbers).shape == (0, len(numbers))
    assert len(asked) == sum(len(t) > 52 for t in tokens) * len(numbers)
