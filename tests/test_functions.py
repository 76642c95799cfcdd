import hashlib

import pytest
from plain import edit_distance, similarity, sound_code
from pyspark.sql import functions as F

from tidemill.functions import hashing as H
from tidemill.functions import numbers as N
from tidemill.functions import text as X
from tidemill.operators import protect as P

NAMES = ["John Smith", "Jon Smith", "john  smith", "J. Smith!", "Jane Doe", "Jane D.", "", "---", "Smith John", "Élan vital", "SMITH", "a a a b"]


def test_similarity_equals_plain_form(spark):
    rows = [(a, b) for a in NAMES for b in NAMES]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", X.combined_similarity(F.col("a"), F.col("b")).alias("s"), F.levenshtein("a", "b").alias("d")).collect()
    for r in got:
        assert r.s == pytest.approx(similarity(r.a, r.b), abs=1e-12), (r.a, r.b)
        assert r.d == edit_distance(r.a, r.b)


def test_sound_code(spark):
    words = ["SMITH", "Pfister", "Lloyd", "", "123", "Aaa", "Tymczak", "Jackson"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.c for r in df.select("w", X.sound_code(F.col("w")).alias("c")).collect()}
    assert got == {w: sound_code(w) for w in words}
    assert got["SMITH"] == "S53H"


def test_term_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],), (["x"],)], "t array<string>")
    got = [dict(r[0]) for r in df.select(X.term_counts(F.col("t"))).collect()]
    assert got == [{"a": 1.0, "b": 2.0}, {}, {"x": 1.0}]


@pytest.mark.parametrize("n", [7, 1000, 95850, (1 << 31) - 1, 10**12 + 39])
def test_digest_mod(spark, n):
    words = [f"word {i}" for i in range(50)] + ["", "é"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(H.md5_mod(F.col("w"), n)).collect()]
    assert got == [int(hashlib.md5(w.encode()).hexdigest(), 16) % n for w in words]


def test_word_rules_differ(spark):
    df = spark.createDataFrame([("Don't stop",)], "t string")
    r = df.select(X.letters_only_words(F.col("t")), X.word_matches(F.col("t")), F.split("t", " ")).first()
    assert [list(x) for x in r] == [["dont", "stop"], ["don", "t", "stop"], ["Don't", "stop"]]


def test_numbers(spark):
    df = spark.createDataFrame([("$1,234.50", "2024-02-30", "-"), ("x", "2024-2-3", "7"), (None, "2024-01-05 x", None)], "m string, d string, s string")
    rows = df.select(N.money(F.col("m")), N.month_key(F.col("d")), N.sentinel_to_null(F.col("s"), "-")).collect()
    assert [tuple(r) for r in rows] == [(1234.5, None, None), (None, "2024-02", 7.0), (None, None, None)]


def test_retry_delay(spark):
    df = spark.range(7).withColumn("a", F.col("id"))
    delays = lambda p, **k: [r[0] for r in df.select(P.retry_delay(p, F.col("a"), 100, 5000, **k)).collect()]
    assert delays("exponential") == [100, 200, 400, 800, 1600, 3200, 5000]
    assert delays("linear") == [100 * (i + 1) for i in range(7)]
    assert delays("fixed") == [100] * 7 and delays("none") == [0] * 7
    jittered = delays("exponential", jitter=0.5, seed=F.col("id"))
    assert all(b <= j <= 1.5 * b for b, j in zip(delays("exponential"), jittered))
