import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.operators import protect as P

BASE = datetime(2024, 1, 1)


def calls(spark, n=600, seed=1, keys=3):
    rnd, t, rows = random.Random(seed), 0, []
    for i in range(n):
        t += rnd.choice([1, 5, 40, 200, 1500])
        rows.append((i, "hot" if rnd.random() < 0.6 else f"k{rnd.randrange(keys)}", BASE + timedelta(milliseconds=t)))
    return rows, spark.createDataFrame(rows, "id long, k string, ts timestamp")


def ms(t):
    return int((t - BASE).total_seconds() * 1000 + 0.5)


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[1], []).append(r)
    return out.values()


def test_fixed_window_counts(spark):
    df = spark.range(150).select("id", F.lit("k").alias("k"), F.lit(BASE).alias("ts"))
    stats = P.throttle_stats(P.throttle_fixed(df, ["k"], "ts", "id", 1, 100)).first()
    assert tuple(stats) == (150, 100, 50)


def test_sliding_window(spark):
    rows, df = calls(spark)
    want = {}
    for group in by_key(rows):
        accepted = []
        for i, _, t in group:
            want[i] = len([a for a in accepted if a >= ms(t) - 1000]) < 5
            if want[i]:
                accepted.append(ms(t))
    got = {r.id: r.allowed for r in P.throttle_sliding(df, "k", "ts", "id", 1000, 5).collect()}
    assert got == want and len(set(want.values())) == 2


@pytest.mark.parametrize("faithful", [True, False])
def test_token_bucket(spark, faithful):
    rows, df = calls(spark, seed=4)
    want = {}
    for group in by_key(rows):
        tokens, clock = 4, None
        for i, _, t in group:
            now = ms(t)
            clock = now if clock is None else clock
            if now - clock >= 1000:
                tokens, clock = 4, now
            else:
                add = (now - clock) * 4 // 1000
                tokens = min(4, tokens + add)
                clock += 0 if faithful else add * 1000 // 4
            want[i] = tokens > 0
            tokens -= want[i]
    got = {r.id: r.allowed for r in P.throttle_bucket(df, "k", "ts", "id", 1000, 4, faithful).collect()}
    assert got == want and len(set(want.values())) == 2


def test_breaker(spark):
    rows, df = calls(spark, seed=9)
    df = df.withColumn("success", F.col("id") % 3 == 0)
    want = {}
    for group in by_key(rows):
        bad = good = last = 0
        is_open = False
        for i, _, t in group:
            now = ms(t) + int(BASE.timestamp() * 1000)
            if is_open and now - last < 700:
                want[i] = "blocked"
                continue
            is_open = False
            if i % 3 == 0:
                good += 1
                want[i] = "success"
            else:
                bad, last = bad + 1, now
                want[i] = "failure"
                is_open = bad >= 5 and bad * 100 // (bad + good) > 50
    got = {r.id: r.outcome for r in P.circuit_breaker(df, "k", "ts", "id", open_ms=700).collect()}
    assert got == want and set(want.values()) == {"blocked", "success", "failure"}


def test_shed_sample(spark):
    df = spark.range(60).select("id", (F.lit(BASE).cast("timestamp") + F.make_interval(secs=F.col("id") / 100)).alias("ts"))
    out = P.shed(df, "ts", "id", 60, 50, "sample").collect()
    assert sorted(r.id for r in out if r.over_mark and r.kept) == [49, 59]
    assert sum(r.kept for r in P.shed(df, "ts", "id", 60, 50, "drop").collect()) == 40
    late = P.shed(df, "ts", "id", 60, 50, "defer").collect()
    assert sum(r.delay_s > 0 for r in late) == 20 and all(r.kept for r in late)


def test_batches_close_by_count(spark):
    df = spark.range(2500).select("id", (F.lit(BASE).cast("timestamp") + F.make_interval(secs=F.col("id") / 1000)).alias("ts"))
    sizes = P.group_by_size(df, "ts", "id").groupBy("slot", "part").count().collect()
    assert sorted(r["count"] for r in sizes) == [500, 1000, 1000]
