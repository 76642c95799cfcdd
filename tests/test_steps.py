"""Machines over tables and streams: one busy key, late rows and restarts."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import buckets, protect as P
from tidemill.operators.steps import Breaker, SlidingWindow, TokenBucket
from tidemill.session import fresh_dir, keyed_state
from tidemill.sources import streams as S
from tidemill.streaming import ordered as O

BASE = datetime(2024, 1, 1)


def rows_of(n, seed, steps):
    """(id, key, time, success); nine of ten rows are of one key."""
    rnd, t, rows = random.Random(seed), 0, []
    for i in range(n):
        t += rnd.choice(steps)
        rows.append((i, rnd.choice(["hot"] * 9 + ["a", None]), BASE + timedelta(microseconds=t), rnd.random() < 0.5))
    return rows


def plain(rows, machine, values=False):
    machines, out = {}, {}
    for i, k, t, ok in sorted(rows, key=lambda r: (r[2], r[0])):
        us = int((t - datetime(1970, 1, 1)) / timedelta(microseconds=1))
        m = machines.setdefault(k, machine())
        out[i] = m(us, ok) if values else m(us)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, k string, ts timestamp, success boolean")


@pytest.mark.parametrize("window,most", [(1000, 4), (1000, 1), (50, 3), (7000, 900), (4_000_000, 3), (1000, 0)])
def test_bucket_of_a_key_that_is_never_quiet(spark, window, most):
    rows = rows_of(3000, 7, [0, 0, 500, 1000, 30_000, 900_000, 2_500_000])
    want = plain(rows, lambda: TokenBucket(window, most))
    for busy in (0, 1000, 10**6):  # all keys by tables, the busy one, none
        got = {r.id: r.allowed for r in P.throttle_bucket(frame(spark, rows), "k", "ts", "id", window, most, busy=busy).collect()}
        assert got == want


def test_refills_of_blocks(spark, monkeypatch):
    """The tables of many small blocks lead to the same refills as one walk over all times."""
    monkeypatch.setattr(buckets, "BLOCK_MS", 300)
    rng = np.random.default_rng(1)
    times = np.unique(rng.integers(0, 40_000, 3000))
    times = times[(times < 15_000) | (times > 19_000)]
    df = spark.createDataFrame([("k", int(t)) for t in times], "k string, ms long")
    got = buckets.refills(df, "k", "ms", 100).collect()
    want = buckets.refill_times(times, buckets.FAR, 100)
    assert sorted(r.here for r in got if r.here is not None) == want.tolist()
    assert all(r.before == max([w for w in want if w < r.slot * 100], default=buckets.FAR) for r in got)


def test_a_busy_key_is_many_tasks(spark):
    rows = spark.range(200_000).select("id", F.lit("hot").alias("k"), F.timestamp_millis(F.col("id") * 997).alias("ts"))
    blocks = rows.select(F.floor(F.unix_millis("ts") / (1000 * buckets.WINDOWS))).distinct().count()
    assert blocks > 3000  # groups (key, block) of one key, each a work of its own
    out = P.throttle_bucket(rows, "k", "ts", "id", 1000, 2, busy=100_000)
    assert out.count() == 200_000


def arrivals(spark, rows, parts=3, late_ms=4000):
    """Deliveries in an order in which no row comes later than ``late_ms`` after a newer one."""
    rnd = random.Random(3)
    ordered = sorted(rows, key=lambda r: r[2] + timedelta(milliseconds=rnd.uniform(0, late_ms * 0.9)))
    size = -(-len(ordered) // parts)
    return [frame(spark, ordered[i : i + size]) for i in range(0, len(ordered), size)]


CASES = {
    "sliding": (lambda: SlidingWindow(1000, 3), lambda s: O.throttle_sliding(s, "k", "ts", "id", 1000, 3, "4 seconds"), False),
    "bucket": (lambda: TokenBucket(1000, 3, False), lambda s: O.throttle_bucket(s, "k", "ts", "id", 1000, 3, "4 seconds", faithful=False), False),
    "breaker": (lambda: Breaker(3, 50, 3000), lambda s: O.circuit_breaker(s, "k", "ts", "id", "4 seconds", least=3, open_ms=3000), True),
}


@pytest.mark.parametrize("name", list(CASES))
def test_streams_with_late_rows_and_restarts(spark, name):
    machine, run, values = CASES[name]
    rows = rows_of(400, 5, [0, 700, 150_000, 400_000])
    end = max(r[2] for r in rows)
    folder, out, log = (fresh_dir(spark, x) for x in ("in", "out", "log"))
    moved = 0
    for part in arrivals(spark, rows):
        part.write.mode("append").parquet(folder)
        answers = run(S.file_stream(spark, folder, part.schema, max_files=1000))
        with keyed_state(spark):
            S.finish(S.write_parquet(answers, out, log))
        moved += 1
    got = {r[1]: r[2] for r in spark.read.parquet(out).collect()}
    passed = end.replace(microsecond=end.microsecond // 1000 * 1000) - timedelta(seconds=4)
    want = {i: a for i, a in plain(rows, machine, values).items() if rows[i][2] <= passed}
    assert moved == 3 and len(want) > 300 and got == want
    assert len(set(want.values())) == (3 if values else 2)


def test_session_keeps_its_state_store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with keyed_state(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name, None) == before


def test_state_is_bounded_and_comes_back():
    m, n = SlidingWindow(1000, 5), SlidingWindow(1000, 5)
    for us in range(0, 10**7, 1000):
        m(us)
        assert len(m.save()) <= 5
    n.load(m.save())
    assert [n(us) for us in range(10**7, 2 * 10**7, 7000)] == [m(us) for us in range(10**7, 2 * 10**7, 7000)]
    m.tick(m.wakes())
    assert m.save() == [] and m.wakes() is None
    b = Breaker(1, 0, 100)
    assert [b(0, False), b(1000, True)] == ["failure", "blocked"] and b.wakes() == 100
    b.tick(b.wakes())
    assert b.wakes() is None and b(100_000, True) == "success"
