from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemill.session import fresh_dir, keyed_state
from tidemill.sources import payloads, streams as S
from tidemill.streaming import monitor as M
from tidemill.streaming import state as ST
from tidemill.streaming import windows as W

BASE = datetime(2024, 3, 1, 12)
SCHEMA = "event_id long, event_time timestamp, user_id string, event_type string, product_id string, session_id string, amount double"


def event(i, minute, user="u", kind="view", amount=1.0):
    return (i, BASE + timedelta(minutes=minute), user, kind, "p", f"{user}-1", amount)


def deliver(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return S.file_stream(spark, folder, SCHEMA, max_files=1000)


def test_late_rows_are_dropped(spark):
    folder, out, log = (fresh_dir(spark, x) for x in ("t-in", "t-out", "t-log"))
    for rows in ([event(1, 0), event(2, 120)], [event(3, 1), event(4, 240)]):
        deliver(spark, folder, rows)
        df = W.tumbling(source(spark, folder))
        S.finish(S.write_parquet(df, out, log))
    got = spark.read.parquet(out).orderBy("window_start").collect()
    assert [(r.window_start, r.event_count) for r in got] == [(BASE, 1), (BASE + timedelta(minutes=120), 1)]


def test_stateful_session_over_batches(spark):
    folder, out, log = (fresh_dir(spark, x) for x in ("s-in", "s-out", "s-log"))
    # the first session spans two deliveries; the second delivery also opens and ends another one
    for rows in ([event(1, 0), event(2, 20, amount=2.0)], [event(3, 45), event(4, 100), event(5, 110)], [event(6, 400, user="w")]):
        deliver(spark, folder, rows)
        with keyed_state(spark):
            S.finish(S.write_parquet(ST.sessions_on_timeout(source(spark, folder)), out, log))
    got = sorted((r.user_id, r.session_duration, r.total_events, r.total_value) for r in spark.read.parquet(out).collect())
    assert got == [("u", 600.0, 2, 2.0), ("u", 2700.0, 3, 4.0)]


def test_fraud_fixture(spark):
    rows = [event(i, i / 3.1, kind="purchase", amount=50.0) for i in range(6)]
    r = W.fraud_alerts(spark.createDataFrame(rows, SCHEMA)).first()
    assert (r.alert_type, r.transaction_count, r.total_amount) == ("high_frequency", 6, 300.0)
    assert abs(r.risk_score - 60.3) < 1e-9


def test_gap_sessions_of_a_busy_user(spark):
    times = [0, 10, 39.99, 69.98, 100, 130, 160.5, 191, 400]
    rows = [event(i, t, user="hot") for i, t in enumerate(times)] + [event(100, 5, user="other")]
    got = W.sessions_by_gap(spark.createDataFrame(rows, SCHEMA)).orderBy("user_id", "session_start").collect()
    want, n, last = [], 0, None
    for t in times:
        if last is not None and t - last > 30:
            want.append(n)
            n = 0
        n, last = n + 1, t
    assert [r.events for r in got] == want + [n] + [1]


def test_replayed_batch_is_written_once(spark):
    folder, out = fresh_dir(spark, "r-in"), fresh_dir(spark, "r-out")
    deliver(spark, folder, [event(1, 0), event(2, 1)])
    agg = lambda: source(spark, folder).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    for log in (fresh_dir(spark, "r-log"), fresh_dir(spark, "r-log")):  # the same batch id comes twice
        S.finish(S.write_versions(agg(), out, log, "update"))
    assert [tuple(r) for r in S.latest_rows(spark, out, ["user_id"]).collect()] == [("u", 2)]


def test_message_round_trip(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "id long, t string, x double")
    assert payloads.as_messages(df, key="id").first().asDict() == {"key": "1", "value": '{"id":1,"t":"a","x":2.5}'}
    bad = spark.createDataFrame([("t", 0, 1, BASE, "no json")], "topic string, partition int, offset long, timestamp timestamp, value string")
    assert payloads.message_events(bad).first().event_id is None


def test_alarms(spark):
    rows = [("q", 0, 10, 20_000.0, 10, 0), ("q", 1, 10, 1.0, 61_000, 0), ("q", 2, 10, 1.0, 1, 0)]
    got = M.alarms(M.progress_table(spark, rows)).orderBy("batch_id").collect()
    assert [(r.high_rate, r.long_batch) for r in got] == [(True, False), (False, True), (False, False)]
