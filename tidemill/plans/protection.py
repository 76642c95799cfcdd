"""Stream protection and the two view architectures."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemill.operators import protect as P
from tidemill.operators import views as V
from tidemill.plans import inputs as I
from tidemill.plans.registry import SQL, query
from tidemill.plans.streams import shop_stream
from tidemill.session import fresh_dir, keyed_state
from tidemill.sources import streams as S
from tidemill.streaming import ordered as O

HOUR_MS = 3_600_000
# the table has a visit every few hours per user, so the windows are hours and the limits small
FIXED = """f AS (SELECT event_id, user_id, epoch_us(ts) // 86400000000 AS slot,
 row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 86400000000 ORDER BY ts, event_id) <= 2 AS allowed FROM events)"""


def calls(spark, sf):
    return I.events(spark, sf).select("event_id", "user_id", "ts")


def fixed(spark, sf):
    return P.throttle_fixed(calls(spark, sf), ["user_id"], "ts", "event_id", 86_400, 2)


@query("throttle_fixed_window", "win_fixed_throttle", sql=f"WITH {FIXED} SELECT event_id, slot, allowed FROM f")
def throttle_fixed(spark, sf):
    return fixed(spark, sf).select("event_id", "slot", "allowed")


@query("throttle_stats", sql=f"""WITH {FIXED} SELECT count(*) AS total, CAST(count_if(allowed) AS BIGINT) AS allowed, CAST(count_if(NOT allowed) AS BIGINT) AS throttled FROM f""")
def throttle_stats(spark, sf):
    return P.throttle_stats(fixed(spark, sf))


SEQ = "seq AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY us, event_id) AS i FROM src)"


@query("throttle_sliding_window", sql=f"""WITH RECURSIVE src AS (SELECT event_id, user_id AS k, epoch_us(ts) AS us FROM events), {SEQ},
 run AS (SELECT event_id, k, i, true AS allowed, [us] AS acc FROM seq WHERE i = 1 UNION ALL
  SELECT event_id, k, i, len(live) < 2, CASE WHEN len(live) < 2 THEN list_append(live, us) ELSE live END FROM (
   SELECT s.event_id, s.k, s.i, s.us, list_filter(r.acc, lambda t: t >= s.us - {12 * HOUR_MS}000) AS live FROM run r JOIN seq s ON s.k = r.k AND s.i = r.i + 1))
SELECT event_id, allowed FROM run""")
def sliding(spark, sf):
    return P.throttle_sliding(calls(spark, sf), "user_id", "ts", "event_id", 12 * HOUR_MS, 2).select("event_id", "allowed")


@query("throttle_token_bucket", sql=f"""WITH RECURSIVE src AS (SELECT event_id, user_id AS k, epoch_us(ts) AS us FROM events), {SEQ},
 run AS (SELECT event_id, k, i, true AS allowed, CAST(2 AS BIGINT) AS tokens, us // 1000 AS clock FROM seq WHERE i = 1 UNION ALL
  SELECT event_id, k, i, tok > 0, greatest(tok - 1, 0), clk FROM (
   SELECT s.event_id, s.k, s.i, CASE WHEN s.us // 1000 - r.clock >= {24 * HOUR_MS} THEN 3 ELSE least(3, r.tokens + (s.us // 1000 - r.clock) * 3 // {24 * HOUR_MS}) END AS tok,
    CASE WHEN s.us // 1000 - r.clock >= {24 * HOUR_MS} THEN s.us // 1000 ELSE r.clock END AS clk FROM run r JOIN seq s ON s.k = r.k AND s.i = r.i + 1))
SELECT event_id, allowed FROM run""")
def bucket(spark, sf):
    return P.throttle_bucket(calls(spark, sf), "user_id", "ts", "event_id", 24 * HOUR_MS, 3).select("event_id", "allowed")


# ---- the same throttles on a stream whose events come up to a day late, in three deliveries with a restart between them

LATE_S = 86_400
DECIDED = f"epoch_us(ts) <= (SELECT max(epoch_us(ts)) // 1000 - {LATE_S * 1000} FROM events) * 1000"


def delivered(df, spark, run, label):
    """Rows (with a column ts) arrive by a time up to a day after their own, in three deliveries, each a run of the same query:
    ``run(stream)`` gives its frame."""
    folder, out, log = (fresh_dir(spark, f"{label}-{x}") for x in ("in", "out", "log"))
    first, last = df.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()
    arrival = F.unix_seconds("ts") + F.pmod(F.col("event_id") * 7919, F.lit(LATE_S))
    third = F.floor((arrival - F.lit(first or 0)) * 3 / F.lit(max(1, (last or 0) - (first or 0) + 1)))
    schema = None
    for part in range(3):
        df.where(F.least(third, F.lit(2)) == part).write.mode("append").parquet(folder)
        frame = run(S.file_stream(spark, folder, df.schema, max_files=1_000_000))
        schema = frame.schema
        with keyed_state(spark):
            S.finish(S.write_parquet(frame, out, log))
    return spark.read.schema(schema).parquet(out)


def decided(name):
    """The rows of the table form that the watermark has passed."""
    return f"SELECT t.* FROM ({SQL[name]}) t JOIN events USING (event_id) WHERE {DECIDED}"


@query("throttle_sliding_window_live", sql=decided("throttle_sliding_window"))
def sliding_live(spark, sf):
    run = lambda s: O.throttle_sliding(s, "user_id", "ts", "event_id", 12 * HOUR_MS, 2, f"{LATE_S} seconds")
    return delivered(calls(spark, sf), spark, run, "sliding").select("event_id", "allowed")


@query("throttle_token_bucket_live", sql=decided("throttle_token_bucket"))
def bucket_live(spark, sf):
    run = lambda s: O.throttle_bucket(s, "user_id", "ts", "event_id", 24 * HOUR_MS, 3, f"{LATE_S} seconds")
    return delivered(calls(spark, sf), spark, run, "bucket").select("event_id", "allowed")


# ---- shedding: a buffer of 50 per six hours, high mark at 80 %
SHED = """r AS (SELECT event_id, ts, epoch_us(ts) // 21600000000 AS slot,
 row_number() OVER (PARTITION BY epoch_us(ts) // 21600000000 ORDER BY ts, event_id) AS rn FROM events)"""


def shedding(spark, sf, strategy):
    return P.shed(calls(spark, sf), "ts", "event_id", 21_600, 50, strategy)


@query("shed_drop", sql=f"WITH {SHED} SELECT event_id, slot, rn <= 40 AS kept FROM r")
def shed_drop(spark, sf):
    return shedding(spark, sf, "drop").select("event_id", "slot", "kept")


@query("shed_sample", sql=f"WITH {SHED} SELECT event_id, rn > 40 AS over_mark, rn <= 40 OR (rn - 40) % 10 = 0 AS kept FROM r")
def shed_sample(spark, sf):
    return shedding(spark, sf, "sample").select("event_id", "over_mark", "kept")


@query("shed_defer", sql=f"""WITH {SHED} SELECT event_id, true AS kept, CASE WHEN rn > 40 THEN (slot + 1) * 21600 - epoch_us(ts) // 1000000 ELSE 0 END AS delay_s FROM r""")
def shed_defer(spark, sf):
    return shedding(spark, sf, "defer").select("event_id", "kept", "delay_s")


# ---- retries and breakers; the outcome of an attempt follows from the event id
ATTEMPTS = """att AS (SELECT event_id, ts, user_id % 16 AS compartment, a AS attempt, (event_id * 7 + a * 3) % 10 > 5 AS success,
 event_id % 23 = 0 AS timed_out FROM events, (SELECT unnest(range(4)) AS a))"""


def attempts(spark, sf):
    ev = I.events(spark, sf).withColumn("attempt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(4)])))
    return ev.select(
        "event_id", "ts", (F.col("user_id") % 16).alias("compartment"), "attempt",
        ((F.col("event_id") * 7 + F.col("attempt") * 3) % 10 > 5).alias("success"),
        (F.col("event_id") % 23 == 0).alias("timed_out"),
    )


def delay_sql(policy):
    grow = {"fixed": "100", "linear": "100 * (attempt + 1)", "exponential": "100 * (1 << CAST(attempt AS INTEGER))", "none": "0"}[policy]
    return f"CAST(least(500, {grow}) AS BIGINT) AS {policy}"


@query("retry_delay", sql=f"WITH {ATTEMPTS} SELECT event_id, attempt, {', '.join(delay_sql(p) for p in ('fixed', 'linear', 'exponential', 'none'))} FROM att")
def delays(spark, sf):
    a = F.col("attempt")
    return attempts(spark, sf).select(
        "event_id", "attempt", *[P.retry_delay(p, a, 100, 500).alias(p) for p in ("fixed", "linear", "exponential", "none")]
    )


@query("retry_outcomes", sql=f"""WITH {ATTEMPTS}, g AS (SELECT event_id, min(attempt) FILTER (success) AS f FROM att GROUP BY 1)
SELECT event_id, coalesce(f, 3) + 1 AS attempts, coalesce(f, 3) AS retry_count, CASE WHEN f IS NULL THEN 'failed' ELSE 'success' END AS status FROM g""")
def outcomes(spark, sf):
    return P.retry_outcomes(attempts(spark, sf), 3)


OPEN_MS = 6 * HOUR_MS


@query("circuit_breaker", sql=f"""WITH RECURSIVE {ATTEMPTS}, src AS (SELECT event_id, compartment AS k, epoch_us(ts) AS us, success AS ok FROM att WHERE attempt = 0), {SEQ},
 run AS (SELECT event_id, k, i, CASE WHEN ok THEN 'success' ELSE 'failure' END AS outcome, CAST(NOT ok AS BIGINT) AS bad, CAST(ok AS BIGINT) AS good,
   CASE WHEN ok THEN 0 ELSE us // 1000 END AS last, false AS is_open FROM seq WHERE i = 1
  UNION ALL SELECT event_id, k, i, outcome, bad, good, last,
    CASE outcome WHEN 'blocked' THEN true WHEN 'success' THEN false ELSE bad >= 5 AND bad * 100 // (bad + good) > 50 END FROM (
   SELECT event_id, k, i, outcome, bad0 + CAST(outcome = 'failure' AS BIGINT) AS bad, good0 + CAST(outcome = 'success' AS BIGINT) AS good,
     CASE WHEN outcome = 'failure' THEN now ELSE last0 END AS last FROM (
    SELECT s.event_id, s.k, s.i, s.us // 1000 AS now, r.bad AS bad0, r.good AS good0, r.last AS last0,
     CASE WHEN r.is_open AND s.us // 1000 - r.last < {OPEN_MS} THEN 'blocked' WHEN s.ok THEN 'success' ELSE 'failure' END AS outcome
    FROM run r JOIN seq s ON s.k = r.k AND s.i = r.i + 1)))
SELECT event_id, outcome FROM run""")
def breaker(spark, sf):
    log = attempts(spark, sf).filter("attempt = 0")
    return P.circuit_breaker(log, "compartment", "ts", "event_id", open_ms=OPEN_MS).select("event_id", "outcome")


@query("circuit_breaker_live", sql=decided("circuit_breaker"))
def breaker_live(spark, sf):
    log = attempts(spark, sf).filter("attempt = 0")
    run = lambda s: O.circuit_breaker(s, "compartment", "ts", "event_id", f"{LATE_S} seconds", open_ms=OPEN_MS)
    return delivered(log, spark, run, "breaker").select("event_id", "outcome")


@query("compartment_health", sql=f"""WITH {ATTEMPTS}, g AS (SELECT compartment, count(*) AS n, avg(CASE WHEN success THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) AS f,
 avg(CASE WHEN timed_out THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS t FROM att GROUP BY 1)
SELECT compartment, n, round(f, 9) AS failure_rate, round(t, 9) AS timeout_rate, (f < 0.4 AND t < 0.05) AS healthy FROM g""")
def health(spark, sf):
    out = P.compartment_health(attempts(spark, sf), "compartment", bad=0.4)
    return out.withColumn("failure_rate", F.round("failure_rate", 9)).withColumn("timeout_rate", F.round("timeout_rate", 9))


# ---- views

CUTOFF = datetime(2024, 1, 20, 12)
KEYS = ["event_type"]
VIEW = "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, min(value) AS least, max(value) AS most FROM events WHERE {c} GROUP BY 1"
LIVE = f"SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, min(value) AS least, max(value) AS most, round(round(sum(value), 2) / count(*), 6) AS average FROM events GROUP BY 1"


def two(df):
    return df.withColumn("total", F.round("total", 2))


def history(spark, sf):
    """The batch view as a table that a nightly job would leave."""
    out = fresh_dir(spark, "batch-view")
    V.batch_view(I.shop(spark, sf), "event_time", CUTOFF, KEYS, "amount").write.parquet(out)
    return spark.read.parquet(out)


def recent(spark, sf):
    return S.updated(V.speed_view(shop_stream(spark, sf), "event_time", CUTOFF, KEYS, "amount"), "speed-view", KEYS)


@query("lambda_batch_view", sql=VIEW.format(c="ts <= TIMESTAMP '2024-01-20 12:00:00'"))
def batch_view(spark, sf):
    return two(history(spark, sf))


@query("lambda_speed_view", sql=VIEW.format(c="ts > TIMESTAMP '2024-01-20 12:00:00'"))
def speed_view(spark, sf):
    return two(recent(spark, sf))


@query("lambda_serving", "union_views", sql=LIVE)
def serving(spark, sf):
    out = two(V.serving_view(history(spark, sf), recent(spark, sf), KEYS))
    return out.withColumn("average", F.round(F.col("total") / F.col("n"), 6))


@query("kappa_stream", sql=VIEW.format(c="true"))
def kappa(spark, sf):
    return two(S.updated(V.partial_view(shop_stream(spark, sf), KEYS, "amount"), "kappa", KEYS))


REPLAY = """WITH i AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS log_index FROM events)
SELECT event_type, count(*) AS n, round(sum(value * 2), 2) AS total, min(value * 2) AS least, max(value * 2) AS most, 2 AS logic_version
FROM i WHERE log_index >= 100 AND log_index < 100 + (SELECT count(*) // 2 FROM events) GROUP BY 1"""


@query("kappa_replay", sql=REPLAY)
def replay(spark, sf):
    log = I.shop(spark, sf)
    piece = V.replay_slice(log, ["event_id"], 100, log.count() // 2)
    newer = piece.withColumn("amount", F.col("amount") * 2)  # the second version of the logic
    return two(V.partial_view(newer, KEYS, "amount")).withColumn("logic_version", F.lit(2))


@query("arch_stats", sql="""SELECT event_type, count(*) AS received, CAST(count_if(ts <= TIMESTAMP '2024-01-20 12:00:00') AS BIGINT) AS in_batch,
 CAST(count_if(ts > TIMESTAMP '2024-01-20 12:00:00') AS BIGINT) AS in_speed, (SELECT count(*) // 2 FROM events) AS replayed FROM events GROUP BY 1""")
def arch(spark, sf):
    ev = I.shop(spark, sf)
    return V.architecture_stats(ev, "event_time", CUTOFF, ev.count() // 2)
