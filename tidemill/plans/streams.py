"""Streaming queries: each runs over what is available now and gives its output table back."""

import functools

from pyspark.sql import functions as F

from tidemill.operators import clean
from tidemill.operators.protect import group_by_size
from tidemill.operators.rank import rank_in_group
from tidemill.plans import inputs as I
from tidemill.plans.registry import query
from tidemill.session import fresh_dir, keyed_state, table
from tidemill.sources import message_log, payloads, streams as S
from tidemill.streaming import monitor as M
from tidemill.streaming import state as ST
from tidemill.streaming import windows as W


def raw_stream(spark, sf, max_files=10):
    """The event files as a stream; the glob serves a single file and a folder of files."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    df = S.file_stream(spark, f"{sf}/event[s].parquet", schema, max_files=max_files)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def shop_stream(spark, sf):
    return I.shop_columns(raw_stream(spark, sf))


# The watermark stands at the newest event minus the allowed delay; windows that end later stay open.
def closed(delay, sql, end="window_end"):
    return f"SELECT * FROM ({sql}) WHERE {end} <= (SELECT max(ts) FROM events) - INTERVAL '{delay}'"


def bucket(length):
    return f"time_bucket(INTERVAL '{length}', event_time)"


DELAY = "epoch_us(event_time) // 1000 % 7"
TUMBLING = f"""SELECT {bucket('5 minutes')} AS window_start, {bucket('5 minutes')} + INTERVAL '5 minutes' AS window_end, event_type,
 CAST(count(*) AS BIGINT) AS event_count, count(DISTINCT user_id) AS unique_users, round(avg({DELAY}), 6) AS avg_delay, CAST(max({DELAY}) AS DOUBLE) AS max_delay
 FROM shop GROUP BY ALL"""


def delayed(df):
    # a stand-in for the time between an event and its arrival
    return df.withColumn("delay", (F.unix_millis("event_time") % 7).cast("double"))


@query("stream_tumbling", sql=f"WITH {I.SHOP} {TUMBLING}")
def tumbling(spark, sf):
    out = W.tumbling(delayed(I.shop(spark, sf)), delay="delay")
    return out.withColumn("avg_delay", F.round("avg_delay", 6))


@query("stream_tumbling_live", sql=f"WITH {I.SHOP} {closed('10 minutes', TUMBLING)}")
def tumbling_live(spark, sf):
    out = S.appended(W.tumbling(delayed(shop_stream(spark, sf)), delay="delay"), "tumbling")
    return out.withColumn("avg_delay", F.round("avg_delay", 6))


@query("stream_prod_metrics", sql=f"""WITH {I.SHOP} {closed('5 minutes', f'''SELECT {bucket('1 minute')} AS window_start, {bucket('1 minute')} + INTERVAL '1 minute' AS window_end,
 event_type, CAST(count(*) AS BIGINT) AS event_count, count(DISTINCT user_id) AS unique_users FROM shop GROUP BY ALL''')}""")
def prod(spark, sf):
    good, _ = clean.validate_split(shop_stream(spark, sf), ["user_id", "event_time"])
    out = S.appended(W.tumbling(good, "1 minute", "5 minutes"), "metrics")
    return out.drop("avg_delay", "max_delay")


SLIDING = """SELECT w AS window_start, w + INTERVAL '10 minutes' AS window_end, user_id, count(*) AS user_events,
 string_agg(event_type, ',' ORDER BY event_time) AS event_sequence, min(event_time) AS first_event, max(event_time) AS last_event
 FROM (SELECT *, unnest([time_bucket(INTERVAL '2 minutes', event_time) - INTERVAL '2 minutes' * i for i in range(5)]) AS w FROM shop) GROUP BY ALL"""


def joined_sequence(df):
    return df.withColumn("event_sequence", F.array_join("event_sequence", ","))


@query("stream_sliding", sql=f"WITH {I.SHOP} {closed('15 minutes', SLIDING)}")
def sliding(spark, sf):
    return joined_sequence(S.appended(W.sliding(shop_stream(spark, sf)), "sliding"))


BY_ID = """SELECT user_id, session_id, min(event_time) AS session_start, max(event_time) AS session_end, count(*) AS session_events,
 CAST(count_if(event_type = 'purchase') AS BIGINT) AS purchases, array_to_string(list_sort(list_distinct(list(product_id))), ',') AS viewed_products,
 CAST(epoch(date_trunc('second', max(event_time))) - epoch(date_trunc('second', min(event_time))) AS BIGINT) AS session_duration FROM shop GROUP BY 1, 2"""


@query("stream_session_by_id", sql=f"WITH {I.SHOP} {BY_ID}")
def by_id(spark, sf):
    out = S.updated(W.sessions_by_id(shop_stream(spark, sf)), "sessions", ["user_id", "session_id"])
    return out.withColumn("viewed_products", F.array_join("viewed_products", ","))


GAP = f"""SELECT user_id, min(event_time) AS session_start, max(event_time) + INTERVAL '30 minutes' AS session_end, count(*) AS events, round(sum(amount), 2) AS total_value
 FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_time) AS no FROM (SELECT *,
  CASE WHEN event_time - lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time) <= INTERVAL '30 minutes' THEN 0 ELSE 1 END AS new FROM shop))
 GROUP BY user_id, no"""


@query("stream_session_by_gap", sql=f"WITH {I.SHOP} {GAP}")
def by_gap(spark, sf):
    return W.sessions_by_gap(I.shop(spark, sf)).withColumn("total_value", F.round("total_value", 2))


@query("stream_session_by_gap_live", sql=f"WITH {I.SHOP} {closed('30 minutes', GAP, 'session_end')}")
def by_gap_live(spark, sf):
    out = S.appended(W.sessions_by_gap_stream(shop_stream(spark, sf)), "gaps")
    return out.withColumn("total_value", F.round("total_value", 2))


@query("stream_stateful_session", sql=f"""WITH {I.SHOP}, g AS ({GAP}),
 r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY session_start DESC) AS newest FROM g)
SELECT user_id, session_start, round(epoch_us(session_end - INTERVAL '30 minutes') / 1e6 - epoch_us(session_start) / 1e6, 3) AS session_duration,
 events AS total_events, total_value, 'timeout' AS session_end_reason
FROM r WHERE newest > 1 OR session_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""")
def stateful(spark, sf):
    with keyed_state(spark):
        out = S.appended(ST.sessions_on_timeout(shop_stream(spark, sf)), "stateful")
    return out.withColumn("total_value", F.round("total_value", 2)).withColumn("session_duration", F.round("session_duration", 3))


FRAUD = """SELECT user_id, time_bucket(INTERVAL '2 minutes', event_time) AS window_start, count(*) AS transaction_count, round(sum(amount), 2) AS total_amount,
 CASE WHEN count(*) > 1 THEN 'high_frequency' ELSE 'high_value' END AS alert_type, round(count(*) * 10 + sum(amount) / 1000, 6) AS risk_score
 FROM shop WHERE event_type = 'purchase' GROUP BY 1, 2 HAVING count(*) > 1 OR sum(amount) > 100"""


def shaped_alerts(df):
    return df.drop("amounts").withColumn("total_amount", F.round("total_amount", 2)).withColumn("risk_score", F.round("risk_score", 6))


@query("stream_fraud", sql=f"WITH {I.SHOP} {FRAUD}")
def fraud(spark, sf):
    # lower limits than the defaults, as the amounts of the table are small
    return shaped_alerts(W.fraud_alerts(I.shop(spark, sf), most=1, limit=100.0))


@query("stream_fraud_live", sql=f"WITH {I.SHOP} {closed('5 minutes', FRAUD, chr(34) + 'window_start' + chr(34) + ' + INTERVAL ' + chr(39) + '2 minutes' + chr(39))}")
def fraud_live(spark, sf):
    return shaped_alerts(S.appended(W.fraud_alerts(shop_stream(spark, sf), most=1, limit=100.0), "fraud"))


CARTS = """SELECT user_id, session_id, count(*) AS events FROM shop GROUP BY 1, 2
 HAVING count_if(event_type = 'click') > 0 AND count_if(event_type = 'purchase') = 0"""


@query("stream_cart_abandon", sql=f"WITH {I.SHOP} {CARTS}")
def carts(spark, sf):
    out = S.completed(W.abandoned_carts(shop_stream(spark, sf), add="click"), "carts")
    return out.select("user_id", "session_id", "events")


WORDS = "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1"


@query("stream_wordcount", "src_text_lines", sql=WORDS)
def words(spark, sf):
    folder = fresh_dir(spark, "lines")
    table(spark, sf, "part").select(F.col("p_name").alias("value")).write.text(folder)
    return S.completed(W.word_counts(S.text_stream(spark, folder)), "words")


def staged(spark, sf, keep):
    """Events whose condition holds, appended as one more file set to a folder."""
    return I.events(spark, sf).filter(keep)


@query("late_data_drop", sql=f"""WITH {I.SHOP}, a AS (SELECT *, event_id % 10 <> 0 AS early FROM shop),
 w1 AS (SELECT max(event_time) - INTERVAL '10 minutes' AS t FROM a WHERE early), w2 AS (SELECT max(event_time) - INTERVAL '10 minutes' AS t FROM a)
SELECT b AS window_start, event_type, CAST(count(*) AS BIGINT) AS event_count
FROM (SELECT *, time_bucket(INTERVAL '5 minutes', event_time) AS b FROM a)
WHERE (early OR b + INTERVAL '5 minutes' > (SELECT t FROM w1)) AND b + INTERVAL '5 minutes' <= (SELECT t FROM w2) GROUP BY 1, 2""")
def late(spark, sf):
    # every tenth event arrives in a second delivery, mostly behind the watermark of the first
    folder, out, log = (fresh_dir(spark, x) for x in ("late-in", "late-out", "late-log"))
    first = F.col("event_id") % 10 != 0
    result = None
    for part in (first, ~first):
        I.shop_columns(staged(spark, sf, part)).write.mode("append").parquet(folder)
        stream = S.file_stream(spark, folder, I.shop(spark, sf).schema, max_files=1_000_000)
        result = W.tumbling(stream)
        S.finish(S.write_parquet(result, out, log))
    return spark.read.schema(result.schema).parquet(out).select("window_start", "event_type", "event_count")


@query("stream_checkpoint_restart", sql="SELECT event_id, count(*) AS times FROM events GROUP BY 1")
def restart(spark, sf):
    folder, out, log = (fresh_dir(spark, x) for x in ("restart-in", "restart-out", "restart-log"))
    half = F.col("event_id") % 2 == 0
    for part in (half, ~half):
        I.shop_columns(staged(spark, sf, part)).write.mode("append").parquet(folder)
        stream = S.file_stream(spark, folder, I.shop(spark, sf).schema)
        S.finish(S.write_parquet(stream.select("event_id"), out, log))  # the second run goes on where the first ended
    return spark.read.parquet(out).groupBy("event_id").agg(F.count(F.lit(1)).alias("times"))


# days are closed when the watermark, ten minutes behind the newest event, has passed their end
CLOSED_DAYS = "SELECT time_bucket(INTERVAL '1 day', ts) AS d, event_type, count(*) AS n FROM events GROUP BY 1, 2"
ALL_EVENTS = "SELECT event_type, count(*) AS n FROM events GROUP BY 1"


@query("stream_triggers_modes", sql=f"""SELECT 'complete' AS mode, 'available now' AS trigger, * FROM ({ALL_EVENTS})
UNION ALL SELECT 'update', 'available now', * FROM ({ALL_EVENTS}) UNION ALL SELECT 'update', 'processing time', * FROM ({ALL_EVENTS})
UNION ALL SELECT 'append', trigger, event_type, CAST(sum(n) AS BIGINT) FROM ({CLOSED_DAYS}), (SELECT unnest(['available now', 'processing time']) AS trigger)
 WHERE d + INTERVAL '1 day' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes' GROUP BY ALL""")
def modes(spark, sf):
    stream = lambda: shop_stream(spark, sf)
    total = lambda: stream().groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    day = F.window("event_time", "1 day").alias("w")
    days = lambda: stream().withWatermark("event_time", "10 minutes").groupBy(day, "event_type").agg(F.count(F.lit(1)).alias("n"))
    soon = {"processingTime": "100 milliseconds"}
    sums = lambda df: df.groupBy("event_type").agg(F.sum("n").alias("n"))
    parts = [
        ("complete", "available now", S.completed(total(), "complete")),
        ("update", "available now", S.updated(total(), "update", ["event_type"])),
        ("update", "processing time", S.updated(total(), "update-timed", ["event_type"], trigger=soon)),
        ("append", "available now", sums(S.appended(days(), "append"))),
        ("append", "processing time", sums(S.appended(days(), "append-timed", trigger=soon))),
    ]
    rows = [df.select(F.lit(m).alias("mode"), F.lit(t).alias("trigger"), "event_type", "n") for m, t, df in parts]
    return functools.reduce(lambda a, b: a.unionByName(b), rows)


@query("stream_progress_metrics", sql="SELECT 'progress' AS name, count(*) AS n_rows, false AS long_batch FROM events")
def progress(spark, sf):
    q = (
        shop_stream(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        .writeStream.format("noop").outputMode("complete").queryName("progress")
        .option("checkpointLocation", fresh_dir(spark, "progress")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    rows = M.alarms(M.progress_table(spark, [M.facts(p) for p in q.recentProgress]))
    return rows.groupBy("name").agg(F.sum("n_rows").alias("n_rows"), F.max("long_batch").alias("long_batch"))


@query("stream_dead_letter", sql=f"""WITH {I.SHOP} SELECT CASE WHEN product_id = '7' THEN 'invalid' ELSE 'valid' END AS sink, count(*) AS n FROM shop GROUP BY 1""")
def dead_letter(spark, sf):
    def side(ok):
        df = shop_stream(spark, sf).withColumn("user_id", F.expr("CASE WHEN product_id = '7' THEN NULL ELSE user_id END"))
        return clean.validate_split(df, ["user_id", "event_time"])[0 if ok else 1]

    parts = [S.appended(side(ok), name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("sink"), "n") for ok, name in ((True, "valid"), (False, "invalid"))]
    return parts[0].unionByName(parts[1])


@query("stream_dedup", sql="SELECT event_id, user_id FROM events")
def dedup(spark, sf):
    folder = fresh_dir(spark, "copies")
    ev = I.shop(spark, sf)
    # errors are delivered twice, a third of them three times
    twice = ev.unionByName(ev.filter("event_type = 'error'")).unionByName(ev.filter("event_type = 'error' AND event_id % 3 = 0"))
    twice.write.parquet(folder)
    stream = S.file_stream(spark, folder, ev.schema, max_files=1_000_000).withWatermark("event_time", "1 hour")
    out = S.appended(stream.dropDuplicatesWithinWatermark(["event_id"]), "firsts")
    return out.select("event_id", F.col("user_id").cast("long").alias("user_id"))


@query("stream_micro_batch_group", sql="""SELECT event_id, CAST(slot * 1000 + (rn - 1) // 10 AS BIGINT) AS batch_no FROM (
 SELECT event_id, slot, row_number() OVER (PARTITION BY slot ORDER BY ts, event_id) AS rn FROM (
  SELECT *, epoch_us(ts) // 21600000000 AS slot FROM events))""")
def micro_batches(spark, sf):
    # a batch ends after six hours or ten events, in the spacing of this table
    out = group_by_size(I.events(spark, sf), "ts", "event_id", seconds=21600, most=10)
    return out.select("event_id", (F.col("slot") * 1000 + F.col("part")).alias("batch_no"))


# ---- sources and sinks of streams


@query("src_file_stream", sql=f"""WITH {I.SHOP} SELECT event_id, user_id, event_type, amount FROM shop""")
def src_files(spark, sf):
    folder = fresh_dir(spark, "json-in")
    ev = I.shop(spark, sf)
    ev.write.json(folder)
    stream = S.file_stream(spark, folder, ev.schema, fmt="json", max_files=10)
    return S.appended(stream.select("event_id", "user_id", "event_type", "amount"), "json-out")


MESSAGES = f"""SELECT event_id AS offset_no, user_id, event_type, date_trunc('millisecond', event_time) AS event_time, amount,
 product_id, CAST(hour(event_time) AS INTEGER) AS hour, CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week FROM shop"""


@query("src_kafka", sql=f"WITH {I.SHOP} {MESSAGES}")
def messages(spark, sf):
    # the connector is not on the class path here: the same envelope comes from files
    folder = fresh_dir(spark, "log-in")
    log = I.envelopes(I.events(spark, sf))
    log.write.parquet(folder)
    parsed = payloads.message_events(S.file_stream(spark, folder, log.schema))
    return S.appended(
        parsed.select(F.col("offset").alias("offset_no"), "user_id", "event_type", "event_time", "amount", "product_id", "hour", "day_of_week"),
        "log-out",
    )


MESSAGES_PER_TRIGGER = 4000


@query("src_kafka_bounded", sql=f"""WITH {I.SHOP} SELECT m.* EXCLUDE (offset_no), l.offset_no, (SELECT CAST(ceil(count(*) / {MESSAGES_PER_TRIGGER}.0) AS BIGINT) FROM events) AS micro_batches
FROM ({MESSAGES}) m JOIN (SELECT event_id, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS offset_no FROM events) l ON l.event_id = m.offset_no""")
def bounded(spark, sf):
    # offsets count up in each partition, as in a log
    folder, progress, out, checkpoint = (fresh_dir(spark, x) for x in ("log", "log-progress", "bounded", "bounded-log"))
    log = rank_in_group(I.envelopes(I.events(spark, sf)), ["partition"], ["offset"], "rank")
    message_log.write_log(log.withColumn("offset", F.col("rank") - 1), folder)
    parsed = payloads.message_events(message_log.log_stream(spark, folder, progress, MESSAGES_PER_TRIGGER))
    soon = {"processingTime": "0 seconds"}
    S.finish(S.write_versions(parsed, out, checkpoint, "append", trigger=soon), soon)
    rows = spark.read.parquet(out)
    batches = rows.select("batch").distinct().count()
    return rows.select(
        F.col("offset").alias("offset_no"), "user_id", "event_type", "event_time", "amount", "product_id", "hour", "day_of_week",
        F.lit(batches).cast("long").alias("micro_batches"),
    )


@query("parse_kafka_events", sql=f"WITH {I.SHOP} SELECT *, 0.0::DOUBLE AS delay_seconds FROM ({MESSAGES})")
def parsed(spark, sf):
    out = payloads.message_events(I.envelopes(I.events(spark, sf)))
    return out.select(
        F.col("offset").alias("offset_no"), "user_id", "event_type", "event_time", "amount", "product_id", "hour", "day_of_week", "delay_seconds"
    )


@query("sink_console", sql="SELECT count(*) AS n_rows FROM events WHERE event_type = 'error'")
def console(spark, sf):
    q = S.write_console(shop_stream(spark, sf).filter("event_type = 'error'"), rows=0)
    q.awaitTermination()
    read = spark.createDataFrame([(p.sink.numOutputRows, p.numInputRows) for p in q.recentProgress], "n_out long, n_in long")
    # the sink does not report its rows, so the source rows are counted against the table
    ok = read.agg(F.sum("n_in")).first()[0] == I.events(spark, sf).count()
    return I.shop(spark, sf).filter("event_type = 'error'").filter(F.lit(ok)).agg(F.count(F.lit(1)).alias("n_rows"))


@query("sink_kafka", sql=f"""WITH {I.SHOP} SELECT '{{"event_id":' || event_id || ',"user_id":"' || user_id || '","event_type":"' || event_type || '"}}' AS value
FROM shop WHERE event_type = 'error'""")
def kafka_rows(spark, sf):
    alerts = I.shop(spark, sf).filter("event_type = 'error'").select("event_id", "user_id", "event_type")
    return payloads.as_messages(alerts)


@query("sink_kafka_update", sql=f"""WITH {I.SHOP} SELECT '{{"day":"' || CAST(event_time AS DATE) || '","event_type":"' || event_type || '","n":' || count(*) || '}}' AS value
FROM shop GROUP BY CAST(event_time AS DATE), event_type""")
def kafka_updates(spark, sf):
    day = F.to_date("event_time").cast("string").alias("day")
    per = shop_stream(spark, sf).groupBy(day, "event_type").agg(F.count(F.lit(1)).alias("n"))
    return payloads.as_messages(S.updated(per, "kafka-update", ["day", "event_type"]).select("day", "event_type", "n"))


PER_MINUTE = f"SELECT {bucket('1 minute')} AS window_start, event_type, count(*) AS n FROM shop GROUP BY ALL"


def per_minute(df):
    agg = df.withWatermark("event_time", "10 minutes").groupBy(F.window("event_time", "1 minute").alias("w"), "event_type")
    return agg.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


@query("sink_table_complete", sql=f"WITH {I.SHOP} {PER_MINUTE}")
def complete_table(spark, sf):
    return S.completed(per_minute(shop_stream(spark, sf)), "complete-table")


@query("sink_foreach_batch", sql=f"WITH {I.SHOP} {PER_MINUTE}")
def foreach(spark, sf):
    return S.updated(per_minute(shop_stream(spark, sf)), "upserts", ["window_start", "event_type"])


@query("sink_parquet_partitioned", sql=f"""WITH {I.SHOP} SELECT CAST(event_time AS DATE) AS date, count(*) AS n FROM shop GROUP BY 1""")
def partitioned(spark, sf):
    df = shop_stream(spark, sf).select("user_id", "event_time", "event_type", F.to_date("event_time").alias("date"))
    return S.appended(df, "activity", by=["date"]).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("sink_multi", sql=f"""WITH {I.SHOP} SELECT 'alerts' AS output, count(*) AS n FROM shop WHERE event_type = 'error'
UNION ALL SELECT 'activity', count(*) FROM shop UNION ALL SELECT 'metrics', count(*) FROM ({PER_MINUTE})""")
def multi(spark, sf):
    out = fresh_dir(spark, "multi")
    outputs = {
        "alerts": lambda d: d.filter("event_type = 'error'").select("event_time", "user_id", "event_type"),
        "activity": lambda d: d.select("user_id", "event_time", "event_type", F.to_date("event_time").alias("date")),
        "metrics": lambda d: d.groupBy(F.window("event_time", "1 minute").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")),
    }
    S.finish(S.write_each(shop_stream(spark, sf), outputs, out, fresh_dir(spark, "multi-log")))
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    keyed = {
        "alerts": read("alerts"), "activity": read("activity"),
        "metrics": read("metrics").groupBy("w", "event_type").agg(F.sum("n").alias("n")),  # a window may span batches
    }
    parts = [d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("output"), "n") for k, d in keyed.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
