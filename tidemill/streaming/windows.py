"""Windowed and per-session aggregates; the same code runs on tables and on streams.

Inputs have event_time, user_id, event_type, product_id, session_id and amount.
Watermarks are set here; on a table they have no effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ONE = F.lit


def tumbling(df: DataFrame, length: str = "5 minutes", late: str = "10 minutes", delay: str | None = None) -> DataFrame:
    """Events, exact distinct users and (with a delay column) mean and greatest delay per window and type.

    Two steps: per window, type and user, then per window and type.  The distinct
    count needs no set of users in the state, and a busy window is spread over its users.
    """
    d = F.col(delay) if delay else F.lit(None).cast("double")
    per_user = (
        df.withWatermark("event_time", late)
        .groupBy(F.window("event_time", length).alias("w"), "event_type", "user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(d).alias("delays"), F.count(d).alias("n_delays"), F.max(d).alias("max_delay"))
    )
    both = per_user.groupBy(F.window(F.window_time("w"), length).alias("w2"), "event_type").agg(
        F.sum("n").alias("event_count"),
        F.count("user_id").alias("unique_users"),
        F.try_divide(F.sum("delays"), F.sum("n_delays")).alias("avg_delay"),
        F.max("max_delay").alias("max_delay"),
    )
    return both.select(
        F.col("w2.start").alias("window_start"), F.col("w2.end").alias("window_end"),
        "event_type", "event_count", "unique_users", "avg_delay", "max_delay",
    )


def sliding(df: DataFrame, length: str = "10 minutes", slide: str = "2 minutes", late: str = "15 minutes") -> DataFrame:
    """Per user and overlapping window: events, their types in time order, first and last time.

    Windows share panes: events are summed once per user and pane of the slide's length, and only panes are copied
    to the windows that hold them, so an event is shuffled and kept once.  The length is a multiple of the slide.
    """
    steps = F.array_sort(F.collect_list(F.struct("event_time", "event_type")))
    panes = (
        df.withWatermark("event_time", late)
        .groupBy(F.window("event_time", slide).alias("p"), "user_id")
        .agg(F.count(F.lit(1)).alias("n"), steps.alias("steps"), F.min("event_time").alias("a"), F.max("event_time").alias("z"))
    )
    out = panes.groupBy(F.window(F.window_time("p"), length, slide).alias("w"), "user_id").agg(
        F.sum("n").alias("user_events"), F.array_sort(F.flatten(F.collect_list("steps"))).alias("steps"),
        F.min("a").alias("first_event"), F.max("z").alias("last_event"),
    )
    return out.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "user_id", "user_events",
        F.col("steps.event_type").alias("event_sequence"), "first_event", "last_event",
    )


def sessions_by_id(df: DataFrame, late: str = "30 minutes") -> DataFrame:
    """Per user and session id: start, end, events, purchases, products, length in seconds."""
    out = (
        df.withWatermark("event_time", late)
        .groupBy("user_id", "session_id")
        .agg(
            F.min("event_time").alias("session_start"),
            F.max("event_time").alias("session_end"),
            F.count(F.lit(1)).alias("session_events"),
            F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("purchases"),
            F.array_sort(F.collect_set("product_id")).alias("viewed_products"),
        )
    )
    seconds = F.unix_timestamp("session_end") - F.unix_timestamp("session_start")
    return out.withColumn("session_duration", seconds)


def sessions_by_gap_stream(df: DataFrame, gap: str = "30 minutes", late: str = "30 minutes") -> DataFrame:
    """Sessions that end after a quiet gap."""
    out = (
        df.withWatermark("event_time", late)
        .groupBy(F.session_window("event_time", gap).alias("w"), "user_id")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("amount").alias("total_value"))
    )
    return out.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events", "total_value")


def sessions_by_gap(df: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """The same sessions on a table, without one task per busy user.

    Events of one user in one aligned slot of the gap's length are closer than the
    gap, so they share a session.  They are summed per slot first (combined before
    the shuffle); only the slots are then chained, and their number is bounded by time.
    """
    us = gap_seconds * 1_000_000
    t = F.unix_micros("event_time")
    slots = df.groupBy("user_id", F.floor(t / us).alias("slot")).agg(
        F.min(t).alias("a"), F.max(t).alias("z"), F.count(F.lit(1)).alias("n"), F.sum("amount").alias("v")
    )
    w = Window.partitionBy("user_id").orderBy("slot")
    # exactly one gap apart still belongs together, as in session_window
    new = F.when(F.col("a") - F.lag("z").over(w) <= us, 0).otherwise(1)
    numbered = slots.withColumn("new", new).withColumn("no", F.sum("new").over(w))
    out = numbered.groupBy("user_id", "no").agg(
        F.min("a").alias("a"), F.max("z").alias("z"), F.sum("n").alias("events"), F.sum("v").alias("total_value")
    )
    return out.select(
        "user_id", F.timestamp_micros("a").alias("session_start"), F.timestamp_micros(F.col("z") + us).alias("session_end"),
        "events", "total_value",
    )


def fraud_alerts(df: DataFrame, most: int = 5, limit: float = 10_000.0, length: str = "2 minutes", late: str = "5 minutes") -> DataFrame:
    """Users with many or expensive purchases in a short window, with a risk score."""
    out = (
        df.withWatermark("event_time", late)
        .filter(F.col("event_type") == "purchase")
        .groupBy("user_id", F.window("event_time", length).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("amount").alias("total_amount"),
            F.array_sort(F.collect_list("amount")).alias("amounts"),
        )
    )
    many, much = F.col("transaction_count") > most, F.col("total_amount") > limit
    return out.filter(many | much).select(
        "user_id", F.col("w.start").alias("window_start"), "transaction_count", "total_amount", "amounts",
        F.when(many, "high_frequency").otherwise("high_value").alias("alert_type"),
        (F.col("transaction_count") * 10 + F.col("total_amount") / 1000).alias("risk_score"),
    )


def abandoned_carts(df: DataFrame, add: str = "add_to_cart", buy: str = "purchase", late: str = "1 hour") -> DataFrame:
    """Sessions that put something in the cart and bought nothing; two flags instead of the event list."""
    has = lambda kind: F.max((F.col("event_type") == kind).cast("int"))
    out = (
        df.withWatermark("event_time", late)
        .groupBy("user_id", "session_id")
        .agg(has(add).alias("has_add"), has(buy).alias("has_buy"), F.count(F.lit(1)).alias("events"))
    )
    return out.filter("has_add = 1 AND has_buy = 0").select("user_id", "session_id", "events")


def word_counts(lines: DataFrame) -> DataFrame:
    """Words between single blanks, case kept."""
    return lines.select(F.explode(F.split("value", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
