"""Stream protection as columns over an event table: throttles, shedding, retries, breakers."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.buckets import token_bucket
from tidemill.operators.rank import rank_in_group
from tidemill.operators.steps import Breaker, SlidingWindow, TokenBucket
from tidemill.session import cut, small


def retry_delay(policy: str, attempt: Column, base_ms: int, cap_ms: int, jitter: float = 0.0, seed: Column | None = None) -> Column:
    """Wait before the retry with the given number (from 0), in milliseconds.

    Jitter stretches the capped delay by up to its share; the stretch comes from a
    digest of ``seed``, so that a recomputed task gives the same delay.
    """
    a = attempt.cast("long")
    if policy == "fixed":
        delay = F.lit(base_ms).cast("long")
    elif policy == "linear":
        delay = F.lit(base_ms) * (a + 1)
    elif policy == "exponential":
        # the power stops growing at the cap, so no attempt number can overflow
        delay = F.lit(base_ms) * F.pow(F.lit(2), F.least(a, F.lit(30))).cast("long")
    elif policy == "none":
        return F.lit(0).cast("long")
    else:
        raise ValueError(f"unknown retry policy {policy}")
    delay = F.least(delay, F.lit(cap_ms)).cast("long")
    if jitter > 0:
        part = F.conv(F.substring(F.md5(F.concat_ws("/", seed, a)), 1, 8), 16, 10).cast("double") / float(1 << 32)
        delay = F.floor(delay * (1 + part * F.lit(jitter))).cast("long")
    return delay


def group_by_size(df: DataFrame, ts: str, id_col: str, seconds: int = 5, most: int = 1000) -> DataFrame:
    """Batches that end with their time slot or after a number of rows: slot, part (from 0)."""
    slotted = df.withColumn("slot", F.floor(F.unix_timestamp(ts) / seconds))
    ranked = rank_in_group(slotted, ["slot"], [ts, id_col], "__rank")
    return ranked.withColumn("part", F.floor((F.col("__rank") - 1) / most)).drop("__rank")


# ---- throttles

#: rows beyond which a key is not one sequence
BUSY = 1_000_000


def throttle_fixed(df: DataFrame, keys: list[str], ts: str, id_col: str, window_s: int, most: int) -> DataFrame:
    """Add ``allowed``: at most ``most`` rows per key and aligned window, in time order."""
    slotted = df.withColumn("slot", F.floor(F.unix_micros(ts) / (window_s * 1_000_000)))
    ranked = rank_in_group(slotted, [*keys, "slot"], [ts, id_col], "__rank")
    return ranked.withColumn("allowed", F.col("__rank") <= most).drop("__rank")


def quiet_segments(df: DataFrame, key: str, ts: str, gap_us: int, equal_ends: bool) -> DataFrame:
    """Add ``segment``: it grows where a key was quiet for more than the gap (or exactly the gap, with ``equal_ends``).

    Rows are summed per key and slot of the gap's length first; a slot cannot hold a
    quiet time that long, so only slots are compared and a busy key is not sorted in one task.
    """
    slot = F.floor(F.unix_micros(ts) / gap_us)
    rows = df.withColumn("__slot", slot)
    spans = rows.groupBy(key, "__slot").agg(F.min(F.unix_micros(ts)).alias("a"), F.max(F.unix_micros(ts)).alias("z"))
    w = Window.partitionBy(key).orderBy("__slot")
    quiet = F.col("a") - F.lag("z").over(w)
    new = quiet >= gap_us if equal_ends else quiet > gap_us
    starts = spans.withColumn("segment", F.sum(F.when(F.coalesce(new, F.lit(True)), 1).otherwise(0)).over(w))
    marks = starts.select(F.col(key).alias("__k"), F.col("__slot").alias("__s"), "segment")
    return rows.join(marks, (F.col(key).eqNullSafe(F.col("__k"))) & (F.col("__slot") == F.col("__s"))).drop("__k", "__s", "__slot")


def in_order(df: DataFrame, keys: list[str], order: list[str], machine: Callable, columns: list[str], out: str) -> DataFrame:
    """A step function over the rows of each key in order, with a small state.

    ``machine()`` gives a fresh step for each key; a step maps the column values of a
    row to the output value.  Rows flow through in record batches, sorted by Spark
    (which spills), so no group is held in memory.
    """
    schema = df.schema.add(out.split()[0], out.split()[1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, step = None, None
        for b in batches:
            marks = list(zip(*[b[k] for k in keys]))
            values = list(zip(*[b[c] for c in columns]))
            result = []
            for mark, row in zip(marks, values):
                if step is None or mark != current:
                    current, step = mark, machine()
                result.append(step(*row))
            yield b.assign(**{out.split()[0]: result})

    parts = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return parts.mapInPandas(run, schema)


def throttle_sliding(df: DataFrame, key: str, ts: str, id_col: str, window_ms: int, most: int) -> DataFrame:
    """Add ``allowed``: fewer than ``most`` accepted rows in the window before; refused rows do not count."""
    return _throttle(df, key, ts, id_col, window_ms, lambda: SlidingWindow(window_ms, most), equal_ends=False)


def throttle_bucket(
    df: DataFrame, key: str, ts: str, id_col: str, window_ms: int, most: int, faithful: bool = True, busy: int = BUSY
) -> DataFrame:
    """Add ``allowed``: a token bucket, refilled fully after a whole window, else in part.

    ``faithful`` (the default rule) leaves the refill clock where it is on a partial
    refill; otherwise the clock moves and fractions stay with it.

    Rows of a key between quiet times flow through the bucket in order.  Keys with more than ``busy`` rows, which may never
    be quiet, are no sequences: their refills come from tables of time blocks (only if ``faithful``).  Both give
    the same answers; the tables cost more for keys of few rows.
    """
    machine = lambda: TokenBucket(window_ms, most, faithful)
    if not faithful:
        return _throttle(df, key, ts, id_col, window_ms, machine, equal_ends=True)
    large = cut(df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > busy).select("__key"))
    if large.isEmpty():
        return _throttle(df, key, ts, id_col, window_ms, machine, equal_ends=True)
    same = F.col(key).eqNullSafe(F.col("__key"))
    rest = _throttle(df.join(small(large), same, "left_anti"), key, ts, id_col, window_ms, machine, equal_ends=True)
    return token_bucket(df.join(small(large), same, "left_semi"), key, ts, id_col, window_ms, most).unionByName(rest)


def _throttle(df, key, ts, id_col, window_ms, machine, equal_ends):
    # after a quiet window every throttle starts afresh, so the parts run on their own;
    # a token clock counts whole milliseconds, so quiet times are measured one longer there
    gap = (window_ms + 1) * 1000 if equal_ends else window_ms * 1000
    cut = quiet_segments(df, key, ts, gap, equal_ends).withColumn("__us", F.unix_micros(ts))
    out = in_order(cut, [key, "segment"], ["__us", id_col], machine, ["__us"], "allowed boolean")
    return out.select(*df.columns, "allowed")


def throttle_stats(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Total, allowed and throttled requests."""
    g = df.groupBy(*by) if by else df
    return g.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("allowed").alias("allowed"), F.count_if(~F.col("allowed")).alias("throttled")
    )


# ---- load shedding


def shed(df: DataFrame, ts: str, id_col: str, slot_s: int, buffer: int, strategy: str = "drop", high: float = 0.8, every: int = 10) -> DataFrame:
    """Decide per row what happens when a time slot's buffer is filled to the high mark.

    drop: refused.  sample: each n-th row over the mark is kept.  defer: all rows are
    kept, those over the mark wait for the next slot (``delay_s``).
    """
    slotted = df.withColumn("slot", F.floor(F.unix_timestamp(ts) / slot_s))
    ranked = rank_in_group(slotted, ["slot"], [ts, id_col], "__rank")
    mark = math.ceil(high * buffer)
    over = F.col("__rank") > mark
    if strategy == "drop":
        kept, delay = ~over, F.lit(0)
    elif strategy == "sample":
        kept, delay = ~over | ((F.col("__rank") - mark) % every == 0), F.lit(0)
    elif strategy == "defer":
        kept = F.lit(True)
        delay = F.when(over, (F.col("slot") + 1) * slot_s - F.unix_timestamp(ts)).otherwise(F.lit(0))
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return ranked.select(*df.columns, "slot", over.alias("over_mark"), kept.alias("kept"), delay.cast("long").alias("delay_s"))


# ---- retries, breaker, health


def retry_outcomes(attempts: DataFrame, max_retries: int) -> DataFrame:
    """Attempt log (event_id, attempt from 0, success) -> attempts made, retries, final status."""
    first = F.min(F.when(F.col("success"), F.col("attempt")))
    last = F.max("attempt")
    out = attempts.filter(F.col("attempt") <= max_retries).groupBy("event_id").agg(first.alias("first"), last.alias("last"))
    return out.select(
        "event_id", (F.coalesce("first", "last") + 1).cast("long").alias("attempts"),
        F.coalesce("first", "last").cast("long").alias("retry_count"),
        F.when(F.col("first").isNotNull(), "success").otherwise("failed").alias("status"),
    )


def circuit_breaker(df: DataFrame, key: str, ts: str, id_col: str, least: int = 5, percent: int = 50, open_ms: int = 5000) -> DataFrame:
    """Add ``outcome``: success, failure or blocked while the key's breaker is open.

    It opens after a failure when there were at least ``least`` failures and they are
    more than ``percent`` of all calls so far; it closes ``open_ms`` after the last
    failure.  The counters run over the whole history of a key, so a key is one
    sequence; keys run side by side.
    """

    timed = df.withColumn("__us", F.unix_micros(ts))
    return in_order(timed, [key], ["__us", id_col], lambda: Breaker(least, percent, open_ms), ["__us", "success"], "outcome string").drop("__us")


def compartment_health(df: DataFrame, key: str, bad: float = 0.1, slow: float = 0.05) -> DataFrame:
    """Failure and time-out rates per compartment; healthy below both limits."""
    out = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.avg((~F.col("success")).cast("double")).alias("failure_rate"),
        F.avg(F.col("timed_out").cast("double")).alias("timeout_rate"),
    )
    healthy = (F.col("failure_rate") < bad) & (F.col("timeout_rate") < slow)
    return out.withColumn("healthy", F.coalesce(healthy, F.lit(True)))
