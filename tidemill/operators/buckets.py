"""A token bucket over a table in which one key may hold most rows and never be quiet."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemill.operators.rank import rank_in_group

#: windows of one block, and milliseconds that a block of several windows spans at most
WINDOWS, BLOCK_MS = 64, 3_600_000
FAR = -(1 << 62)


def last_refills(times: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """For each refill at ``start``, the last one that follows from it among the rising ``times``."""
    now = start.copy()
    at = np.searchsorted(times, now + window)
    while (going := at < len(times)).any():
        now[going] = times[at[going]]
        at = np.where(going, np.searchsorted(times, now + window), at)
    return now


def refill_times(times: np.ndarray, clock: int, window: int) -> np.ndarray:
    """The refills among the rising ``times`` when the last one before was at ``clock``."""
    out, at = [], int(np.searchsorted(times, clock + window))
    while at < len(times):
        out.append(int(times[at]))
        at = int(np.searchsorted(times, times[at] + window))
    return np.array(out, dtype=np.int64)


def refills(df: DataFrame, key: str, ms: str, window: int) -> DataFrame:
    """``k``, ``slot``, ``before``, ``here``: for each key and window-long slot with rows, the last full refill before the
    slot and the one in it (at most one, as they are a window apart; null if there is none).

    A refill comes with the first row a whole window after the one before, so each depends on the last.  As in a
    parallel prefix, the time is cut into blocks.  Every block works out, for each place where its first refill may be,
    where its last one is then (a transition table; places with the same end are one row).  Passing the blocks of a
    key then takes one look into each table, and with the clock it starts from every block finds its refills.
    Tasks hold the distinct milliseconds of a block, and for the pass the tables of a key; rows are never held.
    """
    span = window * max(1, min(WINDOWS, BLOCK_MS // window))
    times = df.select(F.col(key).alias("k"), F.floor(F.col(ms) / span).alias("block"), F.col(ms).alias("t")).distinct()
    kind = times.schema["k"].dataType
    k_type, k_sql = to_arrow_type(kind), kind.simpleString()

    def table(group: pa.Table) -> pa.Table:
        t, block = np.sort(group.column("t").to_numpy()), group.column("block")[0].as_py()
        first = t[: int(np.searchsorted(t, block * span + window)) + 1]  # one more: the first behind the first window
        end = last_refills(t, first, window)
        last = np.append(end[1:] != end[:-1], True)
        n = int(last.sum())
        return pa.table({"k": group.column("k").slice(0, 1).combine_chunks().take(pa.array([0] * n)).cast(k_type), "block": pa.array([block] * n, type=pa.int64()), "first": pa.array(first[last]), "last": pa.array(end[last])})

    def passed(group: pa.Table) -> pa.Table:
        group = group.sort_by([("block", "ascending"), ("first", "ascending")])
        block, first, last = (group.column(c).to_numpy() for c in ("block", "first", "last"))
        at = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, dtype=np.int64)
        clock, clocks = FAR, []
        for a, b in zip(at, np.append(at[1:], len(block))):
            clocks.append(clock)
            i = a + int(np.searchsorted(first[a:b], clock + window))
            clock = int(last[i]) if i < b else clock
        keys = group.column("k").combine_chunks().take(pa.array(at)).cast(k_type)
        return pa.table({"k": keys, "block": pa.array(block[at], type=pa.int64()), "clock": pa.array(clocks, type=pa.int64())})

    def found(rows: pa.Table, clocks: pa.Table) -> pa.Table:
        t = np.sort(rows.column("t").to_numpy())
        refilled = refill_times(t, clocks.column("clock")[0].as_py(), window)
        slots = np.unique(t // window)
        of = np.concatenate([[clocks.column("clock")[0].as_py()], refilled])
        before = of[np.searchsorted(refilled, slots * window)]
        after = of[np.searchsorted(refilled, (slots + 1) * window)]
        keys = rows.column("k").slice(0, 1).combine_chunks().take(pa.array([0] * len(slots))).cast(k_type)
        return pa.table({"k": keys, "slot": pa.array(slots), "before": pa.array(before), "here": pa.array(after, mask=after == before)})

    tables = times.groupBy("k", "block").applyInArrow(table, f"k {k_sql}, block bigint, first bigint, last bigint")
    clocks = tables.groupBy("k").applyInArrow(passed, f"k {k_sql}, block bigint, clock bigint")
    return times.groupBy("k", "block").cogroup(clocks.groupBy("k", "block")).applyInArrow(found, f"k {k_sql}, slot bigint, before bigint, here bigint")


def token_bucket(df: DataFrame, key: str, ts: str, id_col: str, window_ms: int, most: int) -> DataFrame:
    """Add ``allowed``, as ``steps.TokenBucket`` does with ``faithful``.

    There the clock stands still between full refills and every row adds what the time since then is worth.  So of the
    rows after a refill, those too early for a whole token are allowed up to the number ``most``, and each later one
    brings its own token.  That leaves a rank among the early rows, which ``rank_in_group`` finds without holding a group.
    """
    timed = df.withColumn("__ms", F.floor(F.unix_micros(ts) / 1000)).withColumn("__slot", F.floor(F.col("__ms") / window_ms))
    marks = refills(timed, key, "__ms", window_ms).select(F.col("k").alias("__k"), F.col("slot").alias("__s"), "before", "here")
    rows = timed.join(marks, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__slot") == F.col("__s")))
    clock = F.when(F.col("__ms") >= F.col("here"), F.col("here")).otherwise(F.col("before"))
    rows = rows.withColumn("__clock", clock).withColumn("__due", (F.col("__ms") - F.col("__clock")) * most >= window_ms)
    early = rank_in_group(rows.where(~F.col("__due")), [key, "__clock"], [ts, id_col], "__rank")
    parts = early.select(*df.columns, (F.col("__rank") <= most).alias("allowed")), rows.where("__due").select(*df.columns, F.lit(True).alias("allowed"))
    return parts[0].unionByName(parts[1])
