"""Step functions on streams: the rows of a key are decided in the order of their event times, late ones included."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemill.operators.steps import Breaker, Machine, SlidingWindow, TokenBucket


class InOrder(StatefulProcessor):
    """A machine per key behind a buffer.

    Rows wait in a list state until the watermark has passed them, as no earlier row can come after that; then they
    go through the machine in the order (time, id) and leave with its answer.  The machine's state is another list
    state.  One event-time timer per key stands at the first waiting row or at the time the machine changes by
    itself, whichever is first, so a key without rows costs nothing until then.  Everything is in the checkpoint: a
    restarted query goes on where it was.
    """

    def __init__(self, machine: Callable[[], Machine], values: list[tuple[str, str]], out: str):
        self.machine, self.values, self.out = machine, values, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        columns = [("us", "bigint"), ("id", "bigint"), *self.values]
        self.waiting = handle.getListState("waiting", ", ".join(f"{n} {t}" for n, t in columns))
        self.state = handle.getListState("state", self.machine().STATE)
        self.columns = [n for n, _ in columns]

    def _wake(self, ms: int) -> None:
        timers = list(self.handle.listTimers())
        if not timers or ms < min(timers):
            for t in timers:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            values = [tuple(r) for r in chunk[self.columns].astype(object).itertuples(index=False)]
            self.waiting.appendList(values)
            self._wake(-(-min(v[0] for v in values) // 1000))
        yield from ()  # nothing is decided yet, and an empty frame would cost more than all else here

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        rows = sorted(self.waiting.get(), key=lambda r: (r[0], r[1]))
        due = sum(r[0] <= now * 1000 for r in rows)
        machine = self.machine()
        before = list(self.state.get())
        machine.load(before)
        answers = [(r[1], machine(r[0], *r[2:])) for r in rows[:due]]
        machine.tick(now)
        for state, had, left in ((self.state, before, machine.save()), (self.waiting, rows, [tuple(r) for r in rows[due:]])):
            if left and len(left) == len(had) and all(tuple(a) == tuple(b) for a, b in zip(had, left)):
                continue  # each call goes to the JVM
            if left:
                state.put(left)
            elif had:
                state.clear()
        times = [-(-rows[due][0] // 1000)] if due < len(rows) else []
        times += [t for t in [machine.wakes()] if t is not None and t > now]
        if times:
            self._wake(min(times))
        if answers:
            yield self._answers(key, answers)

    def _answers(self, key, answers: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame([(key[0], i, a) for i, a in answers], columns=["key", "id", self.out])

    def close(self) -> None:
        pass


def in_order(df: DataFrame, key: str, ts: str, id_col: str, machine: Callable[[], Machine], out: str, late: str, values: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``id_col`` (a whole number) and the machine's answer for each row of a stream, once the watermark has
    passed it.  Rows later than ``late`` are dropped by Spark.  Run it with ``session.keyed_state``."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    name, kind = out.split()
    rows = df.select(F.col(key).alias("key"), F.col(ts).alias("event_time"), F.unix_micros(ts).alias("us"), F.col(id_col).cast("long").alias("id"), *values)
    done = rows.withWatermark("event_time", late).groupBy("key").transformWithStateInPandas(
        statefulProcessor=InOrder(machine, [(v, types[v]) for v in values], name),
        outputStructType=f"key {types[key]}, id bigint, {name} {kind}",
        outputMode="Append",
        timeMode="EventTime",
    )
    return done.select(F.col("key").alias(key), F.col("id").alias(id_col), name)


def throttle_sliding(df: DataFrame, key: str, ts: str, id_col: str, window_ms: int, most: int, late: str) -> DataFrame:
    """``allowed`` as the table form gives it; the state of a key is its accepted times, ``most`` at most."""
    return in_order(df, key, ts, id_col, lambda: SlidingWindow(window_ms, most), "allowed boolean", late)


def throttle_bucket(df: DataFrame, key: str, ts: str, id_col: str, window_ms: int, most: int, late: str, faithful: bool = True) -> DataFrame:
    return in_order(df, key, ts, id_col, lambda: TokenBucket(window_ms, most, faithful), "allowed boolean", late)


def circuit_breaker(df: DataFrame, key: str, ts: str, id_col: str, late: str, least: int = 5, percent: int = 50, open_ms: int = 5000) -> DataFrame:
    """``outcome`` as the table form gives it; an open breaker is closed by a timer."""
    return in_order(df, key, ts, id_col, lambda: Breaker(least, percent, open_ms), "outcome string", late, ("success",))
