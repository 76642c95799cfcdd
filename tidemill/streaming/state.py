"""Keyed state on streams: sessions that close after a quiet time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SESSION_STATE = "first_us bigint, last_us bigint, events bigint, value double"
SESSION_OUT = (
    "user_id string, session_start timestamp, session_duration double, total_events bigint, "
    "total_value double, session_end_reason string"
)


class SessionProcessor(StatefulProcessor):
    """One open session per user: first and last time, events, value.

    The state has a fixed size: events are summed, not kept.  A batch may hold
    several sessions of a user; those ended by a gap inside it go out at once.
    """

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("session", SESSION_STATE)

    def _row(self, key, first, last, events, value) -> tuple:
        return (key[0], pd.Timestamp(first, unit="us"), (last - first) / 1e6, events, value, "timeout")

    def _frame(self, rows: list) -> pd.DataFrame:
        names = [c.split()[0] for c in SESSION_OUT.split(", ")]
        return pd.DataFrame(rows, columns=names)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        chunk = [(r["event_time"].astype("datetime64[us]").astype("int64").tolist(), r["amount"].fillna(0.0).tolist()) for r in rows]
        events = sorted((t, v) for us, amounts in chunk for t, v in zip(us, amounts))
        parts: list[list] = []  # first, last, events, value
        for us, v in events:
            if parts and us - parts[-1][1] <= self.gap_ms * 1000:
                p = parts[-1]
                p[1], p[2], p[3] = us, p[2] + 1, p[3] + v
            else:
                parts.append([us, us, 1, v])
        done, current = [], self.state.get()
        ends = None if current is None else current[1]
        for first, last, n, v in parts:
            if current is not None:
                cf, cl, cn, cv = current
                if first - cl <= self.gap_ms * 1000 and cf - last <= self.gap_ms * 1000:
                    current = (min(cf, first), max(cl, last), cn + n, cv + v)
                    continue
                if last < cf:  # a whole earlier session arrived after the open one
                    done.append(self._row(key, first, last, n, v))
                    continue
                done.append(self._row(key, *current))
            current = (first, last, n, v)
        self.state.update(current)
        if current[1] != ends:  # a user has one timer, which stands at the end of the open session
            if ends is not None:
                self.handle.deleteTimer(ends // 1000 + self.gap_ms)
            self.handle.registerTimer(current[1] // 1000 + self.gap_ms)
        if done:  # an empty frame would cost more than all else here
            yield self._frame(done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        current = self.state.get()
        if current is not None:
            yield self._frame([self._row(key, *current)])
            self.state.clear()

    def close(self) -> None:
        pass


def sessions_on_timeout(df: DataFrame, gap_minutes: int = 30, late: str = "10 minutes") -> DataFrame:
    """Sessions of a stream (user_id, event_time, amount), sent out when they have ended.  Run it with ``session.keyed_state``."""
    keyed = df.select("user_id", "event_time", "amount").withWatermark("event_time", late).groupBy("user_id")
    return keyed.transformWithStateInPandas(
        statefulProcessor=SessionProcessor(gap_minutes * 60_000),
        outputStructType=SESSION_OUT,
        outputMode="Append",
        timeMode="EventTime",
    )
