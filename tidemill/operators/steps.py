"""Small state machines of single keys: the same ones decide over tables and over streams.

A machine is called with the row's time in microseconds and its values, in time order.  ``save`` gives its state
as rows of ``STATE`` and ``load`` takes them back; ``wakes`` is the time (in milliseconds) at which its state changes by
itself, and ``tick`` makes that change.
"""

from __future__ import annotations

from collections import deque


class Machine:
    STATE = ""

    def save(self) -> list[tuple]:
        raise NotImplementedError

    def load(self, rows: list[tuple]) -> None:
        raise NotImplementedError

    def wakes(self) -> int | None:
        return None

    def tick(self, now: int) -> None:
        pass


class SlidingWindow(Machine):
    """True for fewer than ``most`` accepted rows in the window before; refused rows do not count."""

    STATE = "us bigint"

    def __init__(self, window_ms: int, most: int):
        self.window_us, self.most = window_ms * 1000, most
        self.accepted: deque[int] = deque()

    def __call__(self, us: int) -> bool:
        self._evict(us)
        if len(self.accepted) < self.most:
            self.accepted.append(us)
            return True
        return False

    def _evict(self, us: int) -> None:
        while self.accepted and self.accepted[0] < us - self.window_us:
            self.accepted.popleft()

    def save(self) -> list[tuple]:
        return [(us,) for us in self.accepted]

    def load(self, rows: list[tuple]) -> None:
        self.accepted = deque(r[0] for r in rows)

    def wakes(self) -> int | None:
        # the newest accepted row leaves the window: nothing is left to remember
        return (self.accepted[-1] + self.window_us) // 1000 + 1 if self.accepted else None

    def tick(self, now: int) -> None:
        self._evict(now * 1000)


class TokenBucket(Machine):
    """True while there are tokens; they are refilled fully after a whole window, else in part.

    ``faithful`` leaves the refill clock where it is on a partial refill; otherwise the clock moves and fractions
    stay with it.
    """

    STATE = "tokens bigint, clock bigint"

    def __init__(self, window_ms: int, most: int, faithful: bool = True):
        self.window_ms, self.most, self.faithful = window_ms, most, faithful
        self.tokens, self.clock = most, None

    def __call__(self, us: int) -> bool:
        now = us // 1000
        if self.clock is None:
            self.clock = now
        passed = now - self.clock
        if passed >= self.window_ms:
            self.tokens, self.clock = self.most, now
        else:
            add = passed * self.most // self.window_ms
            self.tokens = min(self.most, self.tokens + add)
            if not self.faithful:
                self.clock += add * self.window_ms // self.most
        if self.tokens > 0:
            self.tokens -= 1
            return True
        return False

    def save(self) -> list[tuple]:
        return [] if self.clock is None else [(self.tokens, self.clock)]

    def load(self, rows: list[tuple]) -> None:
        self.tokens, self.clock = rows[0] if rows else (self.most, None)

    def wakes(self) -> int | None:
        return None if self.clock is None else self.clock + self.window_ms

    def tick(self, now: int) -> None:
        if self.clock is not None and now >= self.clock + self.window_ms:  # the next row finds a full bucket either way
            self.tokens, self.clock = self.most, None


class Breaker(Machine):
    """success, failure, or blocked while open.

    It opens after a failure when there were at least ``least`` failures and they are more than ``percent`` of all
    calls so far; it closes ``open_ms`` after the last failure.
    """

    STATE = "bad bigint, good bigint, last bigint, is_open boolean"

    def __init__(self, least: int = 5, percent: int = 50, open_ms: int = 5000):
        self.least, self.percent, self.open_ms = least, percent, open_ms
        self.bad, self.good, self.last, self.is_open = 0, 0, 0, False

    def __call__(self, us: int, ok: bool) -> str:
        now = us // 1000
        self.tick(now)
        if self.is_open:
            return "blocked"
        if ok:
            self.good += 1
            return "success"
        self.bad += 1
        self.last = now
        self.is_open = self.bad >= self.least and self.bad * 100 // (self.bad + self.good) > self.percent
        return "failure"

    def save(self) -> list[tuple]:
        return [(self.bad, self.good, self.last, self.is_open)]

    def load(self, rows: list[tuple]) -> None:
        self.bad, self.good, self.last, self.is_open = rows[0] if rows else (0, 0, 0, False)

    def wakes(self) -> int | None:
        return self.last + self.open_ms if self.is_open else None

    def tick(self, now: int) -> None:
        if self.is_open and now - self.last >= self.open_ms:
            self.is_open = False
