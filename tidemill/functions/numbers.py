"""Number, time and lookup columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(text: Column) -> Column:
    """'$1,234.50' -> 1234.5; anything unreadable -> null."""
    return F.regexp_replace(text, "[$,]", "").try_cast("double")


def sentinel_to_null(text: Column, sentinel: str) -> Column:
    """The sentinel and unreadable numbers become null."""
    return F.nullif(text, F.lit(sentinel)).try_cast("double")


def ratio(a: Column, b: Column) -> Column:
    """a / b, null when b is 0."""
    return F.try_divide(a, b)


def recode(c: Column, mapping: dict, dtype: str = "string") -> Column:
    """Replace known values; values without an entry stay as they are."""
    entries = list(mapping.items())
    maps = [F.create_map(*[F.lit(x) for k, v in entries[i : i + 1000] for x in (k, str(v))]) for i in range(0, len(entries), 1000)]
    return F.coalesce(*[F.try_element_at(m, c) for m in maps], c.cast("string")).try_cast(dtype)


def month_key(text: Column) -> Column:
    """'yyyy-MM-dd' -> 'yyyy-MM'; other forms -> null."""
    ok = F.when(text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), text)
    return F.date_format(F.try_to_timestamp(ok, F.lit("yyyy-M-d")), "yyyy-MM")


def concat_to_epoch(date: Column, time: Column, fmt: str = "MM/dd/yyyy HH:mm") -> Column:
    """Date text and time text -> seconds since 1970."""
    return F.unix_timestamp(F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(fmt)))


def time_slot(ts: Column, seconds: int) -> Column:
    """Start of the aligned slot, in seconds since 1970."""
    return F.floor(F.unix_timestamp(ts) / F.lit(seconds)) * F.lit(seconds)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def sum_of_squares_below(n: Column) -> Column:
    """0^2 + 1^2 + ... + (n-1)^2 in closed form, in whole numbers throughout."""
    n = n.cast("long")
    return F.call_function("div", n * (n - 1) * (2 * n - 1), F.lit(6))
