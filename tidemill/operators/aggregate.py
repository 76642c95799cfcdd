"""Grouped counts, sums and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numbers import month_key
from tidemill.operators.quantiles import exact_quantiles, quantile_name, quantile_values

QUARTILES = [0.25, 0.5, 0.75]


def count_tokens(df: DataFrame, tokens: Column, name: str = "word") -> DataFrame:
    """Occurrences of each token; counts are combined before the shuffle."""
    return df.select(F.explode(tokens).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def parse_sales(df: DataFrame, with_category: bool = True) -> DataFrame:
    """Comma-separated sales lines -> columns plus ``is_valid``.

    Layouts: date,product,category,quantity,price or date,product,quantity,price.
    A line is valid with exactly that many fields, a strict date and two numbers.
    """
    width = 5 if with_category else 4
    f = F.split("value", ",")
    part = lambda i: F.try_element_at(f, F.lit(i))
    parsed = df.select(
        "*",
        (F.size(f) == width).alias("__width"),
        month_key(F.trim(part(1))).alias("month"),
        part(2).alias("product"),
        (part(3) if with_category else F.lit(None).cast("string")).alias("category"),
        part(width - 1).try_cast("double").alias("quantity"),
        part(width).try_cast("double").alias("price"),
    )
    ok = F.col("__width") & F.col("month").isNotNull() & F.col("quantity").isNotNull() & F.col("price").isNotNull()
    return parsed.withColumn("is_valid", F.coalesce(ok, F.lit(False))).withColumn(
        "amount", F.col("quantity") * F.col("price")
    ).drop("__width")


def totals(df: DataFrame, keys: list[str], amount: str = "amount") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum(amount).alias("total"), F.count(F.lit(1)).alias("n"), F.avg(amount).alias("average")
    )


def totals_by_each(df: DataFrame, dims: list[str], amount: str = "amount") -> DataFrame:
    """Totals by every dimension on its own from one pass, labelled with the dimension."""
    present = F.filter(
        F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("key")) for d in dims]),
        lambda s: s["key"].isNotNull(),
    )
    long = df.select(amount, F.explode(present).alias("d")).select(amount, "d.*")
    return totals(long, ["dimension", "key"], amount)


def as_key_values(df: DataFrame, key: str) -> DataFrame:
    """total / n / average in the long layout ``<key>_total`` etc., two decimals."""
    money = lambda c: F.format_string("%.2f", F.col(c))
    rows = F.array(
        F.struct(F.concat(key, F.lit("_total")).alias("k"), money("total").alias("v")),
        F.struct(F.concat(key, F.lit("_count")).alias("k"), F.col("n").cast("string").alias("v")),
        F.struct(F.concat(key, F.lit("_average")).alias("k"), money("average").alias("v")),
    )
    return df.select(F.explode(rows).alias("r")).select(F.col("r.k").alias("key"), F.col("r.v").alias("value"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Share of each value; the total is one number, so it joins no data."""
    total = df.count()
    return value_counts(df, column).withColumn("share", F.col("n") / F.lit(total))


def describe(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max per column; one row per column (and group)."""
    by = by or []
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}_count"), F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    if by:
        both = df.groupBy(*by).agg(*aggs).join(exact_quantiles(df, columns, QUARTILES, by=by), by)  # one row per group each
    else:
        mid = quantile_values(df, columns, QUARTILES)
        both = df.agg(*aggs).select("*", *[F.lit(v).cast("double").alias(n) for n, v in mid.items()])
    stat = lambda c: F.struct(
        F.lit(c).alias("column_name"),
        F.col(f"{c}_count").alias("count"),
        *[F.col(f"{c}_{s}").cast("double").alias(s) for s in ("mean", "std", "min")],
        *[F.col(quantile_name(c, p)).alias(f"p{round(p * 100)}") for p in QUARTILES],
        F.col(f"{c}_max").cast("double").alias("max"),
    )
    return both.select(*by, F.explode(F.array(*[stat(c) for c in columns])).alias("s")).select(*by, "s.*")


def shape_info(df: DataFrame) -> DataFrame:
    """One row per column: type, non-null values, number of rows."""
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("type"), F.col(c).alias("non_null"), F.col("__rows").alias("n_rows"))
        for c in df.columns
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct values of every column, long layout."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*").distinct()


def repeated_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def pivot_wide(df: DataFrame, row: str, column: str, value: str, values: list, fill: float = -1.0) -> DataFrame:
    """Row x column matrix over a known list of column values; gaps get ``fill``."""
    wide = df.groupBy(row).pivot(column, values).agg(F.max(value))
    return wide.na.fill(fill, [str(v) for v in values])


def event_windows(df: DataFrame, length: str, keys: list[str], aggs: list[Column], slide: str | None = None) -> DataFrame:
    """Aggregates per aligned time window and keys."""
    w = F.window("event_time", length, slide) if slide else F.window("event_time", length)
    out = df.groupBy(w.alias("w"), *keys).agg(*aggs)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *out.columns[1:])
