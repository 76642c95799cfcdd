"""Projections, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.quantiles import quantile_values


def enrich_events(df: DataFrame, kinds: list[str]) -> DataFrame:
    """Positive amounts of the given kinds, with hour and date of the event."""
    return (
        df.filter((F.col("amount") > 0) & F.col("event_type").isin(kinds))
        .withColumn("hour", F.hour("event_time"))
        .withColumn("date", F.to_date("event_time"))
    )


def validity(df: DataFrame, required: list[str]) -> DataFrame:
    """Add ``is_valid``: all required columns are present."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.withColumn("is_valid", F.when(ok, True).otherwise(False))


def validate_split(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows)."""
    checked = validity(df, required)
    return checked.filter("is_valid").drop("is_valid"), checked.filter("NOT is_valid").drop("is_valid")


def above_median(df: DataFrame, columns: list[str], **kw) -> Column:
    """Condition: above the median in every given column."""
    mid = quantile_values(df, columns, [0.5], **kw)
    cond = F.lit(True)
    for c in columns:
        cond = cond & (F.col(c) > F.lit(mid[f"{c}_p50"]))
    return cond


def count_per_column(df: DataFrame, test, name: str) -> DataFrame:
    """One row per column with the number of rows that pass the test, in one pass."""
    wide = df.agg(*[F.count_if(test(F.col(c))).alias(c) for c in df.columns])
    return wide.unpivot([], wide.columns, "column_name", name)


def null_counts(df: DataFrame) -> DataFrame:
    return count_per_column(df, lambda c: c.isNull(), "nulls")


def sentinel_counts(df: DataFrame, sentinel: str) -> DataFrame:
    return count_per_column(df, lambda c: F.coalesce(c.cast("string") == sentinel, F.lit(False)), "sentinels")


def rows_with_null(df: DataFrame) -> DataFrame:
    cond = F.lit(False)
    for c in df.columns:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def one_hot(df: DataFrame, column: str, values: list[str], prefix: str) -> DataFrame:
    """One 0/1 column per value of a known list; the source column goes."""
    flags = [(F.col(column) == v).cast("int").alias(f"{prefix}_{v.replace(' ', '_')}") for v in values]
    return df.select(*[c for c in df.columns if c != column], *flags)


def drop_by_id(df: DataFrame, bad: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the list of bad ids."""
    return df.join(bad.select(key).distinct(), key, "left_anti")


def update_from(df: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """Fill the nulls of a column with the values given per key."""
    new = changes.select(key, F.col(column).alias("__new"))
    return df.join(new, key, "left").withColumn(column, F.coalesce(column, "__new")).drop("__new")
