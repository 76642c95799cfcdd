"""Batch view, speed view, serving view, log replay."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.rank import row_index


def partial_view(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """Mergeable totals: counts, sums, least and greatest; never averages."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total"), F.min(amount).alias("least"), F.max(amount).alias("most")
    )


def batch_view(df: DataFrame, ts: str, cutoff: datetime, keys: list[str], amount: str) -> DataFrame:
    """History up to the cutoff."""
    return partial_view(df.filter(F.col(ts) <= F.lit(cutoff)), keys, amount)


def speed_view(df: DataFrame, ts: str, cutoff: datetime, keys: list[str], amount: str) -> DataFrame:
    """What came after the cutoff; also on a stream, in update mode."""
    return partial_view(df.filter(F.col(ts) > F.lit(cutoff)), keys, amount)


def serving_view(batch: DataFrame, speed: DataFrame, keys: list[str]) -> DataFrame:
    """Both views as one: merged totals and the average from them."""
    merged = batch.unionByName(speed).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most")
    )
    return merged.withColumn("average", F.col("total") / F.col("n"))


def replay_slice(log: DataFrame, order: list[str], start: int, count: int) -> DataFrame:
    """The log rows at positions start .. start + count - 1."""
    indexed = row_index(log, order, "log_index")
    return indexed.filter((F.col("log_index") >= start) & (F.col("log_index") < start + count))


def architecture_stats(df: DataFrame, ts: str, cutoff: datetime, replayed: int) -> DataFrame:
    """Events received, in the batch part, in the speed part and replayed, per type."""
    early = F.col(ts) <= F.lit(cutoff)
    return df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("received"), F.count_if(early).alias("in_batch"), F.count_if(~early).alias("in_speed"),
        F.lit(replayed).cast("long").alias("replayed"),
    )
