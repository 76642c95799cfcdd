"""Shard numbers for rows, and reports on shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.hashing import md5_mod
from tidemill.operators.rank import row_index
from tidemill.session import small


def shard_by_size(df: DataFrame, order: list[str], rows: int | None = None, shards: int = 8) -> DataFrame:
    """Consecutive chunks of a fixed number of rows (by default the rows split over ``shards``)."""
    if rows is None:
        rows = max(1, df.count() // shards)
    indexed = row_index(df, order, "__i")
    return indexed.withColumn("shard_id", F.floor(F.col("__i") / rows)).drop("__i")


def shard_by_count(df: DataFrame, order: list[str], shards: int) -> DataFrame:
    """Chunks of equal size, at most ``shards`` of them; an empty table stays empty."""
    return shard_by_size(df, order, max(1, -(-df.count() // shards)))


def shard_by_hash(df: DataFrame, key: str, shards: int) -> DataFrame:
    """md5 of the key modulo the number of shards: equal keys meet, and the number never changes."""
    return df.withColumn("shard_id", md5_mod(F.col(key).cast("string"), shards))


def shard_by_key(df: DataFrame, key: str) -> DataFrame:
    """One shard per value of a column, numbered in value order."""
    numbered = row_index(df.select(key).distinct(), [key], "shard_id")
    return df.join(small(numbered), key)


def range_number(value: Column, ranges: list[tuple[float, float]]) -> Column:
    """First range with low <= value < high; the last one when none fits."""
    hit = F.when(F.lit(False), F.lit(0))
    for i, (low, high) in enumerate(ranges):
        hit = hit.when((value >= low) & (value < high), F.lit(i))
    return hit.otherwise(F.lit(len(ranges) - 1)).cast("long")


def shard_by_range(df: DataFrame, column: str, ranges: list[tuple[float, float]]) -> DataFrame:
    """By value ranges; a text column is placed by its length."""
    c = F.col(column)
    value = F.char_length(c) if df.schema[column].dataType.typeName() == "string" else c.cast("double")
    return df.withColumn("shard_id", range_number(value, ranges))


def row_bytes() -> Column:
    """Estimated size of a row: its JSON form."""
    return F.octet_length(F.to_json(F.struct("*")))


def shard_adaptive(df: DataFrame, order: list[str], max_mb: float) -> DataFrame:
    """Chunks that fit a memory budget in the mean, judged from the size of all rows."""
    mean = df.agg(F.avg(row_bytes())).first()[0]
    rows = max(1, int(max_mb * 1024 * 1024 / mean)) if mean else 1
    return shard_by_size(df, order, rows)


def shard_stats(named: dict[str, DataFrame]) -> DataFrame:
    """Per strategy: shards, rows, mean, smallest and largest shard."""

    def one(name: str, df: DataFrame) -> DataFrame:
        sizes = df.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n"))
        return sizes.agg(
            F.count(F.lit(1)).alias("n_shards"), F.sum("n").alias("n_rows"), F.avg("n").alias("mean_size"),
            F.min("n").alias("smallest"), F.max("n").alias("largest"),
        ).select(F.lit(name).alias("strategy"), "*")

    return reduce(DataFrame.unionByName, [one(k, v) for k, v in named.items()])


def shard_memory(df: DataFrame) -> DataFrame:
    """Rows and estimated bytes per shard."""
    sized = df.withColumn("__b", row_bytes())
    return sized.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("__b").alias("bytes"))
