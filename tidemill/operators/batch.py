"""Daily batch work: ingest, validate, summarise, retain, report."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest_daily(df: DataFrame, path: str, day: str = "date") -> None:
    """Write rows to folders by day; a rerun replaces just the days it brings."""
    # rebalancing keeps small days in one file and splits a busy day over several tasks
    w = df.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.partitionBy(day).parquet(path)


def with_file(df: DataFrame) -> DataFrame:
    """Keep the name of the file each row came from."""
    return df.withColumn("file", F.input_file_name())


def retained(df: DataFrame, today: date, days: int = 7, day: str = "date") -> DataFrame:
    """Rows of days not older than the limit; on a table by day only those folders are read."""
    return df.filter(F.col(day) >= F.lit(today - timedelta(days=days)))


def expired_days(df: DataFrame, today: date, days: int = 7, day: str = "date") -> DataFrame:
    """Days whose folders may be dropped."""
    return df.filter(F.col(day) < F.lit(today - timedelta(days=days))).select(day).distinct()


def run_report(spark: SparkSession, stages: list[tuple[str, int, str]]) -> DataFrame:
    """One row per stage of a run: stage, rows, status."""
    return spark.createDataFrame(stages, "stage string, n_rows long, status string")
