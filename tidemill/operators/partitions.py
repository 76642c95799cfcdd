"""User functions over partitions, shards and rows.

The caller gives a pandas function; Spark decides where it runs.  Functions that
get a whole shard need shards of a bounded size, as ``shard_by_size`` and
``shard_adaptive`` make them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numbers import sum_of_squares_below
from tidemill.operators.shards import shard_by_size
from tidemill.session import small

Frame = Callable[[pd.DataFrame], pd.DataFrame]
STATUS = "shard_id long, status string, attempts int, error string, payload string"


def map_partitions(df: DataFrame, fn: Frame, schema: str) -> DataFrame:
    """fn over record batches; no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)

    return df.mapInPandas(run, schema)


def map_shards(df: DataFrame, fn: Frame, schema: str, shard: str = "shard_id") -> DataFrame:
    """fn once per shard."""
    return df.groupBy(shard).applyInPandas(fn, schema)


def map_rows(df: DataFrame, fn: Callable, columns: list[str], dtype: str, name: str) -> DataFrame:
    """A row function over one or several columns, run on Arrow batches."""

    @F.pandas_udf(dtype)
    def run(*cols: pd.Series) -> pd.Series:
        return pd.Series([fn(*v) for v in zip(*cols)], index=cols[0].index)

    return df.withColumn(name, run(*[F.col(c) for c in columns]))


def map_with_side(df: DataFrame, side: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Side data for every row: sent to all tasks when it is small, else joined by shuffle."""
    return df.join(small(side), key, how)


def map_in_batches(df: DataFrame, order: list[str], rows: int, fn: Frame, schema: str) -> DataFrame:
    """fn per batch of consecutive rows."""
    return map_shards(shard_by_size(df, order, rows), fn, schema)


def _attempts(fn: Frame, shard: str, retries: int, delay: float) -> Frame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        number, error = int(pdf[shard].iloc[0]), None
        for attempt in range(1, retries + 2):
            try:
                out = fn(pdf)
                rows = [(number, "success", attempt, None, r) for r in out.to_json(orient="records", lines=True).splitlines()]
                return pd.DataFrame(rows, columns=["shard_id", "status", "attempts", "error", "payload"])
            except Exception as e:  # the error becomes a row, the other shards go on
                error = f"{type(e).__name__}: {e}"
                if attempt <= retries and delay:
                    time.sleep(delay * 2 ** (attempt - 1))
        return pd.DataFrame([(number, "failed", retries + 1, error, None)], columns=["shard_id", "status", "attempts", "error", "payload"])

    return run


def map_with_retry(df: DataFrame, fn: Frame, retries: int = 3, delay: float = 1.0, shard: str = "shard_id") -> DataFrame:
    """fn per shard with growing waits between attempts.

    One row per result row (JSON payload); a shard that keeps failing gives one row
    with its error.  ``retries=0`` only reports the errors.
    """
    return df.groupBy(shard).applyInPandas(_attempts(fn, shard, retries, delay), STATUS)


def payloads(results: DataFrame, schema: str) -> DataFrame:
    """The result rows of the shards that succeeded."""
    return results.filter("status = 'success'").select(F.from_json("payload", schema).alias("p")).select("p.*")


def shard_status(results: DataFrame) -> DataFrame:
    """One row per shard: status, attempts, error, result rows."""
    return results.groupBy("shard_id").agg(
        F.any_value("status").alias("status"), F.max("attempts").alias("attempts"), F.max("error").alias("error"),
        F.count("payload").alias("n_results"),
    )


def progress(status: DataFrame, total: int) -> DataFrame:
    """Finished, failed and all shards, and the finished share in percent."""
    done = F.count_if(F.col("status") == "success")
    return status.agg(
        done.alias("finished"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.lit(total).cast("long").alias("shards"), (done * 100.0 / max(1, total)).alias("percent"),
    )


def map_with_checkpoint(df: DataFrame, fn: Frame, schema: str, path: str, waves: int = 4, shard: str = "shard_id") -> DataFrame:
    """fn per shard in several waves; a rerun goes on with the waves not yet written.

    A wave is written all or nothing, so a lost driver costs at most one wave.
    ``shard`` must be part of ``schema``.
    """
    spark = df.sparkSession
    try:
        done = {r[0] for r in spark.read.parquet(path).select("wave").distinct().collect()}
    except AnalysisException:  # nothing written yet
        done = set()
    for wave in range(waves):
        if wave not in done:
            part = df.filter(F.pmod(F.col(shard), F.lit(waves)) == wave)
            map_shards(part, fn, schema, shard).write.mode("overwrite").parquet(f"{path}/wave={wave}")
    return spark.read.parquet(path)


def score_text(df: DataFrame, text: str, fn: Callable[[str], float], name: str = "score") -> DataFrame:
    """A user's text scorer, once per row; a null text has no score.

    Scores leave the worker in Arrow, where a scorer's NaN is not a null, and a batch's texts are read one by one.
    """

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array((fn(t.as_py()) if t.is_valid else None for t in texts), pa.float64())

    return df.withColumn(name, run(F.col(text)))


def heavy_tasks(value: Column, text: Column) -> dict[str, Column]:
    """The three demo workloads in closed form: squares below value mod 1000, length, a hundred times the value."""
    return {
        "cpu_task": sum_of_squares_below(F.pmod(value, F.lit(1000))),
        "io_task": F.char_length(text),
        "memory_task": value * 100,
    }
