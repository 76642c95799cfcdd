"""Streaming readers and writers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.session import fresh_dir
from tidemill.sources.payloads import as_messages

AVAILABLE = {"availableNow": True}


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int = 10) -> DataFrame:
    """A folder (or a glob) of files as a stream with a fixed schema and a bounded intake per trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(path)


def text_stream(spark: SparkSession, path: str, max_files: int = 10) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def kafka_stream(spark: SparkSession, servers: str, topics: list[str], bounded: bool = False, **options) -> DataFrame:
    """Topics of a message log, newest offsets first seen, missing data tolerated.

    ``bounded`` limits the rows per trigger and sets client time-outs.  The frame has
    the envelope columns topic, partition, offset, timestamp and value.  Needs the
    Kafka connector on the class path.
    """
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    if bounded:
        settings |= {
            "maxOffsetsPerTrigger": "100000",
            "kafka.session.timeout.ms": "30000",
            "kafka.request.timeout.ms": "40000",
        }
    settings |= {k: str(v) for k, v in options.items()}
    return spark.readStream.format("kafka").options(**settings).load()


def write_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Every row as one JSON message."""
    w = as_messages(df).writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    w = w.option("checkpointLocation", checkpoint).outputMode(mode)
    return (w.trigger(processingTime=every) if every else w).start()


def write_console(df: DataFrame, rows: int = 20, trigger: dict | None = None) -> StreamingQuery:
    """Print the first rows of each micro-batch."""
    w = df.writeStream.format("console").outputMode("append").option("truncate", False).option("numRows", rows)
    return w.option("checkpointLocation", fresh_dir(df.sparkSession, "console")).trigger(**(trigger or AVAILABLE)).start()


def write_parquet(df: DataFrame, path: str, checkpoint: str, by: list[str] | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Append to a parquet table, each row exactly once (the sink keeps its own log)."""
    w = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    if by:
        w = w.partitionBy(*by)
    return w.trigger(**(trigger or AVAILABLE)).start()


def write_versions(df: DataFrame, path: str, checkpoint: str, mode: str, trigger: dict | None = None) -> StreamingQuery:
    """Write each micro-batch to its own folder ``batch=<id>``.

    A replayed batch overwrites its folder, so nothing is written twice.  In complete
    mode the newest folder is the table, in update mode the newest row per key is.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    w = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or AVAILABLE)).start()


def write_each(df: DataFrame, outputs: dict[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Several outputs from one read of the source: ``path/<name>/batch=<id>``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, shape in outputs.items():
                shape(batch).write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or AVAILABLE)).start()


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """The table a complete-mode query has written last."""
    df = spark.read.parquet(path)
    newest = df.agg(F.max("batch")).first()[0]
    return df.filter(F.col("batch") == F.lit(newest)).drop("batch")


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row of each key an update-mode query has written."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c != "batch"]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select("r.*")


def finish(query: StreamingQuery, trigger: dict | None = None) -> None:
    """Wait for the end of what is available now.  A query with a trigger of its own doesn't end; it is stopped once
    its source has nothing more."""
    if trigger is None or trigger == AVAILABLE:
        query.awaitTermination()
        return
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def appended(df: DataFrame, label: str, by: list[str] | None = None, trigger: dict | None = None) -> DataFrame:
    """Run a stream over what is available now; the appended rows come back as a table."""
    spark = df.sparkSession
    out = fresh_dir(spark, label)
    schema = df.schema
    finish(write_parquet(df, out, fresh_dir(spark, f"{label}-log"), by, trigger), trigger)
    return spark.read.schema(schema).parquet(out)


def updated(df: DataFrame, label: str, keys: list[str], trigger: dict | None = None) -> DataFrame:
    spark = df.sparkSession
    out = fresh_dir(spark, label)
    finish(write_versions(df, out, fresh_dir(spark, f"{label}-log"), "update", trigger), trigger)
    return latest_rows(spark, out, keys)


def completed(df: DataFrame, label: str, trigger: dict | None = None) -> DataFrame:
    spark = df.sparkSession
    out = fresh_dir(spark, label)
    finish(write_versions(df, out, fresh_dir(spark, f"{label}-log"), "complete", trigger), trigger)
    return latest_version(spark, out)
