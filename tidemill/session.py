"""Session settings, the shared work folder and table loading."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# tables whose rows are long texts or very many
COSTLY = {"documents", "lineitem", "conversations", "pages"}

_local_dirs: dict[str, str] = {}
_fresh_dirs: dict[str, list[str]] = {}


def build_session(name: str = "tidemill", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators expect.

    Only names and semantics are set here.  Executor sizes and the number of
    shuffle partitions belong to the cluster; AQE coalesces the latter.
    """
    b = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        b = b.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can see, as named in ``spark.checkpoint.dir``.

    Outside a local session an unset value is an error, because a temporary
    folder of one machine is not visible to the others.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidemill-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is created yet.  ``remove_dirs`` removes all of a session's."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _fresh_dirs.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_dirs(spark: SparkSession) -> None:
    """Remove the intermediate folders of this session.  Results that still read them must be written before."""
    conf = spark._jsc.hadoopConfiguration()
    for path in _fresh_dirs.pop(spark.sparkContext.applicationId, []):
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their keyed state in RocksDB, as stateful processors need it.  A query copies the settings
    when it starts, so the session has its own state store again afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few, unsplittable files enough partitions for the costly work behind it.

    A file can have fewer row groups than Spark cuts splits from its bytes; then most splits are empty and one holds many
    rows.  So the rows of the splits are counted, which reads footers only.  A table of many files or with its
    rows dealt evenly is left alone, so nothing is shuffled there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    if parts >= cores:
        if len(df.inputFiles()) >= 4 * cores:
            return df
        held = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]  # a number per split
        if cores * max(held, default=0) <= 2 * sum(held):
            return df
    return df.repartition(max(cores, parts))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table; zone-less timestamps become UTC timestamps."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if name in COSTLY:
        df = spread(df)
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return df


def to_ntz(df: DataFrame) -> DataFrame:
    """Give timestamps back without a zone, as the input tables have them."""
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp":
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp_ntz"))
    return df


def small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark a side for broadcast only after counting that its rows are few and take little room; else leave it to the shuffle join.

    Counting evaluates the side once more, up to ``max_rows``: pass a side that is cheap or checkpointed.
    """
    size = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    rows, room = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    return F.broadcast(df) if rows <= max_rows and (room or 0) <= max_bytes else df
