"""File and text sources and sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True) -> DataFrame:
    """Delimited text with a given schema; the data is never scanned to guess types."""
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    df.write.mode("errorifexists").option("header", header).option("sep", sep).csv(path)


#: signs that Spark escapes in the names of partition folders
_ESCAPED = {c: f"%{c:02X}" for c in [*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^")]}
_NULL = "__HIVE_DEFAULT_PARTITION__"


def write_text_files(df: DataFrame, path: str, by: list[str]) -> None:
    """One text column, in folders by the other columns: a file per folder and task, a line per row.

    Tasks write the files where they stay.  Spark's writer, made for few large files, starts processes and renames for
    each of them; it remains for file systems that Arrow doesn't know.
    """
    try:
        fs, root = pafs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        df.write.mode("errorifexists").partitionBy(*by).text(path)
        return
    if fs.get_file_info(root).type != pafs.FileType.NotFound:
        raise FileExistsError(path)
    fs.create_dir(root)
    (value,) = (c for c in df.columns if c not in by)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        name = f"part-{TaskContext.get().partitionId():05d}.txt"
        at, out, lines = None, None, 0
        try:
            for b in batches:
                lines += b.num_rows
                for text, *keys in zip(*(b.column(c) for c in (value, *by)), strict=True):
                    keys = [k.as_py() for k in keys]
                    if out is None or keys != at:
                        if out is not None:
                            out.close()
                        at = keys
                        folder = "/".join([root, *(f"{c.translate(_ESCAPED)}={k.translate(_ESCAPED) if k else _NULL}" for c, k in zip(by, keys, strict=True))])
                        fs.create_dir(folder)
                        out = fs.open_output_stream(f"{folder}/{name}")
                    out.write((text.as_py() or "").encode() + b"\n")
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_pydict({"n": pa.array([lines], pa.int64())})

    rows = df.select(value, *[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in by]).sortWithinPartitions(*by)
    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()


DIGESTS = {
    "md5": F.md5, "sha1": F.sha1, "sha256": lambda c: F.sha2(c, 256), "sha512": lambda c: F.sha2(c, 512),
    "crc32": lambda c: F.lpad(F.lower(F.hex(F.crc32(c))), 8, "0"),
}


def _listed(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The files below a folder, with the folders dealt to a few listing tasks per core: Spark makes up to 10,000 tasks of them,
    each for a folder or two.  The files are listed here, so the setting is the session's own again afterwards."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").options(**options).load(path)
    finally:
        spark.conf.set(name, before)


def file_table(spark: SparkSession, path: str, pattern: str | None = None, digest: str = "md5") -> DataFrame:
    """All files below a folder: path, name, size, modified, digest (one of ``DIGESTS``).

    The content is read by the tasks and only its digest is kept.
    """
    if digest not in DIGESTS:
        raise ValueError(f"unknown digest {digest}")
    options = {"pathGlobFilter": pattern} if pattern else {}
    return _listed(spark, path, **options).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
        DIGESTS[digest]("content").alias("digest"),
    )


def nonempty_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every file with at least one byte; no content is read.

    Spark leaves empty files out when it plans a scan, so the listing is the filter.
    """
    return _listed(spark, path).select("path", F.col("length").alias("size"))


def duplicate_files(found: DataFrame) -> DataFrame:
    """Digests held by more than one file: how many files and bytes, and the first path."""
    return (
        found.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"), F.min("path").alias("first_path"))
        .filter("n_files > 1")
    )


def keep_newest(found: DataFrame) -> DataFrame:
    """Per digest with copies: the file to keep (newest, then shortest path) and the bytes the rest holds.

    The choice is an aggregate, so a digest with any number of copies is combined map-side.
    """
    order = F.struct((-F.unix_micros("modified")).alias("m"), F.length("path").alias("l"), F.col("path").alias("p"))
    best = F.min_by(F.struct("path", "name", "size", "modified"), order)
    out = found.groupBy("digest").agg(best.alias("k"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    return out.filter("n > 1").select(
        "digest", F.col("k.path").alias("keep_path"), (F.col("n") - 1).alias("n_delete"),
        (F.col("bytes") - F.col("k.size")).alias("bytes_saved"),
    )
