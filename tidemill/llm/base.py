"""What the operators of this package share: tables in the shared folder and typed schemas."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tidemill.session import fresh_dir


#: rows of one Arrow batch: texts are long, and a batch is held several times over while Python works on it
BATCH_ROWS = 2000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Send rows to Python in small batches, so that a worker's memory is bounded by few texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: lost executors lose none of them."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kind(df: DataFrame, name: str) -> str:
    """The SQL type of a column."""
    return df.schema[name].dataType.simpleString()


def arrow_type(spark_type: DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(spark_type)


def give_back() -> None:
    """Give freed memory back to the system: worker processes outlive their tasks and go on with other ones."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps what it has freed
    if trim:
        trim(0)


def by_batch(columns: dict[str, pa.DataType], rows: Callable[[pa.RecordBatch], dict]) -> Callable:
    """A function for mapInArrow that turns each batch into columns of the given types."""
    schema = pa.schema(list(columns.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = rows(batch)
            yield pa.RecordBatch.from_arrays([pa.array(out[c], type=t) for c, t in columns.items()], schema=schema)
        give_back()

    return run


def more_columns(df: DataFrame, **types: DataType) -> StructType:
    """The schema of a table with columns added."""
    return StructType([*df.schema.fields, *(StructField(n, t) for n, t in types.items())])


def arrow_columns(schema: StructType) -> dict[str, pa.DataType]:
    return {f.name: arrow_type(f.dataType) for f in schema.fields}


def with_row(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, and the whole row as ``row``, for operators that give rows back as they came."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def two(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under names of their own, so that no other column of the caller can clash."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def text_digest(text: Column) -> Column:
    """32 bytes that stand for a whole text."""
    return F.unhex(F.sha2(text, 256))
