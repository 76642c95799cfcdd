"""Token counts with a cache of digests."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.base import by_batch, stored, text_digest, two
from tidemill.llm.encode import encoder_of


#: places over which the rows of one content are dealt
SALTS = 64


def tokenizer_digest(path: str) -> str:
    """The version of a tokenizer: the digest of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _exists(spark, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_cache(spark, cache_dir: str, version: str) -> DataFrame:
    """digest, n_tokens: what is stored for one version of a tokenizer; one row per digest, whoever appended it."""
    path = f"{cache_dir}/tokenizer={version}"
    if not _exists(spark, path):
        return spark.createDataFrame([], "digest binary, n_tokens bigint")
    return spark.read.schema("digest binary, n_tokens bigint").parquet(path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(
    docs: DataFrame, tokenizer: str, cache_dir: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; whole texts, no special tokens added.

    Contents are known by the digest of the text with its runs of ASCII white space made one space (only if
    the tokenizer drops white space; else of the text as it is) and the digest of the tokenizer's file.
    Each content that the cache lacks is encoded once and appended; the counts of all rows are then joined
    from the cache.  Texts travel once, to meet the one row that stands for their content, and copies not at all
    further, so a content that a third of the rows share costs one encoding.

    A null or empty text has 0 bytes and 0 tokens.  Repeated rows and ids each keep their row, null ids too; an
    empty table gives an empty one.  Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    text = F.coalesce("text", F.lit(""))
    content = text
    if encoder_of(tokenizer).by_word:
        content = F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " "))
    rows = two(docs, id_col, text_col).select("doc_id", content.alias("content"), F.octet_length(text).cast("long").alias("n_bytes"), text_digest(content).alias("digest"))
    keys = stored(rows.drop("content").withColumn("salt", F.monotonically_increasing_id() % SALTS), "token-keys")
    misses = keys.groupBy("digest").agg(F.min("doc_id").alias("least")).join(read_cache(spark, cache_dir, version), "digest", "left_anti")
    texts = (
        rows.drop("n_bytes")
        .join(misses.withColumnRenamed("digest", "d"), (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
        .select("digest", "content")
    )

    def count(batches):
        encoder = encoder_of(tokenizer)
        rows = lambda b: {"digest": b.column("digest"), "n_tokens": list(encoder.count(b.column("content")))}
        return by_batch({"digest": pa.binary(), "n_tokens": pa.int64()}, rows)(batches)

    fresh = texts.mapInArrow(count, "digest binary, n_tokens bigint")
    fresh.write.mode("append").parquet(f"{cache_dir}/tokenizer={version}")
    # the rows of one content meet its count in up to SALTS places
    counts = keys.select("digest", "salt").distinct().join(read_cache(spark, cache_dir, version), "digest")
    return keys.join(counts, ["digest", "salt"], "left").select(
        F.col("doc_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
