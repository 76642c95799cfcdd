"""User functions over partitions, shards and rows."""

import pandas as pd
from pyspark.sql import functions as F

from tidemill.operators import partitions as M
from tidemill.operators import shards as H
from tidemill.plans.registry import query
from tidemill.session import fresh_dir, table

SCHEMA = "o_orderkey long, shard_id long, doubled double"
DOUBLED = "SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders"
ROWS = 2_000  # rows per shard: bounds the memory of a task at every scale


def orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


def sharded(spark, sf):
    return H.shard_by_size(orders(spark, sf), ["o_orderkey"], ROWS)


def double(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf[["o_orderkey"]].assign(doubled=pdf["o_totalprice"] * 2)


def double_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf[["o_orderkey", "shard_id"]].assign(doubled=pdf["o_totalprice"] * 2)


def fail_some(pdf: pd.DataFrame) -> pd.DataFrame:
    """Every fifth shard fails for good."""
    if pdf["shard_id"].iloc[0] % 5 == 4:
        raise ValueError("bad shard")
    return double_shard(pdf)


@query("map_partitions", sql=DOUBLED)
def partitions(spark, sf):
    return M.map_partitions(orders(spark, sf), double, "o_orderkey long, doubled double")


SHARD_SUMS = f"""WITH s AS (SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // {ROWS} AS shard_id FROM orders)
SELECT CAST(shard_id AS BIGINT) AS shard_id, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM s GROUP BY 1"""


def summed(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"shard_id": [int(pdf["shard_id"].iloc[0])], "n": [len(pdf)], "total": [round(pdf["o_totalprice"].sum(), 2)]})


@query("map_shards", "concat_shards", sql=SHARD_SUMS)
def shards(spark, sf):
    return M.map_shards(sharded(spark, sf), summed, "shard_id long, n long, total double")


@query("map_in_batches", sql=SHARD_SUMS)
def batches(spark, sf):
    return M.map_in_batches(orders(spark, sf), ["o_orderkey"], ROWS, summed, "shard_id long, n long, total double")


@query("map_rows", sql="SELECT o_orderkey, upper(o_orderpriority) AS label FROM orders")
def rows(spark, sf):
    return M.map_rows(orders(spark, sf), str.upper, ["o_orderpriority"], "string", "label").select("o_orderkey", "label")


@query("map_multi_args", sql="SELECT o_orderkey, CAST(o_orderkey + o_custkey AS BIGINT) AS both FROM orders")
def multi(spark, sf):
    return M.map_rows(orders(spark, sf), lambda a, b: a + b, ["o_orderkey", "o_custkey"], "long", "both").select("o_orderkey", "both")


@query("map_with_broadcast", "join_broadcast_side", sql="""SELECT o_orderkey, o_totalprice * f AS scaled FROM orders
 JOIN (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) AS DOUBLE) AS f FROM (SELECT DISTINCT o_orderpriority FROM orders)) USING (o_orderpriority)""")
def with_side(spark, sf):
    df = orders(spark, sf)
    side = H.shard_by_key(df.select("o_orderpriority").distinct(), "o_orderpriority")
    side = side.select("o_orderpriority", (F.col("shard_id") + 1).cast("double").alias("f"))
    joined = M.map_with_side(df, side, "o_orderpriority")
    return joined.select("o_orderkey", (F.col("o_totalprice") * F.col("f")).alias("scaled"))


STATUS = f"""WITH s AS (SELECT *, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // {ROWS} AS BIGINT) AS shard_id FROM orders),
 g AS (SELECT shard_id, count(*) AS n, shard_id % 5 = 4 AS bad FROM s GROUP BY 1)
SELECT shard_id, CASE WHEN bad THEN 'failed' ELSE 'success' END AS status, CAST(CASE WHEN bad THEN {{a}} ELSE 1 END AS INTEGER) AS attempts,
 CASE WHEN bad THEN 'ValueError: bad shard' END AS error, CASE WHEN bad THEN 0 ELSE n END AS n_results FROM g"""


@query("map_with_retry", sql=STATUS.format(a=4))
def retry(spark, sf):
    return M.shard_status(M.map_with_retry(sharded(spark, sf), fail_some, retries=3, delay=0.001))


@query("map_async_errors", sql=STATUS.format(a=1))
def errors(spark, sf):
    return M.shard_status(M.map_with_retry(sharded(spark, sf), fail_some, retries=0))


@query("map_with_progress", sql=f"""WITH x AS ({STATUS.format(a=1)})
SELECT CAST(count_if(status = 'success') AS BIGINT) AS finished, CAST(count_if(status = 'failed') AS BIGINT) AS failed, count(*) AS shards,
 round(count_if(status = 'success') * 100.0 / count(*), 6)::DOUBLE AS percent FROM x""")
def finished(spark, sf):
    df = sharded(spark, sf)
    status = M.shard_status(M.map_with_retry(df, fail_some, retries=0))
    total = -(-orders(spark, sf).count() // ROWS)
    return M.progress(status, total).withColumn("percent", F.round("percent", 6))


@query("map_with_checkpoint", sql=DOUBLED)
def checkpointed(spark, sf):
    path, df = fresh_dir(spark, "shards"), sharded(spark, sf)
    first = df.filter(F.pmod("shard_id", F.lit(4)) < 2)
    for wave in range(2):  # an earlier run got half of the waves done
        part = first.filter(F.pmod("shard_id", F.lit(4)) == wave)
        M.map_shards(part, double_shard, SCHEMA).write.parquet(f"{path}/wave={wave}")
    return M.map_with_checkpoint(df, double_shard, SCHEMA, path).select("o_orderkey", "doubled")


@query("heavy_task_suite", "math_sum_squares", sql="""SELECT o_orderkey, CAST(m * (m - 1) * (2 * m - 1) // 6 AS BIGINT) AS cpu_task,
 CAST(length(o_orderpriority) AS INTEGER) AS io_task, o_orderkey * 100 AS memory_task FROM (SELECT *, o_orderkey % 1000 AS m FROM orders)""")
def heavy(spark, sf):
    tasks = M.heavy_tasks(F.col("o_orderkey"), F.col("o_orderpriority"))
    return orders(spark, sf).select("o_orderkey", *[c.alias(n) for n, c in tasks.items()])


@query("score_text", sql=r"""SELECT doc_id, round((length(text) - length(replace(text, 'e', '')))::DOUBLE / length(text), 9) AS score FROM documents""")
def scored(spark, sf):
    # no letters at all: 0 / 0, which the SQL answers with NaN
    out = M.score_text(table(spark, sf, "documents").select("doc_id", "text"), "text", lambda t: t.count("e") / len(t) if t else float("nan"))
    return out.select("doc_id", F.round("score", 9).alias("score"))
