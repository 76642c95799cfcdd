"""Inputs in the shapes the operators expect, derived from the given tables.

Every frame has its SQL twin, so that a query and its check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import table


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


# ---- web shop events: product, session and amount come from the event itself
SHOP = """shop AS (
  SELECT event_id, ts AS event_time, CAST(user_id AS VARCHAR) AS user_id, event_type,
         CAST(json_extract(props, '$.k') AS VARCHAR) AS product_id,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         value AS amount
  FROM events)"""


def shop_columns(df: DataFrame) -> DataFrame:
    user = F.col("user_id").cast("string")
    return df.select(
        "event_id",
        F.col("ts").alias("event_time"),
        user.alias("user_id"),
        "event_type",
        F.get_json_object("props", "$.k").alias("product_id"),
        F.concat_ws("-", user, F.to_date("ts").cast("string")).alias("session_id"),
        F.col("value").alias("amount"),
    )


def shop(spark: SparkSession, sf: str) -> DataFrame:
    return shop_columns(events(spark, sf))


# ---- comma-separated sales lines; some are broken in a known way
SALES = """lines AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 50 = 7 THEN concat_ws(',', CAST(l_shipdate AS DATE), p_name, p_type, l_quantity)
         WHEN l_orderkey % 50 = 8 THEN concat_ws(',', CAST(l_shipdate AS DATE), p_name, p_type, 'many', p_retailprice)
         WHEN l_orderkey % 50 = 9 THEN concat_ws(',', 'no date', p_name, p_type, l_quantity, p_retailprice)
         WHEN l_orderkey % 50 = 10 THEN ''
         ELSE concat_ws(',', CAST(l_shipdate AS DATE), p_name, p_type, l_quantity, p_retailprice) END AS line
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
SALES_OK = SALES + """, split AS (SELECT string_split(line, ',') AS f FROM lines),
 sales AS (
  SELECT try_strptime(f[1], '%Y-%m-%d') AS d, f[2] AS product, f[3] AS category,
         try_cast(f[4] AS DOUBLE) AS quantity, try_cast(f[5] AS DOUBLE) AS price
  FROM split WHERE len(f) = 5)"""
SALES_GOOD = SALES_OK + """, good AS (
  SELECT *, quantity * price AS amount, strftime(d, '%Y-%m') AS month
  FROM sales WHERE d IS NOT NULL AND quantity IS NOT NULL AND price IS NOT NULL)"""


def sales_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity")
    pt = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    day, kind = F.to_date("l_shipdate"), F.col("l_orderkey") % 50
    line = (
        F.when(kind == 7, F.concat_ws(",", day, "p_name", "p_type", "l_quantity"))
        .when(kind == 8, F.concat_ws(",", day, "p_name", "p_type", F.lit("many"), "p_retailprice"))
        .when(kind == 9, F.concat_ws(",", F.lit("no date"), "p_name", "p_type", "l_quantity", "p_retailprice"))
        .when(kind == 10, "")
        .otherwise(F.concat_ws(",", day, "p_name", "p_type", "l_quantity", "p_retailprice"))
    )
    return li.join(pt, li.l_partkey == pt.p_partkey).select("l_orderkey", "l_linenumber", line.alias("value"))


# ---- ratings: a customer rates a part by the largest quantity ordered at once
RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(max(least(5, greatest(1, ceil(l_quantity / 10)))) AS DOUBLE) AS rating,
         CAST(max(epoch(o_orderdate)) AS BIGINT) AS rated_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    score = F.least(F.lit(5), F.greatest(F.lit(1), F.ceil(F.col("l_quantity") / 10)))
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(
            F.max(score).cast("double").alias("rating"),
            F.max(F.unix_timestamp("o_orderdate")).alias("rated_at"),
        )
    )


# ---- customer features with a yes/no target
CHURN = """churn AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS segment,
         CASE WHEN c_nationkey % 3 = 0 THEN 'Month-to-month' WHEN c_nationkey % 3 = 1 THEN 'One year' ELSE 'Two year' END AS contract,
         CAST(count(*) AS BIGINT) AS n_orders,
         CAST(date_diff('day', min(o_orderdate), TIMESTAMP '2002-01-01') AS BIGINT) AS tenure,
         round(round(sum(o_totalprice), 2) / count(*), 6) AS monthly, round(sum(o_totalprice), 2) AS total,
         CASE WHEN max(o_orderdate) < TIMESTAMP '2001-06-01' THEN 'Yes' ELSE 'No' END AS churn
  FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2, 3)"""


def churn(spark: SparkSession, sf: str) -> DataFrame:
    cu = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    od = table(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    per = od.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.datediff(F.lit("2002-01-01").cast("date"), F.min("o_orderdate")).cast("long").alias("tenure"),
        F.round(F.round(F.sum("o_totalprice"), 2) / F.count(F.lit(1)), 6).alias("monthly"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.when(F.max("o_orderdate") < F.lit("2001-06-01").cast("timestamp"), "Yes").otherwise("No").alias("churn"),
    )
    plan = F.col("c_nationkey") % 3
    return cu.join(per, cu.c_custkey == per.o_custkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.when(plan == 0, "Month-to-month").when(plan == 1, "One year").otherwise("Two year").alias("contract"),
        "n_orders", "tenure", "monthly", "total", "churn",
    )


# ---- measurements with '-' for a missing value
TRIPS = """trips AS (
  SELECT o_orderkey AS row_id, n AS distance, quantity AS moving_time, o_totalprice AS max_speed, o_orderstatus AS going_to,
         CASE WHEN o_orderkey % 12 = 0 THEN '-' ELSE CAST(fuel AS VARCHAR) END AS fuel
  FROM orders JOIN (SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n, sum(l_quantity) AS quantity, max(l_extendedprice) AS fuel
                    FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)"""


def trips(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("distance"),
        F.sum("l_quantity").alias("moving_time"),
        F.max("l_extendedprice").alias("fuel"),
    )
    od = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return od.join(li, od.o_orderkey == li.l_orderkey).select(
        F.col("o_orderkey").alias("row_id"),
        "distance",
        "moving_time",
        F.col("o_totalprice").alias("max_speed"),
        F.col("o_orderstatus").alias("going_to"),
        F.when(F.col("o_orderkey") % 12 == 0, "-").otherwise(F.col("fuel").cast("string")).alias("fuel"),
    )


# ---- Kafka-like envelopes with a JSON value
def envelopes(df: DataFrame) -> DataFrame:
    """Events as topic / partition / offset / timestamp / JSON value, like a message log."""
    payload = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.unix_millis("ts").alias("timestamp"),
        F.create_map(
            F.lit("amount"), F.col("value").cast("string"), F.lit("product_id"), F.get_json_object("props", "$.k")
        ).alias("properties"),
    )
    return df.select(
        F.lit("user_events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.to_json(payload).alias("value"),
    )
