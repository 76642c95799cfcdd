"""Projections, filters, predicates, cleaning."""

from pyspark.sql import functions as F

from tidemill.functions import numbers as N
from tidemill.operators import clean
from tidemill.operators.rank import row_index
from tidemill.plans import inputs as I
from tidemill.plans.registry import query
from tidemill.session import table

KINDS = ["purchase", "click", "view"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("enrich_file_events", sql=f"""WITH {I.SHOP}
SELECT event_id, event_time, user_id, event_type, amount, CAST(hour(event_time) AS INTEGER) AS hour, CAST(event_time AS DATE) AS date
FROM shop WHERE amount > 0 AND event_type IN ('purchase', 'click', 'view')""")
def enrich(spark, sf):
    out = clean.enrich_events(I.shop(spark, sf), KINDS)
    return out.select("event_id", "event_time", "user_id", "event_type", "amount", "hour", "date")


@query("filter_alerts", sql=f"""WITH {I.SHOP}
SELECT event_id, user_id, event_time, session_id FROM shop WHERE event_type = 'error'""")
def alerts(spark, sf):
    return I.shop(spark, sf).filter("event_type = 'error'").select("event_id", "user_id", "event_time", "session_id")


@query("validate_split", sql=f"""WITH {I.SHOP}, x AS (
  SELECT *, CASE WHEN product_id = '7' THEN NULL ELSE user_id END AS uid FROM shop)
SELECT event_id, uid AS user_id, (uid IS NOT NULL AND event_time IS NOT NULL) AS is_valid FROM x""")
def validated(spark, sf):
    # events of product 7 stand for messages without a user
    df = I.shop(spark, sf).withColumn("user_id", F.expr("CASE WHEN product_id = '7' THEN NULL ELSE user_id END"))
    good, bad = clean.validate_split(df, ["user_id", "event_time"])
    cols = lambda d, ok: d.select("event_id", "user_id", F.lit(ok).alias("is_valid"))
    return cols(good, True).unionByName(cols(bad, False))


@query("head_tail_project", sql="""
SELECT * FROM (SELECT 'head' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'tail' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5)""")
def head_tail(spark, sf):
    od = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    head = od.orderBy("o_orderkey").limit(5).select(F.lit("head").alias("part"), "*")
    tail = od.orderBy(F.desc("o_orderkey")).limit(5).select(F.lit("tail").alias("part"), "*")
    return head.unionByName(tail)


@query("filter_gt_median", sql=f"""WITH {I.CHURN}, m AS (SELECT quantile_cont(monthly, 0.5) AS mm, quantile_cont(tenure, 0.5) AS mt FROM churn)
SELECT customer_id, monthly, tenure, monthly > mm AS above_monthly, (monthly > mm AND tenure > mt) AS above_both FROM churn, m""")
def gt_median(spark, sf):
    df = I.churn(spark, sf)
    one, two = clean.above_median(df, ["monthly"]), clean.above_median(df, ["monthly", "tenure"])
    return df.select("customer_id", "monthly", "tenure", one.alias("above_monthly"), two.alias("above_both"))


NULLED = f"""{I.TRIPS}, n AS (SELECT row_id, distance, moving_time, going_to,
  try_cast(nullif(fuel, '-') AS DOUBLE) AS fuel FROM trips)"""


def nulled(spark, sf):
    return I.trips(spark, sf).select(
        "row_id", "distance", "moving_time", "going_to", N.sentinel_to_null(F.col("fuel"), "-").alias("fuel")
    )


@query("sentinel_to_null", sql=f"WITH {NULLED} SELECT * FROM n")
def sentinel_null(spark, sf):
    return nulled(spark, sf)


@query("null_counts", sql=f"""WITH {NULLED}
SELECT unnest(['row_id','distance','moving_time','going_to','fuel']) AS column_name,
 unnest([count(*) - count(row_id), count(*) - count(distance), count(*) - count(moving_time), count(*) - count(going_to), count(*) - count(fuel)]) AS nulls FROM n""")
def nulls(spark, sf):
    return clean.null_counts(nulled(spark, sf))


@query("sentinel_counts", sql=f"""WITH {I.TRIPS}
SELECT unnest(['going_to','fuel']) AS column_name,
 unnest([CAST(count_if(going_to = '-') AS BIGINT), CAST(count_if(fuel = '-') AS BIGINT)]) AS sentinels FROM trips""")
def sentinels(spark, sf):
    return clean.sentinel_counts(I.trips(spark, sf).select("going_to", "fuel"), "-")


@query("null_row_ids", sql=f"WITH {NULLED} SELECT row_id, distance FROM n WHERE fuel IS NULL")
def null_rows(spark, sf):
    df = nulled(spark, sf)
    ids = clean.rows_with_null(df).select("row_id")
    return df.join(ids, "row_id", "left_semi").select("row_id", "distance")


@query("fill_const", sql=f"WITH {NULLED} SELECT row_id, coalesce(fuel, 0.0) AS fuel FROM n")
def filled(spark, sf):
    return nulled(spark, sf).select("row_id", "fuel").na.fill(0.0, ["fuel"])


@query("recode_map", sql=f"""WITH {I.CHURN}
SELECT customer_id, CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS churn_flag,
 CASE contract WHEN 'One year' THEN '1' WHEN 'Two year' THEN '2' ELSE contract END AS contract_years FROM churn""")
def recoded(spark, sf):
    return I.churn(spark, sf).select(
        "customer_id",
        N.recode(F.col("churn"), {"Yes": 1, "No": 0}, "int").alias("churn_flag"),
        N.recode(F.col("contract"), {"One year": 1, "Two year": 2}).alias("contract_years"),
    )


@query("strip_currency", sql="""WITH t AS (SELECT o_orderkey, '$' || CAST(o_totalprice AS VARCHAR) AS price FROM orders)
SELECT o_orderkey, CAST(replace(replace(price, '$', ''), ',', '') AS DOUBLE) AS price FROM t""")
def currency(spark, sf):
    text = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))  # "$1,234.50"
    return table(spark, sf, "orders").select("o_orderkey", N.money(text).alias("price"))


@query("ratio_feature", sql=f"WITH {I.CHURN} SELECT customer_id, round(total / nullif(tenure, 0), 6) AS per_day FROM churn")
def ratio(spark, sf):
    return I.churn(spark, sf).select("customer_id", F.round(N.ratio(F.col("total"), F.col("tenure")), 6).alias("per_day"))


@query("drop_columns", sql="SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def dropped(spark, sf):
    return table(spark, sf, "customer").drop("c_name", "c_acctbal")


@query("drop_rows_by_id", sql=f"""WITH {I.CHURN} SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT customer_id FROM churn WHERE churn = 'Yes')""")
def dropped_rows(spark, sf):
    bad = I.churn(spark, sf).filter("churn = 'Yes'").select(F.col("customer_id").alias("o_custkey"))
    return clean.drop_by_id(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), bad, "o_custkey")


@query("assign_row_id", sql="""SELECT c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS row_index FROM customer""")
def row_ids(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_name")
    return row_index(df, ["c_custkey"]).select("c_name", "row_index")


@query("one_hot", sql="SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS segment_{s}" for s in SEGMENTS) + " FROM customer")
def hot(spark, sf):
    return clean.one_hot(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", SEGMENTS, "segment")


@query("null_to_empty", sql=f"""WITH a AS (SELECT doc_id, CASE WHEN lang = 'en' THEN source END AS author FROM documents)
SELECT doc_id, coalesce(author, '') AS author FROM a""")
def empty(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("lang") == "en", F.col("source")).alias("author"))
    return docs.select("doc_id", F.coalesce("author", F.lit("")).alias("author"))


@query("upper_text", sql="SELECT p_partkey, upper(p_name) AS value FROM part")
def upper(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("value"))
