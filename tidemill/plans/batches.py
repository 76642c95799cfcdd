"""The daily batch."""

from datetime import date

from pyspark.sql import functions as F

from tidemill.operators import aggregate as A
from tidemill.operators import batch as B
from tidemill.plans import inputs as I
from tidemill.plans.registry import query
from tidemill.session import fresh_dir, table

TODAY = date(2024, 1, 30)


def staged(spark, sf):
    """Events by day, ingested twice: the second run brings the last days again."""
    path = fresh_dir(spark, "daily")
    ev = I.shop(spark, sf).withColumn("date", F.to_date("event_time"))
    B.ingest_daily(ev, path)
    B.ingest_daily(ev.filter("date >= '2024-01-25'"), path)
    return spark.read.parquet(path)


@query("batch_ingest_daily", sql="SELECT CAST(ts AS DATE) AS date, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def ingest(spark, sf):
    return staged(spark, sf).groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))


@query("batch_retention", sql="SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-23' GROUP BY 1")
def retention(spark, sf):
    return B.retained(staged(spark, sf), TODAY).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("batch_retention_expired", sql="SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-23'")
def expired(spark, sf):
    return B.expired_days(staged(spark, sf), TODAY)


@query("batch_validate", sql=f"""WITH {I.SALES_GOOD} SELECT 'valid' AS part, count(*) AS n FROM good
UNION ALL SELECT 'quarantine', (SELECT count(*) FROM lines) - (SELECT count(*) FROM good)""")
def validate(spark, sf):
    parsed = A.parse_sales(I.sales_lines(spark, sf))
    out = parsed.groupBy(F.when(F.col("is_valid"), "valid").otherwise("quarantine").alias("part"))
    return out.agg(F.count(F.lit(1)).alias("n"))


def sales_files(spark, sf):
    path = fresh_dir(spark, "sales")
    lines = I.sales_lines(spark, sf).withColumn("store", F.col("l_orderkey") % 6).select("store", "value")
    lines.write.partitionBy("store").text(path)
    return path


PER_FILE = f"""WITH {I.SALES_GOOD.replace("SELECT l_orderkey, l_linenumber,", "SELECT l_orderkey % 6 AS store,").replace("SELECT string_split(line, ',') AS f FROM lines", "SELECT store, string_split(line, ',') AS f FROM lines").replace("SELECT try_strptime", "SELECT store, try_strptime")}"""


@query("batch_process", sql=f"{PER_FILE} SELECT 'store=' || store AS file_group, category, count(*) AS n, round(sum(amount), 2) AS total FROM good GROUP BY 1, 2")
def process(spark, sf):
    lines = B.with_file(spark.read.text(sales_files(spark, sf)))
    good = A.parse_sales(lines).filter("is_valid")
    group = F.regexp_extract("file", r"(store=\d+)", 1).alias("file_group")
    return good.groupBy(group, "category").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))


@query("batch_daily_summary", sql=f"WITH {I.SALES_GOOD} SELECT category, count(*) AS n, round(sum(amount), 2) AS total FROM good GROUP BY 1")
def summary(spark, sf):
    out = fresh_dir(spark, "summary")
    good = A.parse_sales(spark.read.text(sales_files(spark, sf))).filter("is_valid")
    per = good.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total"))
    per.coalesce(1).write.parquet(out)  # one row per category
    return spark.read.parquet(out)


@query("batch_customer_analysis", sql="""SELECT c_custkey, c_mktsegment, count(o_orderkey) AS n_orders, round(coalesce(sum(o_totalprice), 0), 2) AS total
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""")
def customers(spark, sf):
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("t")
    )  # shrinks the orders before the join
    cu = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return cu.join(per, cu.c_custkey == per.o_custkey, "left").select(
        "c_custkey", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n_orders"), F.round(F.coalesce("t", F.lit(0.0)), 2).alias("total")
    )


@query("batch_run_report", sql=f"""WITH {I.SALES_GOOD} SELECT 'ingest' AS stage, count(*) AS n_rows, 'done' AS status FROM lines
UNION ALL SELECT 'validate', count(*), 'done' FROM good UNION ALL SELECT 'summarise', count(DISTINCT category), 'done' FROM good""")
def report(spark, sf):
    lines = spark.read.text(sales_files(spark, sf))
    good = A.parse_sales(lines).filter("is_valid")
    n, ok, groups = lines.count(), good.count(), good.select("category").distinct().count()
    return B.run_report(spark, [("ingest", n, "done"), ("validate", ok, "done"), ("summarise", groups, "done")])
