"""Sorts, limits, top-k and ordered windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators import aggregate as A
from tidemill.plans import inputs as I
from tidemill.plans.registry import query
from tidemill.session import table

LOG = "log AS (SELECT '10.0.0.' || CAST(user_id % 50 AS VARCHAR) || ' - ' || event_type AS line FROM events)"


@query("top10_ips", sql=f"""WITH {LOG} SELECT string_split(line, ' ')[1] AS ip, count(*) AS n FROM log
GROUP BY 1 ORDER BY n DESC, ip DESC LIMIT 10""")
def top_ips(spark, sf):
    line = F.concat(F.lit("10.0.0."), (F.col("user_id") % 50).cast("string"), F.lit(" - "), F.col("event_type"))
    first = F.try_element_at(F.split(F.trim(line), r"\s+"), F.lit(1))
    return A.value_counts(I.events(spark, sf).select(first.alias("ip")), "ip").orderBy(F.desc("n"), F.desc("ip")).limit(10)


@query("sort_by_rating", sql=f"WITH {I.RATINGS} SELECT item_id, rating FROM ratings WHERE user_id = 7 ORDER BY rating DESC, item_id")
def by_rating(spark, sf):
    return I.ratings(spark, sf).filter("user_id = 7").select("item_id", "rating").orderBy(F.desc("rating"), "item_id")


@query("sorted_unique_lines", "dedup_external_sort", sql=r"""SELECT DISTINCT trim(line) AS line FROM (
 SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(line) <> '' ORDER BY 1""")
def unique_lines(spark, sf):
    lines = table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.select(F.trim("line").alias("line")).filter("line <> ''").distinct().orderBy("line")


@query("win_diff", sql="""WITH m AS (SELECT date_trunc('month', o_orderdate) AS month, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
SELECT strftime(month, '%Y-%m') AS month, total, round(total - lag(total) OVER (ORDER BY month), 2) AS diff FROM m""")
def diffs(spark, sf):
    per = table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    totals = per.agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    # one row per month, so the global window is small at every scale
    w = Window.orderBy("month")
    return totals.withColumn("diff", F.round(F.col("total") - F.lag("total").over(w), 2))
