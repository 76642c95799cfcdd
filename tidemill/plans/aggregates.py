"""Aggregations."""

from pyspark.sql import functions as F

from tidemill.functions import text as X
from tidemill.operators import aggregate as A
from tidemill.plans import inputs as I
from tidemill.plans.registry import query
from tidemill.session import table


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


@query("wordcount_java", sql=r"""SELECT word, count(*) AS n FROM (
 SELECT unnest(string_split_regex(regexp_replace(lower(text), '[^a-z0-9\s]', '', 'g'), '\s+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def wc_letters(spark, sf):
    return A.count_tokens(docs(spark, sf), X.letters_only_words(F.col("text")))


@query("wordcount_regex", sql=r"""SELECT word, count(*) AS n FROM (
 SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM documents) GROUP BY word""")
def wc_regex(spark, sf):
    return A.count_tokens(docs(spark, sf), X.word_matches(F.col("text")))


@query("wordcount_space", sql="""SELECT word, count(*) AS n FROM (
 SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""")
def wc_space(spark, sf):
    return A.count_tokens(docs(spark, sf), F.split("text", " "))


def good_sales(spark, sf):
    return A.parse_sales(I.sales_lines(spark, sf)).filter("is_valid")


def rounded(df):
    # the rounded total is the same number on every engine, so its quotient rounds alike too
    return df.withColumn("total", F.round("total", 2)).withColumn("average", F.round(F.col("total") / F.col("n"), 6))


@query("sales_by_category", sql=f"""WITH {I.SALES_GOOD}
SELECT category, round(sum(amount), 2) AS total, count(*) AS n, round(round(sum(amount), 2) / count(*), 6) AS average FROM good GROUP BY 1""")
def by_category(spark, sf):
    return rounded(A.totals(good_sales(spark, sf), ["category"]))


@query("sales_by_product", sql="""WITH lines AS (
  SELECT concat_ws(',', CAST(l_shipdate AS DATE), p_name, l_quantity, p_retailprice) AS line
  FROM lineitem JOIN part ON l_partkey = p_partkey), f AS (SELECT string_split(line, ',') AS f FROM lines)
SELECT f[2] AS product, round(sum(try_cast(f[3] AS DOUBLE) * try_cast(f[4] AS DOUBLE)), 2) AS total FROM f
WHERE len(f) = 4 AND try_cast(f[3] AS DOUBLE) IS NOT NULL AND try_cast(f[4] AS DOUBLE) IS NOT NULL GROUP BY 1""")
def by_product(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    pt = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    line = F.concat_ws(",", F.to_date("l_shipdate"), "p_name", "l_quantity", "p_retailprice")
    lines = li.join(pt, li.l_partkey == pt.p_partkey).select(line.alias("value"))
    good = A.parse_sales(lines, with_category=False).filter("is_valid")
    return good.groupBy("product").agg(F.round(F.sum("amount"), 2).alias("total"))


@query("sales_multi_dim", sql=f"""WITH {I.SALES_GOOD}
SELECT CASE WHEN grouping(category) = 0 THEN 'category' WHEN grouping(month) = 0 THEN 'month' ELSE 'product' END AS dimension,
 coalesce(category, month, product) AS key, round(sum(amount), 2) AS total, count(*) AS n, round(round(sum(amount), 2) / count(*), 6) AS average
FROM good GROUP BY GROUPING SETS ((category), (month), (product))""")
def multi_dim(spark, sf):
    return rounded(A.totals_by_each(good_sales(spark, sf), ["category", "month", "product"]))


@query("sales_kv_output", sql=f"""WITH {I.SALES_GOOD}, t AS (
 SELECT category, sum(amount) AS total, count(*) AS n, avg(amount) AS average FROM good GROUP BY 1)
SELECT category || '_total' AS key, printf('%.2f', total) AS value FROM t
UNION ALL SELECT category || '_count', CAST(n AS VARCHAR) FROM t
UNION ALL SELECT category || '_average', printf('%.2f', average) FROM t""")
def kv_output(spark, sf):
    return A.as_key_values(A.totals(good_sales(spark, sf), ["category"]), "category")


@query("invalid_record_count", sql=f"""WITH {I.SALES_GOOD}
SELECT CAST((SELECT count(*) FROM lines) - (SELECT count(*) FROM good) AS BIGINT) AS invalid, (SELECT count(*) FROM lines) AS n_lines""")
def invalid(spark, sf):
    return A.parse_sales(I.sales_lines(spark, sf)).agg(
        F.count_if(~F.col("is_valid")).alias("invalid"), F.count(F.lit(1)).alias("n_lines")
    )


@query("value_counts", sql="SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1")
def counts(spark, sf):
    return A.value_counts(table(spark, sf, "orders"), "o_orderpriority").orderBy(F.desc("n"), "o_orderpriority")


@query("value_counts_norm", "win_share", sql=f"""WITH {I.CHURN}
SELECT 'all' AS scope, contract, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM churn GROUP BY 2
UNION ALL SELECT 'churned', contract, count(*), round(count(*) / sum(count(*)) OVER (), 9) FROM churn WHERE churn = 'Yes' GROUP BY 2""")
def shares(spark, sf):
    df = I.churn(spark, sf)
    scoped = lambda d, s: A.value_shares(d, "contract").select(
        F.lit(s).alias("scope"), "contract", "n", F.round("share", 9).alias("share")
    )
    return scoped(df, "all").unionByName(scoped(df.filter("churn = 'Yes'"), "churned"))


@query("distinct_values", sql=" UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM lineitem" for c in ("l_returnflag", "l_linestatus"))
    + " UNION ALL SELECT DISTINCT 'l_linenumber', CAST(l_linenumber AS VARCHAR) FROM lineitem")
def distincts(spark, sf):
    return A.distinct_values(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


def described(table_sql, c, by=""):
    g = f"{by}, " if by else ""
    return (
        f"SELECT {g}'{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,"
        f" CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,"
        f" round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM {table_sql}" + (f" GROUP BY {by}" if by else "")
    )


def round_stats(df):
    for c in ("mean", "std", "p25", "p50", "p75"):
        df = df.withColumn(c, F.round(c, 6))
    return df


@query("describe", sql=" UNION ALL ".join(described("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_tax")))
def desc(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_tax"]
    return round_stats(A.describe(table(spark, sf, "lineitem").select(*cols), cols))


@query("describe_by_group", sql=described("(SELECT n_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey"
                                          " JOIN nation ON c_nationkey = n_nationkey)", "o_totalprice", "n_name"))
def desc_by(spark, sf):
    return round_stats(A.describe(nation_prices(spark, sf), ["o_totalprice"], by=["n_name"]))


def nation_prices(spark, sf):
    od = table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    cu = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    na = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (
        od.join(cu, od.o_custkey == cu.c_custkey)
        .join(F.broadcast(na), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows at every scale
        .select("n_name", "o_totalprice")
    )


@query("shape_info", sql="""SELECT unnest(['c_custkey','c_name','c_nationkey','c_acctbal','c_mktsegment']) AS column_name,
 unnest(['bigint','string','int','double','string']) AS type,
 unnest([count(c_custkey), count(c_name), count(c_nationkey), count(c_acctbal), count(c_mktsegment)]) AS non_null, count(*) AS n_rows FROM customer""")
def shape(spark, sf):
    return A.shape_info(table(spark, sf, "customer"))


@query("count_for_key", sql=f"WITH {I.RATINGS} SELECT count(rating) AS n_ratings, count(rated_at) AS n_times FROM ratings WHERE user_id = 7")
def key_count(spark, sf):
    return I.ratings(spark, sf).filter("user_id = 7").agg(
        F.count("rating").alias("n_ratings"), F.count("rated_at").alias("n_times")
    )


@query("rating_histogram", sql=f"WITH {I.RATINGS} SELECT rating, count(*) AS n FROM ratings WHERE user_id = 7 GROUP BY 1")
def rating_hist(spark, sf):
    return A.value_counts(I.ratings(spark, sf).filter("user_id = 7"), "rating").orderBy("rating")


@query("event_counts_by_window", sql=f"""WITH {I.SHOP}
SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start, time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end,
 event_type, count(*) AS n FROM shop GROUP BY ALL""")
def window_counts(spark, sf):
    return A.event_windows(I.shop(spark, sf), "1 minute", ["event_type"], [F.count(F.lit(1)).alias("n")])


@query("collect_sequence", sql=f"""WITH {I.SHOP}
SELECT session_id, string_agg(event_type, ',' ORDER BY event_time, event_id) AS sequence,
 array_to_string(list_sort(list_distinct(list(product_id))), ',') AS products,
 first(event_type ORDER BY event_time, event_id) AS first_type, last(event_type ORDER BY event_time, event_id) AS last_type
FROM shop GROUP BY 1""")
def sequences(spark, sf):
    # one user and day per group: bounded by what one visitor can do in a day
    key = F.struct("event_time", "event_id")
    steps = F.array_sort(F.collect_list(F.struct("event_time", "event_id", "event_type")))
    return I.shop(spark, sf).groupBy("session_id").agg(
        F.array_join(steps["event_type"], ",").alias("sequence"),
        F.array_join(F.array_sort(F.collect_set("product_id")), ",").alias("products"),
        F.min_by("event_type", key).alias("first_type"),
        F.max_by("event_type", key).alias("last_type"),
    )


@query("conditional_sum", sql=f"""WITH {I.SHOP}
SELECT user_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases FROM shop GROUP BY 1""")
def conditional(spark, sf):
    one = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    return I.shop(spark, sf).groupBy("user_id").agg(F.sum(one).alias("purchases"))


TOKENS = r"""tok AS (SELECT unnest(string_split_regex(regexp_replace(lower(text), '[^a-z0-9\s]', '', 'g'), '\s+')) AS word FROM documents),
freq AS (SELECT word, count(*) AS n FROM tok WHERE word <> '' GROUP BY word)"""


@query("freq_dist_top", sql=f"WITH {TOKENS} SELECT * FROM freq ORDER BY n DESC, word LIMIT 20")
def freq_top(spark, sf):
    return wc_letters(spark, sf).orderBy(F.desc("n"), "word").limit(20)


@query("freq_dist_bottom", sql=f"WITH {TOKENS} SELECT * FROM freq ORDER BY n, word LIMIT 10")
def freq_bottom(spark, sf):
    return wc_letters(spark, sf).orderBy("n", "word").limit(10)


@query("exact_dup_groups", "db_exact_duplicates", sql="""SELECT p_name, p_brand, p_type, count(*) AS n FROM part
GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def dup_groups(spark, sf):
    return A.repeated_keys(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"])


@query("approx_distinct_users", sql=f"""WITH {I.SHOP}
SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start, count(DISTINCT user_id) AS users FROM shop GROUP BY 1""")
def distinct_users(spark, sf):
    out = A.event_windows(I.shop(spark, sf), "5 minutes", [], [F.countDistinct("user_id").alias("users")])
    return out.select("window_start", "users")


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("pivot_wide", sql=f"""WITH {I.RATINGS}
SELECT user_id, {', '.join(f"coalesce(max(CASE WHEN p_type = '{t}' THEN rating END), -1.0) AS {t}" for t in TYPES)}
FROM ratings JOIN part ON item_id = p_partkey GROUP BY 1""")
def pivoted(spark, sf):
    pt = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_type")
    rated = I.ratings(spark, sf).join(pt, "item_id")
    return A.pivot_wide(rated, "user_id", "p_type", "rating", TYPES)
