"""Statistics, profiling, recommendation."""

from pyspark.sql import functions as F

from tidemill.operators import recommend as R
from tidemill.operators import stats as S
from tidemill.operators.phik import phik_matrix
from tidemill.plans import inputs as I
from tidemill.plans.aggregates import described, nation_prices, round_stats
from tidemill.plans.registry import query
from tidemill.session import cut, table

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def items(spark, sf):
    return table(spark, sf, "lineitem").select(*NUM, "l_returnflag")


def profiled(c, kind, numeric):
    top = f"(SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, v DESC LIMIT 1)"
    stats = described("orders", c) if numeric else f"SELECT '{c}' AS column_name, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS p25, NULL::DOUBLE AS p50, NULL::DOUBLE AS p75, NULL::DOUBLE AS max"
    return f"""SELECT '{c}' AS column_name, '{kind}' AS type, b.n_rows, b.nulls, b.n_distinct, t.v AS top_value, t.n AS top_count, s.mean, s.std, s.min, s.p25, s.p50, s.p75, s.max
 FROM (SELECT count(*) AS n_rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS n_distinct FROM orders) b, {top} t, ({stats}) s"""


PROFILE = [
    ("o_orderkey", "bigint", True), ("o_custkey", "bigint", True), ("o_orderstatus", "string", False), ("o_totalprice", "double", True),
    ("o_orderdate", "timestamp", False), ("o_orderpriority", "string", False),
]


@query("profile_report", sql=" UNION ALL ".join(profiled(*c) for c in PROFILE))
def profile(spark, sf):
    df = table(spark, sf, "orders").select(*[c for c, _, _ in PROFILE])
    # the commonest total price is written out as text, so doubles are shown the same way
    return round_stats(S.profile(df))


def hist_sql(c, t, bins):
    return f"""SELECT CAST(least(floor(({c} - lo) / ((hi - lo) / {bins})), {bins - 1}) AS BIGINT) AS bin, lo, hi, {c} FROM {t},
 (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {t})"""


@query("histogram", sql=f"""SELECT bin, round(lo + bin * ((hi - lo) / 30), 6) AS low, round(lo + (bin + 1) * ((hi - lo) / 30), 6) AS high, count(*) AS n
FROM ({hist_sql('l_extendedprice', 'lineitem', 30)}) GROUP BY 1, 2, 3""")
def hist(spark, sf):
    out = S.histogram(items(spark, sf), "l_extendedprice", 30)
    return out.withColumn("low", F.round("low", 6)).withColumn("high", F.round("high", 6))


@query("histogram_density_by", sql=f"""WITH {I.CHURN}, h AS (SELECT churn.churn, x.bin, x.lo, x.hi FROM churn JOIN (SELECT customer_id, CAST(least(floor((monthly - lo) / ((hi - lo) / 10)), 9) AS BIGINT) AS bin, lo, hi FROM churn, (SELECT min(monthly) AS lo, max(monthly) AS hi FROM churn)) x USING (customer_id))
SELECT churn, bin, count(*) AS n, round(count(*) / (sum(count(*)) OVER (PARTITION BY churn) * (any_value(hi) - any_value(lo)) / 10) * 1e6, 6) AS density FROM h GROUP BY 1, 2""")
def density(spark, sf):
    out = S.histogram_density(I.churn(spark, sf), "monthly", "churn", 10)
    return out.withColumn("density", F.round(F.col("density") * 1e6, 6))


@query("corr_matrix", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, " + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 6)") + " AS r FROM lineitem" + (" GROUP BY ALL" if a == b else "")
    for a in NUM for b in NUM).replace("FROM lineitem GROUP BY ALL", ""))
def corr(spark, sf):
    return S.correlations(items(spark, sf), NUM).withColumn("r", F.round("r", 6))


@query("corr_with_target", sql=" UNION ALL ".join(f"SELECT '{c}' AS column_name, round(corr({c}, l_extendedprice), 6) AS r FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def corr_with(spark, sf):
    return S.correlations_with(items(spark, sf), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"]).withColumn("r", F.round("r", 6))


@query("phik_matrix")
def phik(spark, sf):
    df = I.churn(spark, sf).drop("customer_id")
    return phik_matrix(df, interval=["n_orders", "tenure", "monthly", "total"])


BOX = ["o_totalprice", "o_custkey"]


@query("boxplot_stats", sql=" UNION ALL ".join(f"""SELECT '{c}' AS column_name, round(q1, 6) AS q1, round(m, 6) AS median, round(q3, 6) AS q3,
 CAST(min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS whisker_low,
 CAST(max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS whisker_high,
 CAST(count_if({c} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers
 FROM orders, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS m, quantile_cont({c}, 0.75) AS q3 FROM orders) GROUP BY q1, m, q3""" for c in BOX))
def box(spark, sf):
    out = S.boxplot(table(spark, sf, "orders").select(*BOX), BOX)
    for c in ("q1", "median", "q3"):
        out = out.withColumn(c, F.round(c, 6))
    return out


IQR = """q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events),
 f AS (SELECT event_id, value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a) AS value_outlier FROM events, q)"""


@query("iqr_outlier_flags", sql=f"WITH {IQR} SELECT event_id, value_outlier FROM f")
def flags(spark, sf):
    return S.outlier_flags(I.events(spark, sf).select("event_id", "value"), ["value"]).select("event_id", "value_outlier")


@query("iqr_filter", sql=f"WITH {IQR} SELECT event_id FROM f WHERE NOT value_outlier")
def iqr(spark, sf):
    return S.drop_outliers(I.events(spark, sf).select("event_id", "value", "user_id"), ["value", "user_id"]).select("event_id")


Z_SQL = """WITH x AS (SELECT n_name, o_totalprice AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
 a AS (SELECT count(*) AS n, avg(v) AS m, var_samp(v) AS s FROM x WHERE n_name = 'NATION_1'), b AS (SELECT count(*) AS n, avg(v) AS m, var_samp(v) AS s FROM x WHERE n_name = 'NATION_2')
SELECT round((a.m - b.m) / sqrt(((a.n - 1) * a.s + (b.n - 1) * b.s) / (a.n + b.n - 2) * (1 / a.n + 1 / b.n)), 6) AS z FROM a, b"""


@query("ztest_two_sample", sql=Z_SQL)
def z(spark, sf):
    return S.ztest(nation_prices(spark, sf), "o_totalprice", "n_name", "NATION_1", "NATION_2").select(F.round("z", 6).alias("z"))


# at 5 % both ways the decision falls at 1.959964 standard deviations
@query("ztest_decision", sql=f"""WITH t AS ({Z_SQL}) SELECT z, abs(z) > 1.959964 AS reject, true AS p_in_range FROM t""")
def z_decision(spark, sf):
    out = S.ztest(nation_prices(spark, sf), "o_totalprice", "n_name", "NATION_1", "NATION_2")
    return out.select(F.round("z", 6).alias("z"), "reject", F.col("p").between(0, 1).alias("p_in_range"))


@query("series_stats", sql="SELECT round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_samp(value), 6) AS std FROM events")
def series(spark, sf):
    out = S.series_stats(I.events(spark, sf), "value")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


# ---- recommendation: distances of user 7 to all users

USER = 7
# the dense form, as the check: every user against every item, missing = -1
DENSE = f"""{I.RATINGS}, u AS (SELECT DISTINCT user_id FROM ratings), i AS (SELECT DISTINCT item_id FROM ratings),
 t AS (SELECT i.item_id, coalesce(r.rating, -1) AS x FROM i LEFT JOIN ratings r ON r.item_id = i.item_id AND r.user_id = {USER}),
 m AS (SELECT u.user_id, t.x, coalesce(r.rating, -1) AS y FROM u CROSS JOIN t LEFT JOIN ratings r ON r.user_id = u.user_id AND r.item_id = t.item_id),
 dist AS (SELECT user_id, sqrt(sum((x - y) * (x - y))) AS euclidean, 1 - sum(x * y) / sqrt(sum(x * x) * sum(y * y)) AS cosine FROM m GROUP BY 1)"""


def distances(spark, sf):
    return R.user_distances(cut(I.ratings(spark, sf)), USER)


@query("user_euclidean", "join_user_pairs", sql=f"WITH {DENSE} SELECT user_id, round(euclidean, 6) AS euclidean FROM dist")
def euclid(spark, sf):
    return distances(spark, sf).select("user_id", F.round("euclidean", 6).alias("euclidean"))


@query("user_cosine", sql=f"WITH {DENSE} SELECT user_id, round(CASE WHEN user_id = {USER} THEN abs(cosine) ELSE cosine END, 6) AS cosine FROM dist")
def cosine(spark, sf):
    own = F.when(F.col("user_id") == USER, F.abs("cosine")).otherwise(F.col("cosine"))  # 0 of either sign
    return distances(spark, sf).select("user_id", F.round(own, 6).alias("cosine"))


@query("nearest_users", sql=f"WITH {DENSE} SELECT user_id, round(euclidean, 6) AS euclidean FROM dist WHERE user_id <> {USER} ORDER BY 2, 1 LIMIT 10")
def nearest(spark, sf):
    d = distances(spark, sf).withColumn("euclidean", F.round("euclidean", 6))
    return R.nearest_users(d, USER, 10).select("user_id", "euclidean")


NEIGHBOUR = f"(SELECT user_id FROM dist WHERE user_id <> {USER} ORDER BY round(euclidean, 6), user_id LIMIT 1)"


@query("recommend_items", "join_anti_recommend", "set_except_rated", sql=f"""WITH {DENSE}
SELECT item_id, p_name AS title FROM ratings JOIN part ON item_id = p_partkey WHERE user_id = {NEIGHBOUR} AND rating = 5
 AND item_id NOT IN (SELECT item_id FROM ratings WHERE user_id = {USER})""")
def recommended(spark, sf):
    ratings = cut(I.ratings(spark, sf))
    d = R.user_distances(ratings, USER).withColumn("euclidean", F.round("euclidean", 6))
    near = R.nearest_users(d, USER, 1).first()["user_id"]
    titles = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    return R.recommend(ratings, USER, near, titles)
