"""Joins and set operations."""

from pyspark.sql import functions as F

from tidemill.functions import text as X
from tidemill.operators import clean
from tidemill.operators.rank import row_index
from tidemill.plans import inputs as I
from tidemill.plans.registry import query
from tidemill.session import small, table

# words of the benchmark texts, scored by a rule on their length
LEXICON = r"""lexicon AS (SELECT DISTINCT word, CAST(length(word) * 7 % 11 - 5 AS INTEGER) AS score FROM (
  SELECT unnest(string_split_regex(regexp_replace(lower(text), '[^a-z0-9\s]', '', 'g'), '\s+')) AS word FROM benchmark) WHERE length(word) > 3)"""


def lexicon(spark, sf):
    w = table(spark, sf, "benchmark").select(F.explode(X.letters_only_words(F.col("text"))).alias("word")).distinct()
    return w.filter(F.length("word") > 3).withColumn("score", (F.length("word") * 7 % 11 - 5).cast("int"))


@query("join_inner", sql=f"""WITH {I.RATINGS}
SELECT user_id, item_id, p_name AS title, rating FROM ratings JOIN part ON item_id = p_partkey ORDER BY rating DESC""")
def inner(spark, sf):
    titles = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    joined = I.ratings(spark, sf).join(titles, "item_id")
    return joined.select("user_id", "item_id", "title", "rating").orderBy(F.desc("rating"), "user_id", "item_id")


@query("join_lookup_default", sql=rf"""WITH {LEXICON}, w AS (
 SELECT doc_id, unnest(string_split_regex(regexp_replace(lower(text), '[^a-z0-9\s]', '', 'g'), '\s+')) AS word FROM documents)
SELECT doc_id, count(*) AS n_words, CAST(sum(coalesce(score, 0)) AS BIGINT) AS score FROM w LEFT JOIN lexicon USING (word) WHERE word <> '' GROUP BY 1""")
def lookup(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.explode(X.letters_only_words(F.col("text"))).alias("word"))
    per_word = words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))  # shrinks repeats before the join
    scored = per_word.join(small(lexicon(spark, sf)), "word", "left")
    return scored.groupBy("doc_id").agg(
        F.sum("n").alias("n_words"), F.sum(F.col("n") * F.coalesce("score", F.lit(0))).alias("score")
    )


@query("join_index_outer", sql="""WITH a AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_index, c_name FROM customer),
 b AS (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS row_index, s_name FROM supplier)
SELECT row_index, c_name, s_name FROM a FULL JOIN b USING (row_index)""")
def index_outer(spark, sf):
    a = row_index(table(spark, sf, "customer").select("c_custkey", "c_name"), ["c_custkey"]).drop("c_custkey")
    b = row_index(table(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"]).drop("s_suppkey")
    return a.join(b, "row_index", "full")


@query("join_update", sql=f"""WITH {I.TRIPS}, n AS (SELECT *, try_cast(nullif(fuel, '-') AS DOUBLE) AS f FROM trips)
SELECT row_id, going_to, round(coalesce(f, moving_time * 900), 2) AS fuel FROM n""")
def update(spark, sf):
    df = I.trips(spark, sf).withColumn("fuel", F.nullif("fuel", F.lit("-")).try_cast("double"))
    fix = df.filter("fuel IS NULL").select("row_id", (F.col("moving_time") * 900).alias("fuel"))
    out = clean.update_from(df.select("row_id", "going_to", "fuel"), fix, "row_id", "fuel")
    return out.withColumn("fuel", F.round("fuel", 2))


@query("set_union_words", sql=rf"""WITH {LEXICON}, own AS (SELECT DISTINCT lower(p_type) AS word FROM part)
SELECT word FROM lexicon UNION SELECT word FROM own""")
def union_words(spark, sf):
    own = table(spark, sf, "part").select(F.lower("p_type").alias("word"))
    return lexicon(spark, sf).select("word").union(own).distinct()


@query("set_token_ops", sql="""WITH t AS (SELECT a.conv_id, a.turn, list_distinct(list_filter(string_split_regex(lower(a.text), '\\s+'), lambda w: w <> '')) AS x,
  list_distinct(list_filter(string_split_regex(lower(b.text), '\\s+'), lambda w: w <> '')) AS y
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, CAST(len(list_intersect(x, y)) AS INTEGER) AS n_both, CAST(len(list_distinct(list_concat(x, y))) AS INTEGER) AS n_any FROM t""")
def token_ops(spark, sf):
    a, b = X.words(F.lower("text")), X.words(F.lower("next_text"))
    return replies(spark, sf).select(
        "conv_id", "turn", F.size(F.array_intersect(a, b)).alias("n_both"), F.size(F.array_union(a, b)).alias("n_any")
    )


def replies(spark, sf):
    """Each conversation turn with the one after it."""
    t = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    nxt = t.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next_text"))
    return t.join(nxt, ["conv_id", "turn"])
