"""Text analytics over the documents table."""

from pyspark.sql import functions as F

from tidemill.functions import text as X
from tidemill.operators import stats as S
from tidemill.operators import texts as T
from tidemill.plans.joins import LEXICON, lexicon
from tidemill.plans.registry import query
from tidemill.session import cut, table

STOP = T.STOP_WORDS
CLEAN = r"trim(regexp_replace(regexp_replace(lower(text), '[[:punct:]]', ' ', 'g'), '\s+', ' ', 'g'))"
STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP)
TOKENS = f"""tok AS MATERIALIZED (SELECT doc_id, list_filter(string_split({CLEAN}, ' '), lambda w: w <> '' AND NOT regexp_full_match(w, '[0-9]+')) AS w FROM documents),
 kept AS MATERIALIZED (SELECT doc_id, list_filter(w, lambda x: x NOT IN ({STOP_SQL})) AS w FROM tok),
 freq AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM kept) GROUP BY 1)"""


def tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_tokens(F.col("text")).alias("w"))


def kept(spark, sf):
    return tokens(spark, sf).select("doc_id", T.without(F.col("w"), STOP).alias("w"))


def freq(spark, sf):
    return T.frequencies(kept(spark, sf), F.col("w"))


@query("text_clean", sql=f"SELECT doc_id, {CLEAN} AS clean FROM documents")
def clean(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_text(F.col("text")).alias("clean"))


@query("text_stopwords", sql=f"WITH {TOKENS} SELECT doc_id, array_to_string(w, ' ') AS words FROM kept")
def stop(spark, sf):
    return kept(spark, sf).select("doc_id", F.array_join("w", " ").alias("words"))


@query("text_min_length", sql=f"WITH {TOKENS} SELECT doc_id, array_to_string(list_filter(w, lambda x: length(x) > 1), ' ') AS words FROM kept")
def min_length(spark, sf):
    return kept(spark, sf).select("doc_id", F.array_join(T.longer_than(F.col("w")), " ").alias("words"))


@query("text_token_count", sql=f"""WITH {TOKENS}
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, (SELECT CAST(sum(len(w)) AS BIGINT) FROM tok) AS n_all FROM tok""")
def token_count(spark, sf):
    df = tokens(spark, sf).select("doc_id", F.size("w").cast("long").alias("n_tokens"))
    total = df.agg(F.sum("n_tokens")).first()[0]
    return df.withColumn("n_all", F.lit(total).cast("long"))


def gram_sql(n):
    parts = " || ' ' || ".join(f"w[i + {j}]" for j in range(n))
    return f"""WITH {TOKENS}, g AS (SELECT unnest(list_transform(range(1, CAST(len(w) AS BIGINT) - {n - 2}), lambda i: {parts})) AS gram FROM kept)
SELECT gram, count(*) AS n FROM g GROUP BY 1 ORDER BY n DESC, gram LIMIT 20"""


@query("text_bigrams", "win_ngrams", sql=gram_sql(2))
def bigrams(spark, sf):
    return T.top(T.frequencies(kept(spark, sf), X.ngrams(F.col("w"), 2), "gram"), 20, "gram")


@query("text_trigrams", sql=gram_sql(3))
def trigrams(spark, sf):
    return T.top(T.frequencies(kept(spark, sf), X.ngrams(F.col("w"), 3), "gram"), 20, "gram")


@query("text_freq_top200", sql=f"WITH {TOKENS} SELECT * FROM freq ORDER BY n DESC, word LIMIT 200")
def top200(spark, sf):
    return T.top(freq(spark, sf), 200)


# a lemma table by rule: plural s, and a tag table by ending
LEMMA = "lem AS (SELECT word, substr(word, 1, length(word) - 1) AS lemma FROM freq WHERE word LIKE '%s' AND length(word) > 3)"


def lemmas(f):
    return f.filter("word LIKE '%s' AND length(word) > 3").select("word", F.expr("substr(word, 1, length(word) - 1)").alias("lemma"))


AFTER = f"after AS (SELECT coalesce(lemma, word) AS word, CAST(sum(n) AS BIGINT) AS n FROM freq LEFT JOIN lem USING (word) GROUP BY 1)"


@query("text_lemma", sql=f"WITH {TOKENS}, {LEMMA}, {AFTER} SELECT * FROM after")
def lemma(spark, sf):
    f = cut(freq(spark, sf))
    return T.lemma_counts(f, lemmas(f))


@query("text_freq_delta", sql=f"""WITH w AS (SELECT unnest(string_split({CLEAN}, ' ')) AS word FROM documents),
 freq AS MATERIALIZED (SELECT word, count(*) AS n FROM w WHERE word <> '' AND NOT regexp_full_match(word, '[0-9]+') AND word NOT IN ({STOP_SQL}) GROUP BY 1),
 after AS (SELECT CASE WHEN word LIKE '%s' AND length(word) > 3 THEN substr(word, 1, length(word) - 1) ELSE word END AS word, sum(n) AS n FROM freq GROUP BY 1)
SELECT word, CAST(sum(b) AS BIGINT) AS before, CAST(sum(a) AS BIGINT) AS after, CAST(sum(a) - sum(b) AS BIGINT) AS delta
FROM (SELECT word, n AS b, 0 AS a FROM freq UNION ALL SELECT word, 0, n FROM after) GROUP BY 1""")
def delta(spark, sf):
    f = cut(freq(spark, sf))
    return T.frequency_delta(f, T.lemma_counts(f, lemmas(f)))


@query("text_tag_counts", sql=f"""WITH {TOKENS}, tags AS (SELECT word, CASE WHEN word LIKE '%ing' THEN 'VBG' ELSE 'RB' END AS tag FROM freq WHERE word LIKE '%ing' OR word LIKE '%ly')
SELECT coalesce(tag, 'NN') AS tag, CAST(sum(n) AS BIGINT) AS n FROM freq LEFT JOIN tags USING (word) GROUP BY 1""")
def tags(spark, sf):
    f = cut(freq(spark, sf))
    known = f.filter("word LIKE '%ing' OR word LIKE '%ly'").select("word", F.expr("CASE WHEN word LIKE '%ing' THEN 'VBG' ELSE 'RB' END AS tag"))
    return T.tag_counts(f, known)


SENTIMENT = rf"""{LEXICON}, w AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '')) AS word FROM documents),
 sent AS (SELECT doc_id, round(avg(coalesce(score, 0)), 6) AS sentiment FROM w LEFT JOIN lexicon USING (word) GROUP BY 1)"""


def sentiments(spark, sf):
    out = T.sentiment(table(spark, sf, "documents"), "doc_id", "text", lexicon(spark, sf))
    return out.withColumn("sentiment", F.round("sentiment", 6))


@query("text_sentiment_lexicon", sql=f"WITH {SENTIMENT} SELECT d.doc_id, sentiment FROM documents d LEFT JOIN sent USING (doc_id)")
def sentiment(spark, sf):
    return sentiments(spark, sf)


@query("sentiment_extremes", sql=f"""WITH {SENTIMENT}
SELECT * FROM (SELECT 'lowest' AS part, doc_id, sentiment FROM sent ORDER BY sentiment, doc_id LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'highest' AS part, doc_id, sentiment FROM sent ORDER BY sentiment DESC, doc_id LIMIT 10)""")
def extremes(spark, sf):
    s = sentiments(spark, sf).filter("sentiment IS NOT NULL")
    low = s.orderBy("sentiment", "doc_id").limit(10).select(F.lit("lowest").alias("part"), "doc_id", "sentiment")
    high = s.orderBy(F.desc("sentiment"), "doc_id").limit(10).select(F.lit("highest").alias("part"), "doc_id", "sentiment")
    return low.unionByName(high)


@query("sentiment_stats", sql=f"WITH {SENTIMENT} SELECT round(avg(sentiment), 5) AS mean, round(median(sentiment), 5) AS median, round(stddev_samp(sentiment), 5) AS std FROM sent")
def sentiment_stats(spark, sf):
    out = S.series_stats(sentiments(spark, sf), "sentiment")
    return out.select(*[F.round(c, 5).alias(c) for c in out.columns])


@query("text_bow", sql=f"WITH {TOKENS} SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM kept) GROUP BY 1, 2")
def bow(spark, sf):
    return T.term_table(kept(spark, sf), "doc_id", F.col("w"))


@query("text_lda")
def lda(spark, sf):
    found = T.topic_words(T.topics(T.vectorize(kept(spark, sf), "w"), 20))
    rows = [(t, w, float(x)) for t, ws in found.items() for w, x in ws]
    return spark.createDataFrame(rows, "topic int, word string, weight double")


@query("text_coherence")
def coherence(spark, sf):
    df = kept(spark, sf)
    found = T.topic_words(T.topics(T.vectorize(df, "w"), 13))
    scores = T.coherence(df, "w", {t: [w for w, _ in ws] for t, ws in found.items()})
    return spark.createDataFrame([(t, s) for t, s in scores.items()], "topic int, coherence double")


@query("text_window_counts", sql=f"""WITH {TOKENS}, best AS (SELECT word FROM freq ORDER BY n DESC, word LIMIT 8),
 win AS (SELECT doc_id, s, list_distinct(w[s:s + 109]) AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(1, CAST(len(w) AS BIGINT) - 109) + 1)) AS s FROM kept WHERE len(w) > 0))
SELECT a.word AS x, b.word AS y, count(*) AS n FROM win, best a, best b WHERE list_contains(win.x, a.word) AND list_contains(win.x, b.word) GROUP BY 1, 2""")
def windows(spark, sf):
    words = [r["word"] for r in T.top(freq(spark, sf), 8).collect()]  # eight words
    seen, _ = T.window_counts(kept(spark, sf), "w", words)
    return spark.createDataFrame([(words[i], words[j], n) for (i, j), n in seen.items()], "x string, y string, n long")


@query("text_lda_scan")
def scan(spark, sf):
    return T.topic_scan(kept(spark, sf), "w", list(range(2, 30)), passes=10)
