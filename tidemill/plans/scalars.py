"""Scalar functions, one query per kind; the columns carry the names of the functions."""

from pyspark.sql import functions as F

from tidemill.functions import hashing as H
from tidemill.functions import numbers as N
from tidemill.functions import text as X
from tidemill.operators import protect as P
from tidemill.plans import inputs as I
from tidemill.plans.registry import QUERIES, SQL, query
from tidemill.sources import payloads
from tidemill.session import table

PUNCT_SQL = "chr(39) || '!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"


def collapse_sql(x: str) -> str:
    for d in "123456":
        x = f"regexp_replace({x}, '{d}{d}+', '{d}', 'g')"
    return x


def sound_sql(x: str) -> str:
    up = f"regexp_replace(upper({x}), '[^A-Z]', '', 'g')"
    runs = collapse_sql(f"translate({up}, 'BFPVCGJKQSXZDTLMNR', '111122222222334556')")
    tail = f"regexp_replace(substr({runs}, 2), '[AEIOUY]', '', 'g')"
    return f"CASE WHEN {up} = '' THEN '0000' ELSE substr({up}, 1, 1) || rpad(substr({tail}, 1, 3), 3, '0') END"


def mod_sql(digest: str, n: int) -> str:
    return (
        f"CAST(list_reduce([0::BIGINT] || list_transform([0, 1, 2, 3], lambda i: ('0x' || substr({digest}, CAST(i * 8 + 1 AS INTEGER), 8))::BIGINT),"
        f" lambda r, w: (r * 4294967296 + w) % {n}) AS BIGINT)"
    )


@query("scalar_string", sql=rf"""SELECT doc_id, lower(trim(text)) AS str_lower_trim, upper(lang) AS str_upper,
 regexp_replace(text, '\s+', ' ', 'g') AS str_blanks,
 array_to_string(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''), '_') AS str_split_join,
 regexp_replace(text, '[aeiou]+', '#', 'g') AS str_regex_replace,
 CAST(len(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS INTEGER) AS str_regex_find_all,
 regexp_replace(text, '[[:punct:]]', ' ', 'g') AS str_translate, substr(text, 1, 500) || '...' AS str_substring,
 CAST(length(text) AS INTEGER) AS str_length, concat_ws(' ', lang, source) AS str_concat,
 printf('%.2f', n_chars / 7) AS str_format_number FROM documents""")
def strings(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.lower(F.trim(t)).alias("str_lower_trim"),
        F.upper("lang").alias("str_upper"),
        F.regexp_replace(t, r"\s+", " ").alias("str_blanks"),
        F.array_join(X.words(t), "_").alias("str_split_join"),
        F.regexp_replace(t, "[aeiou]+", "#").alias("str_regex_replace"),
        F.size(X.word_matches(t)).alias("str_regex_find_all"),
        F.translate(t, X.PUNCTUATION, " " * len(X.PUNCTUATION)).alias("str_translate"),
        F.concat(F.substring(t, 1, 500), F.lit("...")).alias("str_substring"),
        F.char_length(t).alias("str_length"),
        F.concat_ws(" ", "lang", "source").alias("str_concat"),
        F.format_string("%.2f", F.col("n_chars") / 7).alias("str_format_number"),
    )


@query("scalar_string_distance", sql=f"""SELECT p_partkey, CAST(levenshtein(p_name, lower(p_type)) AS INTEGER) AS str_levenshtein,
 {sound_sql('p_name')} AS str_soundex_custom FROM part""")
def distances(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.levenshtein("p_name", F.lower("p_type")).alias("str_levenshtein"),
        X.sound_code(F.col("p_name")).alias("str_soundex_custom"),
    )


@query("scalar_hash", sql=f"""SELECT doc_id, md5(text) AS hash_md5, sha1(text) AS hash_sha1, sha256(text) AS hash_sha256,
 {mod_sql('md5(text)', 1000)} AS hash_md5_mod FROM documents""")
def hashes(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5("text").alias("hash_md5"),
        F.sha1("text").alias("hash_sha1"),
        F.sha2("text", 256).alias("hash_sha256"),
        H.md5_mod(F.col("text"), 1000).alias("hash_md5_mod"),
    )


@query("scalar_date", sql="""SELECT event_id, CAST(hour(ts) AS INTEGER) AS dt_hour, CAST(ts AS DATE) AS dt_date, CAST(dayofweek(ts) + 1 AS INTEGER) AS dt_dayofweek,
 date_trunc('millisecond', ts) AS dt_epoch_ms, date_trunc('second', ts) AS dt_epoch_s,
 CAST(date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) AS BIGINT) AS dt_diff_seconds,
 strftime(ts, '%Y-%m') AS dt_month_key, CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS dt_to_epoch FROM events""")
def dates(spark, sf):
    ts = F.col("ts")
    return I.events(spark, sf).select(
        "event_id",
        F.hour(ts).alias("dt_hour"),
        F.to_date(ts).alias("dt_date"),
        F.dayofweek(ts).alias("dt_dayofweek"),
        F.timestamp_millis(F.unix_millis(ts)).alias("dt_epoch_ms"),
        F.timestamp_seconds(F.unix_timestamp(ts)).alias("dt_epoch_s"),
        (F.unix_timestamp(ts) - F.unix_timestamp(F.lit("2024-01-01").cast("timestamp"))).alias("dt_diff_seconds"),
        N.month_key(F.to_date(ts).cast("string")).alias("dt_month_key"),
        N.concat_to_epoch(F.date_format(ts, "MM/dd/yyyy"), F.date_format(ts, "HH:mm")).alias("dt_to_epoch"),
    )


@query("scalar_math", sql="""SELECT o_orderkey, round(ln(o_totalprice), 6) AS math_log, CAST(floor(o_totalprice) AS BIGINT) AS math_floor,
 round(sqrt(o_totalprice * o_totalprice + o_custkey * o_custkey), 4) AS math_norm,
 round(o_totalprice * o_custkey + 2.0 * o_orderkey, 2) AS math_dot,
 CAST(ceil(o_orderkey / 7) AS BIGINT) AS math_ceil_div, CAST(least(5000, 100 * (1 << CAST(o_orderkey % 8 AS INTEGER))) AS BIGINT) AS math_shift_cap,
 CAST(floor(epoch(o_orderdate) / 864000) * 864000 AS BIGINT) AS math_time_bucket,
 CAST((o_orderkey % 1000) * (o_orderkey % 1000 - 1) * (2 * (o_orderkey % 1000) - 1) // 6 AS BIGINT) AS math_sum_squares FROM orders""")
def maths(spark, sf):
    n, price, cust = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_custkey").cast("double")
    dot = F.aggregate(
        F.zip_with(F.array(price, F.lit(2.0)), F.array(cust, n.cast("double")), lambda a, b: a * b),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.round(F.ln(price), 6).alias("math_log"),
        F.floor(price).alias("math_floor"),
        F.round(F.sqrt(F.pow(price, 2) + F.pow(cust, 2)), 4).alias("math_norm"),
        F.round(dot, 2).alias("math_dot"),
        F.ceil(n / 7).alias("math_ceil_div"),
        P.retry_delay("exponential", F.col("o_orderkey") % 8, 100, 5000).alias("math_shift_cap"),
        N.time_slot(F.col("o_orderdate"), 864000).alias("math_time_bucket"),
        N.sum_of_squares_below(n % 1000).alias("math_sum_squares"),
    )


@query("scalar_array", sql=r"""WITH t AS (SELECT conv_id, turn, list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> '') AS w, role FROM conversations)
SELECT conv_id, turn, list_contains(w, 'the') AS arr_contains,
 array_to_string(list_transform(w, lambda x: x || '/' || role), ' ') AS arr_field,
 list_min(list_transform(w, lambda x: md5(x || '0'))) AS arr_min_hash, coalesce(w[1], 'none') AS arr_first_or_default,
 round(CAST(len(list_filter(list_zip(w, list_reverse(w)), lambda p: p[1] = p[2])) AS DOUBLE) / len(w), 9) AS arr_match_fraction FROM t""")
def arrays(spark, sf):
    w = X.words(F.lower("text"))
    pairs = F.transform(w, lambda t: F.struct(t.alias("word"), F.concat(t, F.lit("/"), F.col("role")).alias("tag")))
    return table(spark, sf, "conversations").withColumn("p", pairs).select(
        "conv_id",
        "turn",
        F.array_contains("p.word", "the").alias("arr_contains"),
        F.array_join("p.tag", " ").alias("arr_field"),
        F.array_min(F.transform("p.word", lambda t: F.md5(F.concat(t, F.lit("0"))))).alias("arr_min_hash"),
        F.coalesce(F.try_element_at("p.word", F.lit(1)), F.lit("none")).alias("arr_first_or_default"),
        F.round(X.match_fraction(F.col("p.word"), F.reverse("p.word")), 9).alias("arr_match_fraction"),
    )


@query("arr_explode", sql="SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def exploded(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("scalar_map", sql="""SELECT event_id, CAST(value AS VARCHAR) AS map_get, 'none' AS map_get_default, CAST(2 AS INTEGER) AS map_entries FROM events""")
def maps(spark, sf):
    m = F.from_json(F.get_json_object("value", "$.properties"), "map<string,string>")
    df = I.envelopes(I.events(spark, sf)).select(F.col("offset").alias("event_id"), m.alias("m"))
    return df.select(
        "event_id",
        F.try_element_at("m", F.lit("amount")).alias("map_get"),
        F.coalesce(F.try_element_at("m", F.lit("currency")), F.lit("none")).alias("map_get_default"),
        F.size("m").alias("map_entries"),
    )


@query("map_explode", sql="""SELECT event_id, 'amount' AS key, CAST(value AS VARCHAR) AS value FROM events
UNION ALL SELECT event_id, 'product_id', CAST(json_extract(props, '$.k') AS VARCHAR) FROM events""")
def map_exploded(spark, sf):
    m = F.from_json(F.get_json_object("value", "$.properties"), "map<string,string>")
    return I.envelopes(I.events(spark, sf)).select(F.col("offset").alias("event_id"), F.explode(m).alias("key", "value"))


@query("scalar_json", sql="""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS json_parse,
 '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS json_write, 'N/A' AS json_path_default FROM events""")
def jsons(spark, sf):
    return I.events(spark, sf).select(
        "event_id",
        F.from_json("props", "k long")["k"].alias("json_parse"),
        F.to_json(F.struct("event_id", "event_type")).alias("json_write"),
        payloads.path_or(F.col("props"), "$.data.missing").alias("json_path_default"),
    )


@query("scalar_conditional", sql="""SELECT event_id, CASE WHEN value > 100 THEN 'high' WHEN value > 10 THEN 'mid' ELSE 'low' END AS cond_case,
 (event_type IN ('purchase', 'error') AND user_id IS NOT NULL) AS cond_in_notnull FROM events""")
def conditionals(spark, sf):
    v = F.col("value")
    return I.events(spark, sf).select(
        "event_id",
        F.when(v > 100, "high").when(v > 10, "mid").otherwise("low").alias("cond_case"),
        (F.col("event_type").isin("purchase", "error") & F.col("user_id").isNotNull()).alias("cond_in_notnull"),
    )


@query("api_verse_extract", sql="""SELECT doc_id, source AS reference, text, CASE WHEN lang = 'en' THEN 'en' ELSE 'N/A' END AS translation_id,
 'N/A' AS translation_name, 'N/A' AS translation_note FROM documents""")
def verses(spark, sf):
    # a null field is left out of the JSON object
    obj = F.struct(F.col("source").alias("reference"), "text", F.expr("CASE WHEN lang = 'en' THEN lang END AS translation_id"))
    return payloads.verses(table(spark, sf, "documents").select("doc_id", F.to_json(obj).alias("j")), "j", ["doc_id"])


@query("api_pages_extract", sql="""SELECT page_id, url AS title, CASE WHEN page_id % 5 = 0 THEN 'No revisions available'
 WHEN page_id % 5 = 1 THEN 'No content available' ELSE html END AS content FROM pages""")
def wiki(spark, sf):
    rev = F.expr("""CASE WHEN page_id % 5 = 0 THEN NULL
        WHEN page_id % 5 = 1 THEN array(named_struct('*', CAST(NULL AS STRING))) ELSE array(named_struct('*', html)) END""")
    page = F.struct(F.col("page_id").alias("pageid"), F.col("url").alias("title"), rev.alias("revisions"))
    obj = F.struct(F.struct(F.create_map(F.col("page_id").cast("string"), page).alias("pages")).alias("query"))
    return payloads.wiki_pages(table(spark, sf, "pages").select(F.to_json(obj).alias("j")), "j")


@query("api_quote_extract", sql="""SELECT conv_id, turn, text AS quote, CASE WHEN role = 'user' THEN 'user' ELSE 'N/A' END AS author FROM conversations""")
def quoted(spark, sf):
    obj = F.struct(F.struct(F.col("text").alias("quote"), F.expr("CASE WHEN role = 'user' THEN role END AS author")).alias("data"))
    df = table(spark, sf, "conversations").select("conv_id", "turn", F.to_json(obj).alias("j"))
    return payloads.quotes(df, "j", ["conv_id", "turn"])


# ---- each function on its own: the columns of the grouped queries

COLUMNS = {
    ("scalar_string", "doc_id"): {
        "str_case_trim": ["str_lower_trim", "str_upper", "str_blanks"],
        **{n: [n] for n in ("str_split_join", "str_regex_replace", "str_regex_find_all", "str_translate", "str_substring",
                            "str_length", "str_concat", "str_format_number")},
    },
    ("scalar_string_distance", "p_partkey"): {n: [n] for n in ("str_levenshtein", "str_soundex_custom")},
    ("scalar_hash", "doc_id"): {"hash_md5": ["hash_md5", "hash_sha1", "hash_sha256"], "hash_md5_mod": ["hash_md5_mod"]},
    ("scalar_date", "event_id"): {
        **{n: [n] for n in ("dt_hour", "dt_date", "dt_dayofweek", "dt_epoch_ms", "dt_epoch_s", "dt_diff_seconds", "dt_month_key", "dt_to_epoch")},
        "unix_seconds_to_ts": ["dt_epoch_s"],
        "datetime_concat_to_epoch": ["dt_to_epoch"],
    },
    ("scalar_math", "o_orderkey"): {
        "math_log_size": ["math_log", "math_floor"],
        "math_norm_dot": ["math_norm", "math_dot"],
        **{n: [n] for n in ("math_ceil_div", "math_shift_cap", "math_time_bucket")},
    },
    ("scalar_array", "conv_id, turn"): {n: [n] for n in ("arr_contains", "arr_field", "arr_match_fraction", "arr_min_hash", "arr_first_or_default")},
    ("scalar_map", "event_id"): {"map_get": ["map_get", "map_get_default"]},
    ("scalar_json", "event_id"): {n: [n] for n in ("json_parse", "json_write", "json_path_default")},
    ("scalar_conditional", "event_id"): {n: [n] for n in ("cond_case", "cond_in_notnull")},
}


def _column_query(group: str, keys: str, name: str, columns: list[str]) -> None:
    whole = QUERIES[group]
    query(name, sql=f"SELECT {keys}, {', '.join(columns)} FROM ({SQL[group]})")(
        lambda spark, sf: whole(spark, sf).select(*keys.split(", "), *columns)
    )


for (_group, _keys), _names in COLUMNS.items():
    for _name, _columns in _names.items():
        _column_query(_group, _keys, _name, _columns)
