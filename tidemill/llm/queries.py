"""One registered query per operator of this package, over its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import align, ann, cotrain, decontaminate, divergence, html_text, langid, minhash, packing, quotes, token_counts, toxicity, url_rules
from tidemill.llm.base import BATCH_ROWS, small_batches
from tidemill.session import fresh_dir, table

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SEQUENCE = 2048

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, batch_rows: int = BATCH_ROWS):
    def wrap(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
            small_batches(spark, batch_rows)
            return fn(spark, sf_dir, **options)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return wrap


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, tokenizer or public_tokenizers.path(WORD_BPE), SEQUENCE)
    return packing.pack(pieces, SEQUENCE)


@query("op9_token_counts")
def token_count_cache(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, tokenizer or public_tokenizers.path(WORD_BPE), fresh_dir(spark, "token-cache"), SEQUENCE)


DECONTAMINATION_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win
            FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT k FROM windows),
spots AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
found AS (SELECT doc_id, spots.k, i, item_id FROM spots JOIN windows USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
which AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN which USING (doc_id)
"""


@query("op3_decontamination", DECONTAMINATION_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, sh FROM (
       SELECT doc_id, array_to_string(w[i:i + 2], ' ') AS sh FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
       UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) IN (1, 2))),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (SELECT a, b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS common FROM s p JOIN s q USING (sh) WHERE p.doc_id <> q.doc_id GROUP BY ALL)
           JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 85 * (na.n + nb.n - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id, d.doc_id = min(reach.b) AS kept
FROM d JOIN reach ON reach.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op10_minhash_near_dedup", NEAR_DUPLICATES_SQL)
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85).drop("content")


@query("op4_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_quality_cotraining")
def quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op7_permutation_index", batch_rows=10_000)
def permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query("op6_quotation_linking")
def quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"), across_gaps=True)


@query("op11_cross_tokenizer_alignment")
def cross_tokenizer_alignment(spark: SparkSession, sf_dir: str, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    a, b = tokenizers or (public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))
    return align.alignment(table(spark, sf_dir, "documents"), a, b)


#: hosts that no page is wanted from unless a rule names them
UNWANTED = ("*casino*", "*poker*", "*jackpot*", "*viagra*", "*porn*", "*-bets.*", "*.bets.*", "*-pills.*", "*.pills.*", "*.ads.*", "*.ads-*", "*.adserver.*")
RULES = [
    url_rules.below("net", "/", "block"), url_rules.below("example.net", "/en/", "allow"),
    url_rules.below("example.com", "/de/", "block"), url_rules.below("org", "/fr/", "allow"),
    *(url_rules.Rule(g + end, "block") for g in UNWANTED for end in ("", "/**")),
]

URL_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
f AS (SELECT *, '.' || host AS dotted FROM p),
r AS (SELECT *, CASE WHEN ends_with(dotted, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
       WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
       WHEN ends_with(dotted, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN ends_with(dotted, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM f)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(dotted, 'casino|poker|jackpot|viagra|porn|[.-]bets\.|[.-]pills\.|\.ads[.-]|\.adserver\.') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


@query("op12_url_filters", URL_SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), RULES)


DIVERGENCE_SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS MATERIALIZED (SELECT lang, source, r, term, count(*) AS n FROM (SELECT lang, source, r, unnest(w) AS term FROM d) GROUP BY ALL),
vocab AS MATERIALIZED (SELECT lang, term, sum(n) AS total FROM t GROUP BY ALL HAVING count(*) >= 30),
v AS (SELECT lang, count(*) AS terms, sum(total) AS total FROM vocab GROUP BY 1),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM t JOIN vocab USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
f AS MATERIALIZED (SELECT g.lang, g.source, vocab.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (coalesce(s.total, 0) + 5 * v.terms) AS p,
  1 + (1000000000 * (vocab.total + 5)) // (v.total + 5 * v.terms) AS q
  FROM g JOIN vocab ON vocab.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = vocab.term
  LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sums.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
both_parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM f WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts) WHERE part = 'pair' OR rank <= 50
"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))
