"""Deduplication and similarity."""

from pyspark.sql import functions as F

from tidemill.functions import text as X
from tidemill.operators import dedup as D
from tidemill.operators import pairs as P
from tidemill.operators.lsh import lsh_groups
from tidemill.plans.joins import replies
from tidemill.plans.registry import query
from tidemill.plans.scalars import mod_sql, sound_sql
from tidemill.sources import files
from tidemill.session import cut, fresh_dir, table


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text", "lang", "source")


def parts(spark, sf):
    """Parts as named records: name and address-like second text."""
    return table(spark, sf, "part").select(
        "p_partkey", "p_name", F.concat_ws(" ", "p_brand", "p_type").alias("p_line"), "p_size"
    )


PARTS = "parts AS (SELECT p_partkey, p_name, p_brand || ' ' || p_type AS p_line, p_size FROM part)"


# ---- exact


@query("dedup_exact", sql="SELECT min(doc_id) AS doc_id, md5(text) AS digest FROM documents GROUP BY text")
def exact(spark, sf):
    return D.dedup_exact(docs(spark, sf), ["text"], "doc_id").select("doc_id", F.md5("text").alias("digest"))


@query("dedup_hash", sql="SELECT min(doc_id) AS doc_id, md5(text) AS digest FROM documents GROUP BY 2")
def by_hash(spark, sf):
    # only the id and the digest are wanted, so the text stays out of the shuffle
    return D.dedup_exact(docs(spark, sf).select("doc_id", F.md5("text").alias("digest")), ["digest"], "doc_id")


@query("dedup_by_key", sql="""WITH a AS (SELECT doc_id, lang, CASE WHEN lang = 'en' THEN source END AS author FROM documents)
SELECT doc_id, lang, author FROM (SELECT *, row_number() OVER (PARTITION BY lang, coalesce(author, '') ORDER BY doc_id) AS rn FROM a) WHERE rn = 1""")
def by_key(spark, sf):
    d = docs(spark, sf).select("doc_id", "lang", F.when(F.col("lang") == "en", F.col("source")).alias("author"))
    return D.dedup_by_keys(d, ["lang", "author"], "doc_id")


KEEP = "SELECT p_partkey, p_name, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey {o}) AS rn FROM part) WHERE rn = 1"


@query("dedup_subset", "win_keep_first", sql=KEEP.format(o=""))
def keep_first(spark, sf):
    return D.dedup_subset(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), ["p_name", "p_brand"], "p_partkey")


@query("win_keep_last", sql=KEEP.format(o="DESC"))
def keep_last(spark, sf):
    return D.dedup_subset(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), ["p_name", "p_brand"], "p_partkey", "last")


@query("dedup_subset_none", sql="""SELECT p_partkey, p_name, p_brand, p_size FROM (
 SELECT *, count(*) OVER (PARTITION BY p_name, p_brand, p_size) AS n FROM part) WHERE n = 1""")
def keep_none(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    return D.dedup_subset(df, ["p_name", "p_brand", "p_size"], "p_partkey", None)


@query("dedup_sharded", sql=f"""SELECT min(doc_id) AS doc_id, CAST({mod_sql('md5(text)', 16)} AS INTEGER) AS shard_id FROM documents GROUP BY text, 2""")
def sharded(spark, sf):
    return D.dedup_sharded(docs(spark, sf), "text", "doc_id", 16, ["doc_id"]).select("doc_id", "shard_id")


@query("db_merge_duplicates", sql="""WITH d AS (SELECT p_partkey FROM (SELECT p_partkey, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) AS rn FROM part) WHERE rn > 1)
SELECT p_partkey, p_name, (SELECT count(*) FROM d) AS merged FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM d)""")
def merge(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    primary = D.dedup_exact(df, ["p_name", "p_brand"], "p_partkey")
    extra = df.join(primary, "p_partkey", "left_anti").select("p_partkey")
    return D.drop_merged(df, extra, "p_partkey").select("p_partkey", "p_name", F.lit(extra.count()).cast("long").alias("merged"))


# ---- similarity of two texts


def words_sql(x):
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')"


def form_sql(x):
    return rf"regexp_replace(trim(lower({x})), '[^\p{{L}}\p{{N}}_\s]', '', 'g')"


def jaccard_sql(a, b):
    return f"CAST(len(list_intersect({a}, {b})) AS DOUBLE) / len(list_distinct(list_concat({a}, {b})))"


def norm_sql(a):
    return f"sqrt(list_sum(list_transform(list_distinct({a}), lambda w: power(len(list_filter({a}, lambda v: v = w)), 2))))"


def cosine_sql(a, b):
    dot = (
        f"coalesce(list_sum(list_transform(list_intersect({a}, {b}), lambda w:"
        f" len(list_filter({a}, lambda v: v = w)) * len(list_filter({b}, lambda v: v = w)))), 0)"
    )
    return f"{dot} / ({norm_sql(a)} * {norm_sql(b)})"


def blend_sql(fa, fb, wa, wb):
    edit = f"(1.0::DOUBLE - levenshtein({fa}, {fb})::DOUBLE / greatest(length({fa}), length({fb})))"
    snd = f"(CASE WHEN {sound_sql(fa)} = {sound_sql(fb)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
    return (
        f"({jaccard_sql(wa, wb)}) * 0.3::DOUBLE + ({cosine_sql(wa, wb)}) * 0.3::DOUBLE + {edit} * 0.3::DOUBLE + {snd} * 0.1::DOUBLE"
    )


NEXT = f"""nxt AS (SELECT a.p_partkey, a.p_name AS x, b.p_name AS y FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1),
 t AS (SELECT *, {words_sql('x')} AS wx, {words_sql('y')} AS wy FROM nxt)"""


def neighbours(spark, sf):
    """Every part name with the name of the next part."""
    p = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("x"))
    return p.join(p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("x").alias("y")), "p_partkey")


@query("sim_levenshtein", sql=f"""WITH {NEXT} SELECT p_partkey, CAST(levenshtein(x, y) AS INTEGER) AS distance,
 round(1 - levenshtein(x, y)::DOUBLE / greatest(length(x), length(y)), 9) AS similarity FROM t""")
def sim_edit(spark, sf):
    x, y = F.col("x"), F.col("y")
    return neighbours(spark, sf).select(
        "p_partkey", F.levenshtein(x, y).alias("distance"), F.round(X.edit_similarity(x, y), 9).alias("similarity")
    )


TURNS = rf"""t AS (SELECT a.conv_id, a.turn, {words_sql('lower(a.text)')} AS x, {words_sql('lower(b.text)')} AS y
 FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


@query("sim_jaccard", sql=f"WITH {TURNS} SELECT conv_id, turn, round({jaccard_sql('x', 'y')}, 9) AS similarity FROM t")
def sim_jaccard(spark, sf):
    a, b = X.words(F.lower("text")), X.words(F.lower("next_text"))
    return replies(spark, sf).select("conv_id", "turn", F.round(X.jaccard(a, b), 9).alias("similarity"))


@query("sim_cosine", sql=f"WITH {TURNS} SELECT conv_id, turn, round({cosine_sql('x', 'y')}, 9) AS similarity FROM t")
def sim_cosine(spark, sf):
    counts = lambda c: X.term_counts(X.words(F.lower(c)))
    df = replies(spark, sf).select("conv_id", "turn", counts("text").alias("a"), counts("next_text").alias("b"))
    return df.select("conv_id", "turn", F.round(X.count_cosine(F.col("a"), F.col("b")), 9).alias("similarity"))


@query("sim_phonetic", sql=f"WITH {NEXT} SELECT p_partkey, CASE WHEN {sound_sql('x')} = {sound_sql('y')} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS similarity FROM t")
def sim_sound(spark, sf):
    same = X.sound_code(F.col("x")) == X.sound_code(F.col("y"))
    return neighbours(spark, sf).select("p_partkey", F.when(same, 1.0).otherwise(0.0).alias("similarity"))


@query("sim_combined", sql=f"WITH {NEXT} SELECT p_partkey, round({blend_sql('x', 'y', 'wx', 'wy')}, 9) AS similarity FROM t")
def sim_blend(spark, sf):
    return neighbours(spark, sf).select(
        "p_partkey", F.round(X.combined_similarity(F.col("x"), F.col("y")), 9).alias("similarity")
    )


# ---- greedy groups

THRESHOLD = 0.6


def values_sql(column, alias):
    return f"""{alias} AS (SELECT v, form, {words_sql('form')} AS w, vid, n FROM (
  SELECT {column} AS v, {form_sql(column)} AS form, min(p_partkey) AS vid, count(*) AS n FROM parts GROUP BY 1, 2))"""


def edges_sql(values, name, threshold):
    return f"""{name} AS (SELECT * FROM (SELECT a.vid AS a, b.vid AS b, {blend_sql('a.form', 'b.form', 'a.w', 'b.w')} AS s
  FROM {values} a JOIN {values} b ON a.vid < b.vid) WHERE s >= {threshold})"""


def greedy_sql(nodes, edges):
    """The sequential pass: keep a node unless one of the kept ones is its neighbour."""
    return f"""seq AS (SELECT vid, row_number() OVER (ORDER BY vid) AS i FROM {nodes}),
 nb AS (SELECT s.i, any_value(s.vid) AS vid, coalesce(list(e.a) FILTER (e.a IS NOT NULL), []) AS earlier
   FROM seq s LEFT JOIN {edges} e ON e.b = s.vid GROUP BY s.i),
 run(i, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
   SELECT nb.i, CASE WHEN list_has_any(run.kept, nb.earlier) THEN run.kept ELSE list_append(run.kept, nb.vid) END
   FROM run JOIN nb ON nb.i = run.i + 1),
 fin AS (SELECT kept FROM run ORDER BY i DESC LIMIT 1),
 lead AS (SELECT nb.vid, coalesce((SELECT min(x) FROM (SELECT unnest(list_intersect(nb.earlier, (SELECT kept FROM fin))) AS x)), nb.vid) AS leader FROM nb)"""


@query("similar_turns")
def similar_turns(spark, sf):
    # whole, unchanged messages; DuckDB's edit distance counts bytes, so there is no SQL here and below
    turns = table(spark, sf, "conversations").select(F.concat_ws("/", "conv_id", "turn").alias("message"), "text")
    values = cut(P.distinct_values(turns, "message", ["text"]))
    return P.similar_pairs(values, "text", THRESHOLD).select("a", "b", F.round("similarity", 9).alias("similarity"))


@query("similar_texts")
def similar_texts(spark, sf):
    values = cut(P.distinct_values(docs(spark, sf), "doc_id", ["text"]))
    return P.similar_pairs(values, "text", THRESHOLD).select("a", "b", F.round("similarity", 9).alias("similarity"))


NAMES = f"WITH RECURSIVE {PARTS}, {values_sql('p_name', 'val')}, {edges_sql('val', 'edge', THRESHOLD)}, {greedy_sql('val', 'edge')}"


@query("dedup_fuzzy", sql=f"{NAMES} SELECT v.vid AS p_partkey, v.v AS p_name FROM lead l JOIN val v USING (vid) WHERE l.vid = l.leader")
def fuzzy(spark, sf):
    return D.dedup_fuzzy(parts(spark, sf), "p_partkey", "p_name", THRESHOLD).select("p_partkey", "p_name")


@query("dup_groups", sql=f"{NAMES} SELECT p.p_partkey, l.leader FROM parts p JOIN val v ON v.v = p.p_name JOIN lead l USING (vid)")
def groups(spark, sf):
    return D.duplicate_groups(parts(spark, sf), "p_partkey", "p_name", THRESHOLD)


@query("win_group_label", sql=f"""{NAMES} SELECT p.p_partkey, CAST(dense_rank() OVER (ORDER BY l.leader) - 1 AS BIGINT) AS group_no
FROM parts p JOIN val v ON v.v = p.p_name JOIN lead l USING (vid)""")
def labels(spark, sf):
    from tidemill.operators.rank import row_index

    lead = D.duplicate_groups(parts(spark, sf), "p_partkey", "p_name", THRESHOLD)
    numbered = row_index(lead.select("leader").distinct(), ["leader"], "group_no")
    return lead.join(numbered, "leader").select("p_partkey", "group_no")


@query("df_fuzzy_column", sql=f"""{NAMES}, kept AS (SELECT vid FROM lead WHERE vid = leader),
 link AS (SELECT a AS x, b AS y FROM edge UNION ALL SELECT b, a FROM edge UNION ALL SELECT vid, vid FROM val),
 tgt AS (SELECT x, min(y) AS y FROM link WHERE y IN (SELECT vid FROM kept) GROUP BY 1)
SELECT DISTINCT p.p_size, t.v AS p_name FROM parts p JOIN val v ON v.v = p.p_name JOIN tgt ON tgt.x = v.vid JOIN val t ON t.vid = tgt.y""")
def fuzzy_column(spark, sf):
    df = parts(spark, sf).select("p_partkey", "p_name", "p_size")
    return D.dedup_fuzzy_column(df, "p_partkey", "p_name", THRESHOLD, survivors=THRESHOLD)


RECORD_T = 0.8
RECORDS = f"""WITH RECURSIVE {PARTS}, {values_sql('p_name', 'vn')}, {values_sql('p_line', 'vl')},
 en AS (SELECT * FROM (SELECT a.v AS a, b.v AS b, {blend_sql('a.form', 'b.form', 'a.w', 'b.w')} AS s FROM vn a JOIN vn b ON true) WHERE s >= 0.59),
 el AS (SELECT * FROM (SELECT a.v AS a, b.v AS b, {blend_sql('a.form', 'b.form', 'a.w', 'b.w')} AS s FROM vl a JOIN vl b ON true) WHERE s >= 0.59),
 rec AS (SELECT p_name, p_line, min(p_partkey) AS vid, count(*) AS n FROM parts GROUP BY 1, 2),
 redge AS (SELECT x.vid AS a, y.vid AS b, (en.s + el.s) / 2 AS s FROM rec x JOIN en ON en.a = x.p_name JOIN el ON el.a = x.p_line
   JOIN rec y ON y.p_name = en.b AND y.p_line = el.b WHERE x.vid < y.vid),
 edge AS (SELECT * FROM redge WHERE s >= {RECORD_T})"""


@query("db_potential_duplicates", "join_pairs_theta", sql=f"""{RECORDS}
SELECT a, b, x.n AS n_a, y.n AS n_b, round(s, 9) AS similarity FROM edge JOIN rec x ON x.vid = a JOIN rec y ON y.vid = b
UNION ALL SELECT vid, vid, n, n, 1.0::DOUBLE FROM rec WHERE n > 1""")
def potential(spark, sf):
    # distinct records; the copies of a record are one row with a = b, their ids follow from the record
    records = cut(P.distinct_values(parts(spark, sf), "p_partkey", ["p_name", "p_line"]))
    near = P.similar_records(records, ["p_name", "p_line"], RECORD_T)
    size = records.select("vid", "n")
    found = near.join(size.toDF("a", "n_a"), "a").join(size.toDF("b", "n_b"), "b")
    copies = records.filter("n > 1").select(F.col("vid").alias("a"), F.col("vid").alias("b"), F.col("n").alias("n_a"), F.col("n").alias("n_b"))
    return found.select("a", "b", "n_a", "n_b", F.round("similarity", 9).alias("similarity")).unionByName(
        copies.withColumn("similarity", F.round(F.lit(P.SELF), 9))
    )


RECORD_GROUPS = f"{RECORDS}, {greedy_sql('rec', 'edge')}"


@query("df_similar_records", sql=f"""{RECORD_GROUPS}, g AS (SELECT p.p_partkey, p.p_name, p.p_line, l.leader FROM parts p JOIN rec r USING (p_name, p_line) JOIN lead l ON l.vid = r.vid),
 big AS (SELECT leader, row_number() OVER (ORDER BY leader) - 1 AS duplicate_group FROM (SELECT leader FROM g GROUP BY 1 HAVING count(*) > 1))
SELECT p_name, p_line, duplicate_group, p_partkey AS original_index FROM g JOIN big USING (leader)""")
def record_groups(spark, sf):
    return D.similar_record_groups(parts(spark, sf), "p_partkey", ["p_name", "p_line"], RECORD_T)


@query("df_confidence", sql=f"""{RECORDS.replace(f's >= {RECORD_T}', f's > {RECORD_T}')}, {greedy_sql('rec', 'edge')}
SELECT p.p_partkey, round(CASE WHEN p.p_partkey = l.leader THEN 1.0::DOUBLE WHEN r.vid = l.leader THEN 0.0::DOUBLE ELSE 1 - e.s END, 9) AS confidence_score,
 p.p_partkey <> l.leader AS is_likely_duplicate
FROM parts p JOIN rec r USING (p_name, p_line) JOIN lead l ON l.vid = r.vid LEFT JOIN edge e ON e.a = l.leader AND e.b = r.vid""")
def confidence(spark, sf):
    out = D.with_confidence(parts(spark, sf), "p_partkey", ["p_name", "p_line"], RECORD_T)
    return out.select("p_partkey", F.round("confidence_score", 9).alias("confidence_score"), "is_likely_duplicate")


# ---- Bloom filter, MinHash

# the filters are sized for the distinct texts that they hold
def sized_sql(where):
    return f"""sized AS (SELECT bits, greatest(1, CAST(floor(bits / n * ln(2)) AS BIGINT)) AS hashes FROM (
 SELECT CAST(floor(-(n * ln(0.01)) / (ln(2) * ln(2))) AS BIGINT) AS bits, n FROM (SELECT count(DISTINCT text) AS n FROM documents WHERE {where})))"""


def sized(df):
    return D.bloom_size(D.distinct_texts(df, "text"), 0.01)


@query("bloom_build", sql=f"""WITH {sized_sql("true")}, p AS (SELECT DISTINCT {mod_sql("md5(text || h)", "bits")} AS pos FROM (SELECT text, bits, unnest(range(hashes)) AS h FROM documents, sized))
SELECT CAST(pos // 64 AS BIGINT) AS word, count(*) AS bits FROM p GROUP BY 1""")
def bloom_words(spark, sf):
    bloom = D.bloom_build(docs(spark, sf), "text", *sized(docs(spark, sf)))
    return bloom.select("word", F.bit_count("mask").cast("long").alias("bits"))


@query("bloom_probe", sql=f"""WITH {sized_sql("lang = 'en'")}, w AS (SELECT DISTINCT text, lang = 'en' AS is_en FROM documents),
 p AS (SELECT text, is_en, {mod_sql("md5(text || h)", "bits")} AS pos FROM (SELECT text, is_en, bits, unnest(range(hashes)) AS h FROM w, sized)),
 s AS (SELECT DISTINCT pos FROM p WHERE is_en)
SELECT md5(text) AS digest, bool_and(s.pos IS NOT NULL) AS maybe_seen FROM p LEFT JOIN s USING (pos) GROUP BY text""")
def bloom_hits(spark, sf):
    seen = docs(spark, sf).filter("lang = 'en'")
    bits, hashes = sized(seen)
    return D.bloom_probe_digests(docs(spark, sf), "text", D.bloom_build(seen, "text", bits, hashes), bits, hashes)


@query("dedup_probabilistic", sql="SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def probabilistic(spark, sf):
    # the table comes in two batches; the second is checked against the first
    df = docs(spark, sf).select("doc_id", "text")
    middle = (df.agg(F.max("doc_id")).first()[0] or 0) // 2
    one, two = df.filter(F.col("doc_id") <= middle), df.filter(F.col("doc_id") > middle)
    first = D.dedup_exact(one, ["text"], "doc_id")
    return first.unionByName(D.dedup_probabilistic(two, "text", "doc_id", one)).select("doc_id")


def signature_sql(x):
    tokens = words_sql(f"lower({x})")
    return f"list_transform(range(100), lambda i: list_min(list_transform({tokens}, lambda w: md5(w || i))))"


@query("minhash_signature", sql=f"SELECT conv_id, turn, array_to_string({signature_sql('text')}, ' ') AS signature FROM conversations")
def signatures(spark, sf):
    out = D.minhash_signature(table(spark, sf, "conversations"), "text")
    return out.select("conv_id", "turn", F.array_join("signature", " ").alias("signature"))


LSH_SQL = f"""WITH RECURSIVE d AS (SELECT doc_id, list_distinct({words_sql("lower(coalesce(text, ''))")}) AS t FROM documents),
s AS MATERIALIZED (SELECT md5(array_to_string(list_sort(t), ' ')) AS g, min(doc_id) AS node, len(t) AS n FROM d WHERE len(t) > 0 GROUP BY ALL),
w AS MATERIALIZED (SELECT s.node, unnest(d.t) AS word FROM s JOIN d ON d.doc_id = s.node),
rare AS (SELECT word FROM w GROUP BY 1 HAVING count(*) > 1),
c AS (SELECT p.node AS a, q.node AS b, count(*) AS common FROM w p JOIN rare USING (word) JOIN w q USING (word) WHERE p.node <> q.node GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM c JOIN s x ON x.node = a JOIN s y ON y.node = b WHERE common >= 0.8 * (x.n + y.n - common)),
reach AS (SELECT node AS a, node AS b FROM s UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
named AS (SELECT a AS node, min(b) AS group_id FROM reach GROUP BY 1)
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, coalesce(group_id, doc_id) AS group_id
FROM d LEFT JOIN s ON len(d.t) > 0 AND s.g = md5(array_to_string(list_sort(d.t), ' ')) LEFT JOIN named USING (node)"""


@query("minhash_lsh_pairs", sql=LSH_SQL)
def lsh(spark, sf):
    return lsh_groups(docs(spark, sf), "doc_id", "text")


@query("minhash_similarity", sql=f"""WITH s AS (SELECT conv_id, turn, {signature_sql('text')} AS g FROM conversations)
SELECT a.conv_id, a.turn, round(len(list_filter(list_zip(a.g, b.g), lambda p: p[1] = p[2])) / 100.0::DOUBLE, 9) AS similarity
FROM s a JOIN s b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def signature_match(spark, sf):
    s = D.minhash_signature(table(spark, sf, "conversations"), "text").select("conv_id", "turn", "signature")
    nxt = s.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("signature").alias("other"))
    same = X.match_fraction(F.col("signature"), F.col("other"))
    return s.join(nxt, ["conv_id", "turn"]).select("conv_id", "turn", F.round(same, 9).alias("similarity"))


@query("minhash_documents", sql=f"SELECT doc_id, md5(array_to_string({signature_sql('text')}, ' ')) AS digest FROM documents")
def document_signatures(spark, sf):
    out = D.minhash_signature(docs(spark, sf), "text")
    return out.select("doc_id", F.md5(F.array_join("signature", " ")).alias("digest"))


# ---- files


def _files(spark, sf):
    """One text file per page below the shared folder, and a copy of each page of the first 15 of 25 sites: which rows
    share a file doesn't depend on the number of tasks."""
    out = fresh_dir(spark, "pages")
    pages = table(spark, sf, "pages").select(F.col("html").alias("value"), F.col("page_id"))
    # one after the other: each copy is newer than every page
    for part, rows in (("page", pages), ("copy", pages.filter("page_id % 25 < 15"))):
        files.write_text_files(rows, f"{out}/part={part}", ["page_id"])
    return out


def _in_path(column, name):
    return F.regexp_extract(column, f"{name}=([^/]+)/", 1)


# a text file ends with a line feed
FILES = """files AS (SELECT page_id, part, md5(html || chr(10)) AS digest, CAST(strlen(html) + 1 AS BIGINT) AS size
 FROM pages, (SELECT unnest(['page', 'copy']) AS part) WHERE part = 'page' OR page_id % 25 < 15)"""


@query("file_duplicates", sql=f"""WITH {FILES}, g AS (SELECT digest, count(*) AS n_files, CAST(sum(size) AS BIGINT) AS bytes, min('part=' || part || '/page_id=' || page_id || '/') AS p
 FROM files GROUP BY 1 HAVING count(*) > 1)
SELECT digest, n_files, bytes, regexp_extract(p, 'part=([^/]+)/', 1) AS first_part, CAST(regexp_extract(p, 'page_id=([^/]+)/', 1) AS BIGINT) AS first_page FROM g""")
def file_copies(spark, sf):
    found = files.duplicate_files(files.file_table(spark, _files(spark, sf)))
    first = _in_path("first_path", "part").alias("first_part"), _in_path("first_path", "page_id").cast("long").alias("first_page")
    return found.select("digest", "n_files", "bytes", *first)


@query("file_keep_recommendation", "win_keep_newest_file", sql=f"""WITH {FILES} SELECT digest, count(*) - 1 AS n_delete, CAST(sum(size) - any_value(size) AS BIGINT) AS bytes_saved,
 CASE WHEN count_if(part = 'copy') > 0 THEN 'copy' ELSE 'page' END AS kept_part FROM files GROUP BY 1 HAVING count(*) > 1""")
def file_keep(spark, sf):
    return files.keep_newest(files.file_table(spark, _files(spark, sf))).withColumn("kept_part", _in_path("keep_path", "part")).drop("keep_path")


@query("src_binary_files", sql=f"WITH {FILES} SELECT part, page_id, size, sha256(html || chr(10)) AS digest FROM files JOIN pages USING (page_id)")
def file_list(spark, sf):
    found = files.file_table(spark, _files(spark, sf), digest="sha256")
    return found.select(_in_path("path", "part").alias("part"), _in_path("path", "page_id").cast("long").alias("page_id"), "size", "digest")


# ---- choice and report


@query("dedup_auto", sql=f"""{NAMES}
SELECT p_partkey FROM parts WHERE p_partkey IN (SELECT vid FROM lead WHERE vid = leader)""")
def auto(spark, sf):
    return D.dedup_auto(parts(spark, sf), "p_partkey", "p_name", threshold=THRESHOLD)[0].select("p_partkey")


@query("dedup_report", sql="""SELECT count(*) AS original, count(DISTINCT text) AS kept, count(*) - count(DISTINCT text) AS removed,
 round((count(*) - count(DISTINCT text)) / count(*), 9) AS rate, 'exact' AS method FROM documents""")
def report(spark, sf):
    df = docs(spark, sf)
    out = D.dedup_report(df, D.dedup_exact(df, ["text"], "doc_id"), "exact")
    return out.withColumn("rate", F.round("rate", 9))
