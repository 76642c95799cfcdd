"""File sources and sinks: tables are written out in the source's form and read back."""

from pyspark.sql import functions as F

from tidemill.operators import aggregate as A
from tidemill.operators import partitions as M
from tidemill.operators import shards as H
from tidemill.plans import inputs as I
from tidemill.plans.registry import query
from tidemill.session import fresh_dir, small, table
from tidemill.sources import files

CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("src_csv", "sink_csv", sql=CUSTOMER_SQL)
def csv(spark, sf):
    path = fresh_dir(spark, "csv")
    files.write_csv(table(spark, sf, "customer"), path)
    return files.read_csv(spark, path, CUSTOMER)


@query("src_csv_sep", sql=CUSTOMER_SQL)
def csv_sep(spark, sf):
    path = fresh_dir(spark, "csv-sep")
    files.write_csv(table(spark, sf, "customer"), path, sep=";")
    return files.read_csv(spark, path, CUSTOMER, sep=";")


NUMBERS = 64


@query("src_csv_rename", sql=f"SELECT vec_id, {', '.join(f'embedding[{i}]::DOUBLE AS measure_{i}' for i in range(1, NUMBERS + 1))}, label AS class FROM embeddings")
def csv_rename(spark, sf):
    path = fresh_dir(spark, "csv-names")
    numbers = [F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(NUMBERS)]
    files.write_csv(table(spark, sf, "embeddings").select(F.col("vec_id").alias("a"), *numbers, F.col("label").alias("d")), path)
    names = ", ".join(f"measure_{i} double" for i in range(1, NUMBERS + 1))
    return files.read_csv(spark, path, f"vec_id long, {names}, class int")  # names replace the header


@query("src_tsv_lexicon", sql="""WITH lex AS (SELECT DISTINCT word, CAST(length(word) % 11 - 5 AS INTEGER) AS score FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part))
SELECT p_partkey, CAST(sum(score) AS BIGINT) AS score FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part) JOIN lex USING (word) GROUP BY 1""")
def tsv(spark, sf):
    words = table(spark, sf, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))
    path = fresh_dir(spark, "lexicon")
    lex = words.select("word").distinct().select("word", (F.length("word") % 11 - 5).cast("int").alias("score"))
    files.write_csv(lex, path, sep="\t", header=False)
    lexicon = files.read_csv(spark, path, "word string, score int", sep="\t", header=False)
    return words.join(small(lexicon), "word").groupBy("p_partkey").agg(F.sum("score").alias("score"))


@query("src_sql_query", sql="SELECT doc_id, lang, source FROM documents WHERE lang = 'en'")
def by_sql(spark, sf):
    table(spark, sf, "documents").createOrReplaceTempView("posts")
    return spark.sql("SELECT doc_id, lang, source FROM posts WHERE lang = 'en'")


@query("src_sales_lines", sql=f"""WITH {I.SALES_GOOD}
SELECT l.l_orderkey, l.l_linenumber, l.line AS value, (len(f) = 5 AND try_strptime(f[1], '%Y-%m-%d') IS NOT NULL
 AND try_cast(f[4] AS DOUBLE) IS NOT NULL AND try_cast(f[5] AS DOUBLE) IS NOT NULL) AS is_valid
FROM (SELECT *, string_split(line, ',') AS f FROM lines) l""")
def sales(spark, sf):
    out = A.parse_sales(I.sales_lines(spark, sf))
    return out.select("l_orderkey", "l_linenumber", "value", "is_valid")


@query("src_nonempty_files", sql="""SELECT count(*) AS n_valid, CAST(0 AS BIGINT) AS n_empty FROM pages""")
def nonempty(spark, sf):
    path = fresh_dir(spark, "inputs")
    pages = table(spark, sf, "pages").select(F.col("html").alias("value"), "page_id")
    files.write_text_files(pages, path, ["page_id"])
    # five data sets without a line
    for i in range(5):
        pages.select("value").limit(0).coalesce(1).write.text(f"{path}/empty-{i}")
    found = files.nonempty_files(spark, path)
    return found.agg(F.count_if(F.col("size") > 0).alias("n_valid"), F.count_if(F.col("size") == 0).alias("n_empty"))


def shard_files(spark, sf):
    path = fresh_dir(spark, "shard-files")
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    sharded = H.shard_by_hash(df, "o_orderkey", 8)
    # rows of a shard come together, and a large shard is split over tasks and files
    sharded.hint("rebalance", F.col("shard_id")).write.partitionBy("shard_id").option("maxRecordsPerFile", 1_000_000).parquet(path)
    return path


@query("sink_shards", sql="SELECT count(*) AS n, CAST(8 AS BIGINT) AS shards FROM orders")
def write_shards(spark, sf):
    back = spark.read.parquet(shard_files(spark, sf))
    return back.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("shard_id").alias("shards"))


@query("src_shards_map", sql="SELECT count(*) AS n, round(sum(o_totalprice * 2), 2) AS total FROM orders")
def map_shard_files(spark, sf):
    def double(pdf):
        return pdf[["o_orderkey"]].assign(doubled=pdf["o_totalprice"] * 2)

    back = spark.read.parquet(shard_files(spark, sf))
    done = M.map_partitions(back, double, "o_orderkey long, doubled double")
    return done.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("doubled"), 2).alias("total"))


@query("sink_merge_parts", sql="""SELECT 'by_status' AS report, o_orderstatus AS key, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'by_priority', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def merge(spark, sf):
    od, path = table(spark, sf, "orders"), fresh_dir(spark, "parts")
    for name, col in (("by_status", "o_orderstatus"), ("by_priority", "o_orderpriority")):
        A.value_counts(od, col).withColumnRenamed(col, "key").write.parquet(f"{path}/in/report={name}")
    # a summary has one row per key, so one file is enough
    spark.read.parquet(f"{path}/in").coalesce(1).write.parquet(f"{path}/summary")
    return spark.read.parquet(f"{path}/summary").select("report", "key", "n")
