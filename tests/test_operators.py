import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import aggregate as A
from tidemill.operators import models as M
from tidemill.operators import partitions as PT
from tidemill.operators import recommend as R
from tidemill.operators import shards as H
from tidemill.operators import texts as T
from tidemill.operators.phik import phik_from_counts, phik_matrix
from tidemill.session import fresh_dir


def test_sales_lines(spark):
    lines = ["2024-01-05,pen,office,2,1.5", "2024-01-05,pen,2,1.5", "2024-01-05,pen,office,two,1.5", "05.01.2024,pen,office,2,1.5", "", "a,b,c,d,e,f"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [r.is_valid for r in A.parse_sales(df).collect()] == [True] + [False] * 5
    assert [r.is_valid for r in A.parse_sales(df, with_category=False).collect()] == [False, True] + [False] * 4


def test_distances_equal_dense_form(spark):
    rng = np.random.default_rng(3)
    m = np.where(rng.random((12, 30)) < 0.3, rng.integers(1, 6, (12, 30)), -1).astype(float)
    m[:, 0], m[5] = 4, np.where(np.arange(30) == 0, 4, -1)  # one item everyone rated
    rows = [(u, i, float(m[u, i])) for u in range(12) for i in range(30) if m[u, i] > 0]
    seen = sorted({i for _, i, _ in rows})
    dense = m[:, seen]
    got = {r.user_id: r for r in R.user_distances(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), 2).collect()}
    for u in range(12):
        a, b = dense[2], dense[u]
        assert got[u].euclidean == pytest.approx(np.linalg.norm(a - b), abs=1e-9)
        assert got[u].cosine == pytest.approx(1 - a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-9)


@pytest.mark.parametrize("blocks", [(7, 5), (10**6, 10**6)])
def test_nearest_any_blocking(spark, blocks):
    rng = np.random.default_rng(8)
    x, y, q = rng.integers(0, 6, (60, 2)).astype(float), rng.integers(0, 3, 60), rng.integers(0, 6, (17, 2)).astype(float)
    train = spark.createDataFrame([(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))], "id long, a double, b double, y int")
    test = spark.createDataFrame([(i, *map(float, r), 0) for i, r in enumerate(q)], "id long, a double, b double, y int")
    near = M.nearest(train, test, ["a", "b"], "y", "id", 5, *blocks)
    votes = {(r.id, r.k): r.prediction for r in M.vote(near, "id", [1, 3, 5]).collect()}
    for i, p in enumerate(q):
        order = sorted(range(60), key=lambda t: (((x[t] - p) ** 2).sum(), t))
        for k in (1, 3, 5):
            labels = [y[t] for t in order[:k]]
            assert votes[i, k] == max(sorted(set(labels)), key=labels.count)


def test_phik_counts_values_exactly(spark):
    """200 values pass and 201 don't, whatever an approximate count says."""
    for start in range(0, 3000, 500):
        rows = lambda n: spark.createDataFrame([(f"v{start + i}", i % 2) for i in range(n)], "a string, b int")  # noqa: B023
        assert phik_matrix(rows(200), []).count() == 4
        with pytest.raises(ValueError):
            phik_matrix(rows(201), [])


def test_phik_query_has_all_churn_columns(spark, sf):
    from __spark_entry__ import queries

    got = {r.x for r in queries()["phik_matrix"](spark, sf).select("x").distinct().collect()}
    assert got == {"segment", "contract", "n_orders", "tenure", "monthly", "total", "churn"}


def test_phik_extremes():
    assert phik_from_counts(np.full((3, 4), 100.0)) == 0.0
    assert phik_from_counts(np.diag([500.0, 400.0, 300.0])) > 0.95
    x = np.random.default_rng(1).multivariate_normal([0, 0], [[1, 0.6], [0.6, 1]], 40_000)
    counts = np.histogram2d(x[:, 0], x[:, 1], bins=10)[0]
    assert phik_from_counts(counts) == pytest.approx(0.6, abs=0.05)


def test_shards(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, 10, 25])], "id long, v double")
    assert [r.shard_id for r in H.shard_by_range(df, "v", [(0, 10), (10, 20)]).orderBy("id").collect()] == [0, 1, 1]
    assert H.shard_by_count(df.limit(0), ["id"], 4).count() == 0
    numbers = spark.range(10_000)
    assert H.shard_by_count(numbers, ["id"], 7).groupBy("shard_id").count().agg(F.max("count"), F.count("*")).first()[:] == (1429, 7)
    assert H.shard_adaptive(numbers, ["id"], 0.001).agg(F.countDistinct("shard_id")).first()[0] > 10


def test_checkpointed_map_goes_on(spark):
    path, calls = fresh_dir(spark, "waves"), fresh_dir(spark, "calls")
    df = H.shard_by_size(spark.range(100), ["id"], 10)

    def run(pdf):
        return pdf.assign(twice=pdf["id"] * 2)

    def broken(pdf):
        if pdf["shard_id"].iloc[0] == 6:
            raise ValueError("lost")
        return run(pdf)

    schema = "id long, shard_id long, twice long"
    with pytest.raises(Exception):
        PT.map_with_checkpoint(df, broken, schema, path)
    done = {r[0] for r in spark.read.parquet(path).select("wave").distinct().collect()}
    assert done == {0, 1}
    out = PT.map_with_checkpoint(df, run, schema, path)
    assert out.agg(F.count("*"), F.sum("twice")).first()[:] == (100, 9900) and calls


def test_retry_keeps_results_and_failures(spark):
    df = H.shard_by_size(spark.range(50), ["id"], 10)

    def run(pdf):
        if pdf["shard_id"].iloc[0] == 3:
            raise KeyError("x")
        return pdf[["id"]]

    out = PT.map_with_retry(df, run, retries=2, delay=0.001)
    status = {r.shard_id: (r.status, r.attempts) for r in PT.shard_status(out).collect()}
    assert status == {i: ("failed", 3) if i == 3 else ("success", 1) for i in range(5)}
    assert PT.payloads(out, "id long").count() == 40


def test_topic_windows(spark):
    docs = [["a", "b", "x", "x", "a"], ["b"], []]
    df = spark.createDataFrame([(d,) for d in docs], "w array<string>")
    seen, total = T.window_counts(df, "w", ["a", "b"], length=3)
    wins = [d[i : i + 3] for d in docs if d for i in range(max(1, len(d) - 2))]
    assert total == len(wins)
    for i, x in enumerate("ab"):
        for j, y in enumerate("ab"):
            assert seen.get((i, j), 0) == sum(x in w and y in w for w in wins)


def test_split_takes_exact_shares(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "no").otherwise("yes").alias("y"))
    got = {(r.y, r.in_train): r["count"] for r in M.split_by_class(df, "id", "y").groupBy("y", "in_train").count().collect()}
    assert got == {("no", True): 80, ("no", False): 20, ("yes", True): 720, ("yes", False): 180}


def test_sentiment_shuffles_sums_and_no_words(spark):
    import re

    from tidemill.operators import texts as T

    docs = spark.createDataFrame([(1, "Good good bad"), (1, "good x"), (2, None), (3, " "), (4, "x y")], "id long, text string")
    lexicon = spark.createDataFrame([("good", 3), ("bad", -2)], "word string, score int")
    out = T.sentiment(docs, "id", "text", lexicon)
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", out._jdf.queryExecution().executedPlan().toString())
    assert keys and not any("word" in k for k in keys)
    assert sorted(((r.id, r.sentiment) for r in out.collect()), key=str) == [(1, 7 / 5), (1, 7 / 5), (2, None), (3, None), (4, 0.0)]


def test_a_large_file_of_one_row_group_is_spread(spark, tmp_path):
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tidemill.session import table

    rows = [np.random.default_rng(i).bytes(20_000).hex() for i in range(1_000)]
    for name, size in (("documents", 1_000), ("pages", 50)):
        pq.write_table(pa.table({"id": range(1_000), "text": rows}), f"{tmp_path}/{name}.parquet", row_group_size=size, compression="none")
    held = lambda df: [n for n in df.select("id").rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect() if n]
    raw = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert raw.rdd.getNumPartitions() >= 8 and held(raw) == [1_000]
    docs = table(spark, str(tmp_path), "documents")
    assert max(held(docs)) <= 250 and docs.distinct().count() == 1_000
    even = table(spark, str(tmp_path), "pages")
    assert "Repartition" not in even._jdf.queryExecution().optimizedPlan().toString() and max(held(even)) <= 250


def test_scored_texts_may_be_null_or_empty(spark, tmp_path):
    """As in the SQL: a null text has no score, and an empty one NaN."""
    import duckdb

    import __spark_entry__ as entry

    rows = [(1, "bee"), (2, None), (3, ""), (4, "x"), (5, "é e"), (6, " ")]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    got = {r.doc_id: r.score for r in entry.queries()["score_text"](spark, str(tmp_path)).collect()}
    sql = entry.oracle_sql()["score_text"].replace("FROM documents", f"FROM read_parquet('{path}/*.parquet')")
    want = dict(duckdb.sql(sql).fetchall())
    assert got.keys() == want.keys() and got[2] is None and np.isnan(got[3])
    assert all(got[k] == want[k] for k in (1, 2, 4, 5, 6))
