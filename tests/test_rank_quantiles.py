import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import quantiles as Q
from tidemill.operators import rank as R


def hot(spark, n=6000):
    """Two thirds of the rows share one key."""
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("k"), ((F.col("id") * 7919) % n).alias("o"))


@pytest.mark.parametrize("per_slice", [97, 1500, 10**6])
def test_rank_in_group_any_slicing(spark, per_slice):
    df = hot(spark)
    got = R.rank_in_group(df, ["k"], ["o"], "r", rows_per_slice=per_slice).toPandas()
    assert len(got) == 6000
    want = got.groupby("k")["o"].rank().astype(int)
    assert (got["r"] == want).all()


@pytest.mark.parametrize("per_slice", [97, 10**6])
def test_row_index(spark, per_slice):
    got = R.row_index(hot(spark), ["o"], "i", rows_per_slice=per_slice).toPandas().sort_values("o")
    assert got["i"].tolist() == list(range(6000))


def test_rank_with_null_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [("a", i + 100) for i in range(20)], "k string, o long")
    got = R.rank_in_group(df, ["k"], ["o"], "r", rows_per_slice=5).toPandas()
    assert sorted(got["r"]) == sorted(list(range(1, 21)) * 2)


def test_first_last_none(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", None), (4, None, "z"), (5, None, "w")], "id long, k string, v string")
    rows = lambda d: sorted(tuple(r) for r in d.select("id").collect())
    assert rows(R.first_per_key(df, ["k"], "id")) == [(1,), (3,), (4,)]
    assert rows(R.first_per_key(df, ["k"], "id", last=True)) == [(2,), (3,), (5,)]
    assert rows(R.only_unrepeated(df, ["k"])) == [(3,)]
    assert R.first_per_key(df, ["k"], "id").columns == df.columns
    assert R.only_unrepeated(df.select("k"), ["k"]).collect()[0][0] == "b"


@pytest.mark.parametrize("small", [10**6, 1])
def test_quantiles_exact(spark, small):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.lognormal(3, 2, 3000), np.full(1500, 7.25), -rng.random(500) * 1e-6])
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(x)] + [(None, 0)], "x double, g int")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = Q.exact_quantiles(df, ["x"], probs, small_rows=small).first()
    assert list(got) == pytest.approx(np.quantile(x, probs).tolist(), rel=1e-12)
    by = Q.exact_quantiles(df, ["x"], [0.5], by=["g"], small_rows=small).collect()
    g = np.arange(len(x)) % 3
    assert {r.g: r.x_p50 for r in by} == pytest.approx({k: np.quantile(x[g == k], 0.5) for k in range(3)})


@pytest.mark.parametrize("small", [10**6, 3])
def test_quantiles_of_many_groups(spark, small):
    df = spark.range(50_000).selectExpr("id % 12500 AS g", "CAST(id DIV 12500 AS DOUBLE) + id % 12500 AS x").unionByName(spark.createDataFrame([(None, 5.0)], "g long, x double"))
    got = {r.g: r.x_p50 for r in Q.exact_quantiles(df, ["x"], [0.5], by=["g"], small_rows=small).collect()}
    assert got == {None: 5.0} | {g: g + 1.5 for g in range(12_500)}


def test_index_by_text_and_several_columns(spark):
    """Nine of ten texts have one first letter, and nine of ten rows one value of the first order column."""
    rows = [(f"{'a' if i % 10 else 'b'}{i * 7919 % 5000:04d}", int(i % 10 == 0), i, None if i % 7 else "k") for i in range(5000)]
    df = spark.createDataFrame(rows, "t string, o int, id long, g string").repartition(5)
    for order, key in ((["t"], lambda r: r[0]), (["o", "id"], lambda r: r[1:3])):
        got = {r.id: r.i for r in R.row_index(df, order, "i").collect()}
        assert got == {r[2]: i for i, r in enumerate(sorted(rows, key=key))}
        placed = R.ordered_index(df, order, "i", partitions=16)
        assert {r.id: r.i for r in placed.collect()} == got
        sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 12 and max(sizes) < 1000
    ranked = {r.id: r.n for r in R.rank_in_group(df, ["g"], ["t"], "n").collect()}
    for g in (None, "k"):
        assert [ranked[r[2]] for r in sorted(r for r in rows if r[3] == g)] == list(range(1, 1 + sum(r[3] == g for r in rows)))
    assert R.row_index(df.limit(0), ["t"]).count() == 0
