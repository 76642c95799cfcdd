"""Facts that hold for fitted models and not for random answers."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries


@pytest.fixture(scope="module")
def run(spark, sf):
    return lambda name: queries()[name](spark, sf)


@pytest.fixture(scope="module")
def share(run):
    return run("ml_majority_rate").first()["share"]


def test_trees_learn(run, share):
    got = {r.part: r.accuracy for r in run("ml_decision_tree").collect()}
    assert got["deep_train"] >= got["depth3_train"] >= share - 0.02  # the share of all rows, not of the training part
    assert got["deep_train"] > 0.95 and got["depth3_depth"] <= 3 < got["deep_depth"] <= 25


@pytest.mark.parametrize("name", ["ml_logistic", "ml_random_forest"])
def test_no_worse_than_the_majority(run, share, name):
    got = {r.part: r.accuracy for r in run(name).collect()}
    assert got["train"] >= share - 0.02


def test_importances_add_up(run):
    rows = run("ml_feature_importance").collect()
    assert sum(r.importance for r in rows) == pytest.approx(1)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True) and rows[-1].importance >= 0


def test_imputation_fills_and_stays_in_range(spark, sf, run):
    from tidemill.plans.learning import measured

    known = {r.row_id: r.fuel for r in measured(spark, sf).select("row_id", "fuel").collect()}
    filled = {r.row_id: r.fuel for r in run("ml_rf_impute").collect()}
    values = [v for v in known.values() if v is not None]
    assert filled.keys() == known.keys() and None not in filled.values() and len(values) < len(known)
    for k, v in known.items():
        assert filled[k] == v if v is not None else min(values) <= filled[k] <= max(values)


def test_components_are_ordered_and_apart(run):
    got = run("ml_pca2").agg(F.var_pop("x").alias("x"), F.var_pop("y").alias("y"), F.corr("x", "y").alias("r"), F.avg("x").alias("m")).first()
    assert got.x >= got.y > 0 and abs(got.r) < 1e-6 and abs(got.m) < 1e-6


def test_saved_model_scores(run):
    got = run("ml_save_load_score").agg(F.min("score").alias("low"), F.max("score").alias("high"), F.count_if(F.col("prediction").isNull()).alias("n")).first()
    assert 0.5 <= got.low <= got.high <= 1 and got.n == 0


def test_more_clusters_cost_less(spark, sf):
    from tidemill.operators.models import cluster_scan
    from tidemill.plans.learning import points

    cost = [r["cost"] for r in cluster_scan(points(spark, sf), [2, 5, 10, 20]).orderBy("k").collect()]
    assert cost == sorted(cost, reverse=True) and cost[-1] > 0


def test_fits_side_by_side_are_those_of_one_at_a_time(spark, sf):
    from tidemill.operators.models import cluster_scan
    from tidemill.plans.learning import points

    df = points(spark, sf)
    one, four = ([tuple(r) for r in cluster_scan(df, range(2, 6), silhouette=True, side=n).orderBy("k").collect()] for n in (1, 4))
    assert [r[0] for r in four] == [2, 3, 4, 5] and four[0][2] is None
    assert all(a[1:] == pytest.approx(b[1:], rel=1e-9) for a, b in zip(one[1:], four[1:])) and one[0][1] == pytest.approx(four[0][1])
