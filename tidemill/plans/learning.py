"""Machine learning on customer features, order measurements and embeddings."""

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from tidemill.operators import models as M
from tidemill.plans import inputs as I
from tidemill.plans.registry import query
from tidemill.session import cut, fresh_dir, table

FEATURES = ["n_orders", "tenure", "monthly", "total"]
SPLIT = f"""{I.CHURN}, h AS (SELECT *, ('0x' || substr(md5(customer_id || '-42'), 1, 15))::BIGINT AS h FROM churn),
 s AS (SELECT *, CAST(churn = 'Yes' AS INTEGER) AS label, row_number() OVER (PARTITION BY churn ORDER BY h, customer_id)
   <= ceil(count(*) OVER (PARTITION BY churn) * 0.8) AS in_train FROM h)"""


def labelled(spark, sf):
    return I.churn(spark, sf).withColumn("label", (F.col("churn") == "Yes").cast("int"))


def parts(spark, sf):
    """(training rows, test rows), written once so that iterative fits do not redo the join."""
    df = cut(M.split_by_class(labelled(spark, sf), "customer_id", "label"))
    return df.filter("in_train"), df.filter("NOT in_train")


def assembled(spark, sf):
    train, test = parts(spark, sf)
    return M.assemble(train, FEATURES), M.assemble(test, FEATURES)


@query("ml_split_stratified", sql=f"WITH {SPLIT} SELECT customer_id, churn, in_train FROM s")
def split(spark, sf):
    return M.split_by_class(I.churn(spark, sf), "customer_id", "churn").select("customer_id", "churn", "in_train")


@query("ml_majority_rate", sql=f"""WITH {I.CHURN}, c AS (SELECT churn, count(*) AS n FROM churn GROUP BY 1)
SELECT (SELECT churn FROM c ORDER BY n DESC, churn DESC LIMIT 1) AS churn, round(max(n) / sum(n), 9) AS share FROM c""")
def majority(spark, sf):
    return M.majority_rate(I.churn(spark, sf), "churn").withColumn("share", F.round("share", 9))


def report(spark, rows):
    return spark.createDataFrame(rows, "part string, accuracy double")


@query("ml_logistic")
def logistic(spark, sf):
    train, test = assembled(spark, sf)
    return report(spark, M.fit_report(LogisticRegression(maxIter=3333), train, test)[1])


@query("ml_decision_tree")
def tree(spark, sf):
    train, test = assembled(spark, sf)
    rows = []
    for name, m in (("deep", DecisionTreeClassifier(maxDepth=25, seed=42)), ("depth3", DecisionTreeClassifier(maxDepth=3, seed=42))):
        model, scores = M.fit_report(m, train, test)
        rows += [(f"{name}_{part}", acc) for part, acc in scores] + [(f"{name}_depth", float(model.depth))]
    return report(spark, rows)


@query("ml_random_forest")
def forest(spark, sf):
    train, test = assembled(spark, sf)
    return report(spark, M.fit_report(RandomForestClassifier(maxDepth=3, seed=42), train, test)[1])


@query("ml_hyper_search")
def search(spark, sf):
    train, _ = assembled(spark, sf)
    return M.hyper_search(RandomForestClassifier(seed=42), train, {"maxDepth": (3, 10), "numTrees": (5, 30)}, trials=6)


@query("ml_feature_importance")
def importance(spark, sf):
    train, test = assembled(spark, sf)
    model = RandomForestClassifier(maxDepth=3, seed=42).fit(train)
    ranked = M.importances(spark, model, FEATURES)
    # refit without the weakest feature
    strong = [r["feature"] for r in ranked.collect()][:-1]
    drop = lambda d: M.assemble(d.drop("features"), strong)
    refit = RandomForestClassifier(maxDepth=3, seed=42).fit(drop(train))
    return ranked.withColumn("refit_accuracy", F.lit(M.accuracy(refit.transform(drop(test)))))


def measured(spark, sf):
    return I.trips(spark, sf).withColumn("fuel", F.nullif("fuel", F.lit("-")).try_cast("double"))


TRIP = ["distance", "moving_time", "max_speed"]


@query("ml_rf_impute")
def impute(spark, sf):
    df = cut(measured(spark, sf))
    out, _ = M.forest_impute(df, "row_id", "fuel", TRIP)
    return out.select("row_id", "fuel")


@query("ml_r2_mse", sql=f"""WITH {I.TRIPS}, n AS (SELECT try_cast(nullif(fuel, '-') AS DOUBLE) AS y, moving_time * 900 AS p FROM trips)
SELECT round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 6) AS r2, round(avg((y - p) * (y - p)), 2) AS mse FROM n WHERE y IS NOT NULL""")
def quality(spark, sf):
    df = measured(spark, sf).filter("fuel IS NOT NULL").withColumn("p", F.col("moving_time") * 900)
    return M.regression_metrics(df, "fuel", "p").select(F.round("r2", 6).alias("r2"), F.round("mse", 2).alias("mse"))


# ---- nearest neighbours

NEAR = f"""{SPLIT}, d AS (SELECT a.customer_id, a.label AS y, b.customer_id AS tid, b.label AS label,
  (a.n_orders - b.n_orders) ** 2 + (a.tenure - b.tenure) ** 2 + (a.monthly - b.monthly) ** 2 + (a.total - b.total) ** 2 AS d
  FROM s a JOIN s b ON NOT a.in_train AND b.in_train),
 r AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY d, tid) AS rn FROM d),
 ks AS (SELECT unnest(range(2, 20)) AS k),
 v AS (SELECT customer_id, k, any_value(y) AS y, label, count(*) AS n FROM r JOIN ks ON rn <= k GROUP BY customer_id, k, label),
 p AS (SELECT customer_id, k, y, label AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, k ORDER BY n DESC, label) AS o FROM v) WHERE o = 1)"""


def predicted(spark, sf):
    train, test = parts(spark, sf)
    return M.knn(train, test, FEATURES, "label", "customer_id", 18)


@query("ml_knn", sql=f"WITH {NEAR} SELECT customer_id, CAST(prediction AS INTEGER) AS prediction FROM p WHERE k = 18")
def knn(spark, sf):
    return predicted(spark, sf).select("customer_id", F.col("prediction").cast("int").alias("prediction"))


@query("ml_knn_scan", sql=f"WITH {NEAR} SELECT CAST(k AS INTEGER) AS k, round(avg(CASE WHEN y = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 9) AS accuracy FROM p GROUP BY 1")
def knn_scan(spark, sf):
    train, test = parts(spark, sf)
    out = M.knn_scan(train, test, FEATURES, "label", "customer_id", list(range(2, 20)))
    return out.withColumn("accuracy", F.round("accuracy", 9))


@query("ml_confusion", sql=f"WITH {NEAR} SELECT CAST(y AS INTEGER) AS label, CAST(prediction AS INTEGER) AS prediction, count(*) AS n FROM p WHERE k = 18 GROUP BY 1, 2")
def confusion(spark, sf):
    return M.confusion(predicted(spark, sf).withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction")


@query("ml_prediction_compare", sql=f"WITH {NEAR} SELECT y = prediction AS correct, count(*) AS n FROM p WHERE k = 18 GROUP BY 1")
def compare(spark, sf):
    return M.prediction_compare(predicted(spark, sf), "label", "prediction")


@query("ml_scale", sql=f"""WITH {I.CHURN} SELECT customer_id, {', '.join(
    f"round(({c} - (SELECT avg({c}) FROM churn)) / (SELECT stddev_pop({c}) FROM churn), 6) AS {c}" for c in ('tenure', 'monthly', 'total'))} FROM churn""")
def scale(spark, sf):
    cols = ["tenure", "monthly", "total"]
    out = M.standardize(I.churn(spark, sf).select("customer_id", *cols), cols)
    return out.select("customer_id", *[F.round(c, 6).alias(c) for c in cols])


@query("ml_scaled_knn_cv", "ml_pipeline_cv")
def scaled_cv(spark, sf):
    out = M.knn_cross_validation(cut(labelled(spark, sf)), FEATURES, "label", "customer_id", 18)
    return out.agg(F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("std_accuracy"))


# ---- clusters of the embeddings


def points(spark, sf):
    return M.vectors(table(spark, sf, "embeddings"), "embedding", 64).select("vec_id", "label", "features")


@query("ml_kmeans")
def kmeans(spark, sf):
    df = points(spark, sf)
    return KMeans(k=3, seed=42).fit(df).transform(df).select("vec_id", "label", "prediction")


KS = range(2, 30)


@query("ml_kmeans_elbow")
def elbow(spark, sf):
    return M.cluster_scan(points(spark, sf), KS).select("k", "cost", "diff")


@query("ml_silhouette_scan")
def silhouettes(spark, sf):
    plain = M.cluster_scan(points(spark, sf), KS, silhouette=True)
    scaled = M.cluster_scan(M.scaled(points(spark, sf)), KS, silhouette=True)
    tag = lambda d, s: d.select(F.lit(s).alias("data"), "k", "silhouette")
    return tag(plain, "plain").unionByName(tag(scaled, "scaled"))


@query("ml_pca2")
def pca(spark, sf):
    out = M.principal_components(points(spark, sf), 2)
    return out.select("vec_id", F.col("components")[0].alias("x"), F.col("components")[1].alias("y"))


@query("ml_compare_models")
def leaderboard(spark, sf):
    return M.compare_models(*assembled(spark, sf))


@query("ml_save_load_score")
def save_load(spark, sf):
    train, test = parts(spark, sf)
    path = fresh_dir(spark, "model")
    out = M.save_and_score(train.drop("label"), test.drop("label"), FEATURES, "churn", path)
    return out.select("customer_id", "churn", "prediction", "score")
