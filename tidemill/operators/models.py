"""Machine learning: splits, metrics, nearest neighbours, and Spark ML models."""

from __future__ import annotations

import random
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.clean import update_from
from tidemill.operators.neighbours import nearest
from tidemill.operators.rank import rank_in_group
from tidemill.session import small

# ---- split, scale, metrics


def stable_number(id_col: str, seed: int) -> Column:
    """A number below 2^60 from the id and a seed; the same on every run and engine."""
    digest = F.md5(F.concat_ws("-", F.col(id_col).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def split_by_class(df: DataFrame, id_col: str, label: str, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``in_train``: exactly ceil(share x n) rows of every class."""
    mixed = df.withColumn("__h", stable_number(id_col, seed))
    ranked = rank_in_group(mixed, [label], ["__h", id_col], "__rank")
    sizes = df.groupBy(label).agg(F.ceil(F.count(F.lit(1)) * share).alias("__take"))
    return ranked.join(small(sizes), label).select(
        *df.columns, (F.col("__rank") <= F.col("__take")).alias("in_train")
    )


def fold_of(id_col: str, folds: int, seed: int = 42) -> Column:
    return F.pmod(stable_number(id_col, seed), F.lit(folds)).cast("int")


def standardize(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population standard deviation; the two numbers per column come from ``fit_on``."""
    source = fit_on if fit_on is not None else df
    row = source.agg(*[a for c in columns for a in (F.avg(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s"))]).first()
    for c in columns:
        m, s = row[f"{c}__m"], row[f"{c}__s"]
        df = df.withColumn(c, (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0))
    return df


def majority_rate(df: DataFrame, label: str) -> DataFrame:
    """The commonest class and its share."""
    n = F.col("n")
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max_by(label, F.struct("n", label)).alias(label), (F.max(n) / F.sum(n)).alias("share"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def prediction_compare(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """How many predictions are right and wrong."""
    return df.groupBy((F.col(label) == F.col(prediction)).alias("correct")).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double"))).first()[0]


def regression_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """r2 and mse in one pass."""
    e = F.col(y) - F.col(p)
    sums = df.agg(
        F.avg(e * e).alias("mse"), F.sum(e * e).alias("sse"), (F.var_pop(y) * F.count(y)).alias("sst")
    )
    return sums.select((1 - F.try_divide("sse", "sst")).alias("r2"), "mse")


# ---- nearest neighbours


def vote(neighbours: DataFrame, id_col: str, ks: list[int]) -> DataFrame:
    """id, k, prediction: majority among the k nearest, ties to the lowest class."""
    each = neighbours.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).filter(F.col("rank") <= F.col("k"))
    counts = each.groupBy(id_col, "k", "label").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(id_col, "k").agg(F.max_by("label", F.struct(F.col("n"), -F.col("label"))).alias("prediction"))


def knn(train: DataFrame, test: DataFrame, features: list[str], label: str, id_col: str, k: int) -> DataFrame:
    out = vote(nearest(train, test, features, label, id_col, k), id_col, [k]).drop("k")
    return test.join(out, id_col)


def knn_scan(train: DataFrame, test: DataFrame, features: list[str], label: str, id_col: str, ks: list[int]) -> DataFrame:
    """Accuracy for several k from one neighbour search."""
    votes = vote(nearest(train, test, features, label, id_col, max(ks)), id_col, ks)
    both = votes.join(test.select(id_col, F.col(label).cast("double").alias("y")), id_col)
    return both.groupBy("k").agg(F.avg((F.col("y") == F.col("prediction")).cast("double")).alias("accuracy"))


def knn_cross_validation(df: DataFrame, features: list[str], label: str, id_col: str, k: int, folds: int = 5, scale: bool = True) -> DataFrame:
    """fold, accuracy; the scaler is fitted on the training part of each fold."""
    tagged, rows = df.withColumn("__fold", fold_of(id_col, folds)), []
    for f in range(folds):
        train, test = tagged.filter(F.col("__fold") != f), tagged.filter(F.col("__fold") == f)
        if scale:
            train, test = standardize(train, features, train), standardize(test, features, train)
        rows.append((f, accuracy(knn(train, test, features, label, id_col, k), label)))
    return df.sparkSession.createDataFrame(rows, "fold int, accuracy double")


# ---- Spark ML


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(df)


def classifiers(seed: int = 42) -> dict[str, object]:
    return {
        "logistic": LogisticRegression(maxIter=100),
        "decision_tree": DecisionTreeClassifier(maxDepth=3, seed=seed),
        "random_forest": RandomForestClassifier(maxDepth=3, seed=seed),
        "gradient_boosting": GBTClassifier(maxIter=10, seed=seed),
        "naive_bayes": NaiveBayes(modelType="gaussian"),
        "linear_svc": LinearSVC(maxIter=50),
    }


def fit_report(model_of: object, train: DataFrame, test: DataFrame) -> tuple[object, list[tuple[str, float]]]:
    """The fitted model and its accuracy on both parts."""
    model = model_of.fit(train)
    return model, [("train", accuracy(model.transform(train))), ("test", accuracy(model.transform(test)))]


def compare_models(train: DataFrame, test: DataFrame, models: dict[str, object] | None = None) -> DataFrame:
    """Models ranked by the area under the ROC curve."""
    measure, rows = BinaryClassificationEvaluator(metricName="areaUnderROC"), []
    for name, m in (models or classifiers()).items():
        fitted = m.fit(train).transform(test)
        rows.append((name, measure.evaluate(fitted), accuracy(fitted)))
    return train.sparkSession.createDataFrame(rows, "model string, auc double, accuracy double").orderBy(F.desc("auc"), "model")


def random_params(estimator: object, space: dict[str, tuple[int, int]], trials: int, seed: int = 42) -> list[dict]:
    """Seeded random points of an integer space."""
    rnd = random.Random(seed)
    return [{estimator.getParam(n): rnd.randint(*bounds) for n, bounds in space.items()} for _ in range(trials)]


def hyper_search(estimator: object, train: DataFrame, space: dict[str, tuple[int, int]], trials: int = 32, folds: int = 3, seed: int = 42) -> DataFrame:
    """Mean cross-validated accuracy of each trial, best first."""
    grid = random_params(estimator, space, trials, seed)
    measure = MulticlassClassificationEvaluator(metricName="accuracy")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=measure, numFolds=folds, seed=seed, parallelism=4)
    fitted = cv.fit(train)
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(g.items(), key=lambda t: t[0].name)), float(m))
            for i, (g, m) in enumerate(zip(grid, fitted.avgMetrics))]
    return train.sparkSession.createDataFrame(rows, "trial int, params string, accuracy double").orderBy(F.desc("accuracy"), "trial")


def importances(spark, model: object, features: list[str]) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def forest_impute(df: DataFrame, id_col: str, target: str, features: list[str], train_share: float = 0.3, seed: int = 42, trees: int = 100) -> tuple[DataFrame, DataFrame]:
    """(rows with the nulls of ``target`` predicted, r2 and mse on the held-out known rows)."""
    known = assemble(df.filter(F.col(target).isNotNull()), features).withColumn("label", F.col(target))
    cut = F.pmod(stable_number(id_col, seed), F.lit(1000)) < int(train_share * 1000)
    model = RandomForestRegressor(numTrees=trees, seed=seed).fit(known.filter(cut))
    quality = regression_metrics(model.transform(known.filter(~cut)), "label", "prediction")
    missing = assemble(df.filter(F.col(target).isNull()), features)
    guessed = model.transform(missing).select(id_col, F.col("prediction").alias(target))
    return update_from(df, guessed, id_col, target), quality


def vectors(df: DataFrame, column: str, size: int) -> DataFrame:
    """An array column as ML vectors."""
    part = F.transform(F.slice(column, 1, size), lambda x: x.cast("double"))
    return df.withColumn("features", array_to_vector(part))


def scaled(df: DataFrame) -> DataFrame:
    model = StandardScaler(inputCol="features", outputCol="s", withMean=True).fit(df)
    return model.transform(df).drop("features").withColumnRenamed("s", "features")


def cluster_scan(df: DataFrame, ks: range, seed: int = 42, silhouette: bool = False, side: int = 4) -> DataFrame:
    """k, cost (within sum of squares), its change, and optionally the silhouette.  ``side`` fits run side by side, as the
    short jobs of one leave cores idle."""
    measure = ClusteringEvaluator()

    def fitted(k: int) -> tuple[float, float | None]:
        model = KMeans(k=k, seed=seed).fit(df)
        return model.summary.trainingCost, measure.evaluate(model.transform(df)) if silhouette else None

    df.persist()
    try:
        with ThreadPool(side) as pool:
            found = pool.map(inheritable_thread_target(df.sparkSession)(fitted), ks, chunksize=1)
    finally:
        df.unpersist()
    before = [None, *[cost for cost, _ in found]]
    rows = [(k, cost, None if b is None else cost - b, s) for k, b, (cost, s) in zip(ks, before, found)]
    return df.sparkSession.createDataFrame(rows, "k int, cost double, diff double, silhouette double")


def principal_components(df: DataFrame, k: int = 2) -> DataFrame:
    """Centred projection on the first components as arrays."""
    centred = StandardScaler(inputCol="features", outputCol="c", withMean=True, withStd=False).fit(df).transform(df)
    model = PCA(k=k, inputCol="c", outputCol="p").fit(centred)
    return model.transform(centred).withColumn("components", vector_to_array("p")).drop("c", "p")


def save_and_score(train: DataFrame, rows: DataFrame, features: list[str], label: str, path: str) -> DataFrame:
    """Fit, save, load, and score rows: label and probability."""
    steps = [StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc"), VectorAssembler(inputCols=features, outputCol="features"), LogisticRegression()]
    Pipeline(stages=steps).fit(train).write().overwrite().save(path)
    scored = PipelineModel.load(path).transform(rows)
    return scored.withColumn("score", F.array_max(vector_to_array("probability")))


