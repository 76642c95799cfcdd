"""Profiles, histograms, correlations, outliers, tests."""

from __future__ import annotations

import itertools
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.aggregate import describe
from tidemill.operators.quantiles import exact_quantiles, quantile_values

NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in NUMERIC]


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, nulls, distinct values, commonest value, numeric statistics.

    Values are counted per column first (combined before the shuffle), so distinct
    counts and the commonest value come from one aggregate.
    """
    types = dict(df.dtypes)
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in df.columns])
    per = df.select(F.explode(cells).alias("c")).groupBy("c.column_name", "c.v").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("n").alias("n"), F.col("v").alias("v"))
    base = per.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("v").alias("n_distinct"),
        F.max(F.when(F.col("v").isNotNull(), order))["v"].alias("top_value"),
        F.max(F.when(F.col("v").isNotNull(), F.col("n"))).alias("top_count"),
    )
    kinds = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c])])
    base = base.withColumn("type", kinds[F.col("column_name")])
    numbers = numeric_columns(df)
    if not numbers:
        return base
    return base.join(describe(df, numbers).drop("count"), "column_name", "left")  # one row per column on both sides


def span(df: DataFrame, column: str) -> tuple[float, float]:
    return df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()


def bin_number(c: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin from 0; the last bin holds the greatest value."""
    if high == low:
        return F.lit(0).cast("long")
    return F.least(F.floor((c - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("long")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """bin, low, high, n for the bins that hold values."""
    low, high = span(df, column)
    width = (high - low) / bins
    b = bin_number(F.col(column), low, high, bins).alias("bin")
    out = df.filter(F.col(column).isNotNull()).groupBy(b).agg(F.count(F.lit(1)).alias("n"))
    return out.select("bin", (F.lit(low) + F.col("bin") * width).alias("low"), (F.lit(low) + (F.col("bin") + 1) * width).alias("high"), "n")


def histogram_density(df: DataFrame, column: str, by: str, bins: int = 10) -> DataFrame:
    """Per class: counts in common bins and densities that integrate to 1 within the class."""
    low, high = span(df, column)
    width = (high - low) / bins
    b = bin_number(F.col(column), low, high, bins).alias("bin")
    kept = df.filter(F.col(column).isNotNull())
    per = kept.groupBy(by, b).agg(F.count(F.lit(1)).alias("n"))
    size = per.groupBy(by).agg(F.sum("n").alias("n_class"))  # from the counts, not from the rows
    return per.join(size, by).select(by, "bin", "n", (F.col("n") / (F.col("n_class") * width)).alias("density"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson coefficients of all pairs from one pass, long layout, both directions."""
    pairs = list(itertools.combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    rows += [F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), F.col(f"{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    rows += [F.struct(F.lit(c).alias("x"), F.lit(c).alias("y"), F.lit(1.0).alias("r")) for c in columns]
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def correlations_with(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    wide = df.agg(*[F.corr(c, target).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "r")


def boxplot(df: DataFrame, columns: list[str], reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest values within reach x IQR) and outliers per column."""
    q = quantile_values(df, columns, [0.25, 0.5, 0.75])
    rows = []
    aggs = []
    for c in columns:
        low, high = fences(q, c, reach)
        inside = F.col(c).between(low, high)
        aggs += [
            F.min(F.when(inside, F.col(c))).cast("double").alias(f"{c}__lo"), F.max(F.when(inside, F.col(c))).cast("double").alias(f"{c}__hi"),
            F.count_if(~inside).alias(f"{c}__n"),
        ]
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(q[f"{c}_p25"]).alias("q1"), F.lit(q[f"{c}_p50"]).alias("median"), F.lit(q[f"{c}_p75"]).alias("q3"),
            F.col(f"{c}__lo").alias("whisker_low"), F.col(f"{c}__hi").alias("whisker_high"), F.col(f"{c}__n").alias("outliers"),
        ))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def fences(q: dict, column: str, reach: float = 1.5) -> tuple[float, float]:
    q1, q3 = q[f"{column}_p25"], q[f"{column}_p75"]
    return q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)


def outlier_flags(df: DataFrame, columns: list[str], reach: float = 1.5) -> DataFrame:
    """A boolean ``<column>_outlier`` per column."""
    q = quantile_values(df, columns, [0.25, 0.75])
    for c in columns:
        low, high = fences(q, c, reach)
        df = df.withColumn(f"{c}_outlier", (F.col(c) < low) | (F.col(c) > high))
    return df


def drop_outliers(df: DataFrame, columns: list[str], reach: float = 1.5) -> DataFrame:
    """Rows without an outlier in any of the columns."""
    out = outlier_flags(df, columns, reach)
    for c in columns:
        out = out.filter(~F.coalesce(F.col(f"{c}_outlier"), F.lit(False))).drop(f"{c}_outlier")
    return out


def ztest(df: DataFrame, column: str, by: str, first: str, second: str, alpha: float = 0.05) -> DataFrame:
    """Two-sample z test with pooled variance: z, two-sided p, decision."""
    g = df.filter(F.col(by).isin(first, second)).groupBy(by).agg(
        F.count(column).alias("n"), F.avg(column).alias("m"), F.var_samp(column).alias("v")
    )
    pick = lambda who, c: F.max(F.when(F.col(by) == who, F.col(c)))
    s = g.agg(*[pick(w, c).alias(f"{c}{i}") for i, w in enumerate((first, second)) for c in ("n", "m", "v")])  # two rows in
    pooled = ((F.col("n0") - 1) * F.col("v0") + (F.col("n1") - 1) * F.col("v1")) / (F.col("n0") + F.col("n1") - 2)
    z = (F.col("m0") - F.col("m1")) / F.sqrt(pooled * (1 / F.col("n0") + 1 / F.col("n1")))

    @F.pandas_udf("double")
    def two_sided(x: pd.Series) -> pd.Series:
        return x.map(lambda v: math.erfc(abs(v) / math.sqrt(2)))

    out = s.select(z.alias("z")).withColumn("p", two_sided("z"))
    return out.withColumn("reject", F.col("p") < alpha)


def series_stats(df: DataFrame, column: str) -> DataFrame:
    mid = exact_quantiles(df, [column], [0.5]).first()[0]
    return df.agg(F.avg(column).alias("mean"), F.lit(mid).alias("median"), F.stddev_samp(column).alias("std"))
