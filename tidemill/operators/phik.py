"""Correlation of columns of mixed kinds from their contingency tables.

Spark counts the tables.  The chi-square of a pair (less what independence alone
would give) is then turned into the correlation of a bivariate normal that would
have the same chi-square on the same margins; that is arithmetic on a table of
bins x bins numbers.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.stats import bin_number, span

MAX_VALUES = 200
_erf = np.vectorize(math.erf)


def _cdf(x):
    return 0.5 * (1 + _erf(np.clip(x, -12, 12) / math.sqrt(2)))


def _quantile(p: float) -> float:
    low, high = -12.0, 12.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if 0.5 * (1 + math.erf(mid / math.sqrt(2))) < p else (low, mid)
    return (low + high) / 2


def _cells(rho: float, rows: np.ndarray, cols: np.ndarray, points: int = 24) -> np.ndarray:
    """Probabilities of the rectangles between normal quantiles of the two margins."""
    edge = lambda m: np.array([-8.5] + [_quantile(p) for p in np.cumsum(m)[:-1]] + [8.5])
    a, b = edge(rows), edge(cols)
    node, weight = np.polynomial.legendre.leggauss(points)
    s = math.sqrt(max(1e-12, 1 - rho * rho))
    out = np.empty((len(rows), len(cols)))
    for i in range(len(rows)):
        # the outer bins are long, so they are cut into pieces of at most half a unit
        cuts = np.linspace(a[i], a[i + 1], max(2, int((a[i + 1] - a[i]) / 0.5) + 2))
        half = np.diff(cuts) / 2
        x = (half[:, None] * node + (cuts[:-1] + half)[:, None]).ravel()
        w = (half[:, None] * weight).ravel() * np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
        inner = _cdf((b[None, :] - rho * x[:, None]) / s)
        out[i] = w @ np.diff(inner, axis=1)
    return np.clip(out, 1e-300, None)


def phik_from_counts(counts: np.ndarray) -> float:
    """Correlation in [0, 1] of one contingency table."""
    counts = counts[counts.sum(1) > 0][:, counts.sum(0) > 0]
    if min(counts.shape) < 2:
        return 0.0
    n = counts.sum()
    rows, cols = counts.sum(1) / n, counts.sum(0) / n
    expected = n * np.outer(rows, cols)
    chi2 = float(((counts - expected) ** 2 / expected).sum())
    free = (len(rows) - 1) * (len(cols) - 1)
    filled = min(counts.size, n)
    free_effective = max(0.0, free - (counts.size - filled))
    noise = free_effective + 1.5 * math.sqrt(2 * free_effective)
    signal = chi2 - noise
    if signal <= 0:
        return 0.0
    flat = np.outer(rows, cols)
    top = n * min(len(rows) - 1, len(cols) - 1)

    def normal_chi2(rho: float) -> float:
        return n * float(((_cells(rho, rows, cols) - flat) ** 2 / flat).sum())

    limit = normal_chi2(0.9999)
    scale = limit / (top - noise) if top > noise else 1.0
    wanted = min(signal * scale, limit) if signal < top - noise else limit
    low, high = 0.0, 0.9999
    if wanted >= limit:
        return 1.0
    for _ in range(40):
        mid = (low + high) / 2
        low, high = (mid, high) if normal_chi2(mid) < wanted else (low, mid)
    return (low + high) / 2


def phik_matrix(df: DataFrame, interval: list[str], bins: int = 10) -> DataFrame:
    """x, y, phik for all pairs of columns; ``interval`` columns are cut into equal bins.

    All pair tables come from one aggregate: at most bins x bins numbers per pair.
    """
    cells = df
    for c in interval:
        low, high = span(df, c)
        cells = cells.withColumn(c, bin_number(F.col(c), low, high, bins))
    cells = cells.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    wide = cells.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    broad = [c for c, k in wide.items() if k > MAX_VALUES]
    if broad:
        raise ValueError(f"columns with more than {MAX_VALUES} values: {broad}")
    pairs = list(itertools.combinations(df.columns, 2))
    entry = lambda i, a, b: F.struct(F.lit(i).alias("pair"), F.col(a).alias("u"), F.col(b).alias("v"))
    long = cells.select(F.explode(F.array(*[entry(i, a, b) for i, (a, b) in enumerate(pairs)])).alias("p")).select("p.*")
    rows = long.filter("u IS NOT NULL AND v IS NOT NULL").groupBy("pair", "u", "v").count().collect()  # bounded by MAX_VALUES^2 per pair
    result = []
    for i, (a, b) in enumerate(pairs):
        mine = [r for r in rows if r["pair"] == i]
        order = lambda names: {v: k for k, v in enumerate(sorted(names, key=lambda s: (len(s), s)))}
        us, vs = order({r["u"] for r in mine}), order({r["v"] for r in mine})
        m = np.zeros((len(us), len(vs)))
        for r in mine:
            m[us[r["u"]], vs[r["v"]]] = r["count"]
        result += [(a, b, phik_from_counts(m)), (b, a, phik_from_counts(m))]
    result += [(c, c, 1.0) for c in df.columns]
    return df.sparkSession.createDataFrame(result, "x string, y string, phik double")
