"""Exact nearest neighbours in k-d leaves: a row only meets leaves whose box can still beat what it has found."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import cut

#: rows of one group of the comparison
TRAIN_BLOCK, TEST_BLOCK = 20_000, 5_000
#: rows a leaf should have (fewer rows are one leaf), and how many leaves there are at most (their boxes are sent to every task)
LEAF_ROWS, MOST_LEAVES = 20_000, 4_096
#: training rows (in the mean) that the cuts between leaves are taken from; boxes come from all rows
CUT_ROWS = 200_000


@dataclass
class Leaves:
    """A complete binary tree in heap order: a row goes right where its feature is above the cut."""

    depth: int
    feature: np.ndarray
    cut: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        at, row = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[row, self.feature[at]] > self.cut[at])
        return at - (2**self.depth - 1)


def grow(x: np.ndarray, depth: int) -> Leaves:
    """Halve the rows at the median of the widest feature, level by level."""
    feature, cuts = np.zeros(2**depth - 1, dtype=np.int64), np.zeros(2**depth - 1)
    parts = {0: x}
    for node in range(2**depth - 1):
        rows = parts.pop(node)
        if len(rows):
            f = int(np.argmax(rows.max(axis=0) - rows.min(axis=0)))
            feature[node], cuts[node] = f, np.median(rows[:, f])
        right = rows[:, feature[node]] > cuts[node]
        parts[2 * node + 1], parts[2 * node + 2] = rows[~right], rows[right]
    return Leaves(depth, feature, cuts)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(float) if len(column) else np.empty((0, width))


def _with_leaf(df: DataFrame, leaves: Leaves, width: int) -> DataFrame:
    @F.pandas_udf("int")
    def leaf(x: pd.Series) -> pd.Series:
        return pd.Series(leaves.of(_matrix(x, width)))

    return df.withColumn("leaf", leaf("x"))


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    d = np.zeros((len(q), len(x)))
    for f in range(x.shape[1]):
        d += (q[:, f, None] - x[None, :, f]) ** 2
    return d


def _to_boxes(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """At most the squared distance to any row of a box, also after rounding: the steps are those of ``_distances``."""
    d = np.zeros((len(q), len(low)))
    for f in range(low.shape[1]):
        x = q[:, f, None]
        d += np.maximum(np.maximum(low[None, :, f] - x, x - high[None, :, f]), 0) ** 2
    return d


def other_leaves(rows: DataFrame, boxes: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """id, x, leaf: each row with every leaf but its own whose box is not farther than ``reach``, its k-th distance so far."""
    numbers, low, high = boxes

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for start in range(0, len(b), 512):
                piece = b.iloc[start : start + 512]
                q = _matrix(piece["x"], low.shape[1])
                near = _to_boxes(q, low, high) <= piece["reach"].to_numpy()[:, None]
                near &= numbers[None, :] != piece["leaf"].to_numpy()[:, None]
                row, box = np.nonzero(near)
                yield pd.DataFrame({"id": piece["id"].to_numpy()[row], "x": piece["x"].to_numpy()[row], "leaf": numbers[box]})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "x", "leaf", "reach").mapInPandas(meet, f"id {kind}, x array<double>, leaf int")


def _compare(left: DataFrame, right: DataFrame, sizes: dict[int, int], k: int, train_block: int, test_block: int) -> DataFrame:
    """id, tid, y, d: for each row of ``left`` the k best of its leaf, from each block of the leaf.

    A leaf is cut into blocks of training rows and blocks of test rows by its counts, so many equal rows are many groups.
    """
    met = {r["leaf"]: r["count"] for r in left.groupBy("leaf").count().collect()}  # MOST_LEAVES rows at most
    cuts = [(leaf, max(1, -(-sizes[leaf] // train_block)), max(1, -(-n // test_block))) for leaf, n in met.items() if leaf in sizes]
    plan = F.broadcast(left.sparkSession.createDataFrame(cuts, "leaf int, ts int, ss int"))
    own = lambda c, n, salt: F.pmod(F.xxhash64(F.col(c), F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(plan, "leaf").select("id", "x", "leaf", own("id", "ss", 1).alias("s"), every("ts").alias("t"))
    b = right.join(plan, "leaf").select("tid", "x", "y", "leaf", own("tid", "ts", 2).alias("t"), every("ss").alias("s"))

    def best(_, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"id": [], "tid": [], "y": [], "d": []})
        x = _matrix(b["x"], 0)
        q = _matrix(a["x"], x.shape[1])
        ids, tid, y, hits = a["id"].to_numpy(), b["tid"].to_numpy(), b["y"].to_numpy(), []
        kk = min(k, len(x))
        for start in range(0, len(q), 64):
            d = _distances(q[start : start + 64], x)
            edge = np.partition(d, kk - 1, axis=1)[:, kk - 1]
            for i in range(len(d)):
                c = np.nonzero(d[i] <= edge[i])[0]
                c = c[np.lexsort((tid[c], d[i][c]))][:kk]
                hits.append((np.repeat(ids[start + i], kk), tid[c], y[c], d[i][c]))
        return pd.DataFrame({n: np.concatenate([h[j] for h in hits]) for j, n in enumerate(("id", "tid", "y", "d"))})

    kinds = [df.schema[c].dataType.simpleString() for df, c in ((left, "id"), (right, "tid"))]
    keys = ["leaf", "s", "t"]
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(best, f"id {kinds[0]}, tid {kinds[1]}, y double, d double")


def nearest(train: DataFrame, test: DataFrame, features: list[str], label: str, id_col: str, k: int,
            train_block: int = TRAIN_BLOCK, test_block: int = TEST_BLOCK, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The k nearest training rows of every test row: id, rank, label, distance (ties by training id).  Exact.

    Training rows fall into the leaves of a k-d tree.  A test row first meets its own leaf; what it finds there bounds
    how far away a leaf may be, by the box around all rows of that leaf, to be worth a second look.  With few features
    that leaves few; with many features most boxes stay near, and the work is that of all pairs.
    """
    vector = F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    points = cut(train.select(F.col(id_col).alias("tid"), vector, F.col(label).cast("double").alias("y")))
    total = points.count()
    depth = int(np.ceil(np.log2(min(MOST_LEAVES, max(1, total / min(leaf_rows, train_block))))))
    width = len(features)
    asked = test.select(F.col(id_col).alias("id"), vector)
    w = Window.partitionBy("id").orderBy("d", "tid")  # k rows per block that a test row met
    ranked = lambda found: found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    answer = lambda out: out.select(F.col("id").alias(id_col), "rank", F.col("y").alias("label"), F.sqrt("d").alias("distance"))
    if not depth:
        alone = lambda df: df.withColumn("leaf", F.lit(0))
        return answer(ranked(_compare(alone(asked), alone(points), {0: total}, k, train_block, test_block)))
    every = max(1, total // CUT_ROWS)
    some = points.where(F.pmod(F.xxhash64("tid", F.lit("cuts")), F.lit(every)) == 0).select("x").toPandas()["x"]
    leaves = grow(_matrix(some, width), depth)
    right, left = _with_leaf(points, leaves, width), cut(_with_leaf(asked, leaves, width))
    ends = [a(F.get("x", F.lit(f))).alias(f"{n}{f}") for n, a in (("low", F.min), ("high", F.max)) for f in range(width)]
    rows = right.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), *ends).collect()  # MOST_LEAVES rows at most
    sizes = {r["leaf"]: r["n"] for r in rows}
    side = lambda n: np.array([[r[f"{n}{f}"] for f in range(width)] for r in rows]).reshape(-1, width)
    boxes = (np.array([r["leaf"] for r in rows], dtype=np.int32), side("low"), side("high"))
    out = cut(ranked(_compare(left, right, sizes, k, train_block, test_block)).drop("rank"))
    far = out.groupBy("id").agg(F.when(F.count(F.lit(1)) == k, F.max("d")).alias("far"))
    reach = left.join(far, "id", "left").withColumn("reach", F.coalesce("far", F.lit(float("inf"))))
    more = cut(other_leaves(reach, boxes))
    return answer(ranked(out.unionByName(_compare(more, right, sizes, k, train_block, test_block))))
