"""User distances over sparse ratings and recommendations from the nearest user.

A missing rating counts as -1.  With r' = r + 1 the missing ones become 0, so the
distances follow from per-user sums and from the items two users share; no
user x item matrix is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import small


def user_distances(ratings: DataFrame, target: int) -> DataFrame:
    """user_id, euclidean, cosine: distances of every user (the target too) to the target.

    ``ratings`` has one row per user_id and item_id with a rating and is read three times: cut it if it is costly.
    """
    r = ratings.select("user_id", "item_id", (F.col("rating") + 1).alias("r"))
    own_r = F.when(F.col("user_id") == target, F.col("r"))
    items, s0, q0 = r.agg(F.countDistinct("item_id"), F.coalesce(F.sum(own_r), F.lit(0.0)), F.coalesce(F.sum(own_r * own_r), F.lit(0.0))).first()
    own = small(r.filter(F.col("user_id") == target).select("item_id", F.col("r").alias("t")))
    joined = r.join(own, "item_id", "left")
    per = joined.groupBy("user_id").agg(
        F.sum("r").alias("s"),
        F.sum(F.col("r") * F.col("r")).alias("q"),
        F.coalesce(F.sum(F.col("r") * F.col("t")), F.lit(0.0)).alias("d"),
    )
    s, q, d = F.col("s"), F.col("q"), F.col("d")
    dot = d - s - s0 + items
    norms = F.sqrt((q - 2 * s + items) * F.lit(q0 - 2 * s0 + items))
    return per.select(
        "user_id", F.sqrt(F.greatest(q + q0 - 2 * d, F.lit(0.0))).alias("euclidean"), (1 - F.try_divide(dot, norms)).alias("cosine")
    )


def nearest_users(distances: DataFrame, target: int, k: int, measure: str = "euclidean") -> DataFrame:
    """The k nearest other users; ties by id."""
    return distances.filter(F.col("user_id") != target).orderBy(measure, "user_id").limit(k)


def recommend(ratings: DataFrame, target: int, neighbour: int, titles: DataFrame, best: float = 5.0) -> DataFrame:
    """Items the neighbour rated best and the target has not rated, with titles."""
    liked = ratings.filter((F.col("user_id") == neighbour) & (F.col("rating") == best)).select("item_id")
    known = ratings.filter(F.col("user_id") == target).select("item_id")
    return liked.join(known, "item_id", "left_anti").join(titles, "item_id")
