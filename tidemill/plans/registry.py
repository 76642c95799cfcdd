"""Name -> query and name -> SQL."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.session import to_ntz

MODULES = (
    "sources cleaning joins aggregates ordering scalars streams partitions "
    "duplicates shards statistics learning texts protection batches"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(*names: str, sql: str | None = None):
    """Register a query, under several names when they mean the same computation."""

    def wrap(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return to_ntz(fn(spark, sf_dir))

        for name in names:
            if name in QUERIES:
                raise ValueError(f"query {name} is registered twice")
            QUERIES[name] = run
            if sql:
                SQL[name] = sql
        return fn

    return wrap


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"tidemill.plans.{m}")
