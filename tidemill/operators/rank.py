"""Row numbers that do not send a large table, or a large group, to one task.

A numeric order column is cut into slices at approximate quantiles; text, or an order of several columns, is
partitioned by range.  Rows are numbered inside a slice and shifted by the number of rows in the slices before it, so
the result is exact whatever the cuts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import cut

ROWS_PER_SLICE = 1_000_000
MAX_SLICES = 1024
_SLICE = "__slice"


def _bucket(c: Column, bounds: list, lo: int = 0) -> Column:
    """How many of the sorted bounds are <= c, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(lo)
    mid = len(bounds) // 2
    return F.when(c < F.lit(bounds[mid]), _bucket(c, bounds[:mid], lo)).otherwise(
        _bucket(c, bounds[mid + 1 :], lo + mid + 1)
    )


def with_slices(df: DataFrame, order: str, rows_per_slice: int = ROWS_PER_SLICE) -> tuple[DataFrame, int]:
    """Add the slice number of each row; returns the number of slices too."""
    points = [i / MAX_SLICES for i in range(1, MAX_SLICES)]
    n, cuts = df.agg(F.count(F.lit(1)), F.percentile_approx(order, points, 10_000)).first()
    slices = min(MAX_SLICES, -(-n // rows_per_slice))
    if slices <= 1:
        return df.withColumn(_SLICE, F.lit(0)), 1
    step = MAX_SLICES / slices
    bounds = sorted({cuts[min(len(cuts) - 1, round(i * step) - 1)] for i in range(1, slices)})
    return df.withColumn(_SLICE, _bucket(F.col(order), bounds)), len(bounds) + 1


def _has_quantiles(df: DataFrame, column: str) -> bool:
    return df.select(column).dtypes[0][1].split("(")[0] not in ("string", "boolean", "binary", "char", "varchar")


def ordered_index(df: DataFrame, order: list[str], name: str = "row_index", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the whole table, by order columns of any type.

    Rows are partitioned by the range of all order columns together, so that a value of the first one with most of the
    rows is many partitions, and numbered in their partition.  The numbered rows are written before partitions are
    counted: counts and numbers then speak of the same partitions.
    """
    number = [partitions] if partitions else []
    placed = cut(df.repartitionByRange(*number, *order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()))
    # the id of a row is the number of its partition, shifted by 33 bits, and its place there
    part, place = F.shiftright("__m", 33), F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    starts, total = [], 0
    for p, last in sorted(placed.groupBy(part.alias("p")).agg(F.max(place)).collect()):  # one row per partition
        starts.append((p, total))
        total += last + 1
    before = F.broadcast(df.sparkSession.createDataFrame(starts, "__p bigint, __before bigint"))
    return placed.join(before, part == F.col("__p")).select(*df.columns, (place + F.col("__before")).alias(name))


def rank_in_group(
    df: DataFrame, keys: list[str], order: list[str], name: str = "rank", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """1-based position of each row among the rows with the same keys.

    Together the order columns must be unique inside a group.  A group of any size is split over slices, or over ranges
    if ``order[0]`` is a text.
    """
    if not _has_quantiles(df, order[0]):
        placed = ordered_index(df, [*keys, *order], "__i")
        firsts = placed.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min("__i").alias("__first"))
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        return placed.join(firsts, same).select(*df.columns, (F.col("__i") - F.col("__first") + 1).alias(name))
    sliced, slices = with_slices(df, order[0], rows_per_slice)
    local = F.row_number().over(Window.partitionBy(*keys, _SLICE).orderBy(*order)).cast("long")
    if slices == 1:
        return sliced.withColumn(name, local).drop(_SLICE)
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(*keys, _SLICE)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
            F.col(_SLICE).alias("__s"),
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        )
    )
    on = F.col(_SLICE) == F.col("__s")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = sliced.join(starts, on)
    return joined.withColumn(name, local + F.col("__before")).select(*df.columns, name)


def row_index(df: DataFrame, order: list[str], name: str = "row_index", rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """0-based position of each row in the whole table."""
    if len(order) > 1 or not _has_quantiles(df, order[0]):
        return ordered_index(df, order, name)
    sliced, slices = with_slices(df, order[0], rows_per_slice)
    local = F.row_number().over(Window.partitionBy(_SLICE).orderBy(*order)).cast("long") - 1
    if slices > 1:
        total, start = 0, []
        sizes = {r[0]: r[1] for r in sliced.groupBy(_SLICE).count().collect()}  # at most MAX_SLICES rows
        for s in range(slices):
            start.append(total)
            total += sizes.get(s, 0)
        local = local + F.element_at(F.array(*[F.lit(x) for x in start]), F.col(_SLICE) + 1).cast("long")
    return sliced.withColumn(name, local).drop(_SLICE)


def _grouped_rows(df: DataFrame, keys: list[str], pick, *more: Column) -> DataFrame:
    """One row per key: ``pick`` chooses among the other columns, which travel once."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *more).drop("__n")
    return df.groupBy(*keys).agg(pick(F.struct(*rest)).alias("__row"), *more)


def first_per_key(df: DataFrame, keys: list[str], order: str, last: bool = False) -> DataFrame:
    """The first (or last) row of each key by a unique order column.

    An aggregate with a map-side combine, so a hot key shrinks before the shuffle.
    """
    by = F.max_by if last else F.min_by
    if order in keys:
        return df.dropDuplicates(keys)
    out = _grouped_rows(df, keys, lambda row: by(row, F.col(order)))
    return out.select(*keys, "__row.*").select(*df.columns)


def only_unrepeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs exactly once (keep none of the repeated ones)."""
    out = _grouped_rows(df, keys, F.any_value, F.count(F.lit(1)).alias("__times")).filter("__times = 1")
    return out.select(*keys, *(["__row.*"] if "__row" in out.columns else [])).select(*df.columns)
