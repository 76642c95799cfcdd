"""Exact quantiles with linear interpolation.

The built-in ``percentile`` keeps every distinct value of a group in one task, so
it serves only tables and groups of a checked size.  Beyond it the wanted ranks are found by
histogram passes: each pass counts the values of an interval in bins and goes on
inside the bin that holds the rank.  A pass shuffles bin counts, never rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import cut

SMALL_ROWS = 1_000_000
#: groups that one refinement handles at a time
GROUPS_AT_ONCE = 10_000


def _long(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x")) for i, c in enumerate(columns)])
    keys = F.to_json(F.struct(*by)) if by else F.lit("")
    return df.select(keys.alias("g"), F.explode(pairs).alias("p")).select("g", "p.c", "p.x").filter("x IS NOT NULL")


def _ranks(df: DataFrame, columns: list[str], probs: list[float], by: list[str], bins: int) -> dict:
    """(group, column, prob) -> value, by refinement."""
    spark = df.sparkSession
    long = _long(df, columns, by)
    spans = long.groupBy("g", "c").agg(F.count("x"), F.min("x"), F.max("x")).collect()  # of the groups of one block
    size = {(r[0], r[1]): r[2] for r in spans}
    found: dict[tuple, float] = {}
    todo: dict[tuple, tuple] = {}  # (g, c, rank) -> (lo, hi, rows before lo)
    for g, c, n, lo, hi in spans:
        for p in probs:
            at = (n - 1) * p
            for rank in {int(at), min(n - 1, int(at) + 1)}:
                if lo == hi:
                    found[g, c, rank] = lo
                else:
                    todo[g, c, rank] = (lo, hi, 0)
    schema = "g string, c int, lo double, hi double"
    while todo:
        cells = sorted({(g, c, lo, hi) for (g, c, _), (lo, hi, _) in todo.items()})
        step = max(16, min(bins, 4_000_000 // len(cells)))
        bounds = F.broadcast(spark.createDataFrame(cells, schema))  # at most GROUPS_AT_ONCE x columns x probs rows
        pos = (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * step
        hits = long.join(bounds, ["g", "c"]).filter("x >= lo AND x <= hi")
        rows = (
            hits.groupBy("g", "c", "lo", "hi", F.least(F.floor(pos), F.lit(step - 1)).alias("b"))
            .agg(F.count("x").alias("n"), F.min("x").alias("a"), F.max("x").alias("z"))
            .collect()
        )
        hist: dict[tuple, list] = {}
        for r in rows:
            hist.setdefault((r.g, r.c, r.lo, r.hi), []).append((r.b, r.n, r.a, r.z))
        following = {}
        for (g, c, rank), (lo, hi, before) in todo.items():
            for _, n, a, z in sorted(hist[g, c, lo, hi]):
                if rank < before + n:
                    if a == z:
                        found[g, c, rank] = a
                    else:
                        following[g, c, rank] = (a, z, before)
                    break
                before += n
        todo = following
    out = {}
    for (g, c), n in size.items():
        for p in probs:
            at = (n - 1) * p
            a, b = found[g, c, int(at)], found[g, c, min(n - 1, int(at) + 1)]
            out[g, c, p] = a + (b - a) * (at - int(at))
    return out


def quantile_name(column: str, p: float) -> str:
    return f"{column}_p{round(p * 100):d}"


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    by: list[str] | None = None,
    small_rows: int = SMALL_ROWS,
    bins: int = 4096,
) -> DataFrame:
    """One row (per group) with a column ``<name>_p<percent>`` per column and share.

    Groups of up to ``small_rows`` rows, however many, come from the built-in aggregate; larger ones are refined, in
    blocks of ``GROUPS_AT_ONCE``.
    """
    by = by or []
    if not by:
        return _built_in(df, columns, probs, by) if df.count() <= small_rows else _refined(df, columns, probs, by, bins)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    large = cut(sizes.filter(F.col("__n") > small_rows).select(*by))
    if large.isEmpty():
        return _built_in(df, columns, probs, by)
    same = lambda part: [df[b].eqNullSafe(part[b]) for b in by]
    out = _built_in(df.join(large, same(large), "left_anti"), columns, probs, by)
    blocks = -(-large.count() // GROUPS_AT_ONCE)
    for i in range(blocks):
        part = large.filter(F.pmod(F.xxhash64(*by), F.lit(blocks)) == i) if blocks > 1 else large
        out = out.unionByName(_refined(df.join(part, same(part), "left_semi"), columns, probs, by, bins))
    return out


def _built_in(df: DataFrame, columns: list[str], probs: list[float], by: list[str]) -> DataFrame:
    # all shares of a column from one table of its values
    aggs = [F.percentile(c, list(probs)).alias(f"__{i}") for i, c in enumerate(columns)]
    out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    picked = [F.col(f"__{i}")[j].alias(quantile_name(c, p)) for i, c in enumerate(columns) for j, p in enumerate(probs)]
    return out.select(*by, *picked)


def _refined(df: DataFrame, columns: list[str], probs: list[float], by: list[str], bins: int) -> DataFrame:
    spark = df.sparkSession
    values = _ranks(df, columns, probs, by, bins)
    names = [quantile_name(c, p) for c in columns for p in probs]
    groups = sorted({g for g, _, _ in values}) or [""]
    rows = [(g, *[values.get((g, i, p)) for i in range(len(columns)) for p in probs]) for g in groups]
    fields = [T.StructField("__g", T.StringType())] + [T.StructField(n, T.DoubleType()) for n in names]
    out = spark.createDataFrame(rows, T.StructType(fields))
    if not by:
        return out.drop("__g")
    key = T.StructType([df.schema[b] for b in by])
    return out.withColumn("__k", F.from_json("__g", key)).select("__k.*", *names)


def quantile_values(df: DataFrame, columns: list[str], probs: list[float], **kw) -> dict[str, float]:
    """The table-wide quantiles as numbers: one row, so filters on them reach the scan as literals."""
    return exact_quantiles(df, columns, probs, **kw).first().asDict()
