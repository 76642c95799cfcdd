"""How the words of the sources of a language differ, from run-length coded columns of counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.base import give_back, stored
from tidemill.llm.encode import slices

SCALE, SMOOTH = 1_000_000_000, 5
#: what separates terms: every ASCII character that is no letter
BETWEEN = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: numbers of the columns of counts that one task holds
CELLS = 200_000


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of each term in rows of (lang, source, text).

    Terms are summed for some megabytes of text at a time and then by Spark before and after the shuffle, so a frequent
    term or a large source is a few rows of every task.
    """
    names = ["lang", "source", "term", "n", "docs"]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], names=["lang", "source"])
            at = 0
            for texts in slices(batch.column("text")):
                words = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(texts), BETWEEN, " "))
                size = np.diff(words.offsets.to_numpy())
                coded = words.flatten().dictionary_encode()
                which = coded.indices.to_numpy()
                row = np.repeat(np.arange(len(texts)), size)
                filled = np.array([len(w) > 0 for w in coded.dictionary.to_pylist()], dtype=bool)
                width = max(1, len(filled))
                cell, n = np.unique((row * width + which)[filled[which]], return_counts=True)
                lang, source = (batch.column(c).slice(at, len(texts)).dictionary_encode() for c in ("lang", "source"))
                group = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
                first = np.zeros(int(group.max(initial=0)) + 1, dtype=np.int64)
                first[group] = np.arange(len(texts))
                both, where = np.unique(group[cell // width] * width + cell % width, return_inverse=True)
                sums = np.bincount(where, weights=n, minlength=len(both)).astype(np.int64)
                held = np.bincount(where, minlength=len(both)).astype(np.int64)
                of = keys.slice(at, len(texts)).take(pa.array(first[both // width]))
                term = coded.dictionary.take(pa.array(both % width))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([of.field(0), of.field(1), term, pa.array(sums), pa.array(held)], names=names)
        give_back()

    rows = docs.mapInArrow(tally, "lang string, source string, term string, n bigint, docs bigint")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


SHARE = f"1 + CAST({{n}} + {SMOOTH} AS DECIMAL(28, 0)) * {SCALE} div CAST({{total}} + {SMOOTH} * terms AS DECIMAL(28, 0))"


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The smoothed share of each count in billionths; beyond 64 bits in whole numbers of any size."""
    wide = counts if counts.max(initial=0) < (1 << 62) // SCALE else counts.astype(object)
    return (1 + (wide + SMOOTH) * SCALE // (total + SMOOTH * terms)).astype(np.int64)


def runs_of(columns: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Run-length code of each row of counts after the vocabulary is put in an order that keeps equal counts together:
    where each run begins, and its count.  Rows with few different counts are the first in the order, so that
    they have few runs and the others have runs inside theirs."""
    variety = [len(np.unique(c)) for c in columns]
    order = np.lexsort([columns[i] for i in np.argsort(variety, kind="stable")[::-1]])
    columns = columns[:, order]
    starts = [np.concatenate([[0], np.flatnonzero(c[1:] != c[:-1]) + 1]) for c in columns]
    return starts, [c[at] for c, at in zip(columns, starts)]


def apart(rows: pa.Table, heads: pa.Table) -> pa.Table:
    """lang, a, b, value of every two sources of a language: the sum of |p - q| over the terms of one block."""
    source = heads.column("source").combine_chunks()
    total, terms = heads.column("total").to_numpy(), int(heads.column("terms")[0].as_py()) if len(heads) else 0
    n_sources, value = len(source), {}
    if len(rows):
        term = rows.column("term").combine_chunks().dictionary_encode()
        columns = np.zeros((n_sources, len(term.dictionary)), dtype=np.int64)
        columns[pc.index_in(rows.column("source").combine_chunks(), source).to_numpy(), term.indices.to_numpy()] = rows.column("n").to_numpy()
        starts, counts = runs_of(columns)
        p = [shares(c, int(t), terms) for c, t in zip(counts, total)]
        for i in range(n_sources):
            for j in range(i + 1, n_sources):
                cuts = np.union1d(starts[i], starts[j])
                length = np.diff(np.append(cuts, columns.shape[1]))
                f = np.abs(p[i][np.searchsorted(starts[i], cuts, "right") - 1] - p[j][np.searchsorted(starts[j], cuts, "right") - 1])
                value[i, j] = int((f * length).sum())
    i, j = np.triu_indices(n_sources, 1)
    lang = heads.column("lang").combine_chunks()
    values = [value.get(pair, 0) for pair in zip(i.tolist(), j.tolist())]
    return pa.table({"lang": lang.take(pa.array(i)), "a": source.take(pa.array(i)), "b": source.take(pa.array(j)), "value": pa.array(values, type=pa.int64())})


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank: how far the sources of a language are apart (``pair``), and the terms that
    each uses more than its language (``term``, the first ``top``).

    A language keeps the terms in at least ``least_docs`` of its rows.  A term's share in a group is
    1 + floor(10^9 * (count + 5) / (all counts + 5 * terms)), in whole numbers.  For pairs, a language's terms are dealt
    to blocks by hash, so that a block has about ``CELLS`` counts; there the columns of counts are run-length coded, and for
    two sources the runs are intersected: one difference for all terms between two cuts.  Sums per block and pair are
    added up by Spark.  The terms of a group are ranked by a window that keeps ``top`` rows before the shuffle.

    Null language, source and text count as ''.  Groups without terms give their pairs; a language that keeps no term
    has pairs of value 0; one with a single source has no pair.  Each row is a document, repeated rows too; an empty
    table gives an empty one; texts are read whole; other columns are not read.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    groups = stored(rows.select("lang", "source").distinct(), "divergence-groups")
    counts = stored(term_counts(rows), "divergence-counts")
    vocabulary = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).where(F.col("docs") >= least_docs).drop("docs")
    kept = stored(counts.drop("docs").join(vocabulary, ["lang", "term"]), "divergence-kept")
    sums = stored(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), "divergence-sums")
    terms = kept.groupBy("lang").agg(F.count_distinct("term").alias("terms"), F.sum("n").alias("lang_total"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(terms, "lang", "left").fillna(0, ["terms", "lang_total"])
    langs = stored(langs.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / CELLS)).cast("int")), "divergence-langs")
    heads = stored(groups.join(sums, ["lang", "source"], "left").fillna(0, ["total"]).join(langs, "lang"), "divergence-heads")

    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    columns = kept.join(langs.select("lang", "blocks"), "lang").select("lang", block.alias("block"), "source", "term", "n")
    everywhere = heads.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", "total", "terms")
    parts = columns.groupBy("lang", "block").cogroup(everywhere.groupBy("lang", "block")).applyInArrow(apart, "lang string, a string, b string, value bigint")
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).select("lang", sides.alias("s"), "value").select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")

    shares_of = kept.join(heads.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    p, q = F.expr(SHARE.format(n="n", total="total")), F.expr(SHARE.format(n="all", total="lang_total"))
    more = shares_of.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")

    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).alias("rank")
    first = more.select("*", rank).where(F.col("rank") <= top)
    return pairs.select("*", rank).unionByName(first)
