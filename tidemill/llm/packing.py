"""Best-fit packing of token sequences under several capacities."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.base import arrow_type, by_batch, kind, stored, two
from tidemill.llm.encode import encoder_of


def token_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, part, nth: every document's ids with ``end_id`` behind them, cut
    into pieces of ``size`` ids; the last may be shorter.  ``nth`` counts the pieces of one length within the part.

    A null text counts as empty, so it is one piece that holds ``end_id`` alone.
    """
    id_type = docs.schema[id_col].dataType
    end = np.array([end_id], dtype="<u4").tobytes()
    columns = {
        "doc_id": arrow_type(id_type), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
        "part": pa.int32(), "nth": pa.int64(),
    }

    def cut(batches):
        encoder, part, seen = encoder_of(tokenizer), TaskContext.get().partitionId(), Counter()

        def rows(batch: pa.RecordBatch) -> dict:
            out = {c: [] for c in columns}
            which = []
            for i, ids in enumerate(encoder.encode(batch.column("text"))):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    raw = ids[at : at + 4 * size]
                    n = len(raw) // 4
                    which.append(i)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(n)
                    out["ids_crc32"].append(zlib.crc32(raw))
                    out["nth"].append(seen[n])
                    seen[n] += 1
            out["part"] = [part] * len(which)
            out["doc_id"] = batch.column("doc_id").take(pa.array(which, type=pa.int64()))
            return out

        return by_batch(columns, rows)(batches)

    schema = f"doc_id {kind(docs, id_col)}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
    return two(docs, id_col, text_col).mapInArrow(cut, schema)


def plan_bins(
    counts: dict[int, int], tokens: int, documents: int, attention: int, measure: str = "norm", weights: tuple[float, float, float] = (1.0, 0.0, 0.0)
) -> list[tuple[int, int, int, int, int, int]]:
    """Vector best fit, decreasing, over how many pieces there are of each length.

    A piece of n tokens takes the vector (n, 1, n * n) of a bin's (tokens, documents, attention).  It goes to the
    open bin that can still hold it and scores best: ``norm`` takes the least weighted norm of what is left, ``dot``
    the largest weighted dot product of the piece with what is left, both as shares of the capacities; ties go
    to the bin opened first.  Pieces of one length are alike and so are bins of one history, so whole groups are
    placed at a time: work and memory follow the number of lengths, not of pieces.

    Gives runs (length, first, n, per_bin, bin, offset): pieces first .. first + n - 1 of that length fill the bins
    from ``bin`` on, ``per_bin`` each, from ``offset`` on.
    """
    if max(counts, default=0) > tokens or any(n * n > attention for n in counts) or documents < 1:
        raise ValueError("a piece is larger than a bin")
    caps, w = np.array([tokens, documents, attention], dtype=float), np.array(weights, dtype=float)
    left = np.zeros((0, 3))
    first_bin, bins = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    opened, runs = 0, []

    def room(rest: np.ndarray, n: int) -> np.ndarray:
        return np.minimum(np.minimum(rest[..., 0] // n, rest[..., 1]), rest[..., 2] // (n * n)).astype(np.int64)

    for n in sorted(counts, reverse=True):
        piece, at, todo = np.array([n, 1, n * n], dtype=float), 0, counts[n]
        while todo:
            fits = np.flatnonzero(room(left, n) > 0)
            if not len(fits):
                each = int(room(caps, n))
                need = -(-todo // each)
                left, first_bin, bins = np.vstack([left, caps]), np.append(first_bin, opened), np.append(bins, need)
                opened += need
                continue
            rest = left[fits] / caps
            score = ((w * (rest - piece / caps)) ** 2).sum(axis=1) if measure == "norm" else -(w * rest * (piece / caps)).sum(axis=1)
            best = int(fits[np.lexsort((first_bin[fits], score))[0]])
            each = int(room(left[best], n))
            full = min(int(bins[best]), todo // each)
            parts = [(full, each)] if full else []
            if full < bins[best] and todo - full * each:
                parts.append((1, todo - full * each))
            start, offset, old = int(first_bin[best]), int(tokens - left[best, 0]), left[best].copy()
            keep = int(bins[best]) - sum(b for b, _ in parts)
            new_left, new_first, new_bins = [], [], []
            for b, k in parts:
                runs.append((n, at, b * k, k, start, offset))
                at, todo = at + b * k, todo - b * k
                new_left.append(old - k * piece)
                new_first.append(start)
                new_bins.append(b)
                start += b
            if keep:
                new_left.append(old)
                new_first.append(start)
                new_bins.append(keep)
            left = np.vstack([np.delete(left, best, axis=0), np.array(new_left)])
            first_bin, bins = np.append(np.delete(first_bin, best), new_first), np.append(np.delete(bins, best), new_bins)
            alive = (left[:, 0] > 0) & (left[:, 1] > 0) & (left[:, 2] > 0)
            left, first_bin, bins = left[alive], first_bin[alive], bins[alive]
    return runs


def pack(
    pieces: DataFrame, tokens: int, documents: int | None = None, attention: int | None = None, measure: str = "norm", weights=(1.0, 0.0, 0.0)
) -> DataFrame:
    """``pieces`` of ``token_pieces`` with sequence_id and offset: their sequence and their place there.

    The pieces are written once.  Only how many there are of each length reaches the driver (``tokens`` rows at
    most), the bins are planned from that, and each piece finds its bin by its rank among the pieces of its length:
    the number before its part (a sum over parts) plus the number before it in the part.  So one length that holds
    a third of all pieces is no one task's work, and no part leaves a half-filled bin of its own.
    """
    documents, attention = documents or tokens, attention or tokens * tokens
    pieces = stored(pieces, "pieces")
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(sorted(plan_bins(totals, tokens, documents, attention, measure, weights)), dtype=np.int64).reshape(-1, 6)
    shift = np.int64(1 << 44)
    keys = runs[:, 0] * shift + runs[:, 1]
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = pieces.join(before.drop("n"), ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    columns = {f.name: arrow_type(f.dataType) for f in ranked.schema.fields if f.name != "rank"} | {"sequence_id": pa.int64(), "offset": pa.int64()}

    def place(batch: pa.RecordBatch) -> dict:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        run = runs[np.searchsorted(keys, length * shift + rank, side="right") - 1]
        nth = rank - run[:, 1]
        out = {c: batch.column(c) for c in columns if c in batch.schema.names}
        return out | {"sequence_id": run[:, 4] + nth // run[:, 3], "offset": run[:, 5] + nth % run[:, 3] * length}

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.drop("rank").schema.fields) + ", sequence_id bigint, offset bigint"
    return ranked.mapInArrow(by_batch(columns, place), schema)
