"""Severity of toxic language by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.base import arrow_type, by_batch, kind, stored

WORD = re.compile(r"[^\W\d_]+")
#: beginnings of words that are features beside whole words, so that inflected forms share them
STEMS = (4, 5, 6, 7, 8)
#: labelled rows of each label that the model is fitted on, in the mean over draws
FIT_PER_LABEL = 4000
#: features must be in this many fitted rows, and this strongly tied to a label (chi-square)
LEAST_ROWS, LEAST_TIE = 4, 12.0
#: uses of words tied to toxic rows from which a toxic row counts as severe
SEVERE_USES = 3
_KEPT_WORDS = 300_000


def features_of(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


@dataclass
class Model:
    """P(grade <= k) = sigmoid(cuts[k] - sum of the weights of the text's features); one weight for all cuts."""

    weights: dict[str, float]
    cuts: np.ndarray
    seen: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """One row per text: the probability of each grade."""
        sums = np.array([self._sum(t) for t in texts], dtype=float).reshape(-1, 1)
        below = 1 / (1 + np.exp(-np.clip(self.cuts - sums, -60, 60)))
        edge = np.ones((len(texts), 1))
        return np.diff(np.hstack([0 * edge, below, edge]), axis=1)

    def _sum(self, text: str | None) -> float:
        if len(self.seen) > _KEPT_WORDS:
            self.seen.clear()
        here: set[str] = set()
        for w in set(words_of(text)):
            known = self.seen.get(w)
            if known is None:
                known = self.seen[w] = tuple(f for f in features_of(w) if f in self.weights)
            here.update(known)
        return sum(self.weights[f] for f in sorted(here))


def tied(sample: DataFrame) -> dict[str, tuple[float, float]]:
    """feature -> (chi-square, log odds) of the features of (toxic, text) that are tied to the 0/1 label.

    Features are counted by Spark; only those that are tied come to the driver.
    """
    each = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = float(max(1, each.get(1, 0))), float(max(1, each.get(0, 0)))

    def rows(batch: pa.RecordBatch) -> dict:
        out = {"toxic": [], "feature": []}
        for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
            here = {f for w in set(words_of(text)) for f in features_of(w)}
            out["feature"].extend(here)
            out["toxic"].extend([label] * len(here))
        return out

    found = sample.select("toxic", "text").mapInArrow(by_batch({"toxic": pa.int32(), "feature": pa.string()}, rows), "toxic int, feature string")
    counts = found.groupBy("feature").agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
    a, b = F.col("a"), F.col("b")
    c, d = n1 - a, n0 - b
    chi = (n1 + n0) * (a * d - b * c) ** 2 / F.greatest(F.lit(1.0), (a + b) * (c + d) * n1 * n0)
    odds = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))
    strong = counts.where(a + b >= LEAST_ROWS).select("feature", chi.alias("chi"), odds.alias("odds")).where(F.col("chi") >= LEAST_TIE)
    return {r["feature"]: (r["chi"], r["odds"]) for r in strong.collect()}


def fit(features: list[list[int]], names: list[str], grades: np.ndarray, weight: np.ndarray, ridge: float = 0.15, steps: int = 400) -> Model:
    """Weights and ordered cuts of least penalised log loss, by gradient steps of adapted length.

    ``features`` has, for each row, the numbers of the ``names`` that are in it.
    """
    n = max(1, len(features))
    rows = np.repeat(np.arange(len(features)), [len(x) for x in features]).astype(np.int64)
    cols = np.array([c for x in features for c in x], dtype=np.int64)
    top = int(grades.max(initial=0))
    share = weight / max(1e-12, weight.sum())
    # unknowns: weights, first cut, logs of the gaps between cuts
    x = np.zeros(len(names) + top)
    if top:
        x[len(names)] = 2.0
    m, v = np.zeros_like(x), np.zeros_like(x)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, steps + 1 if top else 1):
        w, gaps = x[: len(names)], np.exp(x[len(names) + 1 :])
        cuts = x[len(names)] + np.concatenate([[0], np.cumsum(gaps)])
        s = np.bincount(rows, w[cols], minlength=len(features))
        ends = np.concatenate([[-np.inf], cuts, [np.inf]])
        hi, lo = sig(ends[grades + 1] - s), sig(ends[grades] - s)
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = share * hi * (1 - hi) / p, share * lo * (1 - lo) / p
        g = np.zeros_like(x)
        g[: len(names)] = np.bincount(cols, (d_hi - d_lo)[rows], minlength=len(names)) + ridge * w / n
        by_cut = np.bincount(grades, -d_hi, minlength=top + 1)[:top] + np.bincount(grades, d_lo, minlength=top + 1)[1:]
        g[len(names)] = by_cut.sum()
        g[len(names) + 1 :] = gaps * np.cumsum(by_cut[::-1])[::-1][1:]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    cuts = x[len(names)] + np.concatenate([[0], np.cumsum(np.exp(x[len(names) + 1 :]))]) if top else np.zeros(0)
    return Model({f: float(w) for f, w in zip(names, x) if w}, cuts)


def learn(docs: DataFrame, labels: DataFrame, per_label: int = FIT_PER_LABEL) -> Model:
    """A model from (doc_id, text) and (doc_id, toxic): of each label at most about ``per_label`` rows, chosen by a
    hash of the id, and weighted so that both labels keep their share.  These bounded rows are what is broadcast.

    Rows that aren't toxic have grade 0; the others 1, or 2 from ``SEVERE_USES`` uses on of words tied to toxic rows.
    Of the rows, only the numbers of their tied features reach the driver.
    """
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)").distinct()
    counts = marked.groupBy("toxic").agg(F.count("*").alias("rows"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    chosen = marked.join(counts, "toxic").where(draw * F.col("rows") < per_label)
    sample = stored(docs.where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select("toxic", "rows", "text"), "toxicity-sample")
    ties = tied(sample)
    names = sorted(ties)
    place = {f: i for i, f in enumerate(names)}
    bad = {f for f, (_, odds) in ties.items() if odds > 3}

    def rows(batch: pa.RecordBatch) -> dict:
        cols, uses = [], []
        for text in batch.column("text").to_pylist():
            words = Counter(words_of(text))
            here = {w: [f for f in features_of(w) if f in place] for w in words}
            cols.append(sorted({place[f] for found in here.values() for f in found}))
            uses.append(sum(n for w, n in words.items() if not bad.isdisjoint(here[w])))
        return {"toxic": batch.column("toxic"), "rows": batch.column("rows"), "cols": cols, "uses": uses}

    types = {"toxic": pa.int32(), "rows": pa.int64(), "cols": pa.list_(pa.int32()), "uses": pa.int64()}
    found = sample.mapInArrow(by_batch(types, rows), "toxic int, rows bigint, cols array<int>, uses bigint").collect()
    found.sort(key=lambda r: (r["toxic"], r["uses"], r["cols"]))
    toxic, uses = np.array([r["toxic"] for r in found], dtype=np.int64), np.array([r["uses"] for r in found], dtype=np.int64)
    each = np.bincount(toxic, minlength=2)
    weight = np.array([r["rows"] / each[r["toxic"]] for r in found], dtype=float)
    return fit([r["cols"] for r in found], names, np.where(toxic > 0, np.where(uses >= SEVERE_USES, 2, 1), 0), weight)


def score(docs: DataFrame, labels: DataFrame, cutoff: float = 0.4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, p_toxic, severity, grade, toxic of every row: the probability of any grade above 0, the expected
    grade, the most probable grade, and whether ``p_toxic`` is over ``cutoff``.

    ``labels`` has only toxic 0/1, so grades are told apart weakly (see ``learn``); ``fit`` itself takes any ordered grades.
    Null and empty texts have no features and get what the cuts alone say; without labels, or with one label, nothing
    is toxic.  Repeated rows each give their row; rows of ``labels`` that are null, of other values or without a
    document are passed over; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = learn(rows, labels.select(F.col(id_col).alias("doc_id"), "toxic"))
    columns = {"doc_id": arrow_type(rows.schema["doc_id"].dataType), "p_toxic": pa.float64(), "severity": pa.float64(), "grade": pa.int32()}

    def graded(batch: pa.RecordBatch) -> dict:
        p = model.probabilities(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "p_toxic": 1 - p[:, 0], "severity": p @ np.arange(p.shape[1]), "grade": p.argmax(axis=1).astype(np.int32)}

    found = rows.mapInArrow(by_batch(columns, graded), f"doc_id {kind(rows, 'doc_id')}, p_toxic double, severity double, grade int")
    return found.withColumn("toxic", F.col("p_toxic") > cutoff).withColumnRenamed("doc_id", id_col)
