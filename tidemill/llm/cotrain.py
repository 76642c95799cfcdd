"""Document quality by co-training of a text view and a page-metadata view."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType

from tidemill.llm.base import arrow_columns, by_batch, more_columns, stored, with_row
from tidemill.session import small

#: labelled rows that the views are fitted on, in the mean over draws
FIT_LABELLED = 12_000
ROUNDS = 5
#: how sure a view must be of a pseudo-label
SURE = 0.97
#: how many labelled rows the pseudo-labels of one kind weigh together at most, if fewer rows are labelled; all are used
GIVEN_WEIGHT = 2_000
#: columns that the values of one metadata field are hashed to
BUCKETS = 64
_LETTER = np.array([chr(c).isalpha() or c >= 128 for c in range(256)])
_CLASSES = {
    "upper": np.array([65 <= c <= 90 for c in range(256)]),
    "digit": np.array([48 <= c <= 57 for c in range(256)]),
    "space": np.array([c in b" \t\r\x0b\x0c" for c in range(256)]),
    "line": np.array([c == 10 for c in range(256)]),
    "stop": np.array([c in b".,;:" for c in range(256)]),
    "bang": np.array([c in b"!?" for c in range(256)]),
    "brace": np.array([c in b"<>{}[]|\\/" for c in range(256)]),
    "sign": np.array([c in b"#$%&*+=@^_~`" for c in range(256)]),
    "odd": np.array([c < 32 and c not in b"\t\n\r\x0b\x0c" for c in range(256)]),
    "letter": _LETTER,
}
TEXT_FEATURES = len(_CLASSES) + 11


def text_features(text: bytes | None) -> list[float]:
    """What can be said of a whole text without its meaning: shares of character classes, words and repetition."""
    text = text or b""
    n = max(1, len(text))
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    out = [float(counts[m].sum()) / n for m in _CLASSES.values()]
    share = counts[counts > 0] / n
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    m = max(1, len(words))
    distinct = set(words)
    ends = np.bincount(np.fromiter((w[-1] for w in words), dtype=np.uint8, count=len(words)), minlength=256)
    same = sum(map(bytes.__eq__, words, words[1:]))
    marked = m - ends[_LETTER].sum() if words else 0
    return out + [
        float(-(share * np.log2(share)).sum()),
        np.log1p(len(words)),
        sum(map(len, words)) / m,
        len(distinct) / m,
        len(distinct) / m**0.7,
        same / m,
        float(marked) / m,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(m / max(1, len(lines))),
        zlib_share(text),
        max(map(len, words), default=0) ** 0.5,
    ]


def zlib_share(text: bytes, block: int = 1 << 15) -> float:
    """Compressed size against size, over the whole text in blocks."""
    return sum(len(zlib.compress(text[i : i + block], 1)) for i in range(0, len(text), block)) / max(1, len(text))


@dataclass
class Logistic:
    """Ridge logistic regression on standardised columns, fitted by Newton steps."""

    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 25) -> "Logistic":
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        out = Logistic(mean, scale, np.zeros(x.shape[1] + 1))
        for _ in range(steps):
            if out.move(*out.sums(x, y, np.ones(len(y))), ridge) < 1e-6:
                break
        return out

    def sums(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What weighted rows add to the curvature and to the slope of the likelihood."""
        z = np.hstack([np.clip((x - self.mean) / self.scale, -6, 6), np.ones((len(x), 1))])
        p = 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))
        return (z.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ z, z.T @ (weight * (y - p))

    def move(self, curvature: np.ndarray, slope: np.ndarray, ridge: float) -> float:
        """A Newton step; gives its length."""
        keep = np.r_[np.full(len(self.beta) - 1, ridge), 1e-6]
        step = np.linalg.solve(curvature + np.diag(keep), slope - keep * self.beta)
        self.beta = self.beta + step
        return float(np.abs(step).max())

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.clip(z @ self.beta[:-1] + self.beta[-1], -30, 30)


def widened(x: np.ndarray) -> np.ndarray:
    """Columns with their squares, so that a view can prefer a middle."""
    return np.hstack([x, x * x])


def metadata_columns(meta: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Hashed indicators of each field but the last, which is a number with a missing mark."""
    n, fields = len(meta), meta.shape[1] - 1
    out = np.zeros((n, fields * buckets + 3))
    for j in range(fields):
        out[np.arange(n), j * buckets + meta[:, j].astype(int) % buckets] = 1
    size = meta[:, -1]
    out[:, -3] = np.isnan(size)
    size = np.log1p(np.maximum(np.nan_to_num(size), 0))
    out[:, -2], out[:, -1] = size, size * size
    return out


@dataclass
class Model:
    text: Logistic
    meta: Logistic
    #: calibration of each view (slope, shift) and of both together (weights of the two log odds, shift)
    calibration: list[Logistic]
    both: Logistic
    rounds: list[tuple[int, int]]

    def probabilities(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sig = lambda z: 1 / (1 + np.exp(-z))
        logits = [v.logit(f(x)) for v, f, x in ((self.text, widened, text), (self.meta, metadata_columns, meta))]
        own = [c.logit(x[:, None]) for c, x in zip(self.calibration, logits)]
        return sig(own[0]), sig(own[1]), sig(self.both.logit(np.stack(own, axis=1)))


#: adds up what a function of (text columns, metadata columns) gives for all rows of the pool; None for a pool without rows
Total = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray]], "np.ndarray | None"]
History = list[list[Logistic]]


def _views(text: np.ndarray, meta: np.ndarray) -> list[np.ndarray]:
    return [widened(text), metadata_columns(meta)]


def _given(views: list[np.ndarray], history: History) -> list[np.ndarray]:
    """For each view the label that the other one gives each row: the first it was sure of in the rounds so far, or -1."""
    edge, out = np.log(SURE / (1 - SURE)), []
    for v in (0, 1):
        label = np.full(len(views[v]), -1)
        for model in history[1 - v]:
            z = model.logit(views[1 - v])
            label = np.where((label < 0) & (np.abs(z) > edge), z > 0, label)
        out.append(label)
    return out


def _moments(x: np.ndarray, label: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Of the rows of either label: their number, and the sums of the columns and of their squares about ``centre``."""
    out = []
    for k in (0, 1):
        d = x[label == k] - centre
        out.append(np.r_[len(d), d.sum(axis=0), (d * d).sum(axis=0)])
    return np.stack(out)


def _refit(views: list[np.ndarray], y: np.ndarray, history: History, total: Total, before: tuple | None, ridge: float, steps: int = 25) -> tuple[tuple, list[Logistic]] | None:
    """Both views, fitted on the labelled rows and on every pool row that the other view was sure of.

    The given rows of a label weigh one each, or all less if that is more than ``GIVEN_WEIGHT`` and than the labelled ones.  The pool is read once for its
    means and once for each Newton step, and gives sums only.  None if no view has more rows than ``before``.
    """
    centre = [h[-1].mean for h in history]

    def moments(text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        pool = _views(text, meta)
        return np.concatenate([_moments(x, g, c).ravel() for x, g, c in zip(pool, _given(pool, history), centre)])

    found = total(moments)
    if found is None:
        return None
    at = 2 * (1 + 2 * len(centre[0]))
    more = [part.reshape(2, -1) for part in (found[:at], found[at:])]
    counts = tuple(int(m[:, 0].sum()) for m in more)
    if counts == (before or (0, 0)):
        return None
    weights, models = [], []
    for x, m, c in zip(views, more, centre):
        own = _moments(x, y, c)
        weights.append(np.minimum(1.0, np.maximum(GIVEN_WEIGHT, own[:, 0]) / np.maximum(1, m[:, 0])))
        n, first, second = np.split((own + weights[-1][:, None] * m).sum(axis=0), [1, 1 + len(c)])
        scale = np.sqrt(np.maximum(second / n - (first / n) ** 2, 0))
        models.append(Logistic(c + first / n, np.where(scale > 1e-9, scale, 1.0), np.zeros(len(c) + 1)))
    open_ = [0, 1]
    for _ in range(steps):

        def sums(text: np.ndarray, meta: np.ndarray, open_: list[int] = open_) -> np.ndarray:
            pool, out = _views(text, meta), []
            for v, g in enumerate(_given(pool, history)):
                if v in open_:
                    rows = g >= 0
                    out += [s.ravel() for s in models[v].sums(pool[v][rows], g[rows], weights[v][g[rows]])]
            return np.concatenate(out)

        found, still = total(sums), []
        for v in open_:
            k = len(models[v].beta)
            curvature, slope, found = found[: k * k].reshape(k, k), found[k * k : k * k + k], found[k * k + k :]
            own = models[v].sums(views[v], y, np.ones(len(y)))
            if models[v].move(own[0] + curvature, own[1] + slope, ridge) >= 1e-6:
                still.append(v)
        open_ = still
        if not open_:
            break
    return counts, models


def cotrain(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray, rounds: int = ROUNDS, seed: int = 11) -> Model | None:
    """``cotrain_over`` with a pool in memory."""
    return cotrain_over(text, meta, y, lambda f: f(pool_text, pool_meta) if len(pool_text) else None, rounds, seed)


def cotrain_over(text: np.ndarray, meta: np.ndarray, y: np.ndarray, total: Total, rounds: int = ROUNDS, seed: int = 11) -> Model | None:
    """Fit both views on labelled rows, let each label all pool rows it is sure of for the other, and repeat.

    A fifth of the labelled rows is kept aside to calibrate the views and to weigh them against each other.  A view
    that is never sure gives no labels away.
    """
    if len(set(y.tolist())) < 2 or len(y) < 10:
        return None
    order = np.random.default_rng(seed).permutation(len(y))
    aside, fitted = order[: len(y) // 5], order[len(y) // 5 :]
    if min(len(set(y[aside].tolist())), len(set(y[fitted].tolist()))) < 2:
        aside = fitted = order
    views = _views(text, meta)
    history: History = [[Logistic.fit(v[fitted], y[fitted], ridge=2.0)] for v in views]
    log: list[tuple[int, int]] = []
    for _ in range(rounds):
        found = _refit([v[fitted] for v in views], y[fitted], history, total, log[-1] if log else None, ridge=2.0)
        if found is None:  # rows once given stay given, so later rounds would fit the same rows again
            break
        log.append(found[0])
        for h, m in zip(history, found[1]):
            h.append(m)
    models = [h[-1] for h in history]
    own = [m.logit(x[aside])[:, None] for m, x in zip(models, views)]
    calibration = [Logistic.fit(x, y[aside], ridge=1.0) for x in own]
    pair = np.hstack([c.logit(x)[:, None] for c, x in zip(calibration, own)])
    return Model(models[0], models[1], calibration, Logistic.fit(pair, y[aside], ridge=1.0), log)


def prepared(docs: DataFrame, id_col: str, text_col: str, meta: tuple[str, ...], size_col: str) -> DataFrame:
    """doc_id, text, row, and meta: hashes of the metadata fields and the size.  Fields that the table lacks count as null."""
    have = set(docs.columns)

    def field(c: str) -> Column:
        return F.col(f"row.`{c}`").cast("string") if c in have else F.lit(None).cast("string")

    hashes = [F.coalesce(F.pmod(F.xxhash64(field(c)), F.lit(1 << 20)), F.lit(0)).cast("double") for c in meta]
    return with_row(docs, id_col, text_col).withColumn("meta", F.array(*hashes, field(size_col).cast("double")))


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    n = len(texts)
    content = np.array([text_features(t) for t in texts], dtype=float).reshape(n, TEXT_FEATURES)
    meta = np.array(batch.column("meta").to_pylist(), dtype=float).reshape(n, -1)
    return content, meta, np.array([not (t and t.strip()) for t in texts], dtype=bool)


def _written(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The features of a batch of ``featured`` rows; a null among them is NaN."""
    wide = lambda c: batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return wide("content"), wide("meta")


def featured(rows: DataFrame) -> DataFrame:
    """doc_id, content, meta and whether the text is empty, of all ``prepared`` rows: some 200 bytes a row, written to the shared folder."""
    schema = more_columns(rows.select("doc_id"), content=ArrayType(DoubleType()), meta=ArrayType(DoubleType()), empty=BooleanType())

    def read(batch: pa.RecordBatch) -> dict:
        content, meta, empty = _read(batch)
        return {"doc_id": batch.column("doc_id"), "content": list(content), "meta": list(meta), "empty": empty}

    return stored(rows.select("doc_id", "text", "meta").mapInArrow(by_batch(arrow_columns(schema), read), schema), "quality-features")


def _matrix(rows: list, name: str, width: int) -> np.ndarray:
    return np.array([r[name] for r in rows], dtype=float).reshape(len(rows), width)


def _over(pool: DataFrame) -> Total:
    """Sums over a table of features.  Each task adds up its batches; there are no more tasks than two for each core, so few sums reach the driver."""
    pool = pool.coalesce(2 * pool.sparkSession.sparkContext.defaultParallelism)

    def total(tally: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for batch in batches:
                if batch.num_rows:
                    part = tally(*_written(batch))
                    sums = part if sums is None else sums + part
            if sums is not None:
                yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], type=pa.binary())], names=["sums"])

        parts = [np.frombuffer(bytes(r["sums"])) for r in pool.mapInArrow(run, "sums binary").collect()]
        return np.sum(parts, axis=0) if parts else None

    return total


def learn(found: DataFrame, labels: DataFrame, labelled: int = FIT_LABELLED) -> Model | None:
    """A model from ``featured`` rows and (doc_id, quality).  At most about ``labelled`` labelled rows are chosen by a hash of the
    id and brought to the driver; of all rows without a label only sums reach it."""
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality IN (0, 1) AND doc_id IS NOT NULL").distinct()
    n_marked, full = max(1, marked.count()), found.where("NOT empty").drop("empty")
    sample = full.join(F.broadcast(marked.where(draw * n_marked < labelled)), "doc_id").collect()
    sample = sorted(sample, key=lambda r: (str(r["doc_id"]), r["quality"], r["content"]))  # however rows are laid out
    y = np.array([r["quality"] for r in sample], dtype=float)
    width = len(sample[0]["meta"]) if sample else 1
    pool = stored(full.join(small(marked.select("doc_id").distinct()), "doc_id", "left_anti").select("content", "meta"), "quality-pool")
    return cotrain_over(_matrix(sample, "content", TEXT_FEATURES), _matrix(sample, "meta", width), y, _over(pool))


def judged(rows: DataFrame, model: Model | None) -> DataFrame:
    """``prepared`` rows less text and meta, or ``featured`` rows less their features, with p_text, p_meta and score."""
    out = rows.drop("text", "content", "meta", "empty")
    names, written = out.columns, "content" in rows.columns
    schema = more_columns(out, p_text=DoubleType(), p_meta=DoubleType(), score=DoubleType())

    def judge(batch: pa.RecordBatch) -> dict:
        text, fields, empty = (*_written(batch), batch.column("empty").to_numpy(zero_copy_only=False)) if written else _read(batch)
        found = model.probabilities(text, fields) if model else [np.ones(len(empty))] * 3
        return {c: batch.column(c) for c in names} | {c: np.where(empty, 0.0, p) for c, p in zip(("p_text", "p_meta", "score"), found)}

    return rows.mapInArrow(by_batch(arrow_columns(schema), judge), schema)


def score(
    docs: DataFrame, labels: DataFrame, cutoff: float = 0.5, id_col: str = "doc_id", text_col: str = "text", meta: tuple[str, ...] = ("source", "lang"), size_col: str = "n_chars"
) -> DataFrame:
    """doc_id, p_text, p_meta, score, kept of every row: the calibrated chance of good quality by each view and by
    both, and whether ``score`` reaches ``cutoff``.

    Texts are read once, whole, and their features are written; every row without a label can be given one.  A null
    or blank text has score 0 by all.  Without labels of both kinds every other row has score 1.  Repeated rows each
    give their row; null metadata is a value of its own; labels that are null, of other values or without a
    document are passed over; other columns are not used.
    """
    rows = featured(prepared(docs, id_col, text_col, meta, size_col))
    found = judged(rows, learn(rows, labels.select(F.col(id_col).alias("doc_id"), "quality")))
    return found.withColumn("kept", F.col("score") >= cutoff).withColumnRenamed("doc_id", id_col)


def keep_good(
    docs: DataFrame, labels: DataFrame, cutoff: float = 0.5, id_col: str = "doc_id", text_col: str = "text", meta: tuple[str, ...] = ("source", "lang"), size_col: str = "n_chars"
) -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, as they came.  Texts are read a second time, so that no copy of them is written."""
    rows = prepared(docs, id_col, text_col, meta, size_col)
    model = learn(featured(rows), labels.select(F.col(id_col).alias("doc_id"), "quality"))
    return judged(rows, model).where(F.col("score") >= cutoff).select("row.*")
