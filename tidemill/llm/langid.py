"""Language identification with presence kernels of n-grams, Nyström landmarks and ridge regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from tidemill.llm.base import arrow_columns, by_batch, more_columns, with_row
from tidemill.session import small

UNKNOWN = "und"
#: lengths, in bytes, of the n-grams of the blended spectrum
ORDERS = (1, 2, 3)
#: documents of a language that the classifier is fitted on, in the mean over draws, and landmarks among them
FIT_PER_LANGUAGE, LANDMARKS_PER_LANGUAGE = 600, 80
RIDGE = 1e-3
#: documents whose presence vectors are multiplied together
BLOCK = 64
_FOLD = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def folded(text: str) -> np.ndarray:
    """The UTF-8 bytes of a text in lower case with a space before and behind; all ASCII but letters is space."""
    return np.frombuffer(b" " + text.lower().encode().translate(_FOLD) + b" ", dtype=np.uint8)


def grams(text: str) -> np.ndarray:
    """The distinct n-grams of a text, each as one number that also holds its length."""
    b = folded(text).astype(np.uint32)
    out, code = [], np.zeros(len(b), dtype=np.uint32)
    for n in range(1, max(ORDERS) + 1):
        code = (code[: len(b) - n + 1] << np.uint32(8)) | b[n - 1 :]
        if n in ORDERS:
            out.append(np.unique(code) | np.uint32(n << 24))
    return np.concatenate(out)


@dataclass
class Model:
    """``table`` gives the column of ``weights`` for an n-gram written in the ``letters`` of the landmarks."""

    classes: list[str]
    letters: np.ndarray
    tables: dict[int, np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def present(self, text: str, row: np.ndarray) -> None:
        c = self.letters[folded(text)]
        base, code = int(self.letters.max()) + 1, np.zeros(len(c), dtype=np.int64)
        for n in range(1, max(self.tables) + 1):
            code = code[: len(c) - n + 1] * base + c[n - 1 :]
            if n in self.tables:
                row[self.tables[n][code]] = 1

    def scores(self, texts: list[str]) -> np.ndarray:
        size = len(self.weights)
        out = [np.zeros((0, len(self.classes)))]
        for at in range(0, len(texts), BLOCK):
            part = texts[at : at + BLOCK]
            rows = np.zeros((len(part), size + 1), dtype=np.float32)
            for text, row in zip(part, rows):
                self.present(text, row)
            rows = rows[:, :size]
            norm = np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))
            out.append(rows @ self.weights / norm + self.bias)
        return np.vstack(out)


def fit(languages: list[str], gram_sets: list[np.ndarray], landmarks_each: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> Model | None:
    """One-versus-rest ridge regression on Nyström features.

    The kernel of two texts is the number of n-grams that both have, over the geometric mean of each one's
    number, counted among the n-grams of the landmarks.  Being linear in the presence vectors, landmarks and
    regression multiply out to one weight per n-gram and language.
    """
    classes = sorted(set(languages))
    if not classes:
        return None
    y = np.array([classes.index(x) for x in languages])
    marks = np.concatenate([np.flatnonzero(y == c)[:landmarks_each] for c in range(len(classes))])
    vocab = np.unique(np.concatenate([gram_sets[i] for i in marks]))

    def presence(rows) -> np.ndarray:
        out = np.zeros((len(rows), len(vocab)), dtype=np.float32)
        for r, i in enumerate(rows):
            at = np.minimum(np.searchsorted(vocab, gram_sets[i]), len(vocab) - 1)
            out[r, at[vocab[at] == gram_sets[i]]] = 1
        return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))

    z = presence(marks)
    values, vectors = np.linalg.eigh((z @ z.T).astype(float))
    good = values > 1e-6 * values.max()
    white = vectors[:, good] / np.sqrt(values[good])
    features = presence(range(len(y))) @ z.T @ white
    target = np.where(y[:, None] == np.arange(len(classes)), 1.0, -1.0)
    share = np.bincount(y, minlength=len(classes))[y]
    weight = (1.0 / share)[:, None]
    mean, bias = (weight * features).sum(axis=0) / weight.sum(), (weight * target).sum(axis=0) / weight.sum()
    centred = features - mean
    gram = centred.T @ (weight * centred) + ridge * np.eye(features.shape[1])
    beta = np.linalg.solve(gram, centred.T @ (weight * (target - bias)))
    letters = np.zeros(256, dtype=np.int64)
    used = sorted({(int(v) >> 8 * j) & 255 for v in vocab for j in range(int(v) >> 24)})
    letters[used] = np.arange(1, len(used) + 1)
    base = len(used) + 1
    tables = {n: np.full(base**n, len(vocab), dtype=np.int32) for n in ORDERS}
    for col, v in enumerate(vocab.tolist()):
        n, code = v >> 24, 0
        for j in range(n - 1, -1, -1):
            code = code * base + int(letters[(v >> 8 * j) & 255])
        tables[n][code] = col
    weights = (z.T @ white @ beta).astype(np.float32)
    return Model(classes, letters, tables, weights, (bias - mean @ beta).astype(np.float32))


def learn(train: DataFrame, per_language: int = FIT_PER_LANGUAGE) -> Model | None:
    """A model from (doc_id, text, lang): at most about ``per_language`` documents of each language, chosen by a
    hash of the id, from which only the distinct n-grams come to the driver."""
    train = train.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = train.groupBy("lang").agg(F.count("*").alias("rows"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    chosen = train.join(small(counts), "lang").where(draw * F.col("rows") < per_language).select("lang", "text")

    def rows(batch: pa.RecordBatch) -> dict:
        return {"lang": batch.column("lang"), "grams": [grams(t).tobytes() for t in batch.column("text").to_pylist()]}

    sample = chosen.mapInArrow(by_batch({"lang": pa.string(), "grams": pa.binary()}, rows), "lang string, grams binary").collect()
    sample.sort(key=lambda r: (r["lang"], bytes(r["grams"])))
    order = np.random.default_rng(7).permutation(len(sample))
    return fit([sample[i]["lang"] for i in order], [np.frombuffer(sample[i]["grams"], dtype=np.uint32) for i in order])


def predict(docs: DataFrame, model: Model | None, sharpness: float = 4.0) -> DataFrame:
    """``docs``, which have a text, with lang_pred and score: the language of the largest output, and its share in the
    softmax of ``sharpness`` times the outputs.  A text that is null or has no letter is ``und`` with score 0, and so is
    every text where there was nothing to learn from."""
    schema = more_columns(docs, lang_pred=StringType(), score=DoubleType())

    def rows(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").to_pylist()
        clear = [i for i, t in enumerate(texts) if model and t and any(map(str.isalpha, t))]
        name, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if clear:
            s = sharpness * model.scores([texts[i] for i in clear]).astype(float)
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for i, best, at in zip(clear, p.argmax(axis=1), p.max(axis=1)):
                name[i], score[i] = model.classes[best], float(at)
        return {c: batch.column(c) for c in batch.schema.names} | {"lang_pred": name, "score": score}

    return docs.mapInArrow(by_batch(arrow_columns(schema), rows), schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from the rows with a language that aren't held out.

    A row is held out if the crc32 of its id as text is divisible by 5; null ids aren't.  Only the text is used to
    predict.  Repeated rows each give their row; an empty table gives an empty one; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    model = learn(rows.where(~held_out(F.col("doc_id"))))
    found = predict(rows.select("doc_id", "text"), model)
    return found.select(F.col("doc_id").alias(id_col), held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is identified with a score of ``least`` or more, as they came."""
    rows = with_row(docs, id_col, text_col)
    model = learn(rows.select("doc_id", "text", F.col(f"row.`{lang_col}`").cast("string").alias("lang")).where(~held_out(F.col("doc_id"))))
    return predict(rows.select("row", "text"), model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
