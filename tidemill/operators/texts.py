"""Text analytics on token columns: stop words, lemmas, n-grams, sentiment, topics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import text as X
from tidemill.operators.topics import Bags, TopicModel, bags_of, fit
from tidemill.session import small


#: fixed values: the default English stop words of Spark ML
STOP_WORDS = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its
    itself they them their theirs themselves what which who whom this that these those am is are was were be been being have
    has had having do does did doing a an the and but if or because as until while of at by for with about against between
    into through during before after above below to from up down in out on off over under again further then once here there
    when where why how all any both each few more most other some such no nor not only own same so than too very s t can
    will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's
    it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
    won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's
    when's where's who's why's would
""".split()


def without(tokens: Column, words: list[str]) -> Column:
    """Tokens outside a word list, which Spark looks up as a set; repeats stay."""
    return F.filter(tokens, lambda t: ~t.isin(words))


def longer_than(tokens: Column, n: int = 1) -> Column:
    return F.filter(tokens, lambda t: F.length(t) > n)


def term_table(df: DataFrame, id_col: str, tokens: Column) -> DataFrame:
    """id, word, n: the bag of words in long form."""
    words = df.select(id_col, F.explode(tokens).alias("word"))
    return words.groupBy(id_col, "word").agg(F.count(F.lit(1)).alias("n"))


def frequencies(df: DataFrame, tokens: Column, name: str = "word") -> DataFrame:
    return df.select(F.explode(tokens).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def top(freq: DataFrame, k: int, name: str = "word", least: bool = False) -> DataFrame:
    return freq.orderBy(F.col("n").asc() if least else F.col("n").desc(), name).limit(k)


def lemma_counts(freq: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Word counts -> lemma counts with a table word, lemma; other words stand for themselves.

    Counting comes first, so the join sees each word once.
    """
    out = freq.join(small(lemmas), "word", "left").groupBy(F.coalesce("lemma", "word").alias("word"))
    return out.agg(F.sum("n").alias("n"))


def frequency_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """word, before, after, delta; a word missing on one side counts 0 there."""
    b, a = before.withColumnRenamed("n", "before"), after.withColumnRenamed("n", "after")
    out = b.join(a, "word", "full").na.fill(0, ["before", "after"])
    return out.withColumn("delta", F.col("after") - F.col("before"))


def tag_counts(freq: DataFrame, tags: DataFrame) -> DataFrame:
    """Tags of the tokens from a table word, tag; unknown words get 'NN'."""
    tagged = freq.join(small(tags), "word", "left")
    return tagged.groupBy(F.coalesce("tag", F.lit("NN")).alias("tag")).agg(F.sum("n").alias("n"))


def sentiment(df: DataFrame, id_col: str, text: str, lexicon: DataFrame) -> DataFrame:
    """Mean word score per text, unknown words 0; a text without words gets null.

    With a lexicon that can be broadcast the words of a text stay in its task, and only sums per text are shuffled.
    """
    terms = df.select(id_col, F.explode(X.words(F.lower(text))).alias("word"))
    scored = terms.join(small(lexicon), "word", "left")
    mean = F.sum(F.coalesce("score", F.lit(0))) / F.count(F.lit(1))
    per = scored.groupBy(id_col).agg(mean.alias("sentiment"))
    return df.select(id_col).join(per, id_col, "left")


# ---- topics


def vectorize(df: DataFrame, tokens: str) -> Bags:
    """Bags of all words; they and the vocabulary are tables."""
    return bags_of(df, tokens)


def topics(bags: Bags, k: int, passes: int = 10, seed: int = 42) -> TopicModel:
    return fit(bags, [k], passes, seed)


def topic_words(model: TopicModel, n: int = 10) -> dict[int, list[tuple[str, float]]]:
    """The n strongest words of each topic of a single model: k x n numbers."""
    return {t: words for (_, t), words in model.top(n).items()}


def window_counts(df: DataFrame, tokens: str, words: list[str], length: int = 110) -> tuple[dict, int]:
    """In how many sliding windows each word, and each pair of words, occurs; and the number of windows.

    Each task adds up its own windows, so only words x words numbers per task are shuffled.
    """
    place = {w: i for i, w in enumerate(words)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, pairs = 0, np.zeros((len(words), len(words)), dtype="int64")
        for b in batches:
            for toks in b[tokens]:
                if toks is None or len(toks) == 0:
                    continue
                n = max(1, len(toks) - length + 1)
                total += n
                at = [(p, place[t]) for p, t in enumerate(toks) if t in place]
                used = sorted({w for _, w in at})
                col = {w: i for i, w in enumerate(used)}
                step = np.zeros((n + 1, len(used)), dtype="int32")
                for p, w in at:  # a token at p is in the windows p - length + 1 .. p
                    step[max(0, p - length + 1), col[w]] += 1
                    step[min(n, p + 1), col[w]] -= 1
                seen = (np.cumsum(step[:n], axis=0) > 0).astype("float32")
                pairs[np.ix_(used, used)] += np.rint(seen.T @ seen).astype("int64")
        i, j = np.nonzero(pairs)
        out = [(int(a), int(c), int(pairs[a, c])) for a, c in zip(i, j)] + [(-1, -1, total)]
        yield pd.DataFrame(out, columns=["i", "j", "n"])

    rows = df.select(tokens).mapInPandas(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    found = {(r["i"], r["j"]): r["n"] for r in rows}  # at most words x words rows
    return found, found.pop((-1, -1), 0)


def coherence(df: DataFrame, tokens: str, by_topic: dict[int, list[str]], length: int = 110) -> dict[int, float]:
    """c_v per topic: cosine of each word's NPMI vector with the topic's summed vector, averaged."""
    words = sorted({w for ws in by_topic.values() for w in ws})
    place = {w: i for i, w in enumerate(words)}
    seen, total = window_counts(df, tokens, words, length)
    eps = 1e-12

    def npmi(a: str, b: str) -> float:
        i, j = place[a], place[b]
        pa, pb = seen.get((i, i), 0) / total, seen.get((j, j), 0) / total
        both = seen.get((i, j), 0) / total + eps
        return math.log(both / (pa * pb)) / -math.log(both) if pa and pb else 0.0

    out = {}
    for topic, ws in by_topic.items():
        m = np.array([[npmi(a, b) for b in ws] for a in ws])
        whole = m.sum(0)
        norm = np.linalg.norm(m, axis=1) * np.linalg.norm(whole)
        out[topic] = float(np.mean(np.divide(m @ whole, norm, out=np.zeros(len(ws)), where=norm > 0)))
    return out


#: topics of the models that are fitted in one vector
SIDE = 90


def _dealt(ks: list[int]) -> list[list[int]]:
    """Models in groups of ``SIDE`` topics, one after the other."""
    groups = [[]]
    for k in ks:
        if groups[-1] and sum(groups[-1]) + k > SIDE:
            groups.append([])
        groups[-1].append(k)
    return groups


def topic_scan(df: DataFrame, tokens: str, ks: list[int], passes: int = 10, n: int = 10, seed: int = 42) -> DataFrame:
    """Mean coherence for each number of topics.  All models share their batches and one count of windows; groups of models
    don't depend on each other and are fitted at the same time."""
    bags = vectorize(df, tokens)
    bags.draw(passes, seed)
    groups = _dealt(ks)
    fitted = lambda group: fit(bags, group, passes, seed).top(n)
    with ThreadPool(len(groups)) as pool:
        tops = pool.map(inheritable_thread_target(df.sparkSession)(fitted), groups, chunksize=1)
    found = {t: [w for w, _ in ws] for top in tops for t, ws in top.items()}
    scores = coherence(df, tokens, found)
    rows = [(k, float(np.mean([scores[k, t] for t in range(k)]))) for k in ks]
    return df.sparkSession.createDataFrame(rows, "topics int, coherence double")
