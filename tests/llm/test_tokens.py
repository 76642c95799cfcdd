import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemill.llm import packing, token_counts
from tidemill.llm.encode import WordEncoder
from tidemill.session import fresh_dir, table

from .conftest import ODD


@pytest.fixture(scope="module")
def library(word_bpe):
    return Tokenizer.from_file(word_bpe)


def plain_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_gives_the_ids_of_the_library(spark, sf, word_bpe, library):
    texts = [r["text"] for r in table(spark, sf, "documents").select("text").collect()]
    texts += [t for _, t in ODD] + ["ABC abc. Abc, ABC.", "a\x1cb \x85c d", "<|ENDOFTEXT|> x<|endoftext|>y", "Å Å. ﬁn, ΣΑΣ. ...,.", "n't 'll. it's,"]
    encoder = WordEncoder(word_bpe, room=100_000)
    assert encoder.by_word
    for _ in range(2):
        got = [np.frombuffer(b, dtype="<u4").tolist() for b in encoder.encode(pa.array(texts, type=pa.string()))]
        assert got == [plain_ids(library, t) for t in texts]
        assert list(encoder.count(pa.array(texts, type=pa.string()))) == list(map(len, got))


def test_encoder_on_made_up_texts(word_bpe, library):
    """Letters whose lower case is longer, marks that compose with small letters only, special strings in any case."""
    rng = random.Random(11)
    parts = ["İ", "BELEDİYESİ", "VALİLİĞİ", "i\u0307", "H", "h", "T\u0308", "t\u0308", "W\u030a", "J\u030c", "\u0307", "\u0331", "\u0301", "e", "É", "ß", "ẞ", "ǅ", "ŉ", "Σ", "ς", "ά"]
    parts += ["Straße", "the", "The", "don't", "'LL", "'s", "12", "٣", "Ⅻ", "中文", "한글", "कि", "\u0958", "ก็", "😀", "\u200d", "\ufe0f", "ﬁ", "K", "Å", "|", "!", "..", ".,", ",", ".", ".", ",", "-"]
    parts += ["<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|", "|>", "\x1c", "\x85", "\u00a0", "\u3000", "\u2028", "\x00", "\x0b", "\r\n", "\t"] + [" "] * 25
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(60_000)] + ["BELEDİYESİ, ve TÜRKİYE VALİLİĞİ.", "İ, x", "İ.", "x İ"]
    encoder = WordEncoder(word_bpe, room=1 << 20)
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in encoder.encode(pa.array(texts))]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, g, w in zip(texts, got, want) if g != w] == []


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = WordEncoder(path), Tokenizer.from_file(path)
    texts = ["Hello  world\n\n x", "", "tabs\t and   spaces "]
    assert not encoder.by_word
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in encoder.encode(pa.array(texts))] == [plain_ids(library, t) for t in texts]


def test_counts_of_odd_rows(spark, odd, none, word_bpe, library):
    cache = fresh_dir(spark, "cache")
    got = sorted(map(tuple, token_counts.token_counts(odd, word_bpe, cache, limit=5).collect()), key=repr)
    want = [(i, len((t or "").encode()), len(plain_ids(library, t)), len(plain_ids(library, t)) > 5) for i, t in ODD]
    assert got == sorted(want, key=repr)
    assert token_counts.token_counts(none, word_bpe, fresh_dir(spark, "cache")).count() == 0


def test_cache_is_used_and_grows_by_misses_only(spark, odd, word_bpe):
    cache = fresh_dir(spark, "cache")
    token_counts.token_counts(odd, word_bpe, cache).collect()
    version = token_counts.tokenizer_digest(word_bpe)
    path = f"{cache}/tokenizer={version}"
    first = spark.read.parquet(path)
    distinct = first.count()
    assert distinct == len({(t or "").split().__repr__() for _, t in ODD})
    # a wrong stored count is believed: nothing known is encoded again
    known = first.withColumn("n_tokens", first.n_tokens + 1000)
    other = fresh_dir(spark, "cache")
    known.write.parquet(f"{other}/tokenizer={version}")
    more = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(77, "entirely new words here")], "doc_id long, text string"))
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(more, word_bpe, other).collect()}
    assert got[4] > 1000 > got[77] and spark.read.parquet(f"{other}/tokenizer={version}").count() == distinct + 1


def plain_best_fit(lengths, tokens, documents, attention):
    """Best fit decreasing, one piece at a time."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= n and b[1] >= 1 and b[2] >= n * n]
        b = min(fits, key=lambda b: b[0] - n, default=None)
        if b is None:
            b = [tokens, documents, attention]
            bins.append(b)
        b[0], b[1], b[2] = b[0] - n, b[1] - 1, b[2] - n * n
    return len(bins)


@pytest.mark.parametrize("measure", ["norm", "dot"])
def test_scores_use_all_weights(measure):
    """With one piece of each length the bins are those of the plain vector best fit, and not those of tokens alone."""
    caps, weights = (64, 4, 1500), (1.0, 2.0, 3.0)
    bins, left = {}, []
    for n in range(30, 0, -1):
        piece = (n, 1, n * n)
        share = lambda b: [(x / c, p / c) for x, c, p in zip(left[b], caps, piece)]  # noqa: B023
        norm = lambda b: sum((w * (x - p)) ** 2 for w, (x, p) in zip(weights, share(b)))
        dot = lambda b: -sum(w * x * p for w, (x, p) in zip(weights, share(b)))
        fits = [b for b in range(len(left)) if all(x >= p for x, p in zip(left[b], piece))]
        best = min(fits, key=norm if measure == "norm" else dot, default=len(left))
        if best == len(left):
            left.append(list(caps))
        left[best] = [x - p for x, p in zip(left[best], piece)]
        bins[n] = best
    plan = lambda w: {n: start for n, _, _, _, start, _ in packing.plan_bins({n: 1 for n in range(1, 31)}, *caps, measure=measure, weights=w)}
    assert plan(weights) == bins != plan((1.0, 0.0, 0.0))


@pytest.mark.parametrize("measure", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(50, 50, 2500), (50, 3, 2500), (50, 50, 900), (64, 4, 1200)])
def test_plan_holds_every_capacity(measure, caps):
    rng = random.Random(3)
    lengths = [rng.choice([1, 2, 3, 5, 8, 13, 20, 21, 30]) for _ in range(700)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs = packing.plan_bins(counts, *caps, measure=measure, weights=(1.0, 0.5, 0.5) if measure == "dot" else (1.0, 0.0, 0.0))
    bins, seen = {}, {n: set() for n in counts}
    for n, first, size, per_bin, start, offset in runs:
        for i in range(size):
            seen[n].add(first + i)
            bins.setdefault(start + i // per_bin, []).append((offset + i % per_bin * n, n))
    assert {n: len(s) for n, s in seen.items()} == counts
    for content in bins.values():
        at = 0
        for offset, n in sorted(content):
            assert offset == at
            at += n
        assert at <= caps[0] and len(content) <= caps[1] and sum(n * n for _, n in content) <= caps[2]
    if measure == "norm":
        assert len(bins) <= plain_best_fit(lengths, *caps) * 1.03 + 1


def test_packing_of_odd_rows(spark, odd, none, word_bpe, library):
    rows = packing.pack(packing.token_pieces(odd, word_bpe, 64), 64).collect()
    by_doc, bins = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want = {}
    for i, t in ODD:
        ids = np.array(plain_ids(library, t) + [0], dtype="<u4")
        for at in range(0, len(ids), 64):
            want.setdefault(i, []).append((at, len(ids[at : at + 64]), zlib.crc32(ids[at : at + 64].tobytes())))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    for content in bins.values():
        at = 0
        for offset, n in sorted(content):
            assert offset == at
            at += n
        assert at <= 64
    assert len(bins) == -(-sum(n for v in want.values() for _, n, _ in v) // 64)
    assert packing.pack(packing.token_pieces(none, word_bpe, 64), 64).count() == 0
