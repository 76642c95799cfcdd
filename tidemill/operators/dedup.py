"""Exact, keyed, fuzzy and probabilistic deduplication."""

from __future__ import annotations

import math
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemill.functions import hashing as H
from tidemill.functions import text as X
from tidemill.operators import pairs as P
from tidemill.operators.rank import first_per_key, only_unrepeated, row_index
from tidemill.session import cut

try:  # the plain C form starts faster than the OpenSSL one, which counts for short tokens
    from _md5 import md5
except ImportError:
    from hashlib import md5


# ---- exact


def dedup_exact(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """The first of equal rows by the order column; texts are sorted and compared by their digests."""
    texts = [c for c in columns if df.schema[c].dataType == StringType()]
    keys = [f"__d_{c}" if c in texts else c for c in columns]
    return first_per_key(df.withColumns({f"__d_{c}": F.md5(c) for c in texts}), keys, order).select(*df.columns)


def dedup_by_digest(df: DataFrame, text: str, order: str) -> DataFrame:
    """The first row of each text; the shuffle carries the digest instead of the text as key."""
    return first_per_key(df.withColumn("digest", F.md5(text)), ["digest"], order)


def dedup_by_keys(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each composite key; a missing part counts as ''."""
    filled = df
    for k in keys:
        filled = filled.withColumn(f"__f_{k}", F.coalesce(F.col(k).cast("string"), F.lit("")))
    return first_per_key(filled, [f"__f_{k}" for k in keys], order).select(*df.columns)


def dedup_subset(df: DataFrame, columns: list[str], order: str, keep: str | None = "first") -> DataFrame:
    """Keep the first, the last or (None) no row of each repeated key."""
    if keep is None:
        return only_unrepeated(df, columns)
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first', 'last' or None")
    return first_per_key(df, columns, order, last=keep == "last")


def dedup_sharded(df: DataFrame, text: str, order: str, shards: int, columns: list[str] | None = None) -> DataFrame:
    """Dedup inside hash shards; equal texts share a shard, so the result is global.

    Copies are combined before the shuffle, so a shard gets one row per text and task, with the wanted columns only.
    """
    digest = df.select(*(df.columns if columns is None else dict.fromkeys([order, *columns])), F.md5(text).alias("digest"))
    shard = H.digest_mod(F.col("digest"), shards).cast("int")
    return first_per_key(digest.withColumn("shard_id", shard), ["shard_id", "digest"], order)


def drop_merged(df: DataFrame, merged: DataFrame, key: str) -> DataFrame:
    """Delete the rows listed as merged into a primary row."""
    return df.join(merged.select(key).distinct(), key, "left_anti")


# ---- fuzzy


def duplicate_groups(df: DataFrame, id_col: str, column: str, threshold: float = 0.8) -> DataFrame:
    """id, leader: each row with the first row of its group."""
    values = cut(P.distinct_values(df, id_col, [column]))
    lead = P.first_survivors(values, P.similar_pairs(values, column, threshold))
    facts = values.join(lead, "vid").select(column, "apart", "leader")
    return P.rows_with_values(df, id_col, [column], facts).select(id_col, "leader")


def dedup_fuzzy(df: DataFrame, id_col: str, column: str, threshold: float = 0.8) -> DataFrame:
    """Rows kept by the greedy pass: no earlier kept row is similar."""
    values = cut(P.distinct_values(df, id_col, [column]))
    lead = P.first_survivors(values, P.similar_pairs(values, column, threshold))
    kept = lead.filter("vid = leader").select(F.col("vid").alias(id_col))
    return df.join(kept, id_col, "left_semi")


def dedup_fuzzy_column(df: DataFrame, id_col: str, column: str, threshold: float = 0.8, survivors: float = 0.8) -> DataFrame:
    """Replace each value by the first surviving value similar to it, then drop equal rows.

    Survivors are chosen with their own threshold.  The id column only gives the
    order; it is not part of the result.
    """
    values = cut(P.distinct_values(df, id_col, [column]))
    near = cut(P.similar_pairs(values, column, min(threshold, survivors)))
    kept = P.first_survivors(values, near.filter(F.col("similarity") >= survivors)).filter("vid = leader").select("vid")
    both = near.filter(F.col("similarity") >= threshold).select("a", "b")
    links = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    own = kept.select(F.col("vid").alias("a"), F.col("vid").alias("b"))
    target = links.join(kept, links.b == kept.vid, "left_semi").unionByName(own).groupBy("a").agg(F.min("b").alias("b"))
    target = target.select(F.col("a").alias("vid"), F.col("b").alias("__to"))
    text = values.select(F.col("vid").alias("__to"), F.col(column).alias("__new"))
    # rows without a word keep their text
    mapping = values.filter("apart IS NULL").join(target, "vid").join(text, "__to").select(column, "__new")
    rest = [c for c in df.columns if c not in (id_col, column)]
    out = df.join(mapping, column, "left").select(*rest, F.coalesce("__new", column).alias(column))
    return out.distinct()


def similar_record_groups(df: DataFrame, id_col: str, columns: list[str], threshold: float = 0.8) -> DataFrame:
    """Rows in groups of two or more: the columns, ``duplicate_group`` and ``original_index``."""
    lead = _record_leaders(df, id_col, columns, threshold, strict=False)
    groups = lead.groupBy("leader").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    numbered = row_index(groups.select("leader"), ["leader"], "duplicate_group")
    return (
        lead.join(numbered, "leader")
        .join(df.select(id_col, *columns), id_col)
        .select(*columns, "duplicate_group", F.col(id_col).alias("original_index"))
    )


def _record_leaders(df: DataFrame, id_col: str, columns: list[str], threshold: float, strict: bool) -> DataFrame:
    """id, leader, similarity with the leader (null for the leader itself)."""
    records = cut(P.distinct_values(df, id_col, columns))
    near = cut(P.similar_records(records, columns, threshold, strict))
    lead = P.first_survivors(records, near)
    scored = lead.join(near, (lead.leader == near.a) & (lead.vid == near.b), "left").select("vid", "leader", "similarity")
    # a copy of a record is as similar to the leader as the record, a copy of a leader as it is to itself
    own, parts = F.lit(0.0), F.lit(0)
    for c in columns:
        own = own + F.when(F.col(c).isNull(), 0.0).otherwise(P.SELF)
        parts = parts + F.col(c).isNotNull().cast("int")
    facts = records.join(scored, "vid").select(*columns, "apart", "leader", "similarity", (own / parts).alias("own"))
    hit = P.rows_with_values(df, id_col, columns, facts)
    sim = F.when(F.col(id_col) == F.col("leader"), None).otherwise(F.coalesce("similarity", "own"))
    return hit.select(id_col, "leader", sim.alias("similarity"))


def with_confidence(df: DataFrame, id_col: str, columns: list[str], threshold: float = 0.8) -> DataFrame:
    """Mark later rows similar (more than the threshold) to an earlier leading row."""
    lead = _record_leaders(df, id_col, columns, threshold, strict=True)
    return df.join(lead, id_col, "left").select(
        *df.columns,
        F.when(F.col("similarity").isNull(), 1.0).otherwise(1 - F.col("similarity")).alias("confidence_score"),
        F.col("similarity").isNotNull().alias("is_likely_duplicate"),
    )


# ---- Bloom filter


def bloom_size(expected: int, error: float) -> tuple[int, int]:
    """(number of bits, number of hashes)."""
    bits = int(-(expected * math.log(error)) / math.log(2) ** 2)
    return bits, max(1, int(bits / expected * math.log(2)))


def distinct_texts(df: DataFrame, text: str) -> int:
    """Counted by digest, so that no text is shuffled."""
    return max(1, df.where(F.col(text).isNotNull()).agg(F.count_distinct(F.sha2(text, 256))).first()[0])


def bloom_positions(text: str, bits: int, hashes: int) -> Column:
    """The bit positions of a text, one per hash; only these leave the scan, never a text per hash."""
    salted = lambda i: F.md5(F.concat(F.col(text), i.cast("string")))
    return F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda i: H.digest_mod(salted(i), bits))


def bloom_build(df: DataFrame, text: str, bits: int, hashes: int) -> DataFrame:
    """The filter as a table of 64-bit words: word, mask.  Combined before the shuffle."""
    pos = df.where(F.col(text).isNotNull()).select(F.explode(bloom_positions(text, bits, hashes)).alias("pos"))
    bit = F.expr("shiftleft(1L, int(pos % 64))")
    return pos.groupBy(F.floor(F.col("pos") / 64).alias("word")).agg(F.bit_or(bit).alias("mask"))


def bloom_probe_digests(df: DataFrame, text: str, bloom: DataFrame, bits: int, hashes: int) -> DataFrame:
    """digest (md5) of each distinct text with ``maybe_seen``: all its bits are set.  A null text has no row."""
    known = df.where(F.col(text).isNotNull()).select(F.md5(text).alias("digest"), bloom_positions(text, bits, hashes).alias("at"))
    pos = known.dropDuplicates(["digest"]).select("digest", F.explode("at").alias("pos")).withColumn("word", F.floor(F.col("pos") / 64))
    hit = F.coalesce(F.expr("getbit(mask, int(pos % 64))"), F.lit(0))
    return pos.join(bloom, "word", "left").groupBy("digest").agg((F.min(hit) == 1).alias("maybe_seen"))


def bloom_probe(df: DataFrame, text: str, bloom: DataFrame, bits: int, hashes: int) -> DataFrame:
    """Distinct texts with ``maybe_seen``; the texts meet their answers by digest.  A null text was never seen."""
    texts = df.groupBy(F.md5(text).alias("digest")).agg(F.any_value(text).alias(text))
    answers = bloom_probe_digests(df, text, bloom, bits, hashes)
    return texts.join(answers, "digest", "left").select(text, F.coalesce("maybe_seen", F.lit(False)).alias("maybe_seen"))


def dedup_probabilistic(df: DataFrame, text: str, order: str, seen: DataFrame | None = None, error: float = 0.01) -> DataFrame:
    """First rows of the texts that are not among the seen ones, if there are any.

    The Bloom filter is sized for the distinct texts counted in ``seen``.  Texts outside of it are new for sure; only the
    others are looked up exactly, by digest, so a false alarm loses nothing.  A null text is a text like others.
    """
    if seen is None:
        return dedup_exact(df, [text], order)
    bits, hashes = bloom_size(distinct_texts(seen, text), error)
    digest = lambda d: F.coalesce(F.md5(text), F.lit("")).alias(d)
    probe = bloom_probe_digests(df, text, bloom_build(seen, text, bits, hashes), bits, hashes).withColumnRenamed("digest", "__digest")
    fresh = first_per_key(df.select("*", digest("__digest")), ["__digest"], order)
    told = fresh.join(probe, "__digest", "left").withColumn("maybe_seen", F.coalesce("maybe_seen", F.lit(True)))
    sure = told.filter("NOT maybe_seen")
    checked = told.filter("maybe_seen").join(seen.select(digest("__digest")).distinct(), "__digest", "left_anti")
    return sure.select(*df.columns).unionByName(checked.select(*df.columns))


# ---- MinHash

_CACHE = 40_000  # tokens a worker remembers
_CHUNK = 2_048  # tokens of one text compared at once
_OUT = 256  # signatures in one piece of the answer
_LANES = 51_200  # digests that go through the rounds together
_SHIFTS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_ROUNDS = [(i // 16, (i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16, _SHIFTS[i // 16][i % 4], int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_STATE = [0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476]


def digest_starts(tokens: list[bytes], numbers: list[bytes]) -> np.ndarray:
    """tokens x numbers: the first eight bytes of md5(token + number) as a number, for many tokens at a time.

    Tokens of one length have their number in the same place, so the words of a message are a part of the token (alike for all
    numbers), a part of the number (alike for all tokens) and one word of both.  Longer messages than one block go one by one.
    """
    out = np.empty((len(tokens), len(numbers)), "u8")
    sizes, most = np.array([len(t) for t in tokens]), max(map(len, numbers))
    for size in np.unique(sizes).tolist():
        at = np.nonzero(sizes == size)[0]
        if size + most > 55:
            for i in at.tolist():
                out[i] = np.frombuffer(b"".join([md5(tokens[i] + n).digest()[:8] for n in numbers]), ">u8")
            continue
        first, before = divmod(size, 4)
        ends = np.frombuffer(b"".join([(bytes(before) + n + b"\x80").ljust(-(-(most + 4) // 4) * 4, b"\0") for n in numbers]), "<u4").reshape(len(numbers), -1)
        bits = np.array([8 * (size + len(n)) for n in numbers], "u4")[:, None]
        step = max(1, _LANES // len(numbers))
        for start in range(0, len(at), step):
            some = at[start : start + step]
            held = np.frombuffer(b"".join([tokens[i].ljust(4 * first + 4, b"\0") for i in some.tolist()]), "<u4").reshape(len(some), -1).T
            words: dict[int, np.ndarray] = dict(enumerate(held[:first]))
            words[first] = held[first][None, :] | ends[:, :1]
            for i in range(1, ends.shape[1]):
                if ends[:, i].any():
                    words[first + i] = ends[:, i : i + 1]
            words[14] = bits
            a, b = _md5_rounds(words, (len(numbers), len(some)))
            out[some] = (a.byteswap().astype("u8") << np.uint64(32) | b.byteswap()).T
    return out


def _md5_rounds(words: dict[int, np.ndarray], shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The first two words of the digests of messages of one block; words that aren't given are zero."""
    a, b, c, d = (np.full(shape, x, "u4") for x in _STATE)
    f, t = np.empty_like(a), np.empty_like(a)
    for kind, g, shift, k in _ROUNDS:
        if kind == 0:
            np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
        elif kind == 1:
            np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
        elif kind == 2:
            np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        np.add(f, words[g] + np.uint32(k) if g in words else np.uint32(k), out=f)
        np.left_shift(f, np.uint32(shift), out=t), np.right_shift(f, np.uint32(32 - shift), out=f), np.bitwise_or(f, t, out=f)
        np.add(f, b, out=f)
        a, b, c, d, f = d, f, b, c, a
    return a + np.uint32(_STATE[0]), b + np.uint32(_STATE[1])


def minhash_signature(df: DataFrame, text: str, name: str = "signature", hashes: int = 100) -> DataFrame:
    """Per hash number the smallest md5(token + number) over the tokens, as hex text; null without tokens.

    Tokens are compared by the first eight bytes of their digests.  A worker remembers these for ``_CACHE`` tokens, the
    most used ones longest, makes those of the new tokens of a portion of texts together, and makes the smallest digests whole.  The answer is put together from pieces of ``_OUT``
    signatures, so a batch never stands in the worker as Python strings.
    """

    @F.arrow_udf("array<string>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        numbers = [str(i).encode() for i in range(hashes)]
        table, uses = np.empty((_CACHE, hashes), "u8"), np.zeros(_CACHE, "i8")
        known: dict[bytes, int] = {}

        def make_room() -> None:
            """Half of the tokens stay, the most used ones; older uses count less and less."""
            nonlocal known
            keep = np.argpartition(-uses, _CACHE // 2)[: _CACHE // 2]
            keep.sort()
            place = {int(p): i for i, p in enumerate(keep)}
            table[: len(keep)], uses[: len(keep)] = table[keep], uses[keep] // 2
            uses[len(keep) :] = 0
            known = {t: place[p] for t, p in known.items() if p in place}

        def rows(tokens: list[bytes]) -> np.ndarray:
            learn(tokens)
            at = [known[t] for t in tokens]
            uses[at] += 1
            return table[at]

        def learn(tokens: Collection[bytes]) -> None:
            """Those that aren't remembered, at once: at most half of the cache."""
            if len(known) + len(tokens) > _CACHE:
                make_room()
            new = [t for t in tokens if t not in known]
            if new:
                table[len(known) : len(known) + len(new)] = digest_starts(new, numbers)
                known.update(zip(new, range(len(known), len(known) + len(new))))

        def signed(texts: pa.Array) -> list[list[str] | None]:
            """Texts go in portions of few tokens, whose new ones are made together."""
            out, some, every = [], [], set()
            for x in texts:
                s = x.as_py()
                tokens = [t.encode() for t in set(s.lower().split())] if s else []
                if some and len(every) + len(tokens) > _CACHE // 2:
                    out += together(some, every)
                    some, every = [], set()
                some.append(tokens)
                every.update(tokens)
            return out + together(some, every)

        def together(some: list[list[bytes]], every: set[bytes]) -> list[list[str] | None]:
            if len(every) <= _CACHE // 2:
                learn(every)
            return [one(tokens) for tokens in some]

        def one(tokens: list[bytes]) -> list[str] | None:
            if not tokens:
                return None
            low, best = np.full(hashes, np.iinfo("u8").max), [None] * hashes
            for start in range(0, len(tokens), _CHUNK):
                some = tokens[start : start + _CHUNK]
                m = rows(some)
                least = m.min(0)
                first = m.argmin(0)
                twice = (m == least).sum(0) > 1
                for h in np.nonzero(least <= low)[0].tolist():
                    held = [some[i] for i in np.nonzero(m[:, h] == least[h])[0]] if twice[h] else [some[first[h]]]
                    digest = min([md5(t + numbers[h]).hexdigest() for t in held])
                    best[h] = digest if best[h] is None else min(best[h], digest)
                low = np.minimum(low, least)
            return best

        for s in batches:
            parts = [pa.array(signed(s.slice(i, _OUT)), pa.list_(pa.string())) for i in range(0, len(s), _OUT)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return df.withColumn(name, sign(F.col(text)))


# ---- choice of method and report


def dedup_auto(df: DataFrame, id_col: str, text: str, method: str = "fuzzy", threshold: float = 0.8, shards: int = 64) -> tuple[DataFrame, str]:
    """(kept rows, method used).  The method is the caller's and never the table's size, so that a table that grows
    is still cleaned by the same rule; near copies go unless another method is named."""
    if method == "exact":
        return dedup_exact(df, [text], id_col), method
    if method == "fuzzy":
        return dedup_fuzzy(df, id_col, text, threshold), method
    if method == "probabilistic":
        return dedup_probabilistic(df, text, id_col), method
    if method == "scalable":
        return dedup_sharded(df, text, id_col, shards).select(*df.columns), method
    raise ValueError(f"unknown method {method}")


def dedup_report(df: DataFrame, kept: DataFrame, method: str) -> DataFrame:
    """One row: rows before, kept, removed and the removed share."""
    after = kept.count()
    return df.agg(F.count(F.lit(1)).alias("original")).select(
        "original", F.lit(after).cast("long").alias("kept"), (F.col("original") - after).alias("removed"),
        F.try_divide(F.col("original") - after, F.col("original")).alias("rate"), F.lit(method).alias("method"),
    )
