"""Near-duplicate documents by one-permutation hashing with optimal densification."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.base import arrow_type, by_batch, kind, stored, text_digest, two, with_row
from tidemill.llm.graph import components

BANDS = 32
#: of documents that are just similar enough, the share that may meet in no band
MISSED = 1e-5
#: by how many standard deviations more of the sketches' bits than is usual may differ before a pair isn't looked at
FAR = 5.5
BITS = 128
#: nodes up to which all pairs of a bucket are rows, and nodes of the blocks that larger buckets are compared in
SMALL_BUCKET, BLOCK = 48, 1024


def rows_per_band(similarity: float, bands: int = BANDS) -> int:
    """The most rows of a band with which pairs of this similarity miss each other in all bands at most ``MISSED`` of the time."""
    r = 1
    while (1 - similarity ** (r + 1)) ** bands <= MISSED:
        r += 1
    return r


def bits_apart(similarity: float) -> int:
    """The most bits in which the sketches of similar sets may differ: bins disagree in 1 - similarity of all cases,
    and their bits in half of those."""
    p = (1 - similarity) / 2
    return int(BITS * p + FAR * (BITS * p * (1 - p)) ** 0.5)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """The distinct 64-bit hashes, in order, of the k-word shingles of a text; of all its words as one, if it has fewer.

    Words are what stands between ASCII white space, with A-Z as a-z.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(k, len(w))
    h = np.full(len(w) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[j : len(w) - k + 1 + j]
    return np.unique(_mix(h))


@lru_cache(maxsize=4)
def _donors(bins: int) -> np.ndarray:
    """For each bin, the place of every bin in the bin's own random order of those it may borrow from."""
    rng = np.random.default_rng(20141)
    return np.stack([rng.permutation(bins) for _ in range(bins)]).astype(np.int16)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One hash per bin: the least that falls into it; an empty bin takes that of the full bin that comes first in
    its own random order, so that each borrows on its own (optimal densification).  ``hashes`` isn't empty."""
    place = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    full, first = np.unique(place, return_index=True)
    if len(full) == bins:
        return hashes[first]
    nearest = _donors(bins)[:, full].argmin(axis=1)
    nearest[full] = np.arange(len(full))
    return hashes[first][nearest]


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    rows = sig.reshape(bands, -1)
    h = np.arange(bands, dtype=np.uint64)
    for j in range(rows.shape[1]):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return h


def sketch(sig: np.ndarray) -> np.ndarray:
    """Two 64-bit words of one bit per bin; bins with the same hash give the same bit, others do by half."""
    bits = _mix(sig[:BITS] + np.arange(BITS, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8)).view("<i8")


def features(docs: DataFrame, k: int, similarity: float) -> DataFrame:
    """doc_id, content, n, digest, bands, s0, s1 of every row of (doc_id, text): digest of the text, set size, digest of
    the set, keys of its bands and its sketch.  Without words n is 0 and the rest is null."""
    bins = BANDS * max(4, rows_per_band(similarity))
    columns = {"doc_id": arrow_type(docs.schema["doc_id"].dataType), "content": pa.binary(), "n": pa.int64(), "digest": pa.binary(), "bands": pa.list_(pa.int64()), "s0": pa.int64(), "s1": pa.int64()}

    def rows(batch: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("content", "n", "digest", "bands", "s0", "s1")}
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            h = shingles(text, k)
            out["content"].append(hashlib.sha256(text or b"").digest())
            out["n"].append(len(h))
            if not len(h):
                for c in ("digest", "bands", "s0", "s1"):
                    out[c].append(None)
                continue
            sig = signature(h, bins)
            s = sketch(sig)
            out["digest"].append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
            out["bands"].append(band_keys(sig, BANDS).view(np.int64))
            out["s0"].append(int(s[0]))
            out["s1"].append(int(s[1]))
        return out | {"doc_id": batch.column("doc_id")}

    return docs.mapInArrow(by_batch(columns, rows), f"doc_id {kind(docs, 'doc_id')}, content binary, n bigint, digest binary, bands array<bigint>, s0 bigint, s1 bigint")


def _sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """node, hashes: the full sets of these (node, digest, least); their texts are read again."""
    columns = {"digest": pa.binary(), "hashes": pa.list_(pa.int64())}

    def rows(batch: pa.RecordBatch) -> dict:
        sets = [shingles(t, k) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        return {"digest": [hashlib.blake2b(h.tobytes(), digest_size=16).digest() for h in sets], "hashes": [h.view(np.int64) for h in sets]}

    texts = docs.join(nodes.select("least").distinct(), F.col("doc_id").eqNullSafe(F.col("least")), "left_semi").select("text")
    sets = texts.mapInArrow(by_batch(columns, rows), "digest binary, hashes array<bigint>")
    return stored(sets.join(nodes, "digest").select("node", "hashes"), "minhash-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar."""
    both = pairs.join(sets.toDF("a", "ha"), "a").join(sets.toDF("b", "hb"), "b")

    def rows(batch: pa.RecordBatch) -> dict:
        keep = []
        for i, (x, y) in enumerate(zip(batch.column("ha"), batch.column("hb"))):
            p, q = (v.values.to_numpy().view(np.uint64) for v in (x, y))
            if len(p) > len(q):
                p, q = q, p
            at = np.searchsorted(q, p)
            common = int((q[np.minimum(at, len(q) - 1)] == p).sum())
            if 100 * common >= percent * (len(p) + len(q) - common):
                keep.append(i)
        out = batch.take(pa.array(keep, type=pa.int64()))
        return {"a": out.column("a"), "b": out.column("b")}

    return both.select("a", "b", "ha", "hb").mapInArrow(by_batch({"a": pa.int64(), "b": pa.int64()}, rows), "a bigint, b bigint").distinct()


def _mixed(entries: DataFrame) -> DataFrame:
    """The (node, label, key) of buckets in which nodes of several labels meet."""
    several = entries.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("key")
    return entries.join(several, "key")


def _linking(percent: int):
    """For applyInArrow: the links (a, b) within a group of nodes that join labels which no link so far has joined."""

    def links(group: pa.Table) -> pa.Table:
        node, label = group.column("node").to_numpy(), group.column("label").to_numpy()
        sets = group.column("hashes").combine_chunks()
        size = np.diff(sets.offsets.to_numpy())
        _, which, count = np.unique(sets.flatten().to_numpy(), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(node)), size)
        shared = count[which] > 1  # a shingle of one node alone adds to no intersection
        row, col = row[shared], (np.cumsum(count > 1) - 1)[which[shared]]
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        common = np.zeros((len(node), len(node)), dtype=np.float32)
        width = 2048
        for first in range(0, int((count > 1).sum()), width):
            at, to = np.searchsorted(col, [first, first + width])
            part = np.zeros((len(node), width), dtype=np.float32)
            part[row[at:to], col[at:to] - first] = 1
            common += part @ part.T
        common = common.astype(np.int32)
        union = (size[:, None] + size[None, :]).astype(np.int32) - common
        similar = np.triu((100 * common >= percent * union) & (label[:, None] != label[None, :]), 1)
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up.get(x, x) != x:
                x = up[x]
            return x

        a, b = [], []
        for i, j in np.argwhere(similar):
            p, q = root(int(label[i])), root(int(label[j]))
            if p != q:
                up[max(p, q)] = min(p, q)
                a.append(min(node[i], node[j]))
                b.append(max(node[i], node[j]))
        return pa.table({"a": pa.array(a, type=pa.int64()), "b": pa.array(b, type=pa.int64())})

    return links


def _large_buckets(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between labels in buckets (node, label, key, size) that are too large for rows of pairs.

    A bucket's nodes are dealt to blocks, and every two blocks meet in one group, which holds 2 * ``BLOCK`` sets in the
    mean; only links that join labels leave it.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = entries.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pairs = dealt.select("node", "label", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    return pairs.join(sets, "node").groupBy("key", "low", "high").applyInArrow(_linking(percent), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, content (a digest of the text) of every document: linked are documents with
    100 * |intersection| >= percent * |union| of their sets of k-word shingles.

    * Equal sets are one node, so copies never meet each other.
    * Sets get a one-permutation signature, whose bands put them in buckets.  In each bucket all are linked to one
      centre (a star), so a bucket of any size gives fewer pairs than it has nodes.  Pairs are confirmed on the full sets.
    * A star can miss two nodes that are similar to each other but not to the centre.  So once the stars' components
      are known, nodes in one bucket but in different components are compared as well: as pairs in small buckets, and
      in blocks of sets in large ones, from which only links come out.  A node of which too many shingles are in no
      other node that is left can't be similar to any, so it is spared that.
    * Pairs are dropped unconfirmed only if their sizes rule the similarity out or their sketches differ in more
      bits than similar sets' do but in some millionths of all cases.

    A document of fewer than k words has one shingle; one without words or with a null text has none and is linked
    with nothing.  Repeated rows each give their row and are linked like copies.  ``kept`` says whether the row has
    the least id of its component; null ids are kept only if no other id is in theirs.  Ids that are repeated with
    different texts may lie in several components.  Other columns are not read.
    """
    rows = two(docs, id_col, text_col)
    feats = stored(features(rows, k, percent / 100), "minhash-features")
    nodes = feats.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("least"), *(F.first(c).alias(c) for c in ("n", "s0", "s1", "bands")))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")
    slim = nodes.select("node", "digest", "least", "n", "s0", "s1")
    far = bits_apart(percent / 100)

    def near(x: str, y: str):
        c = {v: (F.col(f"{x}.{v}"), F.col(f"{y}.{v}")) for v in ("n", "s0", "s1")}
        differ = F.bit_count(c["s0"][0].bitwiseXOR(c["s0"][1])) + F.bit_count(c["s1"][0].bitwiseXOR(c["s1"][1]))
        return (percent * F.greatest(*c["n"]) <= 100 * F.least(*c["n"])) & (differ <= far)

    entries = nodes.select("node", F.explode("bands").alias("key"))
    centres = entries.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("size")).where("size > 1").drop("size")
    stars = entries.join(centres, "key").where("node != a").select("a", F.col("node").alias("b")).distinct()
    x, y = slim.alias("x"), slim.alias("y")
    pairs = stars.join(x, F.col("a") == F.col("x.node")).join(y, (F.col("b") == F.col("y.node")) & near("x", "y")).select("a", "b")
    pairs = stored(pairs, "minhash-pairs")
    named = stored(slim.join(pairs.select("a").union(pairs.select("b")).distinct().toDF("node"), "node", "left_semi"), "minhash-named")
    links = stored(_confirmed(pairs, _sets(rows, named, k), percent), "minhash-links")
    labels = components(links)

    # buckets in which several components still meet
    mine = nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), F.explode("bands").alias("key"))
    entries = stored(_mixed(mine), "minhash-mixed")
    left = stored(slim.join(entries.select("node").distinct(), "node", "left_semi"), "minhash-left")
    sets = _sets(rows, left, k)
    once = sets.select("node", F.explode("hashes").alias("h")).groupBy("h").agg(F.min("node").alias("node"), F.max("node").alias("other")).where("node = other")
    alone = left.join(once.groupBy("node").agg(F.count("*").alias("own")), "node").where((100 * F.col("own")) > (100 - percent) * F.col("n")).select("node")
    entries = _mixed(entries.join(alone, "node", "left_anti"))
    entries = stored(entries.join(entries.groupBy("key").agg(F.count("*").alias("size")), "key"), "minhash-rest")
    small = entries.where(F.col("size") <= SMALL_BUCKET).join(left.select("node", "n", "s0", "s1"), "node")
    p, q = small.alias("p"), small.alias("q")
    rest = p.join(q, (F.col("p.key") == F.col("q.key")) & (F.col("p.node") < F.col("q.node")) & (F.col("p.label") != F.col("q.label")) & near("p", "q"))
    rest = rest.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    large = _large_buckets(entries.where(F.col("size") > SMALL_BUCKET), sets, percent)
    more = stored(_confirmed(rest, sets, percent).union(large), "minhash-more")
    if not more.isEmpty():
        labels = components(links.union(more))

    labelled = slim.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).select("digest", "label", "least")
    ids = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = labelled.join(ids, "label").select("digest", "component_id")
    found = feats.select("doc_id", "content", "n", "digest").join(classes, "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "content"
    )


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, as they came; of repeated rows with one id and text, one."""
    first = near_duplicates(docs, k, percent, id_col, text_col).where("kept").select(F.col(id_col).alias("d"), F.col("content").alias("c")).distinct()
    rows = with_row(docs, id_col, text_col)
    rows = rows.select("row", "doc_id", text_digest(F.coalesce("text", F.lit(""))).alias("content"))
    kept = rows.join(first, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("content") == F.col("c")), "left_semi")
    return kept.dropDuplicates(["doc_id", "content"]).select("row.*")
