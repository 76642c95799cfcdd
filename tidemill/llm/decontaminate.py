"""Benchmark decontamination with a generalised suffix automaton."""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from tidemill.llm.base import arrow_columns, by_batch, more_columns, stored, text_digest, two, with_row

#: words are runs of ASCII letters and digits and of everything beyond ASCII; A-Z count as a-z
_SPACE = {c: 32 for c in range(128) if not (chr(c).isdigit() or chr(c).isalpha())}
FOLD = bytes(_SPACE.get(c, c + 32 if 65 <= c <= 90 else c) for c in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: the most words of benchmark items that one automaton, which every task holds, may take
BLOCK_WORDS = 200_000
PAIR_A, PAIR_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


class SuffixAutomaton:
    """All factors of a set of word sequences: from any state, the longest factor that ends here is one step away.

    ``size[s]`` is the length of the longest factor of state s, ``link[s]`` the state of its longest suffix that also
    occurs elsewhere, ``next[s]`` the steps by word number.
    """

    def __init__(self, items: list[list[bytes]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        coded = [[self.ids.setdefault(w, len(self.ids)) for w in item] for item in items]
        ends: list[list[int]] = []
        for seq in coded:
            last, states = 0, []
            for w in seq:
                last = self._extend(last, w)
                states.append(last)
            ends.append(states)
        # the state of a factor's last ``window`` words, and the items that hold them
        self.top = list(range(len(self.size)))
        order = sorted(range(1, len(self.size)), key=self.size.__getitem__)
        for s in order:
            if self.size[self.link[s]] >= window:
                self.top[s] = self.top[self.link[s]]
        self.owners: dict[int, set[int]] = {}
        for i, states in enumerate(ends):
            for s in states[window - 1 :]:
                self.owners.setdefault(self.top[s], set()).add(i)
        # shorter items by state and length, and the nearest state above that has some
        self.whole: dict[int, dict[int, set[int]]] = {}
        for i, seq in enumerate(coded):
            if 0 < len(seq) < window:
                s = 0
                for w in seq:
                    s = self.next[s][w]
                self.whole.setdefault(s, {}).setdefault(len(seq), set()).add(i)
        self.up = [-1] * len(self.size)
        for s in order:
            up = self.link[s]
            self.up[s] = up if up in self.whole else self.up[up]
        self.least = min([window, *(len(seq) for seq in coded if seq)])
        # a hashed set of neighbouring words; what it lets through by chance, the automaton turns down
        pairs = {self._pair(a, b) for seq in coded for a, b in zip(seq, seq[1:])}
        self.bits = max(10, (16 * len(pairs)).bit_length())
        self.neighbours = np.zeros(1 << self.bits, dtype=bool)
        self.neighbours[[h >> (64 - self.bits) for h in pairs]] = True

    @staticmethod
    def _pair(a: int, b: int) -> int:
        return (a * PAIR_A + b * PAIR_B) & 0xFFFFFFFFFFFFFFFF

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.size[q] == self.size[last] + 1 else self._clone(last, w, q)
        new = self._state(self.size[last] + 1, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._clone(p, w, q)
        return new

    def _state(self, size: int, steps: dict[int, int]) -> int:
        self.next.append(steps)
        self.size.append(size)
        self.link.append(-1)
        return len(self.size) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        twin = self._state(self.size[p] + 1, dict(self.next[q]))
        self.link[twin], self.link[q] = self.link[q], twin
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = twin
            p = self.link[p]
        return twin

    def stretches(self, words: list[bytes]) -> tuple[np.ndarray, Iterator[tuple[int, int]]]:
        """The word numbers, and the stretches in which every two neighbours are neighbours in an item: no factor
        of an item reaches out of one."""
        n = len(words)
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), dtype=np.int64, count=n)
        inside = ids >= 0
        if not inside.any():
            return ids, iter(())
        wide = ids.view(np.uint64)
        code = wide[:-1] * np.uint64(PAIR_A) + wide[1:] * np.uint64(PAIR_B)
        joined = np.zeros(n + 1, dtype=bool)
        joined[1:n] = self.neighbours[code >> np.uint64(64 - self.bits)] & inside[1:] & inside[:-1]
        first = np.flatnonzero(inside & ~joined[:n])
        last = np.flatnonzero(inside & ~joined[1:])
        long = last - first + 1 >= self.least
        return ids, zip(first[long].tolist(), last[long].tolist())

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans [from, to) of words inside an occurrence of a window, apart from each other, and the items whose
        windows occur.  A window is ``window`` words of an item, or all of an item that has fewer."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        if len(words) < self.least:
            return spans, items
        ids, stretches = self.stretches(words)
        for first, last in stretches:
            state, length = 0, 0
            for i, w in enumerate(ids[first : last + 1].tolist(), first):
                while state and w not in self.next[state]:
                    state = self.link[state]
                    length = self.size[state]
                state = self.next[state].get(w, 0)
                length = length + 1 if state else 0
                longest = 0
                if length >= self.window:
                    longest = self.window
                    items |= self.owners[self.top[state]]
                s = state if state in self.whole else self.up[state]
                while s >= 0:
                    for n, held in self.whole.get(s, {}).items():
                        if n <= length:
                            items |= held
                            longest = max(longest, n)
                    s = self.up[s]
                if longest:
                    start = i + 1 - longest
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i + 1))
        return spans, items


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of these spans and what stands between them."""
    raw, keep, at = text.encode(), [], 0
    places = [m.span() for m in WORD.finditer(raw)]
    for a, b in spans:
        keep.append(raw[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*keep, raw[at:]]).decode()


def blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[tuple[list[str], list[list[bytes]]]]:
    """Items with words, in blocks of at most ``most`` words (a longer item is a block of its own); one block at least.

    Rows come to the driver one partition at a time and only one block is held.
    """
    ids, items, size = [], [], 0
    for r in two(benchmark, id_col, text_col).toLocalIterator():
        words = words_of((r["text"] or "").encode())
        if size and size + len(words) > most:
            yield ids, items
            ids, items, size = [], [], 0
        if words:
            ids.append("" if r["doc_id"] is None else str(r["doc_id"]))
            items.append(words)
            size += len(words)
    yield ids, items


@functools.lru_cache(maxsize=1)
def _automaton(key: str) -> list[SuffixAutomaton]:
    """The automaton that this Python worker has built for a block, if any."""
    return []


def _scanned(rows: DataFrame, ids: list[str], items: list[list[bytes]], window: int, cut: tuple[int, float] | None = None) -> DataFrame:
    """``rows`` with n_words, spans and items; with ``cut``, a span and a coverage limit, the rows that it leaves, cut."""
    key = uuid.uuid4().hex
    spans_type, items_type = ArrayType(ArrayType(LongType())), ArrayType(StringType())
    schema = more_columns(rows, n_words=LongType(), spans=spans_type, items=items_type)

    def scan(batch: pa.RecordBatch) -> dict:
        held = _automaton(key)
        if not held:
            held.append(SuffixAutomaton(items, window))
        out = {"n_words": [], "spans": [], "items": []}
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            words = words_of(text)
            spans, which = held[0].hits(words)
            out["n_words"].append(len(words))
            out["spans"].append([list(x) for x in spans])
            out["items"].append(sorted({ids[i] for i in which}))
        out |= {c: batch.column(c) for c in batch.schema.names}
        return _limited(out, *cut) if cut else out

    return rows.mapInArrow(by_batch(arrow_columns(schema), scan), schema)


def _limited(found: dict, span_limit: int, coverage_limit: float) -> dict:
    """Without the rows of which more than ``coverage_limit`` is hit, and without spans of ``span_limit`` words or more."""
    hit = [sum(b - a for a, b in spans) for spans in found["spans"]]
    keep = [i for i, n in enumerate(found["n_words"]) if hit[i] <= coverage_limit * n]
    rows = pa.array(keep, type=pa.int64())
    out = {c: x.take(rows) if isinstance(x, pa.Array) else [x[i] for i in keep] for c, x in found.items()}
    long = [[x for x in spans if x[1] - x[0] >= span_limit] for spans in out["spans"]]
    return out | {"text": [cut_spans(t, x) if x else t for t, x in zip(out["text"].to_pylist(), long)]}


def scan_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", block_words: int = BLOCK_WORDS, limits: tuple[int, float] | None = None,
) -> DataFrame:
    """doc_id, text, row (the document as it came), n_words, spans, items of every document; with ``limits``, of those
    that ``decontaminate`` keeps, with the text that it leaves them.

    Words of test items go into a generalised suffix automaton; a document's words are run through it once, which
    gives the longest factor of any item that ends at each word.  Where that is ``window`` words or more, or a whole
    shorter item, the words of the window are hit.  A set of neighbouring words finds the few stretches that the
    automaton has to look at; no factor lies outside of them.

    ``spans`` are [from, to) word numbers, in order and apart; ``items`` the ids, as sorted strings, of items
    with occurring windows.  Each task holds one automaton of at most ``block_words`` words; a larger
    benchmark takes one pass for each block, whose hits are joined by document id and content.

    Null and empty texts have no words and items without words have no windows; repeated rows each give their row;
    null ids stay; items that share an id count as one.  Other columns of either table are not read.
    """
    rows = with_row(docs, id_col, text_col)
    parts = blocks(benchmark, item_col, item_text, block_words)
    first = next(parts)
    more = [
        stored(_scanned(rows.drop("row"), *part, window).where(F.size("spans") > 0).select("doc_id", text_digest(F.col("text")).alias("content"), "spans", "items"), "block-hits")
        for part in parts
    ]
    out = _scanned(rows, *first, window, None if more else limits)
    if not more:
        return out
    hits = functools.reduce(DataFrame.unionByName, more).groupBy(F.col("doc_id").alias("d"), "content")
    hits = hits.agg(F.flatten(F.collect_list("spans")).alias("more_spans"), F.flatten(F.collect_list("items")).alias("more_items"))
    none = F.array().cast("array<string>")
    joined = out.join(hits, F.col("doc_id").eqNullSafe(F.col("d")) & (text_digest(F.col("text")) == F.col("content")), "left")
    out = joined.select(
        "doc_id", "text", "row", "n_words",
        _union(F.concat("spans", F.coalesce("more_spans", F.array().cast("array<array<bigint>>")))).alias("spans"),
        F.array_sort(F.array_union("items", F.coalesce("more_items", none))).alias("items"),
    )
    if not limits:
        return out
    schema = out.schema
    return out.mapInArrow(by_batch(arrow_columns(schema), lambda b: _limited({c: b.column(c) if c in ("doc_id", "text", "row") else b.column(c).to_pylist() for c in b.schema.names}, *limits)), schema)


def _union(spans: Column) -> Column:
    """Spans in order, those that touch or overlap made one."""
    out = F.array().cast("array<array<bigint>>")

    def add(out: Column, x: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        touches = last.isNotNull() & (x[0] <= last[1])
        whole = F.array(last[0], F.greatest(last[1], x[1]))
        return F.when(touches, F.concat(F.slice(out, 1, F.size(out) - 1), F.array(whole))).otherwise(F.concat(out, F.array(x)))

    return F.aggregate(F.array_sort(spans), out, add)


def n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x[1] - x[0])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", **names) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document; see ``scan_documents``."""
    found = scan_documents(docs, benchmark, window, id_col=id_col, **names)
    return found.select(
        F.col("doc_id").alias(id_col), "n_words", n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit() > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, span_limit: int = 10, coverage_limit: float = 0.5, text_col: str = "text", **names
) -> DataFrame:
    """``docs`` with the spans of ``span_limit`` words or more that items share with them cut from their texts.

    A document of which more than ``coverage_limit`` of the words are hit goes as a whole.  Null texts stay null, and
    all other columns stay as they are.
    """
    limits = (span_limit, coverage_limit)
    found = scan_documents(docs, benchmark, window, text_col=text_col, limits=limits, **names)
    return found.select(*(F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
