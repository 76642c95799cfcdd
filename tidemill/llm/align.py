"""Tokens of two tokenizers over the same bytes: groups, links, and how often linked ids meet in the corpus."""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemill.llm.base import arrow_type, give_back, kind, stored, two
from tidemill.llm.encode import JOINED, WORD_ROOM, gathered, slices

#: UTF-8 bytes of texts whose links share a table of id pairs, and of texts that the tokenizers are given at once
BLOCK_BYTES, CALL_BYTES = 4 << 20, 1 << 20
#: ends that are compared first
PROBE = 4
#: what each of the two generations of units may take
ROOM = 80 << 20
#: white space of any kind, and a space beside some or at an end of a text
_WHITE = "[\\x09-\\x0d\\x1c-\\x20\\x85\\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"
WHITE = re.compile(_WHITE)
BESIDE_SPACE = rf" {_WHITE}|{_WHITE} |\A | \z"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, the others are
    numbered from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(other)}


class ByteLevel:
    """A byte-level tokenizer of the tokenizers library; special strings inside texts are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.tokenizer.encode_special_tokens = True
        letters, vocab = byte_letters(), self.tokenizer.get_vocab()
        self.pieces = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.pieces[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        first = spec.get("pre_tokenizer") or {}
        #: the library's own pattern begins a token at each space that stands alone
        self.by_unit = spec.get("normalizer") is None and first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space")

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """A sentencepiece model, which puts a space before the text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = []
        for i in range(self.model.get_piece_size()):
            p = self.model.id_to_piece(i)
            self.pieces.append(bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode())
        #: no piece reaches over a space into what is before it, and texts aren't normalised
        self.by_unit = not any(b" " in p.lstrip(b" ") for p in self.pieces) and self._back(" ﬁ  A\u030a\u00a0①\t ")

    def _back(self, text: str) -> bool:
        return b"".join(self.pieces[i] for i in self.model.encode(text)) == f" {text}".encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Tokens:
    """Both tokenizers with the lengths of their tokens and the decimal ids as they stand in a list of groups.

    Where both begin a token at every space between two other characters, the ids of what stands between such
    spaces are looked up: each distinct unit is encoded once and kept, in two generations of at most ``room`` bytes.
    """

    def __init__(self, path_a: str, path_b: str, room: int = ROOM):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.sizes = [np.array([len(p) for p in t.pieces], dtype=np.int64) for t in (self.a, self.b)]
        self.width = len(self.b.pieces)
        #: the decimal ids of a with , or | behind them, then those of b with , or ;
        self.written = np.array([f"{i}{end}" for t, ends in ((self.a, ",|"), (self.b, ",;")) for end in ends for i in range(len(t.pieces))], dtype="S")
        self.by_unit = self.a.by_unit and self.b.by_unit
        self.known: dict[str, tuple[bytes, bytes, bool]] = {}
        self.older: dict[str, tuple[bytes, bytes, bool]] = {}
        self.room, self.held = room, 0

    def both(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of each text by both; none where one of them doesn't give back the bytes of a space and the text."""
        none = np.zeros(0, dtype=np.int64)
        whole = texts.to_pylist()
        if self.by_unit:
            units, bounds = self._units(texts, whole)
            coded = units.dictionary_encode()
            which, known = coded.indices.to_numpy(), self._known(coded.dictionary.to_pylist())
            right = np.array([k[2] for k in known], dtype=bool)[which]
            sides = [(ids.astype(np.int64) for ids in gathered([k[i] for k in known], which, bounds)) for i in (0, 1)]
        else:
            sides = [[np.array(ids, dtype=np.int64) for ids in t.ids(whole)] for t in (self.a, self.b)]
            right, bounds = np.zeros(len(whole), dtype=bool), range(len(whole) + 1)
        for i, (text, a, b) in enumerate(zip(whole, *sides)):
            sure = right[bounds[i] : bounds[i + 1]].all()
            yield (a, b) if text and (sure or self._same(text, a, b)) else (none, none)

    def _same(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        return b"".join(map(self.a.pieces.__getitem__, a.tolist())) == f" {text}".encode() == b"".join(map(self.b.pieces.__getitem__, b.tolist()))

    def _units(self, texts: pa.Array, whole: list[str]) -> tuple[pa.Array, np.ndarray]:
        """What stands between single spaces, and where each text's units begin and end.  A space beside other white
        space is no border, and stays in its unit."""
        odd = pc.match_substring_regex(texts, BESIDE_SPACE).to_numpy(zero_copy_only=False)
        parts = pc.split_pattern(texts, " ")
        if not odd.any():
            bounds = parts.offsets.to_numpy()
            return parts.flatten(), bounds - bounds[0]
        size, pieces, at = pc.list_value_length(parts).to_numpy().copy(), [], 0
        for i in np.flatnonzero(odd).tolist():
            units = []
            for p in whole[i].split(" "):
                if units and not (p and units[-1] and not WHITE.match(p[0]) and not WHITE.match(units[-1][-1])):
                    units[-1] = f"{units[-1]} {p}"
                else:
                    units.append(p)
            size[i] = len(units)
            pieces += [parts.slice(at, i - at).flatten(), pa.array(units, type=pa.string())]
            at = i + 1
        return pa.concat_arrays([*pieces, parts.slice(at).flatten()]), np.concatenate([[0], np.cumsum(size)])

    def _known(self, units: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """The ids of distinct units by both, and whether both give back a space and the unit."""
        if self.held > self.room:
            self.older, self.known, self.held = self.known, {}, 0
        found = list(map(self.known.get, units))
        missing = [i for i, x in enumerate(found) if x is None]
        fresh, alone = [], []
        for i in missing:
            u = units[i]
            if u in self.older:
                self._keep(u, self.older[u])
            else:
                (alone if not u or WHITE.match(u[0]) or WHITE.match(u[-1]) else fresh).append(u)
        for at in range(0, len(fresh), JOINED):
            self._learn(fresh[at : at + JOINED])
        for u in alone:
            self._learn([u])
        for i in missing:
            found[i] = self.known[units[i]]
        return found

    def _keep(self, unit: str, ids: tuple[bytes, bytes, bool]) -> None:
        self.known[unit] = ids
        self.held += 2 * WORD_ROOM + len(unit) + len(ids[0]) + len(ids[1])

    def _learn(self, units: list[str]) -> None:
        """Encode units as one text and take it apart again where they end."""
        text = " ".join(units)
        ends, sides = np.cumsum([len(u.encode()) + 1 for u in units]), []
        a, b = (np.array(t.ids([text])[0], dtype=np.int64) for t in (self.a, self.b))
        same = self._same(text, a, b)
        if not same and len(units) > 1:
            for u in units:
                self._learn([u])
            return
        for ids, size in zip((a, b), self.sizes):
            stops = np.searchsorted(np.cumsum(size[ids]), ends, side="right").tolist() if len(units) > 1 else [len(ids)]
            raw = ids.astype("<u4").tobytes()
            sides.append([raw[4 * at : 4 * to] for at, to in zip([0, *stops], stops)])
        for u, x, y in zip(units, *sides):
            self._keep(u, (x, y, same))


@lru_cache(maxsize=1)
def _tokens(path_a: str, path_b: str) -> Tokens:
    return Tokens(path_a, path_b)


def inner_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[int], list[int], list[int], list[int]]:
    """Where two rising lists of ends, of which the last are the same, disagree: diagonal run skipping.

    While the ends at i and i + shift agree, tokens stand one to one; how far that goes is probed by comparing ``PROBE``, then
    twice as many ends at once and so on, and halving at the first difference.  Where they differ, the token that ends first is stepped over
    until both end together; that is one irregular group, and the shift becomes what is then between the indices.

    Gives the tokens of a and of b that end inside a group, and for each of these steps the tokens (i, j) that stood there:
    they overlap, and so do the last tokens of each group.
    """
    raw_a, raw_b = ends_a.astype(np.int64).tobytes(), ends_b.astype(np.int64).tobytes()
    a, b = array("q", raw_a), array("q", raw_b)
    n, i, shift = len(a), 0, 0  # shift in bytes, as are the places in the raw ends
    inside_a, inside_b, at_a, at_b = [], [], [], []
    while i < n:
        step, at = 8 * PROBE, 8 * i
        while at < 8 * n and raw_a[at : at + step] == raw_b[at + shift : at + shift + step]:
            at += step
            step *= 2
        while step > 8 and at < 8 * n:
            step //= 2
            if raw_a[at : at + step] == raw_b[at + shift : at + shift + step]:
                at += step
        if at >= 8 * n:
            break
        p, q = at // 8, (at + shift) // 8
        while a[p] != b[q]:
            at_a.append(p)
            at_b.append(q)
            if a[p] < b[q]:
                inside_a.append(p)
                p += 1
            else:
                inside_b.append(q)
                q += 1
        i, shift = p + 1, 8 * (q - p)
    return inside_a, inside_b, at_a, at_b


def align(tokens: Tokens, x: np.ndarray, y: np.ndarray) -> tuple[int, np.ndarray, bytes]:
    """How many groups there are, the code a * width + b of each link, and the groups as text."""
    inside_a, inside_b, at_a, at_b = inner_ends(*(np.cumsum(size[ids]) for size, ids in zip(tokens.sizes, (x, y))))
    last_a, last_b = np.ones(len(x), dtype=bool), np.ones(len(y), dtype=bool)
    last_a[inside_a], last_b[inside_b] = False, False
    links = np.concatenate([x[last_a] * tokens.width + y[last_b], x[at_a] * tokens.width + y[at_b]])
    # a token's place in the text: behind the tokens of its own side before it, and those of the other in groups before
    # its own, for b in its own too
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    until_a, until_b = np.flatnonzero(last_a) + 1, np.concatenate([[0], np.flatnonzero(last_b) + 1])
    order = np.empty(len(x) + len(y), dtype=np.int64)
    n_a, n_b = len(tokens.a.pieces), len(tokens.b.pieces)
    order[np.arange(len(x)) + until_b[group_a]] = x + last_a * n_a
    order[np.arange(len(y)) + until_a[group_b]] = y + last_b * n_b + 2 * n_a
    text = tokens.written[order].tobytes().translate(None, b"\0")[:-1]
    return len(until_a), links, text


def linked(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of (doc_id, text) with their counts and groups, block by block.

    A row of a document has the distinct codes of its links (``codes``) and how often each occurs (``times``); a row
    without ``part = 'doc'`` has the codes of a whole block of documents and in how many of them each is.
    """
    columns = {
        "part": pa.string(), "block": pa.int64(), "doc_id": arrow_type(docs.schema["doc_id"].dataType), "n_a": pa.int64(), "n_b": pa.int64(),
        "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "codes": pa.list_(pa.int64()), "times": pa.list_(pa.int64()),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, block = _tokens(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            for texts in slices(pc.fill_null(batch.column("text"), ""), BLOCK_BYTES):
                out = {c: [] for c in columns}
                for few in slices(texts, CALL_BYTES):
                    for a, b in tokens.both(few):
                        groups, links, text = align(tokens, a, b) if len(a) else (0, np.zeros(0, dtype=np.int64), None)
                        codes, times = np.unique(links, return_counts=True)
                        row = (len(a), len(b), groups, len(links), "" if text is None else hashlib.sha256(text).hexdigest(), codes, times)
                        for c, v in zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"), row):
                            out[c].append(v)
                ids = batch.column("doc_id").slice(at, len(texts))
                at += len(texts)
                codes, holders = np.unique(np.concatenate(out["codes"]), return_counts=True)
                for c, v in (("n_a", 0), ("n_b", 0), ("n_groups", 0), ("n_links", 0), ("groups_sha256", ""), ("codes", codes), ("times", holders)):
                    out[c].append(v)
                out["part"], out["block"] = ["doc"] * len(texts) + ["block"], [block] * (len(texts) + 1)
                out["doc_id"] = pa.concat_arrays([ids, pa.nulls(1, ids.type)])
                block += 1
                yield pa.RecordBatch.from_arrays([pa.array(out[c], type=t) for c, t in columns.items()], names=list(columns))
        give_back()

    schema = f"part string, block bigint, doc_id {kind(docs, 'doc_id')}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, codes array<bigint>, times array<bigint>"
    return docs.mapInArrow(run, schema)


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``.

    Each text is encoded and aligned once.  Documents are dealt to blocks of ``BLOCK_BYTES`` of text; a block gives every id
    pair once with the number of its documents that hold it, so a pair that all documents hold is few rows of the
    shuffle.  The corpus-wide counts go back to the blocks that hold the pairs, where the links of a document are looked up:
    a task holds one block and its pairs, which the block's size bounds, and nothing of the corpus.

    Null and empty texts, and texts whose bytes one of the tokenizers doesn't give back, have zeros and ''.  Each row
    counts as a document of its own, repeated rows and ids too; null ids stay null; an empty table gives an empty one.
    A text longer than a block is a block alone.  Other columns are not read.
    """
    found = stored(linked(two(docs, id_col, text_col), path_a, path_b), "alignment")
    width = _tokens(path_a, path_b).width
    pairs = found.where("part = 'block'").select("block", F.explode(F.arrays_zip("codes", "times")).alias("x")).select("block", F.col("x.codes").alias("code"), F.col("x.times").alias("n"))
    counts = pairs.groupBy("code").agg(F.sum("n").alias("n")).withColumn("a", F.floor(F.col("code") / width))
    counts = stored(counts, "alignment-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = counts.join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    needed = pairs.select(F.col("block").alias("holder"), "code").join(counts, "code").select("holder", "code", "n", "best")
    texts = found.where("part = 'doc'").drop("part")
    names = {"doc_id": found.schema["doc_id"].dataType} | {c: found.schema[c].dataType for c in ("n_a", "n_b", "n_groups", "n_links")}
    columns = {c: arrow_type(t) for c, t in names.items()} | {"n_best": pa.int64(), "count_sum": pa.int64(), "groups_sha256": pa.string()}

    def look_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        code = known.column("code").to_numpy()
        order = np.argsort(code)
        code, n, best = code[order], known.column("n").to_numpy()[order], known.column("best").to_numpy()[order]
        held = rows.column("codes").combine_chunks()
        at = np.searchsorted(code, held.flatten().to_numpy())
        times = rows.column("times").combine_chunks().flatten().to_numpy()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(held).to_numpy())])
        totals = [np.diff(np.concatenate([[0], np.cumsum(times * v[at])])[bounds]) for v in (best.astype(np.int64), n)]
        out = {c: rows.column(c) for c in columns if c in rows.column_names} | {"n_best": totals[0], "count_sum": totals[1]}
        return pa.table({c: pa.chunked_array([pa.array(out[c], type=t)]) if isinstance(out[c], np.ndarray) else out[c].cast(t) for c, t in columns.items()})

    schema = ", ".join(f"{c} {t.simpleString()}" for c, t in names.items()) + ", n_best bigint, count_sum bigint, groups_sha256 string"
    done = texts.groupBy("block").cogroup(needed.groupBy("holder")).applyInArrow(look_up, schema)
    return done.withColumnRenamed("doc_id", id_col)
