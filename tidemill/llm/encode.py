"""Token ids of whole texts by the tokenizers library."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: UTF-8 bytes of texts that are looked at together
SLICE_BYTES = 4 << 20
#: words put into one text for the library
JOINED = 64
#: room that a word takes beside its letters and ids: two objects and a place in a dict
WORD_ROOM = 150
#: what each of the two generations of words may take
ROOM = 48 << 20
#: marks that may compose with the letter before them
COMBINING = "[\u0300-\u036f]"
#: a full stop or comma that is a token of its own: a Latin letter before it, white space or nothing behind it.  I with
#: a dot (U+0130) is left out, for its lower case ends with a combining mark that joins the full stop.
LAST_MARK = "([a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f])([.,])(\\s|$)"


@lru_cache(maxsize=1)
def _kept(path: str, version: str) -> WordEncoder:
    return WordEncoder(path)


def encoder_of(path: str) -> WordEncoder:
    """The encoder of this worker process for a tokenizer file.  Tasks that follow each other in one process find the
    words of those before; a file with other content is another encoder, and only the last one is kept."""
    with open(path, "rb") as f:
        return _kept(path, hashlib.sha256(f.read()).hexdigest())


class WordEncoder:
    """Ids of whole texts, with the ids of words seen before kept in memory.

    The library is asked once for each new word.  That gives the ids of the whole
    text only where no token reaches over white space, so every other tokenizer
    gets whole texts.  Words are kept in two generations of at most ``room`` bytes;
    the older one is let go when the younger is full.
    """

    def __init__(self, path: str, room: int = ROOM):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        vocab = self.tokenizer.get_vocab()
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix) and _drops_white_space(spec)
        self.lowers = _steps(spec.get("normalizer"), "normalizers") >= {"Lowercase"}
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        if self.by_word:
            self.ends[[i for word, i in vocab.items() if word.endswith(suffix)]] = True
        self.room, self.held = room, 0
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers, in order.  A null text has none."""
        for part in slices(pc.fill_null(texts, "")):
            if not self.by_word:
                yield from map(self._ids, part.to_pylist())
                continue
            which, bounds, ids = self._split(part)
            for some in gathered(ids, which, bounds):
                yield some.tobytes()

    def count(self, texts: pa.Array) -> Iterator[int]:
        """How many ids each text has."""
        for part in slices(pc.fill_null(texts, "")):
            if not self.by_word:
                yield from (len(self._ids(t)) // 4 for t in part.to_pylist())
                continue
            which, bounds, ids = self._split(part)
            size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
            to = np.concatenate([[0], np.cumsum(size[which])])[bounds]
            yield from np.diff(to).tolist()

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """The number of each word among the distinct ones, where each text's words begin and end, and the ids of the
        distinct words."""
        words = pc.ascii_split_whitespace(self._plain(texts))
        coded = words.flatten().dictionary_encode()
        bounds = words.offsets.to_numpy()
        return coded.indices.to_numpy(), bounds - bounds[0], self._words(coded.dictionary.to_pylist())

    def _plain(self, texts: pa.Array) -> pa.Array:
        """The texts with fewer distinct words and the same ids: ASCII letters in lower case, if the tokenizer makes
        them so, and a space before a full stop or comma that stands between a letter and white space.

        Texts that hold a special string in any case stay as they are, and texts with combining marks, which may
        compose with a small letter but not with its capital, keep their case.
        """
        special = pc.match_substring_regex(texts, COMBINING)
        plain = pc.if_else(special, texts, pc.ascii_lower(texts)) if self.lowers else texts
        plain = pc.replace_substring_regex(plain, LAST_MARK, r"\1 \2\3")
        for s in self.special:
            plain = pc.if_else(pc.match_substring(texts, s, ignore_case=True), texts, plain)
        return plain

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        if self.held > self.room:
            self.older, self.known, self.held = self.known, {"": b""}, 0
        ids = list(map(self.known.get, words))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            self._learn([words[i] for i in missing])
            for i in missing:
                ids[i] = self.known[words[i]]
        return ids

    def _keep(self, word: str, ids: bytes) -> None:
        self.known[word] = ids
        self.held += WORD_ROOM + len(word) + len(ids)

    def _learn(self, missing: list[str]) -> None:
        plain, rest = [], []
        for w in missing:
            if w in self.older:
                self._keep(w, self.older[w])
            elif w.isalpha():
                plain.append(w)
            else:
                rest.append(w)
        parts = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        coded = self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
        for part, e in zip(parts, coded):
            ids = np.array(e.ids, dtype="<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stops) != len(part):
                rest.extend(part)  # a letter that is no longer one when the library has normalised it
                continue
            raw, at = ids.tobytes(), 0
            for w, stop in zip(part, stops.tolist()):
                self._keep(w, raw[at:stop])
                at = stop
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self._keep(w, np.array(e.ids, dtype="<u4").tobytes())


def gathered(ids: list[bytes], which: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """The ids of texts: those of their words, of which the distinct ones have ``ids``."""
    size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
    pool, first = np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(size) - size
    each = size[which]
    to = np.cumsum(each)
    # the place in the pool of every id: where its word begins there, and how far it is into the word
    flat = pool[np.repeat(first[which] - (to - each), each) + np.arange(to[-1] if len(to) else 0)]
    stops = np.concatenate([[0], to])[bounds].tolist()
    for at, end in zip(stops[:-1], stops[1:]):
        yield flat[at:end]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The texts in slices of at most so many UTF-8 bytes; a longer text is a slice alone."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + most, side="right")))
        yield texts.slice(at, to - at)
        at = to


def _steps(spec: dict | None, parts: str) -> set[str]:
    """The types of a step of the tokenizer, or of the steps it is a sequence of."""
    return {x["type"] for x in (spec or {}).get(parts, [spec] if spec else [])}


def _drops_white_space(spec: dict) -> bool:
    """Whether the tokenizer itself splits at white space and drops it, so that no token can hold any."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    split = next((s for s in steps if s["type"] == "Split"), {})
    pattern = (split.get("pattern") or {}).get("Regex", "")
    added = spec.get("added_tokens", [])
    return bool(
        split.get("invert")
        and split.get("behavior") == "Removed"
        and "[\\p{L}]+" in pattern
        and "[^\\s\\p{L}\\p{N}]+" in pattern
        and not any(t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"]) for t in added)
    )
