"""URL rules as globs, all simulated at once by a bit-parallel automaton."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.base import arrow_type, by_batch, kind

#: bytes that the states of the rows looked at together may take, and the characters of their urls
STATE_BYTES, CELLS = 16 << 20, 4 << 20


@dataclass(frozen=True)
class Rule:
    """A glob on the canonical url and what it says.  ``?`` is one character but a slash, ``*`` any run of those, ``**``
    any run at all.  ``name`` is what is reported, and of the rules that fit the one with the longest name wins, then
    the first; a rule without a name gives a verdict where no named one fits."""

    glob: str
    verdict: str
    name: str | None = None


def below(host: str, path: str, verdict: str) -> Rule:
    """The rule for a host, all its subdomains, and the paths that begin like this."""
    literal = f"{host}{path}"
    if "*" in literal or "?" in literal:
        raise ValueError("write a glob instead")
    return Rule(f"*.{literal}**", verdict, literal)


class Automaton:
    """Shift-And with wildcards: one bit per character of every glob, packed into 64-bit words.

    Bit k of a glob says that its first k characters are matched.  A character of the url moves bits up by one place (with
    the carry from word to word) where the glob has that character or a ``?``, and lets them stay where a star
    follows.  The bit at a glob's beginning is set at the url's beginning only, and the one at its end counts at the url's
    end only, so globs match whole urls.
    """

    def __init__(self, globs: list[str]):
        moves, stays, starts, ends = [], [], [], []  # of each place: characters that lead here, whether '*' or '**' follows
        for g in globs:
            starts.append(len(moves))
            moves.append(None)
            stays.append("")
            i = 0
            while i < len(g):
                if g[i] == "*":
                    run = len(g) - i - len(g[i:].lstrip("*"))
                    stays[-1] = "**" if run > 1 or stays[-1] == "**" else "*"
                    i += run
                else:
                    moves.append(g[i])
                    stays.append("")
                    i += 1
            ends.append(len(moves) - 1)
        self.places, self.ends = len(moves), np.array(ends, dtype=np.int64)
        self.words = -(-self.places // 64)
        #: characters that some glob names have a row of masks each; all others share row 0
        self.letters = np.array(sorted({ord(c) for c in moves if c and c != "?"} | {ord("/")}), dtype=np.uint32)
        rows = len(self.letters) + 1
        move, stay = np.zeros((rows, 64 * self.words), dtype=bool), np.zeros((rows, 64 * self.words), dtype=bool)
        slash = 1 + int(np.searchsorted(self.letters, ord("/")))
        for k, (c, s) in enumerate(zip(moves, stays)):
            if c == "?":
                move[:, k] = True
                move[slash, k] = False
            elif c:
                move[1 + int(np.searchsorted(self.letters, ord(c))), k] = True
            if s:
                stay[:, k] = True
                stay[slash, k] = s == "**"
        self.move, self.stay = self._packed(move), self._packed(stay)
        first = np.zeros((1, 64 * self.words), dtype=bool)
        first[0, starts] = True
        self.start = self._packed(first)[0]

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(len(bits), self.words)

    def rows_of(self, text: str) -> np.ndarray:
        """For each character the number of its row of masks."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        return np.where(self.letters[at] == codes, at + 1, 0).astype(np.int32)

    def run(self, texts: list[str]) -> np.ndarray:
        """Whether each text (a row) is matched by each glob (a column)."""
        found = np.zeros((len(texts), len(self.ends)), dtype=bool)
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        order = np.argsort(-size, kind="stable")  # the longest first: those that still have characters come first
        at = 0
        while at < len(order):
            longest = max(1, int(size[order[at]]))
            n = max(1, min(len(order) - at, STATE_BYTES // (8 * self.words), CELLS // longest))
            found[order[at : at + n]] = self._some([texts[i] for i in order[at : at + n]], size[order[at : at + n]])
            at += n
        return found

    def _some(self, texts: list[str], size: np.ndarray) -> np.ndarray:
        chars = np.zeros((int(size[0]), len(texts)), dtype=np.int32)
        for k, t in enumerate(texts):
            chars[: size[k], k] = self.rows_of(t)
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for p in range(len(chars)):
            n = int(np.searchsorted(-size, -p, side="left"))  # texts longer than p
            now, c = state[:n], chars[p, :n]
            up = now << one
            up[:, 1:] |= now[:, :-1] >> top
            state[:n] = (up & self.move[c]) | (now & self.stay[c])
            if not state[:n].any():
                break  # no glob is alive in any of the texts that go on
        word, bit = self.ends // 64, (self.ends % 64).astype(np.uint64)
        return (state[:, word] >> bit & one).astype(bool)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, in small ASCII letters, behind the first ``://``, and the path up to a query or fragment; both are empty
    without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"\A[^?#]*", 0)
    capitals = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.translate(host, capitals, capitals.lower()), path


def judge(pages: DataFrame, rules: Iterable[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every url.

    The automaton reads ``.host/path``; the dot lets ``*.`` stand for a host and all its subdomains.  Of the named rules that
    fit the longest wins; without one, the first unnamed rule that fits gives the verdict, then ``default``.

    Nothing is shuffled.  The rules are a parameter and go to every task with its code: one bit per character and letter
    of theirs.  Null urls and those without ``://`` have empty host and path.  Every row gives one row, repeated rows and
    null ids too; an empty table gives an empty one; urls of any length are read whole; other columns are not read.
    """
    rules = list(rules)
    order = sorted(range(len(rules)), key=lambda i: (rules[i].name is None, -len(rules[i].name or ""), i))
    names, verdicts = [r.name for r in rules] + [None], [r.verdict for r in rules] + [default]
    automaton = Automaton([r.glob for r in rules])
    host, path = host_and_path(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    columns = {"page_id": arrow_type(urls.schema["page_id"].dataType)} | dict.fromkeys(("host", "path", "rule", "verdict"), pa.string())

    def rows(batch: pa.RecordBatch) -> dict:
        h, p = batch.column("host").to_pylist(), batch.column("path").to_pylist()
        found = automaton.run([f".{x}{y}" for x, y in zip(h, p)])
        ranked = np.hstack([found[:, order], np.ones((len(h), 1), dtype=bool)])
        which = np.array([*order, len(rules)])[ranked.argmax(axis=1)]
        return {"page_id": batch.column("page_id"), "host": h, "path": p, "rule": [names[i] for i in which], "verdict": [verdicts[i] for i in which]}

    schema = f"page_id {kind(urls, 'page_id')}, host string, path string, rule string, verdict string"
    return urls.mapInArrow(by_batch(columns, rows), schema).withColumnRenamed("page_id", id_col)
