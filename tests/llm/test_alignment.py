import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemill.llm import align
from tidemill.session import table

from .conftest import ODD, documents

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain_tokens(text):
    """(id, from, to) by both, straight from the libraries; None where the bytes aren't those of the text."""
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    letters = {v: bytes([k]) for k, v in enumerate(next(c for c, x in align.byte_letters().items() if x == n) for n in range(256))}
    out = []
    for parts in (
        [(i, b"".join(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
        [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]],
    ):
        at, spans = 0, []
        for i, raw in parts:
            spans.append((i, at, at + len(raw)))
            at += len(raw)
        if b"".join(raw for _, raw in parts) != (" " + text).encode():
            return None
        out.append(spans)
    return out


def brute_force(rows):
    docs, count = [], Counter()
    for i, text in rows:
        both = plain_tokens(text) if text else None
        links = [(x, y) for x, s, t in both[0] for y, u, v in both[1] if s < v and u < t] if both else []
        count.update(set(links))
        docs.append((i, both, links))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for i, both, links in docs:
        if not both:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = both
        ends = sorted({t for _, _, t in a} & {t for _, _, t in b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(x) for x, _, t in side if start < t <= end) for side in (a, b)))
            start = end
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((i, len(a), len(b), len(ends), len(links), sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links), sha))
    return sorted(out, key=repr)


def test_inner_ends_against_sets():
    rng = random.Random(5)
    for _ in range(400):
        n = rng.randint(1, 60)
        a, b = (sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n}) for _ in range(2))
        if rng.random() < 0.5:  # long stretches one to one
            b = sorted({*a, *rng.sample(range(1, n + 1), min(n, 2))} - {*rng.sample(a[:-1], min(1, len(a) - 1))})
        inside_a, inside_b, at_a, at_b = align.inner_ends(np.array(a), np.array(b))
        assert [a[i] for i in inside_a] == sorted(set(a) - set(b)) and [b[j] for j in inside_b] == sorted(set(b) - set(a))
        spans = lambda e: list(zip([0, *e[:-1]], e))
        links = {(i, j) for i, (s, t) in enumerate(spans(a)) for j, (u, v) in enumerate(spans(b)) if s < v and u < t}
        last = zip([i for i, e in enumerate(a) if e in b], [j for j, e in enumerate(b) if e in a])
        assert links == {*zip(at_a, at_b), *last} and len(links) == len(at_a) + len(set(a) & set(b))


@pytest.mark.parametrize("block", [1, 300, 4 << 20])
def test_against_brute_force(spark, monkeypatch, block):
    rng = random.Random(2)
    parts = ["the ", "of", " ", "  ", "\n", "Straße", "中文", "😀", "don't ", "<|endoftext|>", "</s>", "<0x41>", "12345", "antidisestablishment", "ing ", "é", "e\u0301", "ﬁ", "\t", "unk", "\x00"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(1, 30)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "▁ is written"), (63, "the same"), (63, "the same"), (64, " "), (None, "no id"), (65, "a " * 300)]
    monkeypatch.setattr(align, "BLOCK_BYTES", block)
    got = align.alignment(documents(spark, rows).repartition(3), *PATHS)
    assert got.columns == NAMES
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force(rows)


def test_odd_rows_and_none(spark, odd, none, sf):
    got = sorted(map(tuple, align.alignment(odd, *PATHS).collect()), key=repr)
    assert [r[0] for r in got] == [i for i, _ in sorted(ODD, key=lambda r: repr((r[0],)))]
    assert all(r[1:] == (0, 0, 0, 0, 0, 0, "") for r in got if r[0] in (1, 2))
    assert align.alignment(none, *PATHS).collect() == []
    rows = align.alignment(table(spark, sf, "documents"), *PATHS)
    assert rows.where("n_links != n_a + n_b - n_groups OR n_best > n_links OR count_sum < n_links").count() == 0
