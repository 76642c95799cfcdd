import random
import time

import pytest

from tidemill.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(text):
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def units(text):
    """(normalised text, whether it is the whole) of a passage and its lines."""
    return {(u, w) for u, w in [(plain(text), True), *((plain(x), False) for x in text.split("\n"))] if u}


def plain_parents(messages):
    """turn -> (reply_to, linked) of one conversation, by looking at every pair of messages."""
    split = {t: quotes.split_message(text) for t, text in messages}
    turns = sorted(split)
    out = {}
    for t in turns:
        quoted = {}
        for q in split[t][1]:
            for u, w in units(q["text"]):
                depth, whole = quoted.get(u, (99, False))
                quoted[u] = (min(depth, q["depth"]), whole or w)
        votes = {}
        for u, (depth, whole) in quoted.items():
            held = [(s, {w for x, w in units(split[s][0]) if x == u}) for s in turns if s < t]
            wholes = [s for s, w in held if True in w and whole]
            source = max(wholes or [s for s, w in held if w], default=None)
            if source is not None:
                d, v = votes.get(source, (99, 0))
                votes[source] = (min(d, depth), v + len(u) + (quotes.WHOLE if wholes else 0))
        before = max((s for s in turns if s < t), default=None)
        best = max(votes, key=lambda s: (-votes[s][0], votes[s][1], s), default=None)
        out[t] = (before, False) if best is None else (best, True)
    return out


@pytest.mark.parametrize("bits", [10, 2])
def test_random_threads_against_all_pairs(spark, monkeypatch, bits):
    """Lines of few words that often repeat, quotes of quotes, gaps between turns, negative turns."""
    monkeypatch.setattr(quotes, "TURN_BITS", bits)
    rng = random.Random(bits)
    rows, want = [], {}
    for conv in range(4):
        said = []
        for turn in sorted(rng.sample(range(-20, 60), 30)):
            lines = []
            for old in rng.sample(said, min(len(said), rng.randint(0, 2))):
                took = old.split("\n")[: rng.randint(1, 4)]
                lines += ["> " * rng.randint(1, 2) + x for x in took]
            lines += [" ".join(rng.choices(["ok", "yes", "no", "why not", "Zürich"], k=rng.randint(1, 3))) for _ in range(rng.randint(1, 3))]
            said.append("\n".join(lines))
            rows.append((conv, turn, "u", said[-1]))
        want.update({(conv, t): r for t, r in plain_parents([(r[1], r[3]) for r in rows if r[0] == conv]).items()})
    got = quotes.link_quotes(spark.createDataFrame(rows, SCHEMA), across_gaps=True).collect()
    assert {(r["conv_id"], r["turn"]): (r["reply_to"], r["linked"]) for r in got} == want
    assert sum(linked for _, linked in want.values()) > 40


def test_a_line_that_all_hold_and_quote(spark):
    rows = [(1, i, "u", f"> ok\nok\nnumber {i}" if i else "ok") for i in range(2500)]
    got = {r["turn"]: r["reply_to"] for r in quotes.link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()}
    # the whole first message is "ok", which is what every later one quotes
    assert got == {0: None, **{i: 0 for i in range(1, 2500)}}
    read = quotes.passages(spark.createDataFrame(rows, SCHEMA))
    assert quotes.quote_sources(read).count() == 2499


def test_very_long_messages_are_linear():
    times = []
    for n in (20_000, 100_000):
        text = "\n".join(f"{'> ' * (i % 3)}line {i}" for i in range(n))
        start = time.process_time()
        body, quoted = quotes.split_message(text)
        times.append(time.process_time() - start)
        assert body.count("\n") + 1 == -(-n // 3) and len(quoted) == n // 3 * 2 + max(0, n % 3 - 1)
    assert times[1] < 5


@pytest.mark.parametrize(
    "text, body",
    [
        ("As I wrote:\nno quote here.\n> x\nEnd.", "As I wrote:\nno quote here.\nEnd."),
        ("Hi.\nOn Mon, 3 March, X\n<x@y> wrote:\n\n> a\n> b\nFine.", "Hi.\n\nFine."),
        ("On Mon, 3 March, we met.\nBob wrote:\n> a", ""),
        ("We met in March.\nBob wrote:\n> a", "We met in March."),
        ("Am 3. Mai schrieb:\n> a\nJa.", "Ja."),
        ("On 3 May, we saw it.\nOn 4 May, Bob wrote:\n> a", "On 3 May, we saw it."),
        ("> a\nAs Ann wrote:", "As Ann wrote:"),
        (None, ""),
        ("", ""),
    ],
)
def test_only_lines_next_to_a_quote_introduce_it(text, body):
    assert quotes.split_message(text)[0] == body


def test_turns_with_gaps(spark):
    df = spark.createDataFrame([(1, 1, "u", "a"), (1, 3, "u", "b"), (1, 3, "u", "b"), (2, 9, "u", "c")], SCHEMA)
    reply = lambda **more: sorted((r["conv_id"], r["turn"], r["reply_to"] or 0) for r in quotes.link_quotes(df, **more).collect())
    assert reply(across_gaps=True) == [(1, 1, 0), (1, 3, 1), (1, 3, 1), (2, 9, 0)]
    assert reply() == [(1, 1, 0), (1, 3, 0), (1, 3, 0), (2, 9, 0)]
