"""Reply-ordered conversations from messages that quote each other."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.base import arrow_columns, by_batch, stored
from tidemill.operators.rank import rank_in_group

_LINE = re.compile(r"\r\n|\n|\r")
_QUOTE = re.compile(r"[ \t]*((?:>[ \t]?)+)")
#: how a line that introduces a quote ends, and how one over two lines begins
_SAYS = re.compile(r"(wrote|écrit|schrieb|escribió)\s*:\s*$")
_OPENS = re.compile(r"\s*(On|Le|Am|El)\s.*[\d,]")

#: turns (2 to this power) of one window when the latest earlier source of a quote is looked for
TURN_BITS = 10
#: what a passage found whole counts more than any number of letters
WHOLE = 1 << 40


def split_message(text: str | None) -> tuple[str, list[dict]]:
    """The text without quotes, and depth and text of each run of quoted lines of one depth; linear in the lines.

    A line of the author that ends in "wrote:", "écrit:", "schrieb:" or "escribió:" right above a quote (blank lines
    between don't count) introduces it and is no part of the text; so is the line above it, if that one begins it ("On
    Monday, 3 March, X").  The same words elsewhere are the author's own.
    """
    lines = []
    for line in _LINE.split(text or ""):
        marks = _QUOTE.match(line)
        lines.append((marks.group(1).count(">"), line[marks.end() :]) if marks else (0, line))
    runs, own, quote_next = [], [], False
    for depth, body in lines:
        if depth and runs and runs[-1][0] == depth:
            runs[-1][1].append(body)
        else:
            runs.append((depth, [body]))
    above = False  # from below: the line introduces the quote and its beginning may be in the next one
    for depth, body in reversed(lines):
        begins = above and not depth and _OPENS.match(body) is not None
        above = False
        if depth:
            quote_next = True
        elif begins:
            quote_next = False
        elif quote_next and _SAYS.search(body):
            quote_next, above = False, _OPENS.match(body) is None
        else:
            own.append(body)
            quote_next = quote_next and not body.strip()
    return "\n".join(reversed(own)).strip(" "), [{"depth": d, "text": "\n".join(x)} for d, x in runs if d]


def normalised(text: Column) -> Column:
    """Lower case, with everything but letters and digits made single spaces: what quoting may change is gone."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def passages(messages: DataFrame) -> DataFrame:
    """``messages`` with body, the text without quotes, and quoted: (depth, text) of each run of lines of one depth."""
    others = messages.drop("text").schema
    kept = arrow_columns(others)
    quoted = pa.list_(pa.struct([("depth", pa.int32()), ("text", pa.string())]))

    def split(batch: pa.RecordBatch) -> dict:
        both = [split_message(t) for t in batch.column("text").to_pylist()]
        return {**{c: batch.column(c) for c in kept}, "body": [b for b, _ in both], "quoted": [q for _, q in both]}

    names = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others)
    schema = f"{names}body string, quoted array<struct<depth:int,text:string>>"
    return messages.mapInArrow(by_batch({**kept, "body": pa.string(), "quoted": quoted}, split), schema)


def _hashes(text: Column) -> Column:
    """(hash, whole, size) of a passage as a whole and of each of its lines, after normalisation; blank ones give none."""
    lines = F.array_distinct(F.transform(F.split(text, "\n"), normalised))
    units = F.concat(F.array(F.struct(normalised(text).alias("t"), F.lit(1).alias("whole"))), F.transform(lines, lambda x: F.struct(x.alias("t"), F.lit(0).alias("whole"))))
    filled = F.filter(units, lambda u: F.length(u["t"]) > 0)
    return F.transform(filled, lambda u: F.struct(F.unhex(F.sha2(u["t"], 256)).alias("hash"), u["whole"].alias("whole"), F.length(u["t"]).cast("bigint").alias("size")))


def quote_sources(known: DataFrame) -> DataFrame:
    """conv_id, turn, depth, size, source, whole of each quoted passage and line that an earlier message holds.

    ``source`` is the latest earlier message whose body, or a line of it, has the hash.  A whole passage looks for whole
    bodies first.  Turns of a hash are searched in windows of 1,024, and windows by what the ones before them hold, so that
    a line which all messages of a conversation hold and quote is many small groups and never pairs.
    """
    bodies = known.select("conv_id", "turn", F.explode(_hashes(F.col("body"))).alias("u"))
    bodies = bodies.select("conv_id", "turn", "u.hash", F.col("turn").alias("source"), F.when(F.col("u.whole") == 1, F.col("turn")).alias("whole_source"))
    quotes = known.select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.depth", F.explode(_hashes(F.col("q.text"))).alias("u"))
    quotes = quotes.select("conv_id", "turn", "depth", "u.*")
    held = bodies.join(quotes.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")
    both = held.unionByName(quotes, allowMissingColumns=True).groupBy("conv_id", "hash", "turn").agg(
        F.max("source").alias("source"), F.max("whole_source").alias("whole_source"),
        F.min("depth").alias("depth"), F.max("whole").alias("whole"), F.max("size").alias("size"),
    )
    both = stored(both.withColumn("part", F.shiftright(F.col("turn").cast("bigint"), TURN_BITS)), "quoted")
    sources = ["source", "whole_source"]
    part = ["conv_id", "hash", "part"]
    earlier = lambda *keys, by: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    inside = both.select("*", *[F.max(c).over(earlier(*part, by="turn")).alias(f"in_{c}") for c in sources]).where("depth IS NOT NULL")
    ends = both.groupBy(*part).agg(*[F.max(c).alias(c) for c in sources])
    before = ends.select(*part, *[F.max(c).over(earlier("conv_id", "hash", by="part")).alias(f"before_{c}") for c in sources])
    near = inside.join(before, part)
    latest = {c: F.coalesce(f"in_{c}", f"before_{c}") for c in sources}
    whole = (F.col("whole") == 1) & latest["whole_source"].isNotNull()
    found = near.select("conv_id", "turn", "depth", "size", whole.alias("whole"), F.when(whole, latest["whole_source"]).otherwise(latest["source"]).alias("source"))
    return found.where("source IS NOT NULL")


def parents(read: DataFrame, across_gaps: bool = False) -> DataFrame:
    """conv_id, turn, reply_to, linked of every distinct message of ``passages``.

    A message answers the one that its quotes come from.  Each quoted passage or line, counted once with its least depth,
    votes for its source (``quote_sources``) with the length of its text, a whole passage with more than all lines: of the
    sources the one with the shallowest quote is answered, then the one with most votes, then the latest.  Without such
    a message it answers the turn before it, if there is one; ``across_gaps``: the latest earlier turn, where turns are missing.
    """
    known = read.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    worth = F.col("size") + F.when(F.col("whole"), F.lit(WHOLE)).otherwise(F.lit(0))
    votes = quote_sources(known).groupBy("conv_id", "turn", "source").agg(F.min("depth").alias("depth"), F.sum(worth).alias("votes"))
    best = votes.groupBy("conv_id", "turn").agg(F.max(F.struct(-F.col("depth"), "votes", "source")).alias("m")).select("conv_id", "turn", F.col("m.source").alias("source"))
    turns = known.select("conv_id", "turn").distinct()
    turns = rank_in_group(turns, ["conv_id"], ["turn"], "place") if across_gaps else turns.withColumn("place", F.col("turn"))
    before = turns.select("conv_id", (F.col("place") + 1).alias("place"), F.col("turn").alias("previous"))
    joined = turns.join(best, ["conv_id", "turn"], "left").join(before, ["conv_id", "place"], "left")
    return joined.select("conv_id", "turn", F.coalesce("source", "previous").alias("reply_to"), F.col("source").isNotNull().alias("linked"))


def _threads(links: DataFrame) -> DataFrame:
    """``links`` with thread, the turn that its chain of answers began with, and level, how far from it.

    By doubled steps: each round, messages that don't know their thread yet go on from where they have come to.
    """
    answers = F.col("reply_to").isNotNull()
    state = stored(links.withColumn("thread", F.coalesce("reply_to", "turn")).withColumn("level", answers.cast("int")).withColumn("open", answers), "threads")
    while not state.where("open").isEmpty():
        ahead = state.where("reply_to IS NOT NULL").select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"), F.col("level").alias("more"), F.col("open").alias("goes_on"))
        moved = state.where("open").join(ahead, ["conv_id", "thread"], "left").select(
            "conv_id", "turn", "reply_to", "linked", F.coalesce("further", "thread").alias("thread"),
            (F.col("level") + F.coalesce("more", F.lit(0))).alias("level"), F.coalesce("goes_on", F.lit(False)).alias("open"),
        )
        state = stored(state.where("NOT open").unionByName(moved), "threads")
    return state.drop("open")


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", across_gaps: bool = False) -> DataFrame:
    """conv_id, thread, level, turn, role, reply_to, linked, n_quotes, body of every message.

    Sorted by conv_id, thread, turn the messages are in reply order: an answer always has a later turn than what it answers
    and the same thread.  ``linked`` says whether the answered message was found by a quote.  Bodies are without quotes.

    Joins are on a conversation and a hash or a turn, so no conversation is ever brought together in one task.  Messages
    with a null conversation or turn answer nothing and are threads of their own; null and empty texts have an empty
    body and no quotes; repeated rows each give their row; other columns are not read.  Very long messages take time in
    proportion to their lines.  ``across_gaps``: see ``parents``.
    """
    rows = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).cast("string").alias("text"))
    read = stored(passages(rows).drop("text"), "messages")
    links = _threads(parents(read, across_gaps))
    joined = read.withColumn("n_quotes", F.size("quoted")).join(links, ["conv_id", "turn"], "left")
    return joined.select(
        F.col("conv_id").alias(conv), F.coalesce("thread", "turn").alias("thread"), F.coalesce("level", F.lit(0)).alias("level"), F.col("turn").alias(turn),
        F.col("role").alias(role), "reply_to", F.coalesce("linked", F.lit(False)).alias("linked"), "n_quotes", "body",
    )
