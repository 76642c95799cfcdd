import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from tidemill.llm import decontaminate
from tidemill.llm.base import stored
from tidemill.session import table

from .test_documents import plain_components, plain_hits

import __spark_entry__ as entry


def test_stages_against_plain_versions(spark, sf):
    docs = table(spark, sf, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, sf), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns
            assert docs.exceptAll(before).isEmpty()
    good = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    ids = {n: {r["doc_id"] for r in d.select("doc_id").distinct().collect()} for n, d in kept.items()}
    first = {r["doc_id"] for r in table(spark, sf, "documents").collect()}
    assert sum((i in ids["quality"]) == bool(q) for i, q in good.items()) >= 0.95 * len(good)
    assert len(ids["language"]) >= 0.98 * len(ids["quality"]) and ids["quality"] < first

    rows = [(r["doc_id"], r["text"]) for r in kept["language"].collect()]
    assert ids["near_dedup"] == {i for i, _, _, keep in plain_components(rows, 5, 80) if keep}

    items = [(str(r["item_id"]), decontaminate.words_of((r["text"] or "").encode())) for r in table(spark, sf, "benchmark").collect()]
    texts = {r["doc_id"]: r["text"] for r in kept["near_dedup"].collect()}
    windows = {b" ".join(w[i : i + 10]) for _, w in items for i in range(max(1, len(w) - 9))}
    some = {i: t for i, t in texts.items() if any(x in b" ".join(decontaminate.words_of(t.encode())) for x in windows)}
    dirty = {i for i, t in some.items() if plain_hits(decontaminate.words_of(t.encode()), items, 10)[0]}
    assert ids["decontamination"] == ids["near_dedup"] - dirty

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = docs.collect()
    want = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in kept["decontamination"].collect()}
    got = {}
    for r in packed:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want
    assert len({r["sequence_id"] for r in packed}) <= 1.01 * -(-sum(want.values()) // corpus_pipeline.SEQUENCE) + 1


def test_odd_rows_pass_all_stages(spark, sf, odd, none):
    for start in (odd, none):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf), name)
        assert docs.columns[:3] == ["doc_id", "piece", "start"]


def test_every_operator_has_its_query():
    names = list(entry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
