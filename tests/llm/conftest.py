import sys
from pathlib import Path

import public_tokenizers
import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest int, n int, row string, label int, score string"


def documents(spark, rows):
    """A table of (doc_id, text) with the other columns of documents and names that the operators use themselves."""
    full = [(i, t, "en", "s", None if t is None else len(t), 1, 2, "r", 3, "x") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


#: nulls, empty and blank texts, a repeated row, a repeated id, a long text and a null id
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "alpha beta gamma delta epsilon zeta"), (5, "alpha beta gamma delta epsilon zeta"),
    (5, "alpha beta gamma delta epsilon zeta"), (6, "one"), (7, "é ß 中文 İ Σ x' 12,3 <|endoftext|> don't"), (8, "word " * 30_000), (9, "two words"),
    (9, "something else than before, with the same id"), (None, "a text of no id at all"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, ODD).cache()


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def word_bpe():
    return public_tokenizers.path("word_bpe_49k.json")
