import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make_docs(spark, texts, source="s", lang="en"):
    """Documents numbered from 0; a text may be None."""
    return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty, blank, very long, repeated, tied and short texts."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    long = " ".join(f"w{i % 977} {i}" for i in range(40_000))
    return make_docs(spark, [None, "", " \n\t ", "one", word, word, word.upper(), long, "a b c d", "\n".join([word] * 5), "é" * 300, "x" * 700])
