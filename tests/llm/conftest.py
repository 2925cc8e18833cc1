import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """A documents table from (doc_id, text) pairs, in two partitions."""

    def make(pairs, lang=None):
        rows = [(i, t, lang, None, None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOC_SCHEMA).repartition(2)

    return make


@pytest.fixture
def prose():
    """``prose(seed, n)``: n invented words, the same for the same seed."""

    def make(seed, n):
        rnd = random.Random(seed)
        return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 7))) for _ in range(n))

    return make
