import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from innkeeper.llm import toxicity as X


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return X.train(docs, labels, "doc_id", "text", "toxic")


def test_trigrams_of_all_rows(make_docs):
    counts = X.count_trigrams(make_docs([(1, "Ab, a"), (2, "ab"), (3, None), (4, "")]), "text")
    a, b = X.letter_symbol("a"), X.letter_symbol("b")
    assert counts[0, a, b] == 2 and counts[a, b, 0] == 2 and counts[0, a, 0] == 1 and counts[a, 0, 0] == 0
    assert np.allclose(np.exp(X.language_model(counts)).sum(axis=2), 1, atol=1e-4)


@pytest.mark.parametrize("span", ["1d10t", "$$0", "a.b.c", "looove", "p 4 t", "!|+"])
def test_viterbi_finds_the_best_path(span):
    model = X.language_model(np.random.default_rng(1).integers(0, 40, (X.SYMBOLS,) * 3))

    def cost(path):
        text, total, p, q = "".join(t for t, _ in path), sum(c for _, c in path), 0, 0
        for letter in text:
            total += model[p, q, X.letter_symbol(letter)]
            p, q = q, X.letter_symbol(letter)
        return total + model[p, q, 0], text

    best = max(itertools.product(*X.lattice(span)), key=lambda path: cost(path)[0])
    assert X.viterbi(span, model) == cost(best)[1]


@pytest.mark.parametrize("span", ["1d10t", "m0r0n", "i d i o t", "s-t-u-p-i-d", "looooser", "$cum", "p@th3tic", "(tr@sh)"])
def test_disguised_words_are_caught(model, span):
    scorer = X.Scorer(model)
    assert scorer.score(f"And thndor with {span} of the eainth.") >= 0.5
    assert scorer.score("And thndor with the of the eainth. Call 555-1234 or see x2y, 3 a b!!") < 0.5


def test_ordinary_text_is_left_alone(model):
    text = "the thntea, (on) 12 34!! of%%% http://a.b/c"
    assert X.Restorer(model.characters).restore(text) == text


def test_scores_of_defined_cases(model, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "..."), (4, "idiot " * 100_000), (None, "moron loser"), (4, "nothing")])
    rows = X.score(docs.withColumn("score", F.lit("clash")), model, restored_col="restored").collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert {(r.text or "")[:5]: r.predicted for r in rows} == {"": 0, "...": 0, "idiot": 1, "moron": 1, "nothi": 0}
    assert X.score(make_docs([]), model).collect() == []


def test_nothing_to_learn(spark, make_docs):
    docs = make_docs([(1, "a"), (2, "b")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in X.score(docs, X.train(docs, none, "doc_id", "text", "toxic")).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert {r.score for r in X.score(docs, X.train(docs, one, "doc_id", "text", "toxic")).collect()} == {1.0}
