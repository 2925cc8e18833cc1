import numpy as np
from pyspark.sql import functions as F

from innkeeper.llm import langid
from innkeeper.llm.common import crc_fold


def train(docs, **options):
    return langid.train(docs, "doc_id", "text", "lang", **options)


def corpus(make_docs):
    en = make_docs([(i, f"the quick thing with the wheel {i} and this") for i in range(40)], "en")
    return en.unionByName(make_docs([(100 + i, f"der schnelle Zug und die Straße nicht {i}") for i in range(40)], "de"))


def test_predictions_and_defined_cases(make_docs):
    model = train(corpus(make_docs))
    docs = make_docs([(1, "with the thing"), (2, "nicht die Straße"), (3, None), (4, ""), (5, "12 !? 34"), (6, "the " * 200_000), (None, "DER ZUG"), (1, "with the thing")])
    rows = langid.predict(docs.withColumn("score", F.lit("clash")), *model).collect()
    got = sorted((str(r.doc_id), r.lang_pred, r.score == 0) for r in rows)
    assert got == [("1", "en", False), ("1", "en", False), ("2", "de", False), ("3", "und", True), ("4", "und", True), ("5", "und", True), ("6", "en", False), ("None", "de", False)]
    assert all(0 <= r.score <= 1 for r in rows)


def test_counts_come_from_every_sampled_row(make_docs):
    docs = corpus(make_docs)
    langs, matrix = train(docs, bits=12)
    sums = np.zeros((1 << 12, 2))
    for r in docs.collect():
        codes = np.array([ord(c) for c in langid.plain(r.text) + langid._PAD], np.uint64)
        for order in langid.ORDERS:
            np.add.at(sums[:, langs.index(r.lang)], langid.buckets(codes, order, 12), 1)
    want = np.log((sums + 0.5) / (sums + 0.5).sum(axis=0))
    assert langs == ["de", "en"] and np.allclose(matrix[:-1], want) and np.allclose(matrix[-1], np.log(0.5))


def test_a_score_depends_on_its_own_text_alone(monkeypatch):
    matrix = np.random.default_rng(0).normal(size=((1 << 10) + 1, 3))
    texts = ["ab cd", "", "Hello wörld " * 5, "x"]
    alone = np.vstack([langid.log_likelihoods([t], matrix, 10) for t in texts])
    for piece in (1 << 19, 7):
        monkeypatch.setattr(langid, "PIECE", piece)
        assert np.allclose(langid.log_likelihoods(texts, matrix, 10), alone)


def test_bounded_sample_and_nothing_to_learn(make_docs):
    docs = corpus(make_docs)
    langs, _ = train(docs, sample_rows=40)
    assert set(langs) <= {"de", "en"}
    empty = train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert [(r.lang_pred, r.score) for r in langid.predict(make_docs([(1, "abc")]), *empty).collect()] == [("und", 0.0)]
    assert langid.predict(make_docs([]), *train(docs)).collect() == []


def test_held_out_accuracy(spark):
    from innkeeper.llm import queries

    sf_dir = "/root/testdata/sf0.01"
    found = queries.op4_language_id(spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    held = found.join(truth, "doc_id").where("held_out").withColumn("fold", crc_fold("doc_id", 3)).collect()
    assert all(r.fold == 1 for r in held) and np.mean([r.lang == r.lang_pred for r in held]) >= 0.97
