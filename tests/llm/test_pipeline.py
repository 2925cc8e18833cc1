import os
import shutil

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from innkeeper.llm import queries

PASSAGE_WORDS = 60


def test_stages_and_planted_cases(spark, prose, tmp_path):
    """Planted cases among real rows: each goes or is cut where it should, clean ones stay whole."""
    sf = "/root/testdata/sf0.01"
    passage, copied = prose(1, PASSAGE_WORDS), prose(2, 100)
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    base = 10_000_000
    planted = [
        (base + 1, "And thndor you idiot and m0r0n, l o s e r, pathetic " + prose(3, 80)),
        (base + 2, copied), (base + 3, copied), (base + 4, copied + " "),
        (base + 5, prose(4, 70) + " " + passage), (base + 6, passage + " " + prose(5, 70)),
        (base + 7, prose(6, 30) + " " + bench + " " + prose(7, 30)),
        (base + 8, prose(8, 90)), (base + 9, None), (None, prose(9, 90)),
    ]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    more = spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in planted], docs.schema)
    folder = tmp_path / "sf"
    os.makedirs(folder)
    docs.unionByName(more).write.parquet(str(folder / "documents.parquet"))
    for name in ("labels", "benchmark"):
        shutil.copy(f"{sf}/{name}.parquet", folder / f"{name}.parquet")

    seen, table = {}, spark.read.parquet(str(folder / "documents.parquet"))
    for name, stage in P.STAGES:
        table = P.materialise(stage(spark, table, str(folder)), f"test-{name}")
        seen[name] = table.collect()
        if name != "bpe_encoding":
            assert table.columns == P.COLUMNS
    at = {name: {r.doc_id: r for r in rows} for name, rows in seen.items()}
    assert base + 1 not in at["toxicity"] and {i for i, _ in planted[1:]} <= at["toxicity"].keys()
    assert base + 2 in at["simhash_near_dedup"] and not {base + 3, base + 4} & at["simhash_near_dedup"].keys()
    cut = at["substring_dedup"]
    assert cut.keys() == at["simhash_near_dedup"].keys()
    assert cut[base + 5].text == planted[4][1] and cut[base + 6].text == prose(5, 70) and cut[base + 6].n_chars == len(prose(5, 70))
    clean = at["benchmark_decontamination"]
    assert base + 7 in cut and base + 7 not in clean and clean[base + 8].text == prose(8, 90) and None in clean
    assert clean[base + 9].text in (None, "")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert at["bpe_encoding"].keys() == clean.keys()
    for r in seen["bpe_encoding"]:
        assert r.token_ids == tokenizer.encode(clean[r.doc_id].text or "", add_special_tokens=False).ids and r.n_tokens == len(r.token_ids)


def test_empty_tables_and_columns_of_clashing_names(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    for name in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{sf}/{name}.parquet").limit(0)
        if name == "documents":
            for c in ("predicted", "score", "token_ids", "fp", "doc", "_doc"):
                df = df.withColumn(c, df["doc_id"])
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in P.STAGES:
        table = P.materialise(stage(spark, table, str(tmp_path)), f"test-empty-{name}")
        assert table.count() == 0
    assert table.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"]


def test_run_reads_the_given_tables(spark):
    rows = P.run(spark, "/root/testdata/sf0.001")
    assert 0 < rows.count() < 200 and "token_ids" in rows.columns


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert len(P.STAGES) == 5 and not queries.ORACLE_SQL and P.ORACLE_SQL is None


def test_a_notice_of_all_documents_hides_no_longer_repeat(spark, make_docs, prose):
    """The third stage cuts the 50 words that each two documents share, though all share 49 of them."""
    notice = prose(201, 49)
    pairs = [(i, f"{prose(i, 30)} {notice} joint{i // 2} {prose(5000 + i, 30)}") for i in range(60)]
    cut = {r.doc_id: len(r.text.split()) for r in P.cut_repeated_passages(spark, make_docs(pairs), "").collect()}
    assert cut == {i: 60 if i % 2 else 110 for i in range(60)}
