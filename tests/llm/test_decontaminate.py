import random
import re

import pytest
from pyspark.sql import functions as F

from innkeeper.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, bench, width):
    windows = {}
    for item, text in bench:
        w = words(text)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).add(item)
    out = []
    for text in texts:
        w, hit, items = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (x := tuple(w[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    items |= {str(i) for i in windows[x] if i is not None}
        out.append((len(w), sorted(hit), sorted(items)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_hits_against_brute_force(spark, make_docs, block_bytes):
    rnd = random.Random(1)
    some = lambda n: " ".join(rnd.choice(["a", "B", "the", "Été", "x1"]) for _ in range(n))
    bench = [(1, some(14)), (2, some(3)), (3, ""), (4, None), (5, "a"), (None, some(6)), (2, some(9)), (7, some(14))]
    texts = [None, "", "!!", "a", "z", some(5), some(400) + " z " + (bench[0][1] or "")] + [some(n) for n in range(10, 60, 3)]
    items = spark.createDataFrame(bench, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    found = D.find_overlaps(make_docs(list(enumerate(texts))), items, width=6, block_bytes=block_bytes).collect()
    want = brute(texts, bench, 6)
    assert len(found) == len(texts)
    for r in found:
        hit = [k for i, j in zip(r.starts, r.ends, strict=True) for k in range(i, j)]
        assert (r.n_words, hit, sorted(r["items"])) == want[r.doc_id]


def test_proximity_matches(spark, make_docs):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    texts = ["one two three four", "one two extra three four", "four three two one zero", "one two a b c d three four"]
    found = {r.doc_id: (r["items"], r.near_items) for r in D.find_overlaps(make_docs(list(enumerate(texts))), bench, width=4, slop=1).collect()}
    assert found[0] == (["1"], []) and found[1] == ([], ["1"]) and found[3] == ([], [])


def test_drop_contaminated(spark, make_docs, prose):
    passage = prose(1, 12)
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = make_docs([(1, prose(2, 50)), (2, prose(3, 9) + " " + passage.upper()), (None, passage), (None, "kept"), (5, None)])
    kept = D.drop_contaminated(docs, bench, width=10)
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted([("1", prose(2, 50)), ("None", "kept"), ("5", "None")])
    assert kept.columns == docs.columns


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_overlaps(make_docs([]), none).collect() == []
    assert [(r.n_words, r.starts) for r in D.find_overlaps(make_docs([(1, "a b")]), none).collect()] == [(2, [])]
