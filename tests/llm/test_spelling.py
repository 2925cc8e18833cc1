import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from innkeeper.llm import queries, spelling


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, ratio=10, min_length=7, min_count=2):
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    form, n_near = {}, {}
    for w, n in words.items():
        found = [v for v in words if near(w, v)]
        n_near[w] = len(found)
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, n_near[w], words.get(form[w])))
    return sorted(out)


def random_words(rnd, letters, n, low=4, high=9):
    return sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(low, high))) for _ in range(n)})


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdeé日\U00010348", "".join(map(chr, range(0x4E00, 0x4F00)))])
def test_search_finds_each_near_pair_once(letters):
    rnd, total = random.Random(4), 0
    for _ in range(25):
        index = spelling.VocabularyIndex(random_words(rnd, letters, 60))
        asked = sorted({*random_words(rnd, letters + "z", 40), *index.words, *(w[:i] + rnd.choice(letters) + w[i + 1 :] for w in index.words for i in (0, 3))})
        found = []
        for side in (spelling.PREFIX, spelling.SUFFIX):
            for d in (-1, 0, 1):
                q, v = index.search(asked, np.array([len(w) + d for w in asked]), side)
                found += [(asked[i], index.words[j]) for i, j in zip(q, v, strict=True)]
        assert sorted(found) == sorted((a, b) for a in asked for b in index.words if near(a, b))
        total += len(found)
    assert total > 20


def test_intervals_of_both_tables_move_together():
    index = spelling.VocabularyIndex(["banana", "bandana", "cabana", "ananas"])
    one = np.ones(1, np.int64)
    a, b, size = one * 0, one * 0, one * len(index.left.symbols)
    codes, _ = index.encode(["ana"])
    left = right = None
    for order in ((0, 1, 2), (2, 1, 0)):  # to the right from the front, to the left from the back
        x, y, n = a, b, size
        for i in order:
            table = index.right if order[0] == 0 else index.left
            x, y, n = index._grow(table, codes[i : i + 1], x, y, n)
        if order[0] == 0:
            right = (int(y[0]), int(x[0]), int(n[0]))
        else:
            left = (int(x[0]), int(y[0]), int(n[0]))
    assert left == right and left[2] == sum(len(re.findall("(?=ana)", w)) for w in index.words)


def test_very_long_words():
    long = "ab" * 5_000
    index = spelling.VocabularyIndex([long, long + "a", "short"])
    q, v = index.search([long], np.array([len(long) + 1]), spelling.PREFIX)
    assert [(index.words[j]) for j in v] == [long + "a"]


def table(spark, counts):
    return spark.createDataFrame([(w, n) for w, n in counts.items()], "word string, n long").repartition(3)


@pytest.mark.parametrize("shard_words", [7, 40, spelling.SHARD_WORDS])
def test_groups_match_brute_force(spark, shard_words):
    rnd = random.Random(shard_words)
    words = random_words(rnd, "abcé", 150, 6, 9)
    words += ["stem" + w for w in random_words(rnd, "ab", 120, 4, 6)]  # one half that many share
    counts = {w: rnd.choice([1, 2, 2, 3, 25, 30, 400, 5000]) for w in words}
    found = spelling.group_variants(table(spark, counts), shard_words=shard_words)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    hand = brute(counts)
    assert sorted(map(tuple, found.collect())) == hand
    assert sum(r[1] is not None for r in hand) > 20 and any(r[2] not in (r[0], r[1]) for r in hand)


def test_ties_repeats_nulls_and_empty(spark):
    rows = [("abcdefg", 1), ("abcdefg", 1), ("abcdefh", 20), ("abcdefi", 20), (None, 50), ("abcdefgh", 1), ("short", 9), ("", 3)]
    df = spark.createDataFrame(rows, "word string, n long").withColumn("key", F.lit(1)).withColumn("best", F.lit("x"))
    found = sorted(map(tuple, spelling.group_variants(df).collect()))
    assert found == [("abcdefg", "abcdefh", "abcdefh", 2, 2, 20), ("abcdefh", None, "abcdefh", 20, 2, None), ("abcdefi", None, "abcdefi", 20, 2, None)]
    assert spelling.group_variants(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="ratio"):
        spelling.group_variants(df, ratio=1)


def test_chains_of_any_length_are_followed(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "w4")], "word string, form string")
    assert {r["root"] for r in spelling.follow_forms(links, 9).collect()} == {"w9"}
    assert spelling.follow_forms(links.limit(0), 0).collect() == []


def words_by_contract(rows):
    counts = Counter()
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return counts


def test_query_matches_the_contract(spark, make_docs, prose, tmp_path):
    rnd = random.Random(2)
    words = prose(3, 60).split() + ["wörterbuch", "Geschäftigkeit", "×÷×÷×÷×÷", "longerword", "ÀÉÎõüÿþ"]
    words += [w + "ending" for w in words[:30]]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(200)) + ", x-y_z1abcdefgh日本語") for i in range(60)]
    rows += [(None, " ".join(words)), (70, None), (71, ""), (5, "longerword " * 3), (5, "longerword " * 3)]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_spelling_variants(spark, str(tmp_path))
    hand = brute(words_by_contract(rows))
    assert sorted(map(tuple, found.collect())) == hand
    assert sum(r[1] is not None for r in hand) > 10


def test_query_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    found = {r["word"]: tuple(r) for r in queries.op12_spelling_variants(spark, sf).collect()}
    counts = words_by_contract(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    assert {w: r[3] for w, r in found.items()} == words
    for w in random.Random(1).sample(sorted(words), 60):
        hits = [v for v in words if near(w, v)]
        assert found[w][4] == len(hits)
        best = min(hits, key=lambda v: (-words[v], v), default=None)
        assert found[w][1] == (best if best and words[best] >= 10 * words[w] else None)
