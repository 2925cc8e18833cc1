import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from innkeeper.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    """Every maximal stretch of every period, kept where no smaller period fits it."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(least, 2 * q) and not any(all(words[k] == words[k - p] for k in range(start + p, j)) for p in range(1, q)):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def texts(seed, n_texts=6):
    """Random words, broken repeats, Thue-Morse and Fibonacci words, in small alphabets."""
    rnd = random.Random(seed)
    for _ in range(n_texts):
        k, n, kind = rnd.choice([1, 2, 2, 3, 5, 50]), rnd.randint(0, 130), rnd.randrange(4)
        if kind == 0:
            d = [rnd.randrange(k) for _ in range(n)]
        elif kind == 1:
            d = ([rnd.randrange(k) for _ in range(rnd.randint(1, 30))] * n)[:n]
            for _ in range(min(n, rnd.randint(0, 3))):
                d[rnd.randrange(n)] = rnd.randrange(k)
        elif kind == 2:
            d = [0]
            while len(d) < n:
                d = d + [1 - x for x in d]
        else:
            a, d = [0], [0, 1]
            while len(d) < n:
                a, d = d, d + a
        yield d[:n] if kind >= 2 else d


def laid(docs):
    return np.array([x for d in docs for x in d], np.int64), np.r_[0, np.cumsum([len(d) for d in docs])].astype(np.int64)


@pytest.mark.parametrize("matches", [4, 200, periodic.MATCHES])
def test_runs_match_brute_force(monkeypatch, matches):
    monkeypatch.setattr(periodic, "MATCHES", matches)
    total = 0
    for seed in range(60):
        docs = list(texts(seed))
        least = (3, 5, 12, 12)[seed % 4]
        ids, bounds = laid(docs)
        hand = [(s + o, n, q) for d, o in zip(docs, bounds, strict=False) for s, n, q in brute(d, least)]
        assert list(map(tuple, periodic.find_runs(ids, bounds, least).tolist())) == hand
        total += len(hand)
    assert total > 500


def test_colliding_hashes_are_done_again(monkeypatch):
    docs = list(texts(3, 12))
    ids, bounds = laid(docs)
    right = periodic.find_runs(ids, bounds)
    real, calls = periodic._Windows.of, []

    def weak(self, width):
        calls.append(width)
        return real(self, width) & np.uint64(1) if len(calls) < 3 else real(self, width)

    monkeypatch.setattr(periodic._Windows, "of", weak)
    assert (periodic.find_runs(ids, bounds) == right).all() and len(right)


def test_long_repeats_are_linear():
    for unit in ([0], [0, 0, 1], [0, 1, 2, 0, 1, 2, 3, 4, 5, 6]):
        ids = np.array(unit * 30_000, np.int64)
        assert periodic.find_runs(ids, np.array([0, len(ids)])).tolist() == [[0, len(ids), len(unit)]]


def test_too_small_a_length_is_refused():
    with pytest.raises(ValueError, match="least"):
        periodic.find_runs(np.array([0]), np.array([0, 1]), least=2)


def test_operator_on_edge_rows(spark):
    rows = [
        (1, None, "x", 1.0), (2, "", "x", 1.0), (3, " \n\t", "x", 1.0), (4, "a b " * 6 + "c", "x", 2.0), (4, "a b " * 6 + "c", "x", 2.0),
        (None, "é x \x0b" * 12, None, None), (6, "a " * 11, "x", 3.0), (7, "w " * 20_000, "x", None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, collapsed double")
    found = periodic.periodic_runs(df)
    assert found.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect())
    assert got == [
        (0, 12, [(0, 12, 1)], "é x"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 13, [(0, 12, 2)], "a b c"),
        (4, 13, [(0, 12, 2)], "a b c"), (6, 11, [], "a a a a a a a a a a a"), (7, 20_000, [(0, 20_000, 1)], "w"),
    ]
    assert periodic.periodic_runs(df.limit(0)).collect() == []


def by_contract(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    s, m, q = min(((s, m, q) for s, m, q in runs), key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        doc_id, len(runs), s, m, q, None if q is None else 1000 * m // q,
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest(),
    )


def test_query_matches_the_contract_on_small_documents(spark, make_docs, prose, tmp_path):
    rnd = random.Random(9)
    rows = [(i, prose(i % 9, rnd.randint(0, 60)) + " go on" * rnd.randint(0, 9)) for i in range(160)]
    rows += [(None, "x y " * 8), (-5, None), (200, ""), (201, "A a\x0bA a " * 4), (12, prose(1, 50))]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for c, t in found.dtypes if c[-6:] != "sha256"} == {"bigint"}
    order = lambda r: (r[0] is None, r[0] or 0, r[7])
    hand = sorted((by_contract(*r) for r in rows), key=order)
    assert sorted(map(tuple, found.collect()), key=order) == hand
    assert sum(r[1] > 0 for r in hand) > 30


def test_query_on_the_small_tables(spark):
    found = {r["doc_id"]: tuple(r) for r in queries.op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    short = [(i, t) for i, t in docs if len((t or "").split()) <= 600]
    assert len(found) == len(docs) and len(short) > 100
    for i, text in short[:80]:
        assert found[i] == by_contract(i, text)
