import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from innkeeper.llm import lm_score, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


def by_hand(word, pieces):
    """Sum over all segmentations of blank + word, by plain recursion from the left."""
    text = b" " + word
    ways = [1.0] + [0.0] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(j):
            ways[j] += ways[i] * sum(p for piece, p in pieces if piece == text[i:j])
    return ways[-1]


def expected_by_hand(words, pieces):
    """Expected piece numbers by listing every path."""
    out = Counter()

    def paths(text):
        if not text:
            yield [], 1.0
        for piece, p in pieces:
            if text.startswith(piece):
                for rest, q in paths(text[len(piece) :]):
                    yield [piece, *rest], p * q

    for word, n in words.items():
        found = list(paths(b" " + word))
        total = sum(p for _, p in found)
        for path, p in found:
            for piece in path:
                out[piece] += n * p / total
    return out


@pytest.fixture(scope="module")
def toy():
    pieces = [(b" ", 0.1), (b" a", 0.1), (b"a", 0.2), (b"b", 0.1), (b"ab", 0.15), (b"bab", 0.05), (b" ab", 0.1), (b"a", 0.05), (b"c", 0.05)]
    lattice = lm_score.Lattice([p for p, _ in pieces])
    prob = np.bincount(lattice.unit_of, [p for _, p in pieces], minlength=lattice.n_units)
    return lattice, prob, pieces


def test_forward_is_the_sum_over_all_segmentations(toy):
    lattice, prob, pieces = toy
    words = [b"abababcab", b"babbab", b"aaaa", b"ab", b"c", b"c", b""]
    found = np.exp(lattice.forward(words, np.log(prob)))
    assert np.allclose(found, [by_hand(w, pieces) for w in words], rtol=1e-12)


def test_expected_numbers_match_listed_paths(toy):
    lattice, prob, pieces = toy
    words = {b"abababc": 3, b"babab": 2, b"aab": 5, b"c": 1}
    found = lattice.expected(list(words), np.array(list(words.values()), float), np.log(prob))
    hand = expected_by_hand(words, pieces)
    units = {}
    for (piece, _), u in zip(pieces, lattice.unit_of, strict=True):
        units[u] = piece
    assert {units[u]: pytest.approx(x, rel=1e-9) for u, x in enumerate(found) if x} == dict(hand)


def test_long_word_keeps_a_finite_score(toy):
    lattice, prob, _ = toy
    score = lattice.forward([b"ab" * 20_000], np.log(prob))[0]
    assert np.isfinite(score) and score < -10_000


def test_vocabulary_file_is_a_distribution_that_reaches_every_byte():
    lattice, prob = lm_score.load(PATH)
    assert prob.sum() == pytest.approx(1) and (prob > 0).all()
    assert np.isfinite(lattice.forward([bytes(range(33, 256)), "▁x日本".encode()], np.log(prob[:-1]))).all()


def brute(rows, rounds=2):
    """Base and lattice scores of (doc_id, text) rows in plain Python, lattices included."""
    lattice, existing = lm_score.load(PATH)
    pieces, _ = lm_score.read_pieces(PATH)
    names = {}
    for piece, u in zip(pieces, lattice.unit_of, strict=True):
        names[piece] = u
    longest = max(map(len, names))

    def spans(word):
        text = b" " + word
        return len(text), [(i, j, names[text[i:j]]) for i in range(len(text)) for j in range(i + 1, min(len(text), i + longest) + 1) if text[i:j] in names]

    def sums(word, prob):
        n, arcs = spans(word)
        there, back = [1.0] + [0.0] * n, [0.0] * n + [1.0]
        for i, j, u in sorted(arcs, key=lambda a: a[1]):
            there[j] += there[i] * prob[u]
        for i, j, u in sorted(arcs, key=lambda a: -a[0]):
            back[i] += back[j] * prob[u]
        return there[n], [(u, there[i] * prob[u] * back[j] / there[n]) for i, j, u in arcs]

    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    split = lambda t: [w.encode() for w in lower(t).replace("\t", " ").replace("\n", " ").split(" ") if w]
    train = [i is None or zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    counts, ends = Counter(), 0
    for (_, text), t in zip(rows, train, strict=True):
        if t:
            counts.update(split(text))
            ends += 1
    n_all, kinds = counts.total() + ends, len(counts) + (ends > 0)
    prob = existing
    for _ in range(rounds if n_all else 0):
        new = np.zeros(len(prob))
        for w, n in counts.items():
            for u, x in sums(w, prob)[1]:
                new[u] += n * x
        new[-1] = ends
        prob = new + lm_score.SMOOTHING * existing
        prob /= prob.sum()
    out = []
    for (i, text), t in zip(rows, train, strict=True):
        words = split(text)
        base = sum(math.log10((counts[w] + 1) / (n_all + kinds + 1)) for w in words) + math.log10((ends + 1) / (n_all + kinds + 1))
        score = sum(math.log10(sums(w, prob)[0]) for w in words) + math.log10(prob[-1])
        out.append((i, not t, len(words) + 1, sum(counts[w] > 0 for w in words) + (ends > 0), n_all, base, score))
    return out


def same(found, hand):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    found, hand = sorted(map(tuple, found), key=key), sorted(hand, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in hand]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in hand], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("head", [lm_score.HEAD, 3, 0])
def test_scores_match_plain_python(make_docs, prose, monkeypatch, head):
    monkeypatch.setattr(lm_score, "HEAD", head)
    rows = [(i, prose(i % 7, 30) + " The the THE été Ünï 日本\tx\nthe") for i in range(12)] + [(20, None), (21, ""), (22, " \n "), (23, "unseen-word the")]
    rows += [(5, "the same row"), (5, "the same row"), (None, "no id the"), (30, "a" * 60)]
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    found = lm_score.score_texts(make_docs(rows), PATH, train, rounds=2)
    held = found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
    same(held.collect(), brute(rows))


def test_empty_table_and_no_training_rows(make_docs):
    none = F.lit(False)
    assert lm_score.score_texts(make_docs([]), PATH, none).collect() == []
    (row,) = lm_score.score_texts(make_docs([(1, "some words here")]), PATH, none).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (4, 0, 0, 0.0)
    _, prob = lm_score.load(PATH)
    assert row["score"] < 3 * math.log10(prob.max()) + math.log10(prob[-1])


def test_extra_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, "a b", 7, "x", "y", 1.0)], "doc_id long, text string, word long, row string, n string, score double")
    (row,) = lm_score.score_texts(df, PATH, F.lit(True)).collect()
    assert row["n_tokens"] == 3 and row["score"] < 0


def test_training_raises_the_score_of_held_out_text(make_docs):
    words = ["thering", "oftion", "ndhe", "shouldern"]
    rows = [(i, " ".join(words[(i + k) % 4] for k in range(50))) for i in range(40)]
    train = F.col("doc_id") % 5 != 0
    got = {r: lm_score.score_texts(make_docs(rows), PATH, train, rounds=r).where("not train").agg(F.avg("score")).first()[0] for r in (0, 3)}
    assert got[3] > got[0] / 2


def test_query_on_the_small_tables(spark):
    found = queries.op11_lm_score(spark, "/root/testdata/sf0.001").toPandas()
    assert list(found.columns) == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert found.held_out.dtype == bool and found.train_tokens.nunique() == 1
    assert found.train_tokens[0] == found.n_tokens[~found.held_out].sum()
    assert (found.n_known <= found.n_tokens).all() and (found.n_known == found.n_tokens)[~found.held_out].all()
    # the model knows what the corpus looks like: documents and base rank alike
    assert np.corrcoef(found.base_score / found.n_tokens, found.score / found.n_tokens)[0, 1] > 0.5
