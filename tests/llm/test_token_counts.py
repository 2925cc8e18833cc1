import base64
import math
import random

import public_tokenizers
import regex
from pyspark.sql import functions as F

from innkeeper.llm import token_counts as C

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def costs():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {k: round(C.COST_SCALE * (math.log(r + 1) + total)) for k, r in ranks.items()}


def brute(word, cost):
    """Cheapest segmentation of one pre-token: cost, pieces."""
    best = [(0, 0)]
    for i in range(1, len(word) + 1):
        best.append(min((best[j][0] + cost[word[j:i]], best[j][1] + 1) for j in range(i) if word[j:i] in cost))
    return best[-1]


def test_counts_against_brute_force(make_docs):
    rnd = random.Random(2)
    texts = [None, "", " ", "a", "Hello world, hello worlds!", "aaaa" * 50, "é한🙂" * 20, "x " * 500]
    texts += [" ".join("".join(rnd.choice("thean rio") for _ in range(rnd.randint(1, 12))) for _ in range(30)) for _ in range(40)]
    cost = costs()
    rows = C.count_tokens(make_docs(list(enumerate(texts)) + [(None, "a"), (3, "a")]).withColumn("n_tokens", F.lit("clash")), PATH, PATTERN).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        words = regex.findall(PATTERN, r.text or "")
        each = [brute(w.encode(), cost) for w in words]
        assert (r.n_pretokens, r.n_tokens) == (len(words), sum(n for _, n in each))
        assert math.isclose(-r.log_prob * C.COST_SCALE, sum(c for c, _ in each), abs_tol=1e-3)


def test_cache_and_long_pretokens(monkeypatch):
    counter = C.UnigramCounter(PATH, PATTERN)
    texts = ["the theory of theories " * 30, "z" * 10_000, "the"]
    whole = counter.count_batch(texts).tolist()
    assert whole[1][0] == 3  # cut by rule at MAX_PRETOKEN
    monkeypatch.setattr(C, "CACHED", 2)
    monkeypatch.setattr(C, "CHUNK_BYTES", 64)
    small = C.UnigramCounter(PATH, PATTERN)
    assert [small.count_batch([t]).tolist()[0] for t in (texts[0], texts[2])] == [whole[0], whole[2]]


def test_bytes_outside_the_vocabulary(tmp_path):
    path = tmp_path / "tiny.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(p) + b" %d" % i for i, p in enumerate([b"a", b"b", b"ab"])))
    counter = C.UnigramCounter(str(path), r"\S+")
    (row,) = counter.count_batch(["ab?b"])
    assert row[:2].tolist() == [1, 3]


def test_pretokens_longer_than_any_limit_are_counted_whole(make_docs):
    rnd = random.Random(5)
    texts = ["z" * 10_000, "-" * 9_000, "".join(rnd.choice("theanrio") for _ in range(4_097)), "".join(rnd.choice("漢字仮名") for _ in range(5_000))]
    texts += [f"before {texts[2]} after {texts[0]}", "".join(rnd.choice("theanrio") for _ in range(4_096))]
    cost, longest = costs(), max(map(len, costs()))
    for r in C.count_tokens(make_docs(list(enumerate(texts))), PATH, PATTERN).collect():
        words = regex.findall(PATTERN, r.text)
        each = []
        for w in map(str.encode, words):
            best = [(0, 0)]
            for i in range(1, len(w) + 1):
                best.append(min((best[j][0] + cost[w[j:i]], best[j][1] + 1) for j in range(max(0, i - longest), i) if w[j:i] in cost))
            each.append(best[-1])
        assert (r.n_pretokens, r.n_tokens) == (len(words), sum(n for _, n in each))
        assert math.isclose(-r.log_prob * C.COST_SCALE, sum(c for c, _ in each), abs_tol=1e-3)


def test_empty_table(make_docs):
    assert C.count_tokens(make_docs([]), PATH, PATTERN).collect() == []
