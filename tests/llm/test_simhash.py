import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from innkeeper.llm import simhash
from innkeeper.llm.components import connected_components


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union_find(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


def test_fingerprints_and_components_against_brute_force(make_docs, prose):
    texts = [None, "", " \t\n", "One", "one two", "ONE two three", "é " * 800, prose(1, 300), prose(1, 300).upper(), "a\x0bb\x0cc d"]
    texts += [prose(s, 40) + tail for s in range(30) for tail in ("", " x", "\x85y")]
    pairs = [(3 * i + 1, t) for i, t in enumerate(texts)] + [(1, None), (None, "one two")]
    got = simhash.near_duplicates(make_docs(pairs).withColumn("fp", F.lit("clash"))).collect()
    fps = [brute_fingerprint(t) for _, t in pairs]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    roots = union_find(len(fps), near)
    ids = [i for i, _ in pairs]
    least = {r: min((ids[k] for k in range(len(ids)) if roots[k] == r and ids[k] is not None), default=None) for r in roots}
    want = sorted(((str(ids[k]), fps[k], least[roots[k]]) for k in range(len(ids))), key=str)
    assert sorted(((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in got), key=str) == want


def test_links_at_every_distance_with_and_without_crowded_buckets(spark):
    rnd = random.Random(5)
    centres = [rnd.getrandbits(64) for _ in range(3)]
    values = set(centres)
    for c in centres:
        for _ in range(60):
            x = c
            for b in rnd.sample(range(64), rnd.randint(0, 4)):
                x ^= 1 << b
            values.add(x)
    signed = sorted(int(np.uint64(v).astype(np.int64)) for v in values)
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    for distance, segments in ((0, 2), (1, 2), (2, 2), (2, 4), (3, 2)):
        near = [(i, j) for i in range(len(signed)) for j in range(i) if ((signed[i] ^ signed[j]) % (1 << 64)).bit_count() <= distance]
        roots = union_find(len(signed), near)
        want = {(signed[i], signed[roots[i]]) for i in range(len(signed)) if any(i in p for p in near)}
        for crowded in (1, 3, 10**6):
            found = connected_components(simhash.links(fps, distance, segments, crowded), "a", "b")
            assert {(r.node, r.root) for r in found.collect()} == want, (distance, segments, crowded)
        if near and distance == 2:
            listed = simhash.links(fps, distance, segments, 10**6).collect()
            assert len(listed) >= len(near) and {tuple(sorted((r.a, r.b))) for r in listed} == {(signed[j], signed[i]) for i, j in near}


def test_majority_of_many_hashes():
    rng = np.random.default_rng(0)
    counts = np.array([0, 1, 254, 255, 256, 0, 1000])
    hashes = rng.integers(0, 2**64, counts.sum(), dtype=np.uint64)
    got, at = simhash.majority(hashes, counts).view(np.uint64), 0
    for fp, n in zip(got.tolist(), counts.tolist(), strict=True):
        part = hashes[at : at + n].tolist()
        assert fp == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in part) > n)
        at += n


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 900), (None, 3)], "a long, b long")
    assert {(r.node, r.root) for r in connected_components(links, "b", "a").collect()} == {(i, 0) for i in range(201)}


def test_one_row_of_a_group_stays(make_docs, prose):
    pairs = [(4, prose(1, 60)), (2, prose(1, 60)), (2, prose(1, 60)), (9, prose(2, 60)), (None, prose(1, 60)), (2, prose(3, 60))]
    kept = simhash.drop_near_duplicates(make_docs(pairs))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(2, prose(1, 60)), (2, prose(3, 60)), (9, prose(2, 60))])
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []
    assert simhash.drop_near_duplicates(make_docs([])).collect() == []
