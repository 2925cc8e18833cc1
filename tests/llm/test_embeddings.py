import numpy as np
import pytest
from pyspark.sql import functions as F

from innkeeper.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    n, links, root = len(rows), [], list(range(len(rows)))

    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    counts = [0] * n
    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if la is None or la != lb or not usable(a) or not usable(b) or len(a) != len(b):
                continue
            x, y = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                counts[i] += 1
                counts[j] += 1
                links.append((i, j))
                root[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i in range(n):
        ids = [rows[k][0] for k in range(n) if find(k) == find(i) and rows[k][0] is not None]
        component = min(ids, default=None)
        out.append((rows[i][0], counts[i], component, rows[i][0] is not None and rows[i][0] == component))
    return sorted(out, key=str)


def make(rng, groups, per, dim, spread):
    rows, i = [], 0
    for g in range(groups):
        centre = rng.normal(size=dim)
        for _ in range(per):
            rows.append((i, (centre + spread * rng.normal(size=dim)).astype(np.float32).tolist(), g % 3))
            i += 1
    return rows


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_links", F.lit("clash")).repartition(3)
    return sorted((tuple(r) for r in E.near_duplicates(df, **options).collect()), key=str)


def test_links_and_components_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(0)
    rows = make(rng, 12, 15, 16, 0.25)
    rows += [(1000 + k, rows[3][1], rows[3][2]) for k in range(20)]  # copies
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [None] + [1.0] * 15, 1)]
    rows += [(2005, rows[0][1], None), (2006, [float("inf")] * 16, 1), (2007, [1.0, 2.0], 0), (2008, [2.0, 4.0], 0), (None, rows[7][1], rows[7][2])]
    rows += [(3000, [-x for x in rows[3][1]], rows[3][2]), (3001, [3 * x for x in rows[3][1]], rows[3][2]), (5, rows[3][1], rows[3][2])]
    assert found(spark, rows) == brute(rows)
    # many small lists and blocks, all lists probed: the same links
    monkeypatch.setattr(E, "LIST_ROWS", 16)
    monkeypatch.setattr(E, "BLOCK", 4)
    monkeypatch.setattr(E, "QUERY_BLOCK", 5)
    assert found(spark, rows, probes=10**6) == brute(rows)


def test_recall_with_few_probes(spark):
    sf_dir = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = {r.vec_id: r.n_links for r in E.near_duplicates(df).collect()}
    table = df.toPandas()
    x = np.stack(table["embedding"]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = {}
    for _, part in table.groupby("label"):
        at = part.index.to_numpy()
        near = (x[at] @ x[at].T >= 0.93).sum(axis=1) - 1
        want |= dict(zip(part["vec_id"], near.tolist(), strict=True))
    assert all(got[k] <= n for k, n in want.items())
    assert sum(got.values()) >= 0.95 * sum(want.values())


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0, 2.0], 1)]])
def test_tiny_tables(spark, rows):
    assert found(spark, rows) == [(r[0], 0, r[0], True) for r in rows]
