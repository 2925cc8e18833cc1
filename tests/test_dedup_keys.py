import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from innkeeper.operators.dedup import dense_distinct, drop_exact_duplicates, duplicate_count, keep_first
from innkeeper.operators.keys import dense_key, layout_key
from innkeeper.plans.warehouse import total_vs_distinct


def test_duplicate_count_nulls_equal(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert duplicate_count(df, ["k"]).first()["duplicates"] == 2


def test_duplicate_count_empty(spark):
    df = spark.createDataFrame([], "k int")
    assert duplicate_count(df, ["k"]).first()["duplicates"] == 0


def test_exact_dedup_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "k int, v string")
    assert drop_exact_duplicates(df).count() == 2


def test_keep_first_orders_nulls_first(spark):
    df = spark.createDataFrame([("A", "G"), ("A", None), ("B", "Z"), ("B", "Y")], "n string, g string")
    got = {r["n"]: r["g"] for r in keep_first(df, ["n"], ["g"]).collect()}
    assert got == {"A": None, "B": "Y"}


def test_keep_first_keeps_whole_row(spark):
    df = spark.createDataFrame([(1, 2, "x"), (1, 1, "y"), (2, 5, "z")], "k int, o int, p string")
    rows = sorted(tuple(r) for r in keep_first(df, ["k"], ["o"]).collect())
    assert rows == [(1, 1, "y"), (2, 5, "z")]


def _numbered(df, col):
    return sorted((r["k"], r[col]) for r in df.collect())


def test_dense_key_bucketed_equals_row_number(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(-1000, 1000), rnd.randint(0, 3)) for _ in range(3000)] + [(None, 1)]
    df = spark.createDataFrame(data, "k int, t int")
    got = dense_key(df, ["k", "t"], "key", n_buckets=7)
    w = Window.orderBy(F.col("k").asc_nulls_first(), F.col("t").asc_nulls_first())
    expect = df.withColumn("key", F.row_number().over(w))
    # ties (k, t) may swap numbers, so compare the multiset of (k, t, key) by position
    g = sorted((r["key"], r["k"], r["t"]) for r in got.collect())
    e = sorted((r["key"], r["k"], r["t"]) for r in expect.collect())
    assert [x[0] for x in g] == list(range(1, len(data) + 1))
    assert [(x[1], x[2]) for x in g] == [(x[1], x[2]) for x in e]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan  # partitioned window, not a single partition


@pytest.mark.parametrize("checkpoint", [False, True])
@pytest.mark.parametrize("partitions", ["1", "4"])
@pytest.mark.parametrize(
    "values, schema", [([5, 3, 9], "k int"), ([None] * 40, "k int"), ([7] * 40, "k long"), ([], "k int"), ([None, "b", "", "ab", "aé", "a"], "k string")]
)
def test_dense_key_one_plan_for_every_input(spark, values, schema, partitions, checkpoint):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], schema + ", i int")
        keyed = dense_key(df, ["k", "i"], "key", checkpoint=checkpoint)
        plan = keyed._jdf.queryExecution().executedPlan().toString()
        assert "direct_shuffle_partition_id(_bucket" in plan and "SinglePartition" not in plan
        order = sorted(enumerate(values), key=lambda x: (x[1] is not None, x[1] if x[1] is not None else 0, x[0]))
        assert sorted((r["key"], r["i"]) for r in keyed.collect()) == [(n + 1, i) for n, (i, _) in enumerate(order)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_dense_key_rejects_a_hot_sort_value(spark):
    df = spark.createDataFrame([(1, i) for i in range(100)], "k int, i int")
    with pytest.raises(ValueError, match="100 rows share one bucket"):
        dense_key(df, ["k", "i"], "key", max_bucket_rows=99)
    packed = F.col("k") * 1000 + F.col("i")
    assert dense_key(df, ["k", "i"], "key", sort_value=packed, max_bucket_rows=99).count() == 100


def test_dense_key_text_keys(spark):
    names = [f"N{i:04d}" for i in range(500)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "k string")
    got = sorted((r["k"], r["key"]) for r in dense_key(df, ["k"], "key", n_buckets=5).collect())
    assert got == [(n, i + 1) for i, n in enumerate(sorted(names))]


def test_dense_key_stable_across_jobs(spark):
    df = spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 5003)
    keyed = dense_key(df, ["k"], "key", n_buckets=6)
    a = sorted(tuple(r) for r in keyed.select("k", "key").collect())
    b = sorted(tuple(r) for r in keyed.select("k", "key").collect())
    assert a == b


def test_dense_key_random_against_row_number(spark):
    rnd = random.Random(21)
    for trial in range(4):
        n = rnd.randint(50, 2000)
        hot = rnd.randint(-5, 5)
        data = [
            (hot if rnd.random() < 0.33 else (None if rnd.random() < 0.02 else rnd.randint(-10**12, 10**12)), i)
            for i in range(n)
        ]
        df = spark.createDataFrame(data, "k long, i int")
        got = dense_key(df, ["k", "i"], "key", n_buckets=rnd.randint(2, 40))
        expect = sorted(data, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1]))
        rows = sorted((r["key"], r["k"], r["i"]) for r in got.collect())
        assert [(k, i) for _, k, i in rows] == expect, trial
        assert [x[0] for x in rows] == list(range(1, n + 1))


@pytest.mark.parametrize("piece_rows", [40, 150, 400, 10**6])
def test_layout_key_numbers_by_day_then_key(spark, piece_rows):
    rnd = random.Random(piece_rows)
    days = [20240131, 20240201, 20240202, 20240229, 20250101]
    # a third of all rows on one day, NULL and negative keys, repeated ones
    data = [(days[1] if rnd.random() < 0.33 else rnd.choice(days), rnd.choice([None, -5] + 60 * [rnd.randint(0, 10**12)]), i) for i in range(900)]
    df = spark.createDataFrame([(d // 100, d, k, i) for d, k, i in data], "m int, d int, k long, i int").repartition(5)
    got = layout_key(df, "m", "d", ["k", "i"], "key", piece_rows=piece_rows)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would join small tasks
    try:
        tasks = [[(r["m"], r["d"], r["key"], r["k"], r["i"]) for r in part] for part in got.rdd.glom().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    rows = sorted(r[2:] for part in tasks for r in part)
    expect = sorted(data, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    assert rows == [(n + 1, k, i) for n, (_, k, i) in enumerate(expect)]
    for part in tasks:  # file order, and no task with much more than a piece
        assert part == sorted(part, key=lambda r: (r[0], r[1], r[2]))
        assert len(part) <= 1.5 * piece_rows
    assert len([p for p in tasks if p]) >= min(900 // (2 * piece_rows), 900)


@pytest.mark.parametrize("rows", [[], [(202401, 20240105, None)], [(202401, 20240105, 7)] * 60])
def test_layout_key_small_inputs(spark, rows):
    df = spark.createDataFrame(rows, "m int, d int, k int")
    got = layout_key(df, "m", "d", ["k"], "key", piece_rows=25)
    assert sorted(r["key"] for r in got.collect()) == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("seed", range(6))
def test_bitmap_distinct_is_exact(spark, seed):
    rnd = random.Random(seed)
    low, span = rnd.choice([(0, 10), (-5, 40_000), (2**40, 70_000), (20240101, 300)]), 0
    low, span = low
    hot = low + 3
    data = [(None if rnd.random() < 0.03 else hot if rnd.random() < 0.33 else low + rnd.randrange(span), rnd.choice([None, 1, 2, 7])) for _ in range(rnd.choice([1, 900, 4000]))]
    df = spark.createDataFrame(data, "a long, b int").repartition(3)
    for cols in (["a"], ["b"], ["a", "b"]):
        if dense_distinct(df, cols) is None:
            assert span > 10_000
        got = tuple(total_vs_distinct(df, cols, "t", "d").first())
        values = {r if len(cols) > 1 else r[0] for r in ([(x[0], x[1]) if len(cols) > 1 else (x["ab".index(cols[0])],) for x in data])}
        assert got == (len(data), len(values - {None})), (cols, seed)


def test_bitmap_distinct_ships_no_keys(spark):
    df = spark.range(100_000).selectExpr("cast(id % 50000 as int) AS k", "cast(20240101 + id % 28 as int) AS d")
    for cols in (["k"], ["k", "d"]):
        got = total_vs_distinct(df, cols, "t", "d")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "bitmap_construct_agg" in plan and "distinct" not in plan.lower().replace("count(distinct", "distinct")
        assert got.first()["t"] == 100_000
    thin = spark.range(1000).selectExpr("id * 1000003 AS k")
    assert dense_distinct(thin, ["k"]) is None and tuple(total_vs_distinct(thin, ["k"], "t", "d").first()) == (1000, 1000)
    assert dense_distinct(thin.selectExpr("cast(k as string) AS k"), ["k"]) is None
    assert tuple(total_vs_distinct(thin.limit(0), ["k"], "t", "d").first()) == (0, 0)
