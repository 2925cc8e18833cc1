"""Numbered commits under two writers, and batches appended with continued keys."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from innkeeper import schemas, session
from innkeeper.plans import append as A
from innkeeper.plans import pipeline as P
from innkeeper.plans import warehouse as W
from innkeeper.sources import commits, files
from tests.fixtures import raw


def test_one_of_many_writers_wins_each_number(spark, tmp_path):
    root, start = str(tmp_path), threading.Barrier(8)

    def write(i):
        start.wait()
        try:
            return commits.commit(spark, root, {"by": i}, 0).number
        except commits.CommitConflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(write, range(8)))
    assert sorted(x for x in got if x) == [1]
    assert commits.latest(spark, root).record == {"by": got.index(1)}


def test_an_unfinished_record_is_passed_over(spark, tmp_path):
    root = str(tmp_path)
    assert commits.latest(spark, root) is None and commits.head(spark, root) == 0
    commits.commit(spark, root, {"version": "a"}, 0)
    with open(os.path.join(root, commits.FOLDER, f"{2:012d}"), "w") as f:
        f.write('{"version": "b"')  # its writer died
    assert files.current_version(spark, root) == "a" and commits.head(spark, root) == 2
    files.publish_version(spark, root, "c")
    assert files.current_version(spark, root) == "c"
    assert [c.record["version"] for c in commits.history(spark, root)] == ["a", "c"]


def test_racing_refreshes_have_one_winner(spark, monkeypatch):
    """Two loads start from the same state; both write, one commits, and readers see its rows only."""
    root = session.scratch_path(spark, "test-race")
    tables = raw(spark)
    staged = P.run_staging(spark, tables, f"{root}/staging", enforce=False)
    real, meet = files.publish_version, threading.Barrier(2)

    def wait_then_publish(*args, **kwargs):
        meet.wait(120)
        return real(*args, **kwargs)

    monkeypatch.setattr(P.files, "publish_version", wait_then_publish)

    def load(_):
        try:
            return P.run_warehouse(spark, staged.path, f"{root}/warehouse", enforce=False).path
        except commits.CommitConflict:
            return None

    with ThreadPoolExecutor(2) as pool:
        paths = list(pool.map(load, range(2)))
    assert paths.count(None) == 1
    winner = next(p for p in paths if p)
    assert files.current_version(spark, f"{root}/warehouse") == winner
    assert P.read_star(spark, winner).fact_reviews.count() == 3


@pytest.fixture(scope="module")
def parts(spark):
    rows = [(i % 5 + 1, 20240101 + i % 28 + 100 * (i % 3), 1000 - i, i, 1, 202401 + i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "listing_key int, date_key int, review_id long, reviewer_id long, review_count int, month_key int")
    return [df.where(F.col("reviewer_id") % 3 == k) for k in range(3)]


def keys(spark, root):
    return sorted((r["review_key"], r["review_id"]) for r in A.read_batches(spark, root, schemas.FACT_REVIEWS).collect())


def expected(batches, start=1):
    out = []
    for df in batches:
        rows = sorted((r["date_key"], r["review_id"]) for r in df.collect())
        out += [(start + len(out) + i, review) for i, (_, review) in enumerate(rows)][: len(rows)]
    return out


def test_keys_go_on_and_a_replayed_batch_changes_nothing(spark, tmp_path, parts):
    root = str(tmp_path / "fact")
    assert A.read_batches(spark, root, schemas.FACT_REVIEWS).count() == 0
    A.append_batch(spark, root, "a", parts[0], W.number_reviews, "review_key")
    A.append_batch(spark, root, "b", parts[1], W.number_reviews, "review_key")
    before = keys(spark, root)
    again = A.append_batch(spark, root, "a", parts[2], W.number_reviews, "review_key")
    assert again.rows == 20 and keys(spark, root) == before
    A.append_batch(spark, root, "none", parts[0].limit(0), W.number_reviews, "review_key")
    A.append_batch(spark, root, "c", parts[2], W.number_reviews, "review_key")
    got = keys(spark, root)
    assert got == expected(parts) and [k for k, _ in got] == list(range(1, 61))
    assert [(b.name, b.rows, b.last_key) for b in A.batches(spark, root)] == [("a", 20, 20), ("b", 20, 40), ("none", 0, 40), ("c", 20, 60)]
    table = A.read_batches(spark, root, schemas.FACT_REVIEWS)
    assert "PartitionFilters: [isnotnull(month_key" in table.where("month_key = 202402")._jdf.queryExecution().executedPlan().toString()


def test_a_batch_that_died_before_its_commit_is_not_seen(spark, tmp_path, parts):
    root = str(tmp_path / "fact")
    A.append_batch(spark, root, "a", parts[0], W.number_reviews, "review_key")
    with pytest.raises(ZeroDivisionError), pytest.MonkeyPatch.context() as patch:
        patch.setattr(A.commits, "commit", lambda *a: 1 / 0)
        A.append_batch(spark, root, "b", parts[1], W.number_reviews, "review_key")
    assert keys(spark, root) == expected(parts[:1])
    A.append_batch(spark, root, "b", parts[1], W.number_reviews, "review_key")
    assert keys(spark, root) == expected(parts[:2])


def test_two_appending_writers_get_disjoint_keys(spark, tmp_path, parts, monkeypatch):
    root, real, first = str(tmp_path / "fact"), commits.commit, threading.Barrier(2)
    calls = []

    def commit(*args):
        calls.append(args[2]["batch"])
        if len(calls) <= 2:  # both have numbered from 1 by now
            first.wait(120)
        return real(*args)

    monkeypatch.setattr(A.commits, "commit", commit)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda k: A.append_batch(spark, root, f"b{k}", parts[k], W.number_reviews, "review_key"), range(2)))
    order = [int(b.name[1]) for b in A.batches(spark, root)]
    assert keys(spark, root) == expected([parts[k] for k in order]) and len(calls) == 3
