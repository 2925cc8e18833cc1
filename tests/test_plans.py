"""Physical-plan assertions on a star built by the pipeline from the sf0.001 stand-ins."""

import contextlib
import io

import pytest

from innkeeper import catalog, session
from innkeeper.plans import analytics as A
from innkeeper.plans import pipeline as P
from innkeeper.plans import warehouse as W
from innkeeper.sources import files, standin
from innkeeper.sources.planted import broken_star
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def built(spark):
    root = session.scratch_path(spark, "test-plans")
    raw = standin.raw_extracts(spark, SF_SMALL)
    staged = P.run_staging(spark, raw, f"{root}/staging", enforce=False)
    wh = P.run_warehouse(spark, staged.path, f"{root}/warehouse", enforce=False)
    return P.read_star(spark, wh.path, wh.row_counts), P.read_staging(spark, staged.path)


def test_q1_prunes_months_and_aggregates_before_shuffle(built):
    star, _ = built
    plan = plan_of(A.cheapest_most_available(star, catalog.Q1_YEAR, catalog.Q1_MONTH))
    assert "PartitionFilters: [isnotnull(month_key" in plan and "202401" in plan
    assert "ReadSchema: struct<listing_key:int,date_key:int,available:boolean>" in plan
    assert "BroadcastHashJoin LeftSemi" in plan
    # the tree lists the partial aggregate below the first exchange of the fact side
    tree = plan.split("\n\n")[0].replace("BroadcastExchange", "Broadcast")
    assert tree.index("HashAggregate") < tree.index("Exchange") < tree.rindex("HashAggregate")


def test_q5_pushes_the_date_key_range(built):
    star, _ = built
    plan = plan_of(A.recommend_range(star, catalog.Q5_GUESTS, catalog.Q5_START, catalog.Q5_END))
    assert "GreaterThanOrEqual(date_key,20240110)" in plan and "LessThanOrEqual(date_key,20240114)" in plan


def test_fact_lookup_uses_broadcast_when_dimension_is_proved_small(built, spark):
    star, stg = built
    rows = W.availability_rows(stg["calendar"], star.dim_listing, dim_rows=star.rows("dim_listing"))
    assert "BroadcastHashJoin" in plan_of(rows)


def test_large_dimension_is_not_broadcast(built, spark):
    """Over the row limit no hint is given; with Spark's own size threshold off
    (a dimension too large for it), the lookup is a shuffle join."""
    star, stg = built
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rows = W.review_rows(stg["reviews"], star.dim_listing, max_broadcast_rows=10, dim_rows=star.rows("dim_listing"))
        plan = plan_of(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("piece_rows", [100, 8_000_000])
def test_one_shuffle_serves_numbering_and_files(built, spark, piece_rows):
    """After the lookup a fact moves once: by the numbering's buckets, which are the files; the write
    adds neither an exchange nor a sort to the one of the numbering."""
    star, stg = built
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for rows, number in ((W.review_rows(stg["reviews"], star.dim_listing), W.number_reviews), (W.availability_rows(stg["calendar"], star.dim_listing), W.number_availability)):
            fact = number(rows, piece_rows)
            path = session.scratch_path(spark, "test-layout")
            plan = fact._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1, plan
            assert ("direct_shuffle_partition_id" if piece_rows == 100 else "SinglePartition") in plan, plan  # few rows: one task
            assert plan.count("Sort [") == 1 and "Sort [month_key" in plan, plan
            # what a write partitioned by month asks of its input, so it sorts nothing
            assert fact._jdf.queryExecution().optimizedPlan().outputOrdering().toString().startswith("List(month_key#")
            written = P.write_fact(fact, path)
            assert written == rows.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_both_foreign_keys_of_a_fact_come_from_one_scan(built):
    star, _ = built
    broken = broken_star(star)
    report = W.foreign_key_report(broken)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    for fact in W.FACTS:
        leaves = [line for line in plan.splitlines() if "Relation" in line and ("review" if fact == "fact_reviews" else "available") in line]
        assert len(leaves) == 2, leaves  # the broken fact is a union of two reads
    got = {(r["table_name"], r["rule"]): r["violations"] for r in report.collect()}
    for fact in W.FACTS:
        rows = getattr(broken, fact)
        for key, dim in (("listing_key", broken.dim_listing), ("date_key", broken.dim_date)):
            known = {r[0] for r in dim.select(key).collect()}
            assert got[fact, W.KEY_RULES[key]] == sum(r[0] not in known or r[0] is None for r in rows.select(key).collect()) > 0
    assert len(got) == 4


def test_row_counts_come_from_footers(built):
    star, _ = built
    counts = W.table_row_counts(star)
    plan = plan_of(counts)
    assert plan.count("ReadSchema: struct<>") == plan.count("ReadSchema") == 5, plan
    assert {r["table_name"]: r["row_count"] for r in counts.collect()} == {n: df.count() for n, df in star.tables().items()}


def test_staging_reads_only_needed_columns(built):
    _, stg = built
    plan = plan_of(W.dim_date(stg["calendar"], stg["reviews"]))
    assert "ReadSchema: struct<date:date>" in plan


def test_enforced_staging_names_every_fatal_rule(spark):
    from innkeeper.operators.quality import DataQualityError

    root = session.scratch_path(spark, "test-enforce-standin")
    with pytest.raises(DataQualityError) as err:
        P.run_staging(spark, standin.raw_extracts(spark, SF_SMALL), f"{root}/staging", enforce=True)
    message = str(err.value)
    for rule in ("price_not_negative", "rating_between_1_and_5", "listing_id_date_unique"):
        assert rule in message, rule
    with pytest.raises(Exception):  # nothing was published
        files.current_version(spark, f"{root}/staging")
