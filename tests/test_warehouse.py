import pytest
from pyspark.sql import functions as F

from innkeeper import session
from innkeeper.operators import quality as Q
from innkeeper.plans import pipeline as P
from innkeeper.plans import warehouse as W
from tests.fixtures import raw


@pytest.fixture(scope="module")
def star(spark):
    root = session.scratch_path(spark, "test-wh")
    return P.full_refresh(spark, raw(spark), root, enforce=False), root


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_staging_enforce_raises_on_duplicate_listing_date(spark):
    root = session.scratch_path(spark, "test-enforce")
    with pytest.raises(Q.DataQualityError, match="listing_id_date_unique"):
        P.run_staging(spark, raw(spark), root, enforce=True)


def test_dim_neighbourhood_dedup_before_null_drop(star):
    s, _ = star
    assert rows(s.dim_neighbourhood, "neighbourhood_key", "neighbourhood", "neighbourhood_group") == [
        (1, "Born", "G"), (2, "Gracia", "G")]


def test_dim_listing_keys_and_unmatched_lookup(star):
    s, _ = star
    assert rows(s.dim_listing, "listing_key", "listing_id", "neighbourhood_key") == [
        (1, 1, 2), (2, 2, 2), (3, 3, 1), (4, 4, None)]
    assert str(s.dim_listing.schema["latitude"].dataType) == "DecimalType(9,6)"


def test_dim_date_only_observed_dates(star):
    s, _ = star
    assert s.dim_date.count() == 31 + 3
    assert s.dim_date.filter("date_key = 20270101").first()["week_of_year"] == 53


def test_fact_availability_dedup_unavailable_wins(star):
    s, _ = star
    assert s.fact_availability.count() == 4 * 31
    row = s.fact_availability.filter("listing_key = 3 AND date_key = 20270106").first()
    assert row["available"] is False
    keys = [r[0] for r in s.fact_availability.select("availability_key").collect()]
    assert sorted(keys) == list(range(1, 4 * 31 + 1))


def test_fact_reviews(star):
    s, _ = star
    assert rows(s.fact_reviews, "review_key", "review_id", "listing_key", "date_key", "review_count") == [
        (1, 10, 1, 20261102, 1), (2, 11, 1, 20261120, 1), (3, 12, 2, 20261121, 1)]


def test_facts_are_month_partitioned(star, spark):
    s, _ = star
    plan = s.fact_availability.filter("month_key = 202701")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month_key" in plan


def test_post_load_checks_clean(star):
    s, _ = star
    assert all(r["violations"] == 0 for r in W.constraint_report(s).collect())
    assert all(r["violations"] == 0 for r in W.orphan_facts(s).collect())
    assert all(r["violations"] == 0 for r in W.invalid_date_keys(s).collect())
    tv = W.total_vs_distinct(s.fact_availability, ["listing_key", "date_key"], "t", "d").first()
    assert tv["t"] == tv["d"]


def test_constraint_report_finds_planted_violations(star, spark):
    s, _ = star
    broken = W.Star(
        dim_neighbourhood=s.dim_neighbourhood,
        dim_listing=s.dim_listing.unionByName(s.dim_listing.limit(1)),
        dim_date=s.dim_date,
        fact_reviews=s.fact_reviews.withColumn("listing_key", F.lit(99)),
        fact_availability=s.fact_availability,
    )
    got = {(r["table_name"], r["rule"]): r["violations"] for r in W.constraint_report(broken).collect()}
    assert got[("dim_listing", "listing_id_unique")] == 1
    assert got[("fact_reviews", "orphan_listing_key")] == 3


def test_rerun_gives_same_rows(star, spark):
    s, root = star
    again = P.full_refresh(spark, raw(spark), root, enforce=False)
    for name, df in s.tables().items():
        assert rows(df, *df.columns) == rows(again.tables()[name], *df.columns), name


def test_without_match_anti_join(spark):
    from innkeeper.operators.lookup import without_match

    fact = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    dim = spark.createDataFrame([(1,), (3,)], "k int")
    assert [r[0] for r in without_match(fact, dim, "k").collect()] == [2]


def test_fact_files_follow_months(star, spark):
    _, root = star
    import glob

    version = glob.glob(f"{root}/warehouse/v=*/fact_availability/month_key=*")
    assert version, "fact is partitioned by month_key"


def test_staging_metrics_observed_during_writes(spark):
    root = session.scratch_path(spark, "test-metrics")
    result = P.run_staging(spark, raw(spark), root, enforce=False)
    m = {x["step"]: x for x in result.metrics}
    assert m["listings_nights_range"] == {"step": "listings_nights_range", "rows_in": 5, "rows_out": 4, "dropped": 1}
    assert m["reviews_orphans"]["dropped"] == 1
    assert m["calendar_orphans"]["rows_in"] == 5 * 31 + 1 and m["calendar_orphans"]["dropped"] == 31


def test_every_step_has_its_rows(spark):
    """Rows in and out of each step of both loads, observed during the writes."""
    root = session.scratch_path(spark, "test-steps")
    staged = P.run_staging(spark, raw(spark), f"{root}/staging", enforce=False)
    built = P.run_warehouse(spark, staged.path, f"{root}/warehouse", enforce=False)
    got = {m["step"]: (m["rows_in"], m["rows_out"], m["dropped"]) for m in staged.metrics + built.metrics}
    assert got == {
        "neighbourhoods_duplicates": (5, 4, 1), "listings_nights_range": (5, 4, 1), "reviews_orphans": (4, 3, 1),
        "calendar_duplicates": (157, 156, 1), "calendar_orphans": (156, 125, 31), "dim_date_dates": (128, 34, 94),
        "dim_neighbourhood_duplicates": (4, 3, 1), "dim_neighbourhood_nulls": (3, 2, 1), "dim_listing_duplicates": (4, 4, 0),
        "dim_listing_lookup": (4, 3, 1), "fact_reviews_lookup": (3, 3, 0), "fact_availability_duplicates": (125, 124, 1),
        "fact_availability_lookup": (124, 124, 0),
    }


def test_validate_warehouse_reports(star):
    s, _ = star
    reports = W.validate_warehouse(s)
    counts = {r["table_name"]: r["row_count"] for r in reports["row_counts"].collect()}
    assert counts == {"dim_neighbourhood": 2, "dim_listing": 4, "dim_date": 34, "fact_reviews": 3, "fact_availability": 124}
    u = reports["unique_listing_date"].first()
    assert u["total_rows"] == u["unique_listing_date"] == 124


def test_fact_files_are_clustered_by_day(star):
    """Within each written file rows are in date_key order, so Parquet row-group
    statistics can skip row groups for a date range."""
    import glob

    import pyarrow.parquet as pq

    _, root = star
    files_ = glob.glob(f"{root}/warehouse/v=*/fact_availability/month_key=*/*.parquet")
    assert files_
    for f in files_:
        keys = pq.read_table(f, columns=["date_key"]).column("date_key").to_pylist()
        assert keys == sorted(keys), f
