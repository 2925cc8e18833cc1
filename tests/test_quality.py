import pytest
from pyspark.sql import functions as F

from innkeeper.operators import quality as Q


def report(df, table, rules):
    return {r["rule"]: r["violations"] for r in Q.validate(df, table, rules).collect()}


def test_listing_rules_planted_and_clean(spark):
    bad = spark.createDataFrame(
        [(1, -1.0, 0, -1, 5, 2, 0.5), (1, 10.0, 2, 1, 1, 3, 5.5), (None, 10.0, 2, 1, 1, 3, None)],
        "listing_id long, price double, accommodates int, bedrooms int, minimum_nights int, maximum_nights int, review_scores_rating double",
    )
    got = report(bad, "listings", Q.listing_rules())
    assert got == {
        "listing_id_unique": 1, "listing_id_not_null": 1, "price_not_negative": 1, "accommodates_positive": 1,
        "bedrooms_not_negative": 1, "min_nights_le_max_nights": 1, "rating_between_1_and_5": 2,
    }
    good = bad.filter("listing_id = 1 AND price > 0").withColumn("review_scores_rating", F.lit(4.0)).withColumn(
        "accommodates", F.lit(2)).withColumn("bedrooms", F.lit(1)).withColumn("minimum_nights", F.lit(1))
    assert set(report(good, "listings", Q.listing_rules()).values()) == {0}


def test_calendar_and_review_rules(spark):
    cal = spark.createDataFrame([(1, "2027-01-01", True), (1, "2027-01-01", None), (None, None, True)],
                                "listing_id long, date string, available boolean")
    assert report(cal, "calendar", Q.calendar_rules()) == {
        "listing_id_not_null": 1, "date_not_null": 1, "available_not_null": 1, "listing_id_date_unique": 1}
    rev = spark.createDataFrame([(1, 1, "d"), (2, 1, None)], "review_id long, listing_id long, date string")
    assert report(rev, "reviews", Q.review_rules()) == {"review_id_unique": 0, "listing_id_not_null": 0, "date_not_null": 1}


def test_neighbourhood_rules(spark):
    nb = spark.createDataFrame([("A", None), ("A", "G"), (None, "G")], "neighbourhood string, neighbourhood_group string")
    assert report(nb, "neighbourhoods", Q.neighbourhood_rules()) == {
        "neighbourhood_not_null": 1, "neighbourhood_group_not_null": 1, "neighbourhood_unique": 1}


def test_enforce_reports_every_fatal_rule(spark):
    df = spark.createDataFrame([(None, -1.0)], "listing_id long, price double")
    rules = [Q.Rule.not_null("listing_id"), Q.Rule.row("price_not_negative", F.col("price") < 0),
             Q.Rule.row("warn_only", F.lit(True), Q.WARNING)]
    with pytest.raises(Q.DataQualityError) as err:
        Q.enforce(Q.validate(df, "listings", rules))
    assert "listing_id_not_null" in str(err.value) and "price_not_negative" in str(err.value)
    assert "warn_only" not in str(err.value)


def test_warnings_do_not_raise(spark):
    df = spark.createDataFrame([(1,)], "x int")
    rows = Q.enforce(Q.validate(df, "t", [Q.Rule.row("w", F.lit(True), Q.WARNING)]))
    assert rows[0]["violations"] == 1
