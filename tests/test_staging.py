import pytest
from pyspark.sql import functions as F

from innkeeper import schemas, session
from innkeeper.plans import pipeline as P
from innkeeper.plans import staging as S
from innkeeper.sources import files
from tests.fixtures import raw


def test_nights_range_filter(spark):
    df = spark.createDataFrame([(1, 1, 3), (2, 3, 1), (3, None, 3), (4, 2, 2)], "listing_id int, minimum_nights int, maximum_nights int")
    assert sorted(r[0] for r in S.nights_in_range(df).collect()) == [1, 4]


def test_stage_listings_types_and_values(spark):
    stg = S.stage_listings(raw(spark)["listings"])
    assert stg.schema == schemas.STG_LISTINGS
    row = stg.filter("listing_id = 5").first()
    assert row["price"] == 1200.0 and row["host_name"] == "Host 5" and row["host_is_superhost"] is True


def test_missing_listing_column_raises(spark):
    with pytest.raises(Exception):
        S.stage_listings(raw(spark)["listings"].drop("beds"))


def test_clean_drops_orphans_and_counts(spark):
    r = raw(spark)
    stg_l, stg_r, stg_c = S.stage_listings(r["listings"]), S.stage_reviews(r["reviews"]), S.stage_calendar(r["calendar"])
    c = S.clean(stg_l, stg_r, stg_c)
    assert sorted(x[0] for x in c.listings.select("listing_id").collect()) == [1, 2, 3, 4]
    assert 13 not in [x[0] for x in c.reviews.select("review_id").collect()]
    assert c.reviews.count() == stg_r.count() - 1 and c.calendar.count() == stg_c.count() - 31


def test_unknown_columns_pass_through_both_layers(spark):
    r = raw(spark)
    r["reviews"] = r["reviews"].withColumn("a `b`", F.lit(" as is ")).withColumn("score", F.lit("x"))
    r["calendar"] = r["calendar"].withColumn("Price", F.col("date"))
    staged = P.run_staging(spark, r, session.scratch_path(spark, "test-extra"), enforce=False)
    back = P.read_staging(spark, staged.path)
    assert back["reviews"].columns == [*schemas.STG_REVIEWS.fieldNames(), "a `b`", "score"]
    assert {tuple(x) for x in back["reviews"].select(F.col("`a ``b```"), "score").collect()} == {(" as is ", "x")}
    assert back["calendar"].columns == [*schemas.STG_CALENDAR.fieldNames(), "Price"]
    assert back["calendar"].where("Price <> cast(date as string) OR Price IS NULL").count() == 0
    # the star is built from such a version as from any other
    assert P.run_warehouse(spark, staged.path, session.scratch_path(spark, "test-extra-wh"), enforce=False).row_counts["fact_reviews"] == 3


def test_a_version_without_recorded_schemas_reads_the_fixed_ones(spark):
    staged = P.run_staging(spark, raw(spark), session.scratch_path(spark, "test-old"), enforce=False)
    session.delete_path(spark, f"{staged.path}/_schemas.json")
    assert P.read_staging(spark, staged.path)["reviews"].schema == schemas.STG_REVIEWS


def test_an_unknown_column_named_like_a_staged_one_raises(spark):
    with pytest.raises(ValueError, match=r"named like staged ones: \['Review_ID'\]"):
        S.stage_reviews(raw(spark)["reviews"].withColumn("Review_ID", F.lit("1")))


def test_stage_calendar_drops_exact_duplicates_only(spark):
    cal = S.stage_calendar(raw(spark)["calendar"])
    assert cal.count() == 5 * 31 + 1  # the differing copy stays


def test_stage_neighbourhoods_normalises(spark):
    nb = S.stage_neighbourhoods(raw(spark)["neighbourhoods"])
    assert nb.columns == ["neighbourhood_group", "neighbourhood"]
    want = [("G", "Gracia"), ("G", "Born"), (None, "Sants"), ("G", "Sants")]
    assert sorted((tuple(r) for r in nb.collect()), key=repr) == sorted(want, key=repr)


def test_csv_round_trip_keeps_quoted_text(spark):
    path = session.scratch_path(spark, "test-csv")
    r = raw(spark)
    files.write_csv(r["reviews"], path)
    back = files.scan_csv(spark, path, schemas.RAW_REVIEWS)
    texts = sorted(x[0] for x in back.select("comments").collect())
    assert 'Great, "cozy"\nplace' in texts
    assert back.count() == 4
    assert sorted(x[0] for x in back.select("reviewer_name").collect())[0] == " Ann "


def test_required_input_missing(spark):
    with pytest.raises(FileNotFoundError, match="input/a, .*input/b"):
        files.read_tables(spark, "/nonexistent/innkeeper/input", {"a": None, "b": None})


def test_lenient_parsers_keep_rows(spark):
    df = spark.createDataFrame([("1", "bad", "t", "x", "3")], schemas.RAW_CALENDAR)
    row = S.stage_calendar(df).first()
    assert row["date"] is None and row["minimum_nights"] is None and row["maximum_nights"] == 3


def test_plain_csv_without_multiline(spark):
    path = session.scratch_path(spark, "test-csv-plain")
    r = raw(spark)
    files.write_csv(r["calendar"], path, compression="none")
    back = files.scan_csv(spark, path, schemas.RAW_CALENDAR, multiline=False)
    assert back.count() == r["calendar"].count()
    assert sorted(tuple(x) for x in back.collect()) == sorted(tuple(x) for x in r["calendar"].collect())


def test_union_all_keeps_duplicates(spark):
    from innkeeper.operators.lookup import union_all, union_distinct

    a = spark.createDataFrame([(1,), (2,)], "d int")
    b = spark.createDataFrame([(2,), (3,)], "d int")
    assert union_all(a, b).count() == 4
    assert union_distinct(a, b).count() == 3


def test_read_tables_names_every_missing_input(spark):
    with pytest.raises(FileNotFoundError) as err:
        files.read_tables(spark, "/nonexistent/innkeeper", {"a": None, "b": schemas.STG_REVIEWS})
    assert "/nonexistent/innkeeper/a" in str(err.value) and "/nonexistent/innkeeper/b" in str(err.value)


def test_publish_moves_the_current_pointer(spark):
    root = session.scratch_path(spark, "test-publish")
    v1, v2 = files.new_version(root), files.new_version(root)
    files.publish_version(spark, root, v1)
    assert files.current_version(spark, root) == v1
    files.publish_version(spark, root, v2)
    assert files.current_version(spark, root) == v2


def test_csv_binds_columns_by_header_name(spark):
    """Extracts carry more columns than staging uses, in their own order."""
    path = session.scratch_path(spark, "test-csv-order")
    r = raw(spark)["listings"]
    rest = [c for c in reversed(r.columns) if c not in ("price", "id", "name")]
    shuffled = r.select("price", "id", "name", *rest)
    files.write_csv(shuffled.withColumn("scrape_id", shuffled["id"]), path)
    back = files.scan_csv(spark, path, schemas.LISTING_COLUMNS)
    staged = S.stage_listings(back)
    assert sorted((x["listing_id"], x["price"]) for x in staged.collect()) == [
        (1, 100.0), (2, 80.0), (3, None), (4, 50.0), (5, 1200.0)]
    with pytest.raises(ValueError, match="missing columns"):
        files.scan_csv(spark, path, ["id", "no_such_column"])


def test_missing_pointer_is_a_clear_error(spark):
    with pytest.raises(FileNotFoundError):
        files.current_version(spark, session.scratch_path(spark, "test-no-pointer"))
