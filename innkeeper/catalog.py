"""The registered queries: one per operator group of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the stand-in extracts of ``sf_dir``.

``Build`` assembles the staging layer lazily, so a staging query only computes what it reads.
Warehouse queries read the staging tables and the star that the pipeline wrote (``_published``), once per application.
Parameters of the questions are fixed for the stand-in data: the calendar covers
January 2024, reviews cover 1995-2001.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeeper import schemas, session
from innkeeper.functions import columns as C
from innkeeper.operators import quality as Q
from innkeeper.operators.dedup import drop_exact_duplicates, keep_first
from innkeeper.operators.keys import dense_key
from innkeeper.operators.lookup import lookup_key, missing_parent_ids, union_all, union_distinct
from innkeeper.operators.metrics import metrics_frame
from innkeeper.plans import analytics as A
from innkeeper.plans import pipeline as P
from innkeeper.plans import staging as S
from innkeeper.plans import warehouse as W
from innkeeper.plans.append import append_batch, read_batches
from innkeeper.sources import files, standin
from innkeeper.sources.planted import broken, broken_star

# Question parameters on the stand-in data.
Q1_YEAR, Q1_MONTH = 2024, 1
Q2_YEAR, Q2_MONTH = 1997, 11
Q4_GUESTS, Q4_MIN_DAYS, Q4_YEAR, Q4_MONTH = 4, 7, 2024, 1
Q5_GUESTS, Q5_START, Q5_END = 5, "2024-01-10", "2024-01-14"
# Reviews (1995-2001) and calendar (2024-01) share no month; drill_across shifts
# review dates by this many years so the two facts overlap.
DRILL_SHIFT_YEARS = 27


class Build:
    """Lazily built layers of the stand-in warehouse for one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return standin.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return standin.raw_extracts(self.spark, self.sf_dir)

    @cached_property
    def stg_listings(self) -> DataFrame:
        return S.stage_listings(self.raw["listings"])

    @cached_property
    def stg_reviews(self) -> DataFrame:
        return S.stage_reviews(self.raw["reviews"])

    @cached_property
    def stg_calendar(self) -> DataFrame:
        return S.stage_calendar(self.raw["calendar"])

    @cached_property
    def stg_neighbourhoods(self) -> DataFrame:
        return S.stage_neighbourhoods(self.raw["neighbourhoods"])

    @cached_property
    def cleaned(self) -> S.Cleaned:
        return S.clean(self.stg_listings, self.stg_reviews, self.stg_calendar)

def _b(spark: SparkSession, sf_dir: str) -> Build:
    return Build(spark, sf_dir)


@dataclass
class Published:
    """Staging tables and star of one ``sf_dir``, written by the pipeline and read back."""

    staging: dict[str, DataFrame]
    star: W.Star
    metrics: list[dict]


_PUBLISHED: dict[tuple[str, str], Published] = {}


def _published(spark: SparkSession, sf_dir: str) -> Published:
    """Built once per application, as the questions, checks and warehouse steps read a published load."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PUBLISHED:
        root = session.scratch_path(spark, "innkeeper-published")
        staged = P.run_staging(spark, _b(spark, sf_dir).raw, f"{root}/staging", enforce=False)
        built = P.run_warehouse(spark, staged.path, f"{root}/warehouse", enforce=False)
        _PUBLISHED[key] = Published(P.read_staging(spark, staged.path), P.read_star(spark, built.path, built.row_counts), staged.metrics + built.metrics)
    return _PUBLISHED[key]


def _star(spark: SparkSession, sf_dir: str) -> W.Star:
    return _published(spark, sf_dir).star


# --- questions -------------------------------------------------------------------------


def q1_cheapest_most_available(spark, sf_dir):
    return A.cheapest_most_available(_star(spark, sf_dir), Q1_YEAR, Q1_MONTH)


def q2_most_reviewed(spark, sf_dir):
    return A.most_reviewed(_star(spark, sf_dir), Q2_YEAR, Q2_MONTH)


def q3_priciest_neighbourhood(spark, sf_dir):
    return A.priciest_neighbourhoods(_star(spark, sf_dir), 1)


def q4_family_stay(spark, sf_dir):
    return A.recommend_month(_star(spark, sf_dir), Q4_GUESTS, Q4_MIN_DAYS, Q4_YEAR, Q4_MONTH)


def q5_range_stay(spark, sf_dir):
    return A.recommend_range(_star(spark, sf_dir), Q5_GUESTS, Q5_START, Q5_END)


def drill_across(spark, sf_dir):
    p = _published(spark, sf_dir)
    star = p.star
    shifted = p.staging["reviews"].withColumn("date", F.add_months("date", 12 * DRILL_SHIFT_YEARS))
    return A.drill_across(star, W.fact_reviews(shifted, star.dim_listing, dim_rows=star.rows("dim_listing")))


# --- star build ------------------------------------------------------------------------


def dim_neighbourhood(spark, sf_dir):
    return W.dim_neighbourhood(_published(spark, sf_dir).staging["neighbourhoods"])


def dim_date(spark, sf_dir):
    stg = _published(spark, sf_dir).staging
    return W.dim_date(stg["calendar"], stg["reviews"])


def dim_listing(spark, sf_dir):
    p = _published(spark, sf_dir)
    return W.dim_listing(p.staging["listings"], p.star.dim_neighbourhood, dim_rows=p.star.rows("dim_neighbourhood"))


def fact_reviews(spark, sf_dir):
    p = _published(spark, sf_dir)
    return W.fact_reviews(p.staging["reviews"], p.star.dim_listing, dim_rows=p.star.rows("dim_listing"))


def fact_availability(spark, sf_dir):
    p = _published(spark, sf_dir)
    return W.fact_availability(p.staging["calendar"], p.star.dim_listing, dim_rows=p.star.rows("dim_listing"))


LINEITEM_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def fact_surrogate_key(spark, sf_dir):
    """K2 on the largest table: dense 1..N in (order, line, ...) order."""
    li = _b(spark, sf_dir).table("lineitem")
    packed = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return dense_key(li, LINEITEM_ORDER, "line_key", sort_value=packed)


def conform_types(spark, sf_dir):
    """Every listing column of the warehouse that staging has, cast to its target type."""
    listings = _b(spark, sf_dir).cleaned.listings
    target = [f for f in schemas.DIM_LISTING.fields if f.name in listings.columns]
    return W.conform(listings, T.StructType(target))


def append_batches(spark, sf_dir):
    """The reviews as three batches (by year), the second one sent twice: keys go on from batch to batch and
    the repeated one changes nothing."""
    p = _published(spark, sf_dir)
    root = session.scratch_path(spark, "innkeeper-append")
    year = F.year("date")
    parts = {"to 1995": year <= 1995, "1996 and 1997": year.between(1996, 1997), "from 1998": year >= 1998}
    for name in ("to 1995", "1996 and 1997", "1996 and 1997", "from 1998"):
        rows = W.review_rows(p.staging["reviews"].where(parts[name]), p.star.dim_listing, dim_rows=p.star.rows("dim_listing"))
        append_batch(spark, root, name, rows, W.number_reviews, "review_key")
    return read_batches(spark, root, schemas.FACT_REVIEWS)


# Numbers that depend on the columns of a row together: table -> (key, what goes with it).
CONTENT = {
    "dim_neighbourhood": ("neighbourhood_key", "length(neighbourhood) * 7 + length(neighbourhood_group)"),
    "dim_listing": ("listing_key", "listing_id + coalesce(neighbourhood_key, 0) * 31 + coalesce(accommodates, 0) * 7"),
    "dim_date": ("date_key", "year * 31 + month * 17 + day + week_of_year * 5 + day_of_week * 3 + quarter"),
    "fact_reviews": ("review_key", "review_id + listing_key * 31 + date_key * 7 + coalesce(reviewer_id, 0)"),
    "fact_availability": (
        "availability_key",
        "listing_key * 31 + date_key * 7 + cast(available AS INT) + coalesce(minimum_nights, 0) * 3 + coalesce(maximum_nights, 0)",
    ),
}


def full_refresh(spark, sf_dir):
    """The whole pipeline twice into the shared scratch folder (the
    second run replaces the first, whose files expire), then counts and content sums of the published star."""
    b = _b(spark, sf_dir)
    root = session.scratch_path(spark, "innkeeper-full-refresh")
    for _ in range(2):
        star = P.full_refresh(spark, b.raw, root, enforce=False)
    for layer in ("staging", "warehouse"):
        files.expire_versions(spark, f"{root}/{layer}", keep=1)
    parts = []
    for name, df in star.tables().items():
        key, rest = CONTENT[name]
        parts.append(
            df.selectExpr(f"cast({key} AS BIGINT) AS k", f"cast({key} % 1009 * (({rest}) % 1013) AS BIGINT) AS c").agg(
                F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.sum("k").alias("key_sum"), F.sum("c").alias("content_sum")
            )
        )
    return Q.report_union(parts)


# --- staging -------------------------------------------------------------------------


def stg_listings(spark, sf_dir):
    return _b(spark, sf_dir).stg_listings


def stg_reviews(spark, sf_dir):
    return _b(spark, sf_dir).stg_reviews


def stg_neighbourhoods(spark, sf_dir):
    return _b(spark, sf_dir).stg_neighbourhoods


def stg_calendar(spark, sf_dir):
    return _b(spark, sf_dir).stg_calendar


def clean_listings(spark, sf_dir):
    return _b(spark, sf_dir).cleaned.listings


def clean_reviews_semi(spark, sf_dir):
    return _b(spark, sf_dir).cleaned.reviews


def clean_calendar_semi(spark, sf_dir):
    return _b(spark, sf_dir).cleaned.calendar


def cleaning_metrics(spark, sf_dir):
    """Rows in and out of every cleaning step of the load, observed while it wrote."""
    return metrics_frame(spark, _published(spark, sf_dir).metrics)


def stg_reviews_extra(spark, sf_dir):
    """Reviews with a column that staging doesn't know, after the staging pipeline and its read-back."""
    raw = dict(_b(spark, sf_dir).raw)
    raw["reviews"] = raw["reviews"].withColumn("Review Source", F.concat(F.lit(" r"), "id"))
    staged = P.run_staging(spark, raw, session.scratch_path(spark, "innkeeper-extra"), enforce=False)
    return P.read_staging(spark, staged.path)["reviews"]


def normalise_headers(spark, sf_dir):
    return S.normalise_headers(_b(spark, sf_dir).raw["neighbourhoods"])


# --- scan / sink ---------------------------------------------------------------------


def scan_csv_typed(spark, sf_dir):
    """S1/S3 + M1: raw listings written as gzip CSV, read back with the explicit
    string schema and staged."""
    path = session.scratch_path(spark, "innkeeper-csv")
    files.write_csv(_b(spark, sf_dir).raw["listings"], path)
    return S.stage_listings(files.scan_csv(spark, path, schemas.LISTING_COLUMNS))


def scan_csv_plain(spark, sf_dir):
    """S2 + M2: raw reviews whose comments hold newlines, as one uncompressed file read in splits of 64 KB."""
    raw = _b(spark, sf_dir).raw["reviews"].withColumn("comments", F.concat("comments", F.lit("\nthe \"end\",\n")))
    with session.Scratch(spark) as scratch:
        path = scratch.path("innkeeper-csv-plain")
        files.write_csv(raw.coalesce(1), path, compression="none")
        return _kept(S.stage_reviews(files.scan_csv(spark, path, schemas.RAW_REVIEWS, split_bytes=1 << 16)))


def scan_csv_many(spark, sf_dir):
    """S1/S2 + M4: the calendar as many files of two layouts (other order and a column more), each bound by its own header."""
    raw = _b(spark, sf_dir).raw["calendar"]
    odd = F.col("listing_id").cast("long") % 2 == 1
    with session.Scratch(spark) as scratch:
        path = scratch.path("innkeeper-csv-many")
        files.write_csv(raw.where(~odd).repartition(5), f"{path}/even")
        other = raw.where(odd).select("maximum_nights", "date", F.concat("listing_id", F.lit(".00")).alias("price"), "available", "minimum_nights", "listing_id")
        files.write_csv(other.repartition(7), f"{path}/odd", compression="none")
        return _kept(S.stage_calendar(files.scan_csv(spark, [f"{path}/even", f"{path}/odd"], schemas.RAW_CALENDAR, multiline=False)))


def _kept(df: DataFrame) -> DataFrame:
    """``df`` written once for the caller, so that the files it was read from can go."""
    return session.Scratch(df.sparkSession).write(df, "innkeeper-scanned")


def staging_roundtrip(spark, sf_dir):
    """Cleaned reviews written to Parquet and read back with types intact."""
    path = session.scratch_path(spark, "innkeeper-staging")
    files.write_parquet(_b(spark, sf_dir).cleaned.reviews, path)
    return files.read_parquet(spark, path)


# --- scalars -------------------------------------------------------------------------


def cast_ids(spark, sf_dir):
    o = _b(spark, sf_dir).table("orders")
    large = (F.col("o_orderkey") + F.lit(2**53)).cast("string")  # beyond what a double holds exactly
    text = (
        F.when(F.col("o_orderstatus") == "P", F.lit(None))
        .when(F.col("o_orderstatus") == "F", F.concat(large, F.lit(".0")))
        .otherwise(F.concat(F.lit(" "), F.col("o_orderkey").cast("string")))
    )
    return o.select("o_orderkey", C.strict_bigint(text, "id").alias("parsed_id"))


def parse_date_lenient(spark, sf_dir):
    o = _b(spark, sf_dir).table("orders")
    iso = F.col("o_orderdate").cast("date").cast("string")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.regexp_replace(iso, "-", "/"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.substring(iso, 1, 8), F.lit("31")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("not a date"))
        .otherwise(iso)
    )
    return o.select("o_orderkey", text.alias("date_text"), C.parse_date(text).alias("parsed_date"))


def parse_currency(spark, sf_dir):
    p = _b(spark, sf_dir).table("part")
    money = F.format_number("p_retailprice", 2)
    text = (
        F.when(F.col("p_size") % 10 == 0, F.lit("call us"))
        .when(F.col("p_size") % 10 == 1, F.concat(F.lit("-$"), money))
        .otherwise(F.concat(F.lit("$"), money))
    )
    return p.select("p_partkey", text.alias("price_text"), C.parse_currency(text).alias("price"))


def parse_numeric_lenient(spark, sf_dir):
    e = _b(spark, sf_dir).table("events")
    num = F.format_string("%.2f", "value")
    text = (
        F.when(F.col("event_type") == "error", F.concat(num, F.lit("x")))
        .when(F.col("event_type") == "signup", F.concat(F.lit(" "), num, F.lit(" ")))
        .when(F.col("event_type") == "view", F.lit("nan"))
        .when(F.col("event_type") == "click", F.concat(num, F.lit("e2")))
        .otherwise(num)
    )
    return e.select("event_id", text.alias("value_text"), C.parse_number(text).alias("value"))


def _flag_text() -> F.Column:
    return F.when(F.col("event_type") == "click", "t").when(F.col("event_type") == "view", "f").when(
        F.col("event_type") == "error", "x"
    )


def parse_flag(spark, sf_dir):
    e = _b(spark, sf_dir).table("events")
    return e.select("event_id", _flag_text().alias("flag_text"), C.parse_flag(_flag_text()).alias("flag"))


def flag_to_bit(spark, sf_dir):
    e = _b(spark, sf_dir).table("events")
    return e.select("event_id", C.flag_to_bit(C.parse_flag(_flag_text())).alias("bit"))


def strip_text(spark, sf_dir):
    p = _b(spark, sf_dir).table("part")
    padded = F.concat(F.lit("\t "), "p_name", F.lit("\n  "))
    return p.select("p_partkey", C.strip_text(padded).alias("name"), C.strip_text(F.lit("   ")).alias("blank"))


def null_tokens(spark, sf_dir):
    e = _b(spark, sf_dir).table("events")
    text = (
        F.when(F.col("event_type") == "error", "N/A")
        .when(F.col("event_type") == "view", "null")
        .when(F.col("event_type") == "click", "")
        .when(F.col("event_type") == "signup", " NA ")
        .otherwise(F.col("event_type"))
    )
    return e.select("event_id", C.clean_text(text).alias("event_type"))


# --- dedup / filter --------------------------------------------------------------------


def dedup_exact(spark, sf_dir):
    li = _b(spark, sf_dir).table("lineitem")
    return drop_exact_duplicates(li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"))


def dedup_keep_first(spark, sf_dir):
    li = _b(spark, sf_dir).table("lineitem")
    return keep_first(li, ["l_orderkey", "l_linenumber"])


def dedup_composite(spark, sf_dir):
    cal = _b(spark, sf_dir).stg_calendar
    return keep_first(cal, ["listing_id", "date"], order_by=["available", "minimum_nights", "maximum_nights"])


def drop_null_rows(spark, sf_dir):
    df = _b(spark, sf_dir).stg_listings.select("listing_id", "review_scores_rating", "host_is_superhost", "host_since")
    return df.dropna(how="any", subset=["review_scores_rating", "host_is_superhost", "host_since"])


# --- joins / sets ----------------------------------------------------------------------


def lookup_left(spark, sf_dir):
    p = _published(spark, sf_dir)
    return W.listings_with_neighbourhood_key(p.staging["listings"], p.star.dim_neighbourhood).select(
        "listing_id", "neighbourhood", "neighbourhood_key"
    )


def lookup_inner(spark, sf_dir):
    p = _published(spark, sf_dir)
    return lookup_key(p.staging["reviews"].select("review_id", "listing_id"), p.star.dim_listing, "listing_id", "listing_key")


def lookup_misses(spark, sf_dir):
    p = _published(spark, sf_dir)
    return W.lookup_misses(W.listings_with_neighbourhood_key(p.staging["listings"], p.star.dim_neighbourhood))


def missing_parent_ids_q(spark, sf_dir):
    b = _b(spark, sf_dir)
    parent = b.cleaned.listings
    return (
        missing_parent_ids(b.stg_reviews, parent, "listing_id").withColumn("child", F.lit("reviews"))
        .unionByName(missing_parent_ids(b.stg_calendar, parent, "listing_id").withColumn("child", F.lit("calendar")))
    )


def union_dates(spark, sf_dir):
    b = _b(spark, sf_dir)
    return union_distinct(b.cleaned.calendar.select("date"), b.cleaned.reviews.select("date"))


def union_all_dates(spark, sf_dir):
    """The dates of both tables with their repeats."""
    stg = _published(spark, sf_dir).staging
    return union_all(*[stg[t].select(F.lit(t).alias("source"), "date") for t in ("calendar", "reviews")])


# --- quality ---------------------------------------------------------------------------


def dq_listings(spark, sf_dir):
    """V1-V4, V6 on cleaned listings with planted breaks: repeated and missing ids, no guests, fewer than no bedrooms, nights the wrong way."""
    changes = {
        "listing_id": "CASE WHEN listing_id % 40 = 2 THEN NULL ELSE listing_id END",
        "accommodates": "CASE WHEN listing_id % 40 = 3 THEN 0 ELSE accommodates END",
        "bedrooms": "CASE WHEN listing_id % 40 = 4 THEN -1 ELSE bedrooms END",
        "minimum_nights": "CASE WHEN listing_id % 40 = 5 THEN maximum_nights + 1 ELSE minimum_nights END",
    }
    planted = broken(_b(spark, sf_dir).cleaned.listings, "listing_id % 40 = 1", changes)
    return Q.validate(planted, "listings", Q.listing_rules())


def dq_reviews(spark, sf_dir):
    """V5/V8/V9 on cleaned reviews with planted breaks: repeated ids, no listing, no date."""
    changes = {
        "listing_id": "CASE WHEN review_id % 30 = 2 THEN NULL ELSE listing_id END",
        "date": "CASE WHEN review_id % 30 = 3 THEN NULL ELSE date END",
    }
    planted = broken(_b(spark, sf_dir).cleaned.reviews, "review_id % 30 = 1", changes)
    return Q.validate(planted, "reviews", Q.review_rules())


def dq_neighbourhoods(spark, sf_dir):
    """V10/V11 with names that occur twice and names that are missing."""
    changes = {"neighbourhood": "CASE WHEN ascii(right(neighbourhood, 1)) % 5 = 1 THEN NULL ELSE neighbourhood END"}
    planted = broken(_b(spark, sf_dir).stg_neighbourhoods, "ascii(right(neighbourhood, 1)) % 5 = 2", changes)
    return Q.validate(planted, "neighbourhoods", Q.neighbourhood_rules())


def dq_calendar(spark, sf_dir):
    """V5, V9, V12, V13 with missing listings, dates and flags beside the repeats that the calendar has."""
    changes = {
        "listing_id": "CASE WHEN listing_id % 30 = 2 THEN NULL ELSE listing_id END",
        "date": "CASE WHEN listing_id % 30 = 3 THEN NULL ELSE date END",
        "available": "CASE WHEN listing_id % 30 = 4 THEN NULL ELSE available END",
    }
    planted = broken(_b(spark, sf_dir).cleaned.calendar, "listing_id % 30 = 1", changes)
    return Q.validate(planted, "calendar", Q.calendar_rules())


def dq_relationships(spark, sf_dir):
    """V14 on the staged (not yet cleaned) tables, where orphans still exist."""
    b = _b(spark, sf_dir)
    return P.relationship_report(b.cleaned.listings, b.stg_reviews, b.stg_calendar)


def dq_duplicates(spark, sf_dir):
    li = _b(spark, sf_dir).table("lineitem")
    return Q.validate(
        li,
        "lineitem",
        [Q.Rule.unique_key("l_orderkey", severity=Q.REPORT), Q.Rule.unique_key("l_orderkey", "l_linenumber", severity=Q.REPORT)],
    )


def dq_constraints(spark, sf_dir):
    return W.constraint_report(broken_star(_star(spark, sf_dir)))


def orphan_facts(spark, sf_dir):
    return W.orphan_facts(broken_star(_star(spark, sf_dir)))


def invalid_date_keys(spark, sf_dir):
    return W.invalid_date_keys(broken_star(_star(spark, sf_dir)))


def table_row_counts(spark, sf_dir):
    return W.table_row_counts(_star(spark, sf_dir))


def check_unique_listings(spark, sf_dir):
    return W.total_vs_distinct(_star(spark, sf_dir).dim_listing, ["listing_id"], "total_listings", "unique_listings")


def check_unique_neighbourhoods(spark, sf_dir):
    return W.total_vs_distinct(
        _star(spark, sf_dir).dim_neighbourhood, ["neighbourhood"], "total_rows", "unique_neighbourhoods"
    )


def check_unique_reviews(spark, sf_dir):
    return W.total_vs_distinct(_star(spark, sf_dir).fact_reviews, ["review_id"], "total_reviews", "unique_reviews")


def check_unique_listing_date(spark, sf_dir):
    return W.total_vs_distinct(
        _star(spark, sf_dir).fact_availability, ["listing_key", "date_key"], "total_rows", "unique_listing_date"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q1_cheapest_most_available": q1_cheapest_most_available,
    "q2_most_reviewed": q2_most_reviewed,
    "q3_priciest_neighbourhood": q3_priciest_neighbourhood,
    "q4_family_stay": q4_family_stay,
    "q5_range_stay": q5_range_stay,
    "drill_across": drill_across,
    "dim_neighbourhood": dim_neighbourhood,
    "dim_date": dim_date,
    "dim_listing": dim_listing,
    "fact_reviews": fact_reviews,
    "fact_availability": fact_availability,
    "fact_surrogate_key": fact_surrogate_key,
    "conform_types": conform_types,
    "full_refresh": full_refresh,
    "append_batches": append_batches,
    "stg_listings": stg_listings,
    "stg_reviews": stg_reviews,
    "stg_neighbourhoods": stg_neighbourhoods,
    "stg_calendar": stg_calendar,
    "clean_listings": clean_listings,
    "clean_reviews_semi": clean_reviews_semi,
    "clean_calendar_semi": clean_calendar_semi,
    "cleaning_metrics": cleaning_metrics,
    "stg_reviews_extra": stg_reviews_extra,
    "normalise_headers": normalise_headers,
    "scan_csv_typed": scan_csv_typed,
    "scan_csv_plain": scan_csv_plain,
    "scan_csv_many": scan_csv_many,
    "staging_roundtrip": staging_roundtrip,
    "cast_ids": cast_ids,
    "parse_date_lenient": parse_date_lenient,
    "parse_currency": parse_currency,
    "parse_numeric_lenient": parse_numeric_lenient,
    "parse_flag": parse_flag,
    "flag_to_bit": flag_to_bit,
    "strip_text": strip_text,
    "null_tokens": null_tokens,
    "dedup_exact": dedup_exact,
    "dedup_keep_first": dedup_keep_first,
    "dedup_composite": dedup_composite,
    "drop_null_rows": drop_null_rows,
    "lookup_left": lookup_left,
    "lookup_inner": lookup_inner,
    "lookup_misses": lookup_misses,
    "missing_parent_ids": missing_parent_ids_q,
    "union_dates": union_dates,
    "union_all_dates": union_all_dates,
    "dq_listings": dq_listings,
    "dq_reviews": dq_reviews,
    "dq_neighbourhoods": dq_neighbourhoods,
    "dq_calendar": dq_calendar,
    "dq_relationships": dq_relationships,
    "dq_duplicates": dq_duplicates,
    "dq_constraints": dq_constraints,
    "orphan_facts": orphan_facts,
    "invalid_date_keys": invalid_date_keys,
    "table_row_counts": table_row_counts,
    "check_unique_listings": check_unique_listings,
    "check_unique_neighbourhoods": check_unique_neighbourhoods,
    "check_unique_reviews": check_unique_reviews,
    "check_unique_listing_date": check_unique_listing_date,
}
