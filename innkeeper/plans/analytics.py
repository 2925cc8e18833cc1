"""Business questions over the star (Q1-Q5) and the drill-across report.

Plan shape for every fact question: prune the fact by ``month_key`` (and
``date_key`` for a range; both follow from the DimDate predicate because
``month_key = date_key div 100`` and ``date_key`` orders like the date), keep
the DimDate predicate as a semi join, aggregate per ``listing_key`` (partial
aggregation before the only fact shuffle), and only then join listing
attributes.  Listing attributes are unique per ``listing_key`` (checked by
``constraint_report``), so grouping by the key equals grouping by
``(listing_id, price, ...)``.  Top-k is ``orderBy().limit()``, which Spark runs
as a per-partition top-k followed by one merge (TakeOrderedAndProject).
Every ordering ends with a natural-key tie-break; a NULL price ranks cheapest.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeeper.functions import columns as C
from innkeeper.operators.lookup import DEFAULT_BROADCAST_ROWS, checked_broadcast
from innkeeper.plans.warehouse import Star


def _date_keys(star: Star, predicate, k0: int, k1: int, max_broadcast_rows: int) -> DataFrame:
    """Distinct DimDate keys matching ``predicate``.  ``k0..k1`` bounds date_key
    (implied by the predicate: date_key is yyyyMMdd of full_date), so the result
    has at most ``k1 - k0 + 1`` rows: a proof of size that needs no count job."""
    keys = (
        star.dim_date.filter(predicate & F.col("date_key").between(k0, k1)).select("date_key").distinct()
    )
    if k1 - k0 + 1 <= max_broadcast_rows:
        return F.broadcast(keys)
    return checked_broadcast(keys, max_broadcast_rows)


def _dim_neighbourhood(star: Star, max_broadcast_rows: int) -> DataFrame:
    rows = star.rows("dim_neighbourhood") if hasattr(star, "rows") else None
    side = star.dim_neighbourhood.select("neighbourhood_key", "neighbourhood")
    return checked_broadcast(side, max_broadcast_rows, rows)


def _month_dates(star: Star, year: int, month: int, max_broadcast_rows: int) -> DataFrame:
    base = (year * 100 + month) * 100
    predicate = (F.col("year") == year) & (F.col("month") == month)
    return _date_keys(star, predicate, base + 1, base + 31, max_broadcast_rows)


def _available_days(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """``SUM(CAST(available AS INT))`` per listing_key over available rows on ``dates``
    (``dates`` is already a size-checked broadcast)."""
    return (
        fact.filter(F.col("available"))
        .join(dates, "date_key", "left_semi")
        .groupBy("listing_key")
        .agg(F.sum(C.flag_to_bit("available")).cast("bigint").alias("days_available"))
    )


def cheapest_most_available(
    star: Star, year: int, month: int, n: int = 1, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """Q1: listing(s) with the most available days in a month, cheapest first."""
    ym = year * 100 + month
    fact = star.fact_availability.filter(F.col("month_key") == ym)
    days = _available_days(fact, _month_dates(star, year, month, max_broadcast_rows))
    listing = star.dim_listing.select("listing_key", "listing_id", "price")
    return (
        days.join(listing, "listing_key")
        .select("listing_id", "price", "days_available")
        .orderBy(F.desc("days_available"), F.asc_nulls_first("price"), F.asc("listing_id"))
        .limit(n)
    )


def most_reviewed(
    star: Star, year: int, month: int, n: int = 10, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """Q2: listings with the most reviews in a month."""
    ym = year * 100 + month
    counts = (
        star.fact_reviews.filter(F.col("month_key") == ym)
        .join(_month_dates(star, year, month, max_broadcast_rows), "date_key", "left_semi")
        .groupBy("listing_key")
        .agg(F.count("review_id").cast("bigint").alias("total_reviews"))
    )
    return (
        counts.join(star.dim_listing.select("listing_key", "listing_id"), "listing_key")
        .select("listing_id", "total_reviews")
        .orderBy(F.desc("total_reviews"), F.asc("listing_id"))
        .limit(n)
    )


def priciest_neighbourhoods(star: Star, n: int = 1, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Q3: neighbourhoods by average listing price (each listing counts once).
    The average is rounded to 6 places before ranking so that engines agree."""
    avg = (
        star.dim_listing.groupBy("neighbourhood_key")
        .agg(F.avg(F.col("price").cast("double")).alias("_avg"))
        .join(_dim_neighbourhood(star, max_broadcast_rows), "neighbourhood_key")
        .select("neighbourhood", F.round("_avg", 6).alias("avg_price"))
    )
    return avg.orderBy(F.desc_nulls_last("avg_price"), F.asc("neighbourhood")).limit(n)


def _recommend(
    star: Star, fact: DataFrame, dates: DataFrame, guests: int, keep_days, n: int, max_broadcast_rows: int
) -> DataFrame:
    days = _available_days(fact, dates).filter(keep_days(F.col("days_available")))
    listing = star.dim_listing.filter(F.col("accommodates") >= guests).select(
        "listing_key", "listing_id", "neighbourhood_key", "accommodates", "price"
    )
    nb = _dim_neighbourhood(star, max_broadcast_rows)
    return (
        days.join(listing, "listing_key")
        .join(nb, "neighbourhood_key")
        .select("listing_id", "neighbourhood", "accommodates", "price", "days_available")
        .orderBy(F.asc_nulls_first("price"), F.asc("listing_id"))
        .limit(n)
    )


def recommend_month(
    star: Star,
    guests: int,
    min_days: int,
    year: int,
    month: int,
    n: int = 5,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Q4: cheapest listings for ``guests`` people with at least ``min_days``
    available days (not necessarily consecutive) in the month."""
    fact = star.fact_availability.filter(F.col("month_key") == year * 100 + month)
    dates = _month_dates(star, year, month, max_broadcast_rows)
    return _recommend(star, fact, dates, guests, lambda d: d >= min_days, n, max_broadcast_rows)


def recommend_range(
    star: Star,
    guests: int,
    start: str | _dt.date,
    end: str | _dt.date,
    n: int = 5,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Q5: cheapest listings for ``guests`` people available on every day of the
    inclusive range ``start..end`` (the fact is unique per listing and date, so
    "every day" is "available days = length of the range")."""
    start_d = _dt.date.fromisoformat(str(start))
    end_d = _dt.date.fromisoformat(str(end))
    n_days = (end_d - start_d).days + 1
    k0, k1 = (int(d.strftime("%Y%m%d")) for d in (start_d, end_d))
    fact = star.fact_availability.filter(
        F.col("month_key").between(k0 // 100, k1 // 100) & F.col("date_key").between(k0, k1)
    )
    dates = _date_keys(star, F.col("full_date").between(F.lit(start_d), F.lit(end_d)), k0, k1, max_broadcast_rows)
    return _recommend(star, fact, dates, guests, lambda d: d == n_days, n, max_broadcast_rows)


def drill_across(star: Star, fact_reviews: DataFrame | None = None) -> DataFrame:
    """Reviews and available days per listing and month, side by side (the two
    facts share DimListing and DimDate).  Both sides are aggregated to
    (listing_key, month_key) first, so the full outer join reuses that
    partitioning; a side with no row for the pair shows 0."""
    reviews = (fact_reviews if fact_reviews is not None else star.fact_reviews).groupBy("listing_key", "month_key").agg(
        F.sum("review_count").cast("bigint").alias("reviews")
    )
    avail = star.fact_availability.groupBy("listing_key", "month_key").agg(
        F.sum(C.flag_to_bit("available")).cast("bigint").alias("available_days")
    )
    both = reviews.join(avail, ["listing_key", "month_key"], "full_outer")
    return both.join(star.dim_listing.select("listing_key", "listing_id"), "listing_key").select(
        "listing_id",
        "month_key",
        F.coalesce("reviews", F.lit(0)).cast("bigint").alias("reviews"),
        F.coalesce("available_days", F.lit(0)).cast("bigint").alias("available_days"),
    )
