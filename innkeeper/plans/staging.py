"""Staging (M1-M5): raw string extracts -> typed, cleaned staging tables.

Each ``stage_*`` is a single projection (plus one dedup for calendar and
neighbourhoods) built from column functions, so Catalyst fuses it into the
scan's codegen stage.  ``clean`` applies the cross-table rules: the nights range
filter on listings and semi joins of reviews/calendar to the listings kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeeper import schemas
from innkeeper.functions import columns as C
from innkeeper.operators.dedup import drop_exact_duplicates
from innkeeper.operators.lookup import checked_broadcast
from innkeeper.operators.metrics import COPIES, StepMetrics

LISTING_RENAMES = {
    "id": "listing_id",
    "neighbourhood_cleansed": "neighbourhood",
    "neighbourhood_group_cleansed": "neighbourhood_group",
}

_LISTING_TEXT = ["host_name", "neighbourhood", "neighbourhood_group", "property_type", "room_type"]
_LISTING_DATES = ["host_since", "first_review", "last_review"]
_LISTING_NUMBERS = ["latitude", "longitude", "bathrooms", "review_scores_rating", "reviews_per_month"]


def _typed(name: str, c, dtype) -> F.Column:
    return c.cast(dtype).alias(name)


def stage_listings(raw: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """M1: select the 30 listing columns (a missing one raises), rename, type."""
    df = raw.select(*schemas.LISTING_COLUMNS).withColumnsRenamed(LISTING_RENAMES)
    out = []
    for field in schemas.STG_LISTINGS.fields:
        name, c = field.name, F.col(field.name)
        if name in ("listing_id", "host_id"):
            expr = C.strict_bigint(c, name)
        elif name in _LISTING_TEXT:
            expr = C.clean_text(c)
        elif name in _LISTING_DATES:
            expr = C.parse_date(c, date_format)
        elif name == "host_is_superhost":
            expr = C.parse_flag(c)
        elif name == "price":
            expr = C.parse_currency(c)
        elif name in _LISTING_NUMBERS:
            expr = C.parse_number(c)
        else:
            expr = C.parse_int(c)
        out.append(_typed(name, expr, field.dataType))
    return df.select(*out)


def _passed_through(raw: DataFrame, known: set[str], taken: list[str]) -> list[F.Column]:
    """The columns that staging doesn't know, as they are.  One that is named like a staged column would
    make two of that name, so it raises."""
    extra = [c for c in raw.columns if c not in known]
    if clash := sorted({c for c in extra if c.lower() in {t.lower() for t in taken}}):
        raise ValueError(f"columns named like staged ones: {clash}")
    return [F.col(f"`{c.replace('`', '``')}`") for c in extra]


def stage_reviews(raw: DataFrame, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """M2: rename ``id`` -> ``review_id``, strict ids, lenient date, trimmed text; other columns are kept as they are."""
    extra = _passed_through(raw, set(schemas.RAW_REVIEWS.fieldNames()), schemas.STG_REVIEWS.fieldNames())
    return raw.select(
        C.strict_bigint("listing_id", "listing_id").alias("listing_id"),
        C.strict_bigint("id", "review_id").alias("review_id"),
        C.parse_date("date", date_format).alias("date"),
        C.strict_bigint("reviewer_id", "reviewer_id").alias("reviewer_id"),
        C.clean_text("reviewer_name").alias("reviewer_name"),
        C.clean_text("comments").alias("comments"),
        *extra,
    )


def normalise_headers(df: DataFrame) -> DataFrame:
    """``column.strip().lower()`` on every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def stage_neighbourhoods(raw: DataFrame, metrics: StepMetrics | None = None) -> DataFrame:
    """M3: normalise headers, trim both columns, drop exact duplicates."""
    df = normalise_headers(raw)
    typed = df.select(
        C.clean_text("neighbourhood_group").alias("neighbourhood_group"),
        C.clean_text("neighbourhood").alias("neighbourhood"),
    )
    return _distinct_rows(typed, "neighbourhoods_duplicates", metrics)


def _distinct_rows(df: DataFrame, step: str, metrics: StepMetrics | None) -> DataFrame:
    if metrics is None:
        return drop_exact_duplicates(df)
    return metrics.deduplicated(drop_exact_duplicates(df, COPIES), step)


def stage_calendar(raw: DataFrame, date_format: str = "yyyy-MM-dd", metrics: StepMetrics | None = None) -> DataFrame:
    """M4: strict id, lenient date, t/f flag, lenient nights; drop exact duplicates.
    Columns other than the five known ones are kept as they are (P4)."""
    typed = [
        C.strict_bigint("listing_id", "listing_id").alias("listing_id"),
        C.parse_date("date", date_format).alias("date"),
        C.parse_flag("available").alias("available"),
        C.parse_int("minimum_nights").alias("minimum_nights"),
        C.parse_int("maximum_nights").alias("maximum_nights"),
    ]
    extra = _passed_through(raw, set(schemas.RAW_CALENDAR.fieldNames()), schemas.STG_CALENDAR.fieldNames())
    return _distinct_rows(raw.select(*typed, *extra), "calendar_duplicates", metrics)


@dataclass
class Cleaned:
    listings: DataFrame
    reviews: DataFrame
    calendar: DataFrame


def nights_in_range(listings: DataFrame) -> DataFrame:
    """keep ``minimum_nights <= maximum_nights`` (NULL on either side drops)."""
    return listings.filter(F.col("minimum_nights") <= F.col("maximum_nights"))


def clean(listings: DataFrame, reviews: DataFrame, calendar: DataFrame) -> Cleaned:
    """M5: F1 on listings, then keep reviews/calendar rows of kept listings."""
    kept = nights_in_range(listings)
    return Cleaned(listings=kept, **drop_orphans(kept, reviews, calendar))


def drop_orphans(
    kept_listings: DataFrame, reviews: DataFrame, calendar: DataFrame, kept_rows: int | None = None
) -> dict[str, DataFrame]:
    """Reviews and calendar rows whose listing_id is a kept listing.  The
    id side is size-checked once (or ``kept_rows`` proves it) for both joins."""
    ids = checked_broadcast(kept_listings.select("listing_id").dropna(), known_rows=kept_rows)
    return {
        "reviews": reviews.join(ids, "listing_id", "left_semi"),
        "calendar": calendar.join(ids, "listing_id", "left_semi"),
    }
