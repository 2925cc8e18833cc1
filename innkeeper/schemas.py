"""Explicit schemas for every layer: raw extracts, staging and the star schema.

Raw extracts are read with every column as STRING (a CSV has no types); typing
happens once, in staging, with the column functions in ``innkeeper.functions``.
The warehouse schemas are the target types the load conforms to (op C18).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
B, DT = T.BooleanType(), T.DateType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S, True) for n in names])


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# The 30 listing columns the staging step keeps, in source order.
LISTING_COLUMNS = [
    "id", "host_id", "host_name", "host_since", "host_is_superhost",
    "neighbourhood_cleansed", "neighbourhood_group_cleansed",
    "latitude", "longitude",
    "property_type", "room_type",
    "accommodates", "bathrooms", "bedrooms", "beds",
    "price", "minimum_nights", "maximum_nights",
    "availability_30", "availability_60", "availability_90", "availability_365",
    "number_of_reviews", "number_of_reviews_ltm", "number_of_reviews_l30d",
    "first_review", "last_review",
    "review_scores_rating", "reviews_per_month",
    "calculated_host_listings_count",
]

RAW_LISTINGS = _strings(*LISTING_COLUMNS, "name")
RAW_REVIEWS = _strings("listing_id", "id", "date", "reviewer_id", "reviewer_name", "comments")
RAW_CALENDAR = _strings("listing_id", "date", "available", "minimum_nights", "maximum_nights")
RAW_NEIGHBOURHOODS = _strings("neighbourhood_group", "neighbourhood")

STG_LISTINGS = _struct(
    ("listing_id", L, True), ("host_id", L, True), ("host_name", S, True),
    ("host_since", DT, True), ("host_is_superhost", B, True),
    ("neighbourhood", S, True), ("neighbourhood_group", S, True),
    ("latitude", D, True), ("longitude", D, True),
    ("property_type", S, True), ("room_type", S, True),
    ("accommodates", I, True), ("bathrooms", D, True), ("bedrooms", I, True), ("beds", I, True),
    ("price", D, True), ("minimum_nights", I, True), ("maximum_nights", I, True),
    ("availability_30", I, True), ("availability_60", I, True),
    ("availability_90", I, True), ("availability_365", I, True),
    ("number_of_reviews", I, True), ("number_of_reviews_ltm", I, True),
    ("number_of_reviews_l30d", I, True),
    ("first_review", DT, True), ("last_review", DT, True),
    ("review_scores_rating", D, True), ("reviews_per_month", D, True),
    ("calculated_host_listings_count", I, True),
)
STG_REVIEWS = _struct(
    ("listing_id", L, True), ("review_id", L, True), ("date", DT, True),
    ("reviewer_id", L, True), ("reviewer_name", S, True), ("comments", S, True),
)
STG_CALENDAR = _struct(
    ("listing_id", L, True), ("date", DT, True), ("available", B, True),
    ("minimum_nights", I, True), ("maximum_nights", I, True),
)
STG_NEIGHBOURHOODS = _struct(("neighbourhood_group", S, True), ("neighbourhood", S, True))

DIM_NEIGHBOURHOOD = _struct(
    ("neighbourhood_key", I, False), ("neighbourhood", S, False), ("neighbourhood_group", S, False),
)
DIM_LISTING = _struct(
    ("listing_key", I, False), ("listing_id", L, False), ("host_id", L, True),
    ("host_name", S, True), ("price", D, True), ("host_is_superhost", B, True),
    ("neighbourhood_key", I, True),
    ("latitude", T.DecimalType(9, 6), True), ("longitude", T.DecimalType(9, 6), True),
    ("property_type", S, True), ("room_type", S, True), ("accommodates", I, True),
    ("bathrooms", T.DecimalType(4, 1), True), ("bedrooms", I, True), ("beds", I, True),
)
DIM_DATE = _struct(
    ("date_key", I, False), ("full_date", DT, False), ("day", I, False), ("month", I, False),
    ("month_name", S, False), ("quarter", I, False), ("year", I, False), ("day_name", S, False),
    ("day_of_week", I, False), ("week_of_year", I, False), ("month_key", I, False),
)
FACT_REVIEWS = _struct(
    ("review_key", L, False), ("listing_key", I, False), ("date_key", I, False),
    ("review_id", L, False), ("reviewer_id", L, True), ("review_count", I, False),
    ("month_key", I, False),
)
FACT_AVAILABILITY = _struct(
    ("availability_key", L, False), ("listing_key", I, False), ("date_key", I, False),
    ("available", B, False), ("minimum_nights", I, True), ("maximum_nights", I, True),
    ("month_key", I, False),
)

WAREHOUSE = {
    "dim_neighbourhood": DIM_NEIGHBOURHOOD,
    "dim_listing": DIM_LISTING,
    "dim_date": DIM_DATE,
    "fact_reviews": FACT_REVIEWS,
    "fact_availability": FACT_AVAILABILITY,
}

# NVARCHAR widths of the warehouse DDL, checked as rules (op V16).
TEXT_WIDTHS = {
    "dim_neighbourhood": {"neighbourhood": 255, "neighbourhood_group": 255},
    "dim_listing": {"host_name": 255, "property_type": 255, "room_type": 100},
    "dim_date": {"month_name": 20, "day_name": 20},
}
