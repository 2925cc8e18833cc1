"""A star with planted breaks, so that every post-load check has something to find.

The breaks are derived from the built star by the rows' own keys, so they grow with the data:
repeated keys, NULLs in required columns, texts over their width, broken neighbourhood, listing and
date keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from innkeeper.plans.warehouse import Star

# Table -> (rows that appear twice, column -> expression that breaks some of its rows).
BREAKS: dict[str, tuple[str, dict[str, str]]] = {
    "dim_neighbourhood": (
        "neighbourhood_key % 10 = 1",
        {
            "neighbourhood_key": "CASE WHEN neighbourhood_key % 10 = 6 THEN NULL ELSE neighbourhood_key END",
            "neighbourhood": "CASE WHEN neighbourhood_key % 10 = 2 THEN NULL WHEN neighbourhood_key % 10 = 3 THEN repeat('n', 256) ELSE neighbourhood END",
            "neighbourhood_group": "CASE WHEN neighbourhood_key % 10 = 4 THEN NULL WHEN neighbourhood_key % 10 = 5 THEN repeat('g', 300) ELSE neighbourhood_group END",
        },
    ),
    "dim_listing": (
        "listing_key % 50 = 1",
        {
            "listing_key": "CASE WHEN listing_key % 50 = 7 THEN NULL ELSE listing_key END",
            "listing_id": "CASE WHEN listing_key % 50 = 2 THEN NULL ELSE listing_id END",
            "host_name": "CASE WHEN listing_key % 50 = 3 THEN repeat('h', 256) ELSE host_name END",
            "property_type": "CASE WHEN listing_key % 50 = 4 THEN repeat('p', 256) ELSE property_type END",
            "room_type": "CASE WHEN listing_key % 50 = 5 THEN repeat('r', 101) ELSE room_type END",
            "neighbourhood_key": "CASE WHEN listing_key % 50 = 6 THEN neighbourhood_key + 100000 ELSE neighbourhood_key END",
        },
    ),
    "dim_date": (
        "date_key % 7 = 1",
        {
            "date_key": "CASE WHEN date_key % 11 = 8 THEN NULL WHEN date_key % 7 = 2 THEN -date_key ELSE date_key END",
            "day": "CASE WHEN date_key % 11 = 1 THEN NULL ELSE day END",
            "month": "CASE WHEN date_key % 11 = 2 THEN NULL ELSE month END",
            "quarter": "CASE WHEN date_key % 11 = 3 THEN NULL ELSE quarter END",
            "year": "CASE WHEN date_key % 11 = 4 THEN NULL ELSE year END",
            "week_of_year": "CASE WHEN date_key % 11 = 5 THEN NULL ELSE week_of_year END",
            "month_key": "CASE WHEN date_key % 11 = 6 THEN NULL ELSE month_key END",
            "full_date": "CASE WHEN date_key % 7 = 3 THEN NULL ELSE full_date END",
            "month_name": "CASE WHEN date_key % 11 = 7 THEN NULL WHEN date_key % 7 = 4 THEN repeat('m', 21) ELSE month_name END",
            "day_name": "CASE WHEN date_key % 7 = 5 THEN repeat('d', 21) WHEN date_key % 7 = 6 THEN NULL ELSE day_name END",
            "day_of_week": "CASE WHEN date_key % 7 = 0 THEN NULL ELSE day_of_week END",
        },
    ),
    "fact_reviews": (
        "review_key % 40 = 1",
        {
            "review_key": "CASE WHEN review_key % 40 = 6 THEN NULL ELSE review_key END",
            "review_id": "CASE WHEN review_key % 40 = 7 THEN NULL ELSE review_id END",
            "month_key": "CASE WHEN review_key % 40 = 8 THEN NULL ELSE month_key END",
            "listing_key": "CASE WHEN review_key % 40 = 2 THEN -listing_key WHEN review_key % 40 = 3 THEN NULL ELSE listing_key END",
            "date_key": "CASE WHEN review_key % 40 = 4 THEN NULL ELSE date_key END",
            "review_count": "CASE WHEN review_key % 40 = 5 THEN NULL ELSE review_count END",
        },
    ),
    "fact_availability": (
        "availability_key % 40 = 1",
        {
            "availability_key": "CASE WHEN availability_key % 40 = 5 THEN NULL ELSE availability_key END",
            "month_key": "CASE WHEN availability_key % 40 = 6 THEN NULL ELSE month_key END",
            "listing_key": "CASE WHEN availability_key % 40 = 2 THEN -listing_key WHEN availability_key % 40 = 7 THEN NULL ELSE listing_key END",
            "date_key": "CASE WHEN availability_key % 40 = 3 THEN NULL ELSE date_key END",
            "available": "CASE WHEN availability_key % 40 = 4 THEN NULL ELSE available END",
        },
    ),
}


def broken(df: DataFrame, twice: str, changes: dict[str, str]) -> DataFrame:
    """``df`` with the rows of ``twice`` repeated and the columns of ``changes`` replaced."""
    changed = df.selectExpr(*[f"{changes.get(c, c)} AS {c}" for c in df.columns])
    return changed.unionByName(df.where(twice))


def broken_star(star: Star) -> Star:
    return Star(**{name: broken(df, *BREAKS[name]) for name, df in star.tables().items()})
