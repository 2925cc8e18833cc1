"""Star-schema build (M6-M11): three dimensions, two facts, post-load checks.

Layout decisions for scale:

* dimensions are joined to facts through ``lookup_key``: broadcast only when the
  row count is proved small, otherwise a shuffle join with AQE skew splitting;
* dimension keys use ``dense_key`` (no single-partition window);
* both facts carry ``month_key`` (yyyyMM) and are written ``partitionBy``
  month_key, so month/range questions prune partitions; their keys number the rows in
  that layout (``layout_key``: by date, then natural key), so one shuffle
  serves the numbering and the files;
* the calendar is deduplicated on its natural key with a map-side-combining
  aggregate before the lookup, so a hot listing never moves all its copies.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeeper import schemas
from innkeeper.functions import columns as C
from innkeeper.operators import quality as Q
from innkeeper.operators.dedup import dense_distinct, drop_exact_duplicates, keep_first
from innkeeper.operators.keys import PIECE_ROWS, dense_key, layout_key
from innkeeper.operators.lookup import (
    DEFAULT_BROADCAST_ROWS,
    checked_broadcast,
    lookup_key,
    union_all,
)
from innkeeper.operators.metrics import COPIES, StepMetrics
from innkeeper.session import Scratch

# The staged columns of the listing dimension: its own, less the keys, plus the name that is looked up.
LISTING_DIM_SOURCE = [
    "neighbourhood" if f.name == "neighbourhood_key" else f.name for f in schemas.DIM_LISTING.fields if f.name != "listing_key"
]


def conform(df: DataFrame, schema) -> DataFrame:
    """Project and cast to the target schema, in its column order.  A value that the target
    type can't hold raises, with ANSI casts on or off."""
    return df.select(*[_checked_cast(df, f) for f in schema.fields])


def _checked_cast(df: DataFrame, target) -> F.Column:
    value = F.col(target.name)
    if df.schema[target.name].dataType == target.dataType:
        return value
    cast = value.try_cast(target.dataType)
    wrong = F.raise_error(F.concat(F.lit(f"{target.name}: no {target.dataType.simpleString()}: "), value.cast("string")))
    return F.when(value.isNull() | cast.isNotNull(), cast).otherwise(wrong.cast(target.dataType)).alias(target.name)


def required_date_key(c) -> F.Column:
    """C11 on a fact: the key of a NULL date is an error, not a NULL."""
    return F.coalesce(C.date_key(c), F.raise_error(F.lit("fact row with NULL date"))).cast("int")


@dataclass
class Star:
    dim_neighbourhood: DataFrame
    dim_listing: DataFrame
    dim_date: DataFrame
    fact_reviews: DataFrame
    fact_availability: DataFrame
    # Exact row counts per table when known (observed while the tables were
    # written); they prove broadcast sizes without a count job.
    row_counts: dict[str, int] = field(default_factory=dict)

    def rows(self, name: str) -> int | None:
        return self.row_counts.get(name)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_neighbourhood": self.dim_neighbourhood,
            "dim_listing": self.dim_listing,
            "dim_date": self.dim_date,
            "fact_reviews": self.fact_reviews,
            "fact_availability": self.fact_availability,
        }


def _first_rows(df: DataFrame, keys: list[str], step: str, metrics: StepMetrics | None, order_by: list[str] | None = None) -> DataFrame:
    if metrics is None:
        return keep_first(df, keys, order_by)
    return metrics.deduplicated(keep_first(df, keys, order_by, COPIES), step)


def dim_neighbourhood(stg_neighbourhoods: DataFrame, metrics: StepMetrics | None = None) -> DataFrame:
    """M6: first row per name (NULL group first), then drop rows with a NULL
    (dedup before the NULL drop, so a name whose first row lacks a group is
    gone), then key by name."""
    df = stg_neighbourhoods.select("neighbourhood", "neighbourhood_group")
    df = _first_rows(df, ["neighbourhood"], "dim_neighbourhood_duplicates", metrics, ["neighbourhood_group"])
    df = metrics.before(df, "dim_neighbourhood_nulls") if metrics else df
    df = df.dropna(how="any", subset=["neighbourhood", "neighbourhood_group"])
    df = metrics.after(df, "dim_neighbourhood_nulls") if metrics else df
    df = dense_key(df, ["neighbourhood"], "neighbourhood_key")
    return conform(df, schemas.DIM_NEIGHBOURHOOD)


def dim_date(calendar: DataFrame, reviews: DataFrame, metrics: StepMetrics | None = None) -> DataFrame:
    """M7: one row per date seen in calendar or reviews (no gap filling)."""
    dates = union_all(calendar.select("date"), reviews.select("date")).dropna(subset=["date"])
    dates = metrics.deduplicated(drop_exact_duplicates(dates, COPIES), "dim_date_dates") if metrics else drop_exact_duplicates(dates)
    attrs = C.date_attributes("date")
    return dates.select(*[attrs[f.name].cast(f.dataType).alias(f.name) for f in schemas.DIM_DATE.fields])


def listings_with_neighbourhood_key(
    stg_listings: DataFrame,
    dim_nb: DataFrame,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    dim_rows: int | None = None,
    metrics: StepMetrics | None = None,
) -> DataFrame:
    """M8 steps D2, C4, J3: first row per listing_id, price parsed if still text,
    neighbourhood_key looked up (unmatched -> NULL, row kept)."""
    df = _first_rows(stg_listings.select(*LISTING_DIM_SOURCE), ["listing_id"], "dim_listing_duplicates", metrics)
    if dict(df.dtypes)["price"] == "string":
        df = df.withColumn("price", C.parse_currency("price"))
    df = metrics.before(df, "dim_listing_lookup") if metrics else df
    df = lookup_key(df, dim_nb, "neighbourhood", "neighbourhood_key", "left", max_broadcast_rows, dim_rows)
    return metrics.after(df, "dim_listing_lookup", F.col("neighbourhood_key").isNotNull()) if metrics else df


def lookup_misses(listings_keyed: DataFrame, n: int = 5) -> DataFrame:
    """A fixed sample of listings whose neighbourhood had no key."""
    return (
        listings_keyed.filter(F.col("neighbourhood_key").isNull())
        .select("listing_id", "neighbourhood")
        .orderBy("listing_id")
        .limit(n)
    )


def missing_key_sample(dim: DataFrame, n: int = 5) -> DataFrame:
    """V15 on the written dimension: the first listings that got no neighbourhood key."""
    return dim.where(F.col("neighbourhood_key").isNull()).select("listing_id").orderBy("listing_id").limit(n)


def dim_listing(
    stg_listings: DataFrame,
    dim_nb: DataFrame,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    dim_rows: int | None = None,
    checkpoint: bool = False,
    metrics: StepMetrics | None = None,
) -> DataFrame:
    """M8: D2, C4, J3, C7, then a dense key in listing_id order."""
    df = listings_with_neighbourhood_key(stg_listings, dim_nb, max_broadcast_rows, dim_rows, metrics)
    df = dense_key(df, ["listing_id"], "listing_key", checkpoint=checkpoint)
    return conform(df, schemas.DIM_LISTING)


def review_rows(
    clean_reviews: DataFrame,
    dim_list: DataFrame,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    dim_rows: int | None = None,
    metrics: StepMetrics | None = None,
) -> DataFrame:
    """M9 before its key: J4 (inner lookup), C11, P6 (review_count = 1)."""
    df = clean_reviews.select("listing_id", "review_id", "date", "reviewer_id")
    df = metrics.before(df, "fact_reviews_lookup") if metrics else df
    df = lookup_key(df, dim_list, "listing_id", "listing_key", "inner", max_broadcast_rows, dim_rows)
    return df.select(
        "listing_key",
        required_date_key("date").alias("date_key"),
        "review_id",
        "reviewer_id",
        F.lit(1).cast("int").alias("review_count"),
        C.month_key("date").alias("month_key"),
    )


def number_reviews(rows: DataFrame, piece_rows: int = PIECE_ROWS, scratch: Scratch | None = None) -> DataFrame:
    """M9's K2: by date, then review_id; laid out by month."""
    order = ["review_id", "listing_key", "reviewer_id"]
    return conform(layout_key(rows, "month_key", "date_key", order, "review_key", piece_rows, scratch), schemas.FACT_REVIEWS)


def fact_reviews(
    clean_reviews: DataFrame,
    dim_list: DataFrame,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    dim_rows: int | None = None,
    scratch: Scratch | None = None,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """M9: looked up and numbered."""
    return number_reviews(review_rows(clean_reviews, dim_list, max_broadcast_rows, dim_rows), piece_rows, scratch)


def availability_rows(
    clean_calendar: DataFrame,
    dim_list: DataFrame,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    dim_rows: int | None = None,
    metrics: StepMetrics | None = None,
) -> DataFrame:
    """M10 before its key: D3 (global, one row per listing and date, unavailable first), J5, C11."""
    df = clean_calendar.select("listing_id", "date", "available", "minimum_nights", "maximum_nights")
    order = ["available", "minimum_nights", "maximum_nights"]
    df = _first_rows(df, ["listing_id", "date"], "fact_availability_duplicates", metrics, order)
    df = metrics.before(df, "fact_availability_lookup") if metrics else df
    df = lookup_key(df, dim_list, "listing_id", "listing_key", "inner", max_broadcast_rows, dim_rows)
    return df.select(
        "listing_key",
        required_date_key("date").alias("date_key"),
        "available",
        "minimum_nights",
        "maximum_nights",
        C.month_key("date").alias("month_key"),
    )


def number_availability(rows: DataFrame, piece_rows: int = PIECE_ROWS, scratch: Scratch | None = None) -> DataFrame:
    """M10's K2: by date, then listing; laid out by month."""
    keyed = layout_key(rows, "month_key", "date_key", ["listing_key"], "availability_key", piece_rows, scratch)
    return conform(keyed, schemas.FACT_AVAILABILITY)


def fact_availability(
    clean_calendar: DataFrame,
    dim_list: DataFrame,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    dim_rows: int | None = None,
    scratch: Scratch | None = None,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """One row per listing and date, looked up and numbered."""
    return number_availability(availability_rows(clean_calendar, dim_list, max_broadcast_rows, dim_rows), piece_rows, scratch)


# --- M11: post-load checks (V16-V19) ----------------------------------------------------


def table_row_counts(star: Star) -> DataFrame:
    """``(table_name, row_count)`` for the five tables.  The scans of written tables read no
    column: their rows are counted from the footers of the files."""
    parts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).cast("bigint").alias("row_count"))
        for name, df in star.tables().items()
    ]
    return Q.report_union(parts)


def _rows(star, name: str) -> int | None:
    rows = getattr(star, "rows", None)
    return rows(name) if rows is not None else None


FACTS = ("fact_reviews", "fact_availability")


def _unmatched_keys(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One row ``listing_key, date_key``: fact rows whose key of that name is in no row of its dimension (a NULL key isn't).

    The fact is scanned once for both: the few dates are met first (their keys are broadcast after a size check), then one
    aggregate per listing key, which collapses a hot listing before anything moves, carries the rows and those without a date
    to the listing dimension."""
    dates = checked_broadcast(dims["dim_date"].select("date_key").dropna().distinct().withColumn("_dated", F.lit(True)))
    per_listing = fact.select("listing_key", "date_key").join(dates, "date_key", "left").groupBy("listing_key").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(F.col("_dated").isNull()).alias("_undated")
    )
    listed = dims["dim_listing"].select("listing_key").dropna().distinct().withColumn("_listed", F.lit(True))
    both = per_listing.join(listed, "listing_key", "left")
    orphans = F.sum(F.when(F.col("_listed").isNull(), F.col("_rows")).otherwise(0))
    return both.agg(F.coalesce(orphans, F.lit(0)).alias("listing_key"), F.coalesce(F.sum("_undated"), F.lit(0)).alias("date_key"))


KEY_RULES = {"listing_key": "orphan_listing_key", "date_key": "invalid_date_key"}


def foreign_key_report(star: Star, severity: str = Q.FATAL, keys: tuple[str, ...] = ("listing_key", "date_key")) -> DataFrame:
    """The foreign keys of both facts."""
    parts = []
    for name in FACTS:
        counts = _unmatched_keys(getattr(star, name), {"dim_date": star.dim_date, "dim_listing": star.dim_listing})
        parts.append(Q.values_report(name, [(KEY_RULES[k], severity, k) for k in keys], counts))
    return Q.report_union(parts)


def orphan_facts(star: Star) -> DataFrame:
    """Fact rows whose listing_key is not in DimListing."""
    return foreign_key_report(star, Q.REPORT, ("listing_key",))


def invalid_date_keys(star: Star) -> DataFrame:
    """Fact rows whose date_key is not in DimDate."""
    return foreign_key_report(star, Q.REPORT, ("date_key",))


UNIQUE_KEYS = {
    "dim_neighbourhood": [["neighbourhood_key"], ["neighbourhood"]],
    "dim_listing": [["listing_key"], ["listing_id"]],
    "dim_date": [["date_key"], ["full_date"]],
    "fact_reviews": [["review_key"], ["review_id"]],
    "fact_availability": [["availability_key"], ["listing_key", "date_key"]],
}


def constraint_report(star: Star) -> DataFrame:
    """The DDL constraints as rules: NOT NULL, PK/UNIQUE, NVARCHAR widths,
    and the foreign keys (listing -> neighbourhood, facts -> listing and date)."""
    parts = []
    for name, df in star.tables().items():
        rules = Q.constraint_rules(schemas.WAREHOUSE[name], UNIQUE_KEYS[name], schemas.TEXT_WIDTHS.get(name, {}))
        parts.append(Q.validate(df, name, rules))
    nb_keys = checked_broadcast(
        star.dim_neighbourhood.select("neighbourhood_key"), known_rows=_rows(star, "dim_neighbourhood")
    )
    listed = star.dim_listing.filter(F.col("neighbourhood_key").isNotNull())
    parts.append(
        Q.value_report(
            "dim_listing", "fk_neighbourhood_key", Q.FATAL, Q.unmatched_row_count(listed, nb_keys, "neighbourhood_key"), "n"
        )
    )
    parts.append(foreign_key_report(star))
    return Q.report_union(parts)


def validate_warehouse(star: Star) -> dict[str, DataFrame]:
    """The post-load reports by name (row counts, orphans, invalid date keys,
    every DDL constraint, total-vs-distinct of the four natural keys)."""
    return {
        "row_counts": table_row_counts(star),
        "orphan_facts": orphan_facts(star),
        "invalid_date_keys": invalid_date_keys(star),
        "constraints": constraint_report(star),
        "unique_listings": total_vs_distinct(star.dim_listing, ["listing_id"], "total_listings", "unique_listings"),
        "unique_neighbourhoods": total_vs_distinct(
            star.dim_neighbourhood, ["neighbourhood"], "total_rows", "unique_neighbourhoods"
        ),
        "unique_reviews": total_vs_distinct(star.fact_reviews, ["review_id"], "total_reviews", "unique_reviews"),
        "unique_listing_date": total_vs_distinct(
            star.fact_availability, ["listing_key", "date_key"], "total_rows", "unique_listing_date"
        ),
    }


def total_vs_distinct(df: DataFrame, cols: list[str], total_name: str, distinct_name: str) -> DataFrame:
    """``COUNT(*)`` beside ``COUNT(DISTINCT key)``; a composite key is a struct
    of its columns, whose NULLs count as values (its text ``a-b`` counts the same for integer parts).

    Integer keys that lie densely are counted exactly by bitmaps (``dense_distinct``); other keys by an aggregation."""
    total = F.count(F.lit(1)).cast("bigint").alias(total_name)
    if (by_bitmap := dense_distinct(df, cols)) is not None:
        rows, bits = by_bitmap
        return rows.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias(total_name), bits.cast("bigint").alias(distinct_name))
    key = F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)
    return df.agg(total, F.count_distinct(key).cast("bigint").alias(distinct_name))
