"""End-to-end jobs (M12 staging, M13 warehouse / full refresh).

Each layer is written once and read back: the written Parquet is the lineage
cut (a lost executor recomputes from the last written table, not from the raw
extracts), validation reads only the columns its rules need, and the next layer
starts from typed, pruned scans.  A version is published only after its checks
pass.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeeper import schemas
from innkeeper.operators import quality as Q
from innkeeper.operators.lookup import DEFAULT_BROADCAST_ROWS, missing_parent_ids
from innkeeper.operators.metrics import StepMetrics
from innkeeper.plans import staging as S
from innkeeper.plans import warehouse as W
from innkeeper.session import Scratch
from innkeeper.sources import commits, files

STAGING_TABLES = ("listings", "reviews", "neighbourhoods", "calendar")
T = TypeVar("T")
FACT_PARTITION = ["month_key"]


@dataclass
class StagingResult:
    path: str
    report: list
    metrics: list
    row_counts: dict[str, int]


def relationship_report(listings: DataFrame, reviews: DataFrame, calendar: DataFrame) -> DataFrame:
    """Distinct listing ids of reviews / calendar missing from listings."""
    return Q.report_union(
        [
            Q.count_report("reviews", "listing_id_in_listings", Q.WARNING, missing_parent_ids(reviews, listings, "listing_id")),
            Q.count_report("calendar", "listing_id_in_listings", Q.WARNING, missing_parent_ids(calendar, listings, "listing_id")),
        ]
    )


def staging_report(listings: DataFrame, reviews: DataFrame, neighbourhoods: DataFrame, calendar: DataFrame) -> DataFrame:
    return Q.report_union(
        [
            Q.validate(listings, "listings", Q.listing_rules()),
            Q.validate(reviews, "reviews", Q.review_rules()),
            Q.validate(neighbourhoods, "neighbourhoods", Q.neighbourhood_rules()),
            Q.validate(calendar, "calendar", Q.calendar_rules()),
            relationship_report(listings, reviews, calendar),
        ]
    )


def run_concurrently(*jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark actions (table writes) as concurrent jobs.

    Each small job leaves most task slots idle, and the driver-side planning of
    one overlaps the execution of another; results do not depend on the overlap.
    An exception in any job is raised after all have finished."""
    if len(jobs) == 1:
        return [jobs[0]()]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(job) for job in jobs]
        return [f.result() for f in futures]


def run_staging(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    out_root: str,
    enforce: bool = True,
    date_format: str = "yyyy-MM-dd",
) -> StagingResult:
    """Stage, clean, write, validate the written tables, then publish.

    The S13 metrics (rows in / out of each cleaning step) are observed during the
    writes themselves, so they cost no extra pass over the input.  The schemas of the written tables are recorded in the
    version, so columns that only pass through (P4) are there again when it is read."""
    base, version = commits.head(spark, out_root), files.new_version(out_root)
    steps = StepMetrics()
    with ThreadPoolExecutor(max_workers=3) as pool:
        # Neighbourhoods depend on nothing else: written alongside the rest.
        neighbourhoods = S.stage_neighbourhoods(raw["neighbourhoods"], steps)
        nb_job = pool.submit(files.write_parquet_counted, neighbourhoods, f"{version}/neighbourhoods")
        # Listings next: the written table (with its observed row count) is the
        # id side of both orphan joins, so the listing chain runs once.
        listings = S.nights_in_range(steps.before(S.stage_listings(raw["listings"], date_format), "listings_nights_range"))
        kept_rows = files.write_parquet_counted(listings, f"{version}/listings")
        kept = files.read_parquet(spark, f"{version}/listings", schemas.STG_LISTINGS)
        staged_reviews = steps.before(S.stage_reviews(raw["reviews"], date_format), "reviews_orphans")
        staged_calendar = steps.before(S.stage_calendar(raw["calendar"], date_format, steps), "calendar_orphans")
        cleaned = S.drop_orphans(kept, staged_reviews, staged_calendar, kept_rows)
        reviews_job = pool.submit(files.write_parquet_counted, cleaned["reviews"], f"{version}/reviews")
        calendar_out = files.write_parquet_counted(cleaned["calendar"], f"{version}/calendar")
        reviews_out, nb_rows = reviews_job.result(), nb_job.result()
    for step, n in (("listings_nights_range", kept_rows), ("reviews_orphans", reviews_out), ("calendar_orphans", calendar_out)):
        steps.known(step, rows_out=n)
    written = {"listings": listings, "reviews": cleaned["reviews"], "neighbourhoods": neighbourhoods, "calendar": cleaned["calendar"]}
    files.write_schemas(spark, version, {name: df.schema for name, df in written.items()})
    staged = read_staging(spark, version)
    report = staging_report(staged["listings"], staged["reviews"], staged["neighbourhoods"], staged["calendar"])
    rows = Q.enforce(report) if enforce else report.collect()
    files.publish_version(spark, out_root, version, base)
    counts = {"listings": kept_rows, "reviews": reviews_out, "neighbourhoods": nb_rows, "calendar": calendar_out}
    return StagingResult(version, rows, steps.rows(), counts)


STAGING_SCHEMAS = {
    "listings": schemas.STG_LISTINGS,
    "reviews": schemas.STG_REVIEWS,
    "neighbourhoods": schemas.STG_NEIGHBOURHOODS,
    "calendar": schemas.STG_CALENDAR,
}


def read_staging(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """S5 with S11: all four staging tables with the schemas recorded beside them (the fixed ones if there are none), or one
    error naming the missing tables."""
    return files.read_tables(spark, path, {**STAGING_SCHEMAS, **files.read_schemas(spark, path)})


def read_star(spark: SparkSession, path: str, row_counts: dict[str, int] | None = None) -> W.Star:
    return W.Star(**files.read_tables(spark, path, dict(schemas.WAREHOUSE)), row_counts=dict(row_counts or {}))


@dataclass
class WarehouseResult:
    path: str
    report: list
    row_counts: dict[str, int]
    metrics: list = field(default_factory=list)
    missing_keys: int = 0  # V15: listings without a neighbourhood key
    missing_sample: list = field(default_factory=list)


def write_fact(df: DataFrame, path: str) -> int:
    """Facts are written partitioned by month, in the layout that their numbering left them in: each task holds whole
    months or one piece of a month, in date order, so the write adds no shuffle and no sort, and the
    statistics of Parquet row groups let date-range predicates skip row groups."""
    return files.write_parquet_counted(df, path, FACT_PARTITION)


def run_warehouse(
    spark: SparkSession,
    staging_path: str,
    out_root: str,
    enforce: bool = True,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> WarehouseResult:
    """M13 / S10 full refresh: dimensions, then facts against the written
    dimensions, then the post-load checks; publish the version last.  Row counts
    of the written tables are observed during their write; they decide, with
    ``max_broadcast_rows``, whether the lookups broadcast a dimension.
    Listings left without a neighbourhood key (V15) are counted, with a sample of them."""
    stg = read_staging(spark, staging_path)
    base, version = commits.head(spark, out_root), files.new_version(out_root)
    rows: dict[str, int] = {}
    steps = StepMetrics()
    with ThreadPoolExecutor(max_workers=2) as pool:
        # DimDate depends on nothing else: written alongside the listing chain.
        date_job = pool.submit(
            files.write_parquet_counted, W.dim_date(stg["calendar"], stg["reviews"], steps), f"{version}/dim_date"
        )
        rows["dim_neighbourhood"] = files.write_parquet_counted(
            W.dim_neighbourhood(stg["neighbourhoods"], steps), f"{version}/dim_neighbourhood"
        )
        nb = files.read_parquet(spark, f"{version}/dim_neighbourhood", schemas.DIM_NEIGHBOURHOOD)
        rows["dim_listing"] = files.write_parquet_counted(
            W.dim_listing(stg["listings"], nb, max_broadcast_rows, rows["dim_neighbourhood"], True, steps),
            f"{version}/dim_listing",
        )
        listing = files.read_parquet(spark, f"{version}/dim_listing", schemas.DIM_LISTING)
        with Scratch(spark) as scratch:
            reviews = W.review_rows(stg["reviews"], listing, max_broadcast_rows, rows["dim_listing"], steps)
            calendar = W.availability_rows(stg["calendar"], listing, max_broadcast_rows, rows["dim_listing"], steps)
            rows["fact_reviews"], rows["fact_availability"] = run_concurrently(
                lambda: write_fact(W.number_reviews(reviews, scratch=scratch), f"{version}/fact_reviews"),
                lambda: write_fact(W.number_availability(calendar, scratch=scratch), f"{version}/fact_availability"),
            )
        rows["dim_date"] = date_job.result()
    for step in ("fact_reviews", "fact_availability"):
        steps.known(f"{step}_lookup", rows_out=rows[step])
    star = read_star(spark, version, rows)
    report = W.constraint_report(star)
    checked = Q.enforce(report) if enforce else report.collect()
    files.publish_version(spark, out_root, version, base)
    # the written dimension names its listings without a key: one pruned scan, a bounded sample
    missing = int(star.dim_listing.where(F.col("neighbourhood_key").isNull()).count())
    sample = W.missing_key_sample(star.dim_listing).collect() if missing else []
    return WarehouseResult(version, checked, rows, steps.rows(), missing, sample)


def full_refresh(spark: SparkSession, raw: dict[str, DataFrame], root: str, enforce: bool = True) -> W.Star:
    """Staging then warehouse; returns the published star, read back from Parquet."""
    staged = run_staging(spark, raw, f"{root.rstrip('/')}/staging", enforce)
    built = run_warehouse(
        spark, staged.path, f"{root.rstrip('/')}/warehouse", enforce
    )
    return read_star(spark, built.path, built.row_counts)
