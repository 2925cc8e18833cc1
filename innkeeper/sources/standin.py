"""Stand-in raw extracts derived from the test tables.

The rental extracts are not available, so the four raw inputs are derived from
the TPC-H-like tables with the shape a CSV read gives them (every column
STRING, missing-value tokens already NULL):

* listings       <- customer x nation x region (one listing per customer)
* reviews        <- orders (one review per order; ``o_custkey`` is the listing)
* calendar       <- events (one row per event; ``user_id`` is the listing, the
                    event day is the date, an ``error`` event means unavailable),
                    so a listing/date appears several times
* neighbourhoods <- customer x nation x region (one row per customer: many exact
                    duplicates; one nation has no group)

Everything grows with the input tables.  The DuckDB oracle in
``innkeeper.oracle`` derives the same rows with the same rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from innkeeper.functions.columns import NA_LIST_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an under-split scan over the cluster's task slots.

    A gzip CSV (and a one-row-group Parquet file) is read by a single task; when
    the scan has fewer partitions than ``defaultParallelism`` the parsing that
    follows would run on one core.  Large multi-file inputs already have more
    partitions than slots and are returned unchanged (no extra shuffle).  Apply
    it to the scan itself: the check plans only the scan, and the shuffle moves
    the narrow source rows rather than the derived text columns."""
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD access (Spark Connect): leave as is
        return df
    return df.repartition(slots) if parts < slots else df


def as_read_from_csv(df: DataFrame) -> DataFrame:
    """S3: what a CSV read yields: missing-value tokens become NULL."""
    return df.selectExpr(*[_na_to_null(c) for c in df.columns])


def _na_to_null(name: str) -> str:
    q = f"`{name}`"
    return f"CASE WHEN {q} IN ({NA_LIST_SQL}) THEN NULL ELSE {q} END AS {q}"


def _s(expr: str, name: str) -> str:
    return f"CAST({expr} AS STRING) AS {name}"


def _day(base: str, offset: str) -> str:
    return f"CAST(date_add(DATE'{base}', CAST({offset} AS INT)) AS STRING)"


LISTING_EXPRS = [
    _s("c_custkey", "id"),
    _s("c_custkey DIV 3", "host_id"),
    "concat('  ', c_name, chr(9)) AS host_name",
    f"CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'unknown' ELSE {_day('2010-01-01', 'c_custkey % 3650')} END AS host_since",
    "CASE c_mktsegment WHEN 'BUILDING' THEN 't' WHEN 'MACHINERY' THEN 'x' ELSE 'f' END AS host_is_superhost",
    "concat(' ', n_name) AS neighbourhood_cleansed",
    "r_name AS neighbourhood_group_cleansed",
    "concat('41.', lpad(CAST(c_custkey % 1000000 AS STRING), 6, '0')) AS latitude",
    "concat('2.', lpad(CAST(c_custkey * 7919 % 1000000 AS STRING), 6, '0')) AS longitude",
    "CASE WHEN c_custkey % 8 >= 3 THEN 'Entire rental unit' ELSE 'Private room in rental unit' END AS property_type",
    "c_mktsegment AS room_type",
    _s("1 + c_custkey % 8", "accommodates"),
    "concat(CAST(1 + c_custkey % 3 AS STRING), CASE WHEN c_custkey % 2 = 0 THEN '.0' ELSE '.5' END) AS bathrooms",
    _s("c_custkey % 5", "bedrooms"),
    _s("1 + c_custkey % 6", "beds"),
    "concat('$', format_number(c_acctbal, 2)) AS price",
    _s("1 + c_custkey % 7", "minimum_nights"),
    _s("3 + c_custkey % 30", "maximum_nights"),
    _s("c_custkey % 31", "availability_30"),
    _s("c_custkey % 61", "availability_60"),
    _s("c_custkey % 91", "availability_90"),
    _s("c_custkey % 366", "availability_365"),
    _s("c_custkey % 50", "number_of_reviews"),
    _s("c_custkey % 20", "number_of_reviews_ltm"),
    _s("c_custkey % 5", "number_of_reviews_l30d"),
    f"{_day('2015-01-01', 'c_custkey % 1000')} AS first_review",
    f"{_day('2015-01-01', 'c_custkey % 1000 + c_custkey % 700')} AS last_review",
    "CASE WHEN c_mktsegment = 'FURNITURE' THEN 'N/A' "
    "ELSE concat(CAST((c_custkey % 60) DIV 10 AS STRING), '.', CAST(c_custkey % 10 AS STRING)) END AS review_scores_rating",
    "concat(CAST((c_custkey % 300) DIV 100 AS STRING), '.', lpad(CAST(c_custkey % 100 AS STRING), 2, '0')) AS reviews_per_month",
    _s("1 + c_custkey % 4", "calculated_host_listings_count"),
    "c_name AS name",
]

REVIEW_EXPRS = [
    _s("o_custkey", "listing_id"),
    _s("o_orderkey", "id"),
    _s("CAST(o_orderdate AS DATE)", "date"),
    _s("o_orderkey * 31 % 5000", "reviewer_id"),
    "concat(' ', o_orderpriority, ' ') AS reviewer_name",
    "concat('Stay ', lower(o_orderstatus), ', \"', o_orderpriority, '\"') AS comments",
]

CALENDAR_EXPRS = [
    _s("user_id", "listing_id"),
    _s("CAST(ts AS DATE)", "date"),
    "CASE WHEN event_type = 'error' THEN 'f' ELSE 't' END AS available",
    _s("1 + user_id % 7", "minimum_nights"),
    _s("3 + user_id % 30", "maximum_nights"),
]

NEIGHBOURHOOD_EXPRS = [
    "CASE WHEN n_nationkey = 24 THEN CAST(NULL AS STRING) ELSE concat(r_name, ' ') END AS ` neighbourhood_group`",
    "concat(' ', n_name) AS `Neighbourhood `",
]


def _tables(spark: SparkSession, sf_dir: str, names: tuple[str, ...], cache: dict | None) -> list[DataFrame]:
    cache = {} if cache is None else cache
    for name in names:
        if name not in cache:
            df = table(spark, sf_dir, name)
            cache[name] = spread(df) if name in ("customer", "orders", "events") else df
    return [cache[n] for n in names]


def raw_listings(spark: SparkSession, sf_dir: str, cache: dict | None = None) -> DataFrame:
    c, n, r = _tables(spark, sf_dir, ("customer", "nation", "region"), cache)
    src = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    return as_read_from_csv(src.selectExpr(*LISTING_EXPRS))


def raw_reviews(spark: SparkSession, sf_dir: str, cache: dict | None = None) -> DataFrame:
    (o,) = _tables(spark, sf_dir, ("orders",), cache)
    return as_read_from_csv(o.selectExpr(*REVIEW_EXPRS))


def raw_calendar(spark: SparkSession, sf_dir: str, cache: dict | None = None) -> DataFrame:
    (e,) = _tables(spark, sf_dir, ("events",), cache)
    return as_read_from_csv(e.selectExpr(*CALENDAR_EXPRS))


def raw_neighbourhoods(spark: SparkSession, sf_dir: str, cache: dict | None = None) -> DataFrame:
    """Headers are written untidily on purpose (`` neighbourhood_group``,
    ``Neighbourhood ``): staging normalises them (op P3)."""
    c, n, r = _tables(spark, sf_dir, ("customer", "nation", "region"), cache)
    src = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return as_read_from_csv(src.selectExpr(*NEIGHBOURHOOD_EXPRS))


def raw_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw extracts of ``sf_dir`` (each source table read once)."""
    cache: dict = {}
    return {
        "listings": raw_listings(spark, sf_dir, cache),
        "reviews": raw_reviews(spark, sf_dir, cache),
        "calendar": raw_calendar(spark, sf_dir, cache),
        "neighbourhoods": raw_neighbourhoods(spark, sf_dir, cache),
    }
