"""DuckDB SQL for every registered query, written independently of the Spark code.

All oracles share one chain of CTEs that derives the stand-in extracts, the
staging tables and the star schema from the test tables with the same rules as
the Spark side (``innkeeper.sources.standin``, ``plans.staging``,
``plans.warehouse``).  DuckDB only evaluates the CTEs a query references.

Engine differences handled here: DuckDB sorts NULLs last by default (every
ORDER BY states NULLS FIRST/LAST), ``sum`` of integers is HUGEINT (cast to
BIGINT), ``/`` on integers is a real division (``//`` is used), and casting a
double to INTEGER rounds (``trunc`` first).
"""

from __future__ import annotations

NUM = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INF = r"^\s*[+-]?(?i)(inf|infinity)\s*$"
INT = r"^\s*[+-]?\d+\s*$"
TOKENS = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def text(x: str) -> str:
    return f"CASE WHEN {strip(x)} IN ({TOKENS}) THEN NULL ELSE {strip(x)} END"


def num(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '{NUM}') OR regexp_matches({x}, '{INF}') "
        f"THEN TRY_CAST(trim({x}) AS DOUBLE) END"
    )


def integer(x: str) -> str:
    return f"TRY_CAST(trunc({num(x)}) AS INTEGER)"


def money(x: str) -> str:
    return num(f"replace(replace({x}, '$', ''), ',', '')")


def bigint(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN regexp_matches({x}, '{INT}') THEN TRY_CAST(trim({x}) AS BIGINT) "
        f"ELSE error('not an integer') END"
    )


def date(x: str) -> str:
    return f"CAST(TRY_STRPTIME({x}, '%Y-%m-%d') AS DATE)"


def flag(x: str) -> str:
    return f"CASE WHEN {x} = 't' THEN TRUE WHEN {x} = 'f' THEN FALSE END"


def day(base: str, offset: str) -> str:
    return f"CAST(DATE '{base}' + CAST({offset} AS INTEGER) AS VARCHAR)"


def date_key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def month_key(d: str) -> str:
    return f"CAST(year({d}) * 100 + month({d}) AS INTEGER)"


LISTING_TEXT = ["host_name", "neighbourhood", "neighbourhood_group", "property_type", "room_type"]

CTES = {
    "raw_listings": f"""
SELECT
  CAST(c_custkey AS VARCHAR) AS id,
  CAST(c_custkey // 3 AS VARCHAR) AS host_id,
  '  ' || c_name || chr(9) AS host_name,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'unknown' ELSE {day('2010-01-01', 'c_custkey % 3650')} END AS host_since,
  CASE c_mktsegment WHEN 'BUILDING' THEN 't' WHEN 'MACHINERY' THEN 'x' ELSE 'f' END AS host_is_superhost,
  ' ' || n_name AS neighbourhood_cleansed,
  r_name AS neighbourhood_group_cleansed,
  '41.' || lpad(CAST(c_custkey % 1000000 AS VARCHAR), 6, '0') AS latitude,
  '2.' || lpad(CAST(c_custkey * 7919 % 1000000 AS VARCHAR), 6, '0') AS longitude,
  CASE WHEN c_custkey % 8 >= 3 THEN 'Entire rental unit' ELSE 'Private room in rental unit' END AS property_type,
  c_mktsegment AS room_type,
  CAST(1 + c_custkey % 8 AS VARCHAR) AS accommodates,
  CAST(1 + c_custkey % 3 AS VARCHAR) || CASE WHEN c_custkey % 2 = 0 THEN '.0' ELSE '.5' END AS bathrooms,
  CAST(c_custkey % 5 AS VARCHAR) AS bedrooms,
  CAST(1 + c_custkey % 6 AS VARCHAR) AS beds,
  '$' || format('{{:,.2f}}', c_acctbal) AS price,
  CAST(1 + c_custkey % 7 AS VARCHAR) AS minimum_nights,
  CAST(3 + c_custkey % 30 AS VARCHAR) AS maximum_nights,
  CAST(c_custkey % 31 AS VARCHAR) AS availability_30,
  CAST(c_custkey % 61 AS VARCHAR) AS availability_60,
  CAST(c_custkey % 91 AS VARCHAR) AS availability_90,
  CAST(c_custkey % 366 AS VARCHAR) AS availability_365,
  CAST(c_custkey % 50 AS VARCHAR) AS number_of_reviews,
  CAST(c_custkey % 20 AS VARCHAR) AS number_of_reviews_ltm,
  CAST(c_custkey % 5 AS VARCHAR) AS number_of_reviews_l30d,
  {day('2015-01-01', 'c_custkey % 1000')} AS first_review,
  {day('2015-01-01', 'c_custkey % 1000 + c_custkey % 700')} AS last_review,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 'N/A'
       ELSE CAST((c_custkey % 60) // 10 AS VARCHAR) || '.' || CAST(c_custkey % 10 AS VARCHAR) END AS review_scores_rating,
  CAST((c_custkey % 300) // 100 AS VARCHAR) || '.' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS reviews_per_month,
  CAST(1 + c_custkey % 4 AS VARCHAR) AS calculated_host_listings_count
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "raw_reviews": """
SELECT CAST(o_custkey AS VARCHAR) AS listing_id, CAST(o_orderkey AS VARCHAR) AS id,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(o_orderkey * 31 % 5000 AS VARCHAR) AS reviewer_id,
       ' ' || o_orderpriority || ' ' AS reviewer_name,
       'Stay ' || lower(o_orderstatus) || ', "' || o_orderpriority || '"' AS comments
FROM orders""",
    "raw_calendar": """
SELECT CAST(user_id AS VARCHAR) AS listing_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
       CASE WHEN event_type = 'error' THEN 'f' ELSE 't' END AS available,
       CAST(1 + user_id % 7 AS VARCHAR) AS minimum_nights, CAST(3 + user_id % 30 AS VARCHAR) AS maximum_nights
FROM events""",
    "raw_neighbourhoods": """
SELECT CASE WHEN n_nationkey = 24 THEN NULL ELSE r_name || ' ' END AS neighbourhood_group, ' ' || n_name AS neighbourhood
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "stg_listings": f"""
SELECT {bigint('id')} AS listing_id, {bigint('host_id')} AS host_id, {text('host_name')} AS host_name,
  {date('host_since')} AS host_since, {flag('host_is_superhost')} AS host_is_superhost,
  {text('neighbourhood_cleansed')} AS neighbourhood, {text('neighbourhood_group_cleansed')} AS neighbourhood_group,
  {num('latitude')} AS latitude, {num('longitude')} AS longitude,
  {text('property_type')} AS property_type, {text('room_type')} AS room_type,
  {integer('accommodates')} AS accommodates, {num('bathrooms')} AS bathrooms,
  {integer('bedrooms')} AS bedrooms, {integer('beds')} AS beds, {money('price')} AS price,
  {integer('minimum_nights')} AS minimum_nights, {integer('maximum_nights')} AS maximum_nights,
  {integer('availability_30')} AS availability_30, {integer('availability_60')} AS availability_60,
  {integer('availability_90')} AS availability_90, {integer('availability_365')} AS availability_365,
  {integer('number_of_reviews')} AS number_of_reviews, {integer('number_of_reviews_ltm')} AS number_of_reviews_ltm,
  {integer('number_of_reviews_l30d')} AS number_of_reviews_l30d,
  {date('first_review')} AS first_review, {date('last_review')} AS last_review,
  {num("CASE WHEN review_scores_rating IN (" + TOKENS + ") THEN NULL ELSE review_scores_rating END")} AS review_scores_rating,
  {num('reviews_per_month')} AS reviews_per_month,
  {integer('calculated_host_listings_count')} AS calculated_host_listings_count
FROM raw_listings""",
    "stg_reviews": f"""
SELECT {bigint('listing_id')} AS listing_id, {bigint('id')} AS review_id, {date('date')} AS date,
       {bigint('reviewer_id')} AS reviewer_id, {text('reviewer_name')} AS reviewer_name, {text('comments')} AS comments
FROM raw_reviews""",
    "stg_calendar": f"""
SELECT DISTINCT {bigint('listing_id')} AS listing_id, {date('date')} AS date, {flag('available')} AS available,
       {integer('minimum_nights')} AS minimum_nights, {integer('maximum_nights')} AS maximum_nights
FROM raw_calendar""",
    "stg_neighbourhoods": f"""
SELECT DISTINCT {text('neighbourhood_group')} AS neighbourhood_group, {text('neighbourhood')} AS neighbourhood
FROM raw_neighbourhoods""",
    "clean_listings": "SELECT * FROM stg_listings WHERE minimum_nights <= maximum_nights",
    "clean_reviews": """
SELECT * FROM stg_reviews WHERE listing_id IN (SELECT listing_id FROM clean_listings WHERE listing_id IS NOT NULL)""",
    "clean_calendar": """
SELECT * FROM stg_calendar WHERE listing_id IN (SELECT listing_id FROM clean_listings WHERE listing_id IS NOT NULL)""",
    "nb_first": """
SELECT neighbourhood, neighbourhood_group FROM (
  SELECT neighbourhood, neighbourhood_group,
         row_number() OVER (PARTITION BY neighbourhood ORDER BY neighbourhood_group ASC NULLS FIRST) AS rn
  FROM stg_neighbourhoods) t WHERE rn = 1""",
    "dim_neighbourhood": """
SELECT CAST(row_number() OVER (ORDER BY neighbourhood) AS INTEGER) AS neighbourhood_key, neighbourhood, neighbourhood_group
FROM nb_first WHERE neighbourhood IS NOT NULL AND neighbourhood_group IS NOT NULL""",
    "dim_date": f"""
SELECT {date_key('date')} AS date_key, date AS full_date, CAST(day(date) AS INTEGER) AS day,
       CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name, CAST(quarter(date) AS INTEGER) AS quarter,
       CAST(year(date) AS INTEGER) AS year, dayname(date) AS day_name, CAST(isodow(date) AS INTEGER) AS day_of_week,
       CAST(weekofyear(date) AS INTEGER) AS week_of_year, {month_key('date')} AS month_key
FROM (SELECT date FROM clean_calendar UNION SELECT date FROM clean_reviews) u WHERE date IS NOT NULL""",
    "lst_first": """
SELECT * EXCLUDE (rn) FROM (
  SELECT listing_id, host_id, host_name, price, host_is_superhost, neighbourhood, latitude, longitude, property_type,
         room_type, accommodates, bathrooms, bedrooms, beds,
         row_number() OVER (PARTITION BY listing_id ORDER BY host_id NULLS FIRST, host_name NULLS FIRST,
           price NULLS FIRST, host_is_superhost NULLS FIRST, neighbourhood NULLS FIRST, latitude NULLS FIRST,
           longitude NULLS FIRST, property_type NULLS FIRST, room_type NULLS FIRST, accommodates NULLS FIRST,
           bathrooms NULLS FIRST, bedrooms NULLS FIRST, beds NULLS FIRST) AS rn
  FROM clean_listings) t WHERE rn = 1""",
    "lst_keyed": """
SELECT l.*, n.neighbourhood_key FROM lst_first l LEFT JOIN dim_neighbourhood n ON l.neighbourhood = n.neighbourhood""",
    "dim_listing": """
SELECT CAST(row_number() OVER (ORDER BY listing_id) AS INTEGER) AS listing_key, listing_id, host_id, host_name, price,
       host_is_superhost, neighbourhood_key, CAST(latitude AS DECIMAL(9,6)) AS latitude,
       CAST(longitude AS DECIMAL(9,6)) AS longitude, property_type, room_type, accommodates,
       CAST(bathrooms AS DECIMAL(4,1)) AS bathrooms, bedrooms, beds
FROM lst_keyed""",
    "fact_reviews": f"""
SELECT CAST(row_number() OVER (ORDER BY r.date, r.review_id NULLS FIRST, l.listing_key, r.reviewer_id NULLS FIRST) AS BIGINT) AS review_key,
       l.listing_key, {date_key('r.date')} AS date_key, r.review_id, r.reviewer_id,
       CAST(1 AS INTEGER) AS review_count, {month_key('r.date')} AS month_key
FROM clean_reviews r JOIN dim_listing l ON r.listing_id = l.listing_id""",
    "cal_first": """
SELECT listing_id, date, available, minimum_nights, maximum_nights FROM (
  SELECT *, row_number() OVER (PARTITION BY listing_id, date
            ORDER BY available NULLS FIRST, minimum_nights NULLS FIRST, maximum_nights NULLS FIRST) AS rn
  FROM clean_calendar) t WHERE rn = 1""",
    "fact_availability": f"""
SELECT CAST(row_number() OVER (ORDER BY c.date, l.listing_key) AS BIGINT) AS availability_key,
       l.listing_key, {date_key('c.date')} AS date_key, c.available, c.minimum_nights, c.maximum_nights,
       {month_key('c.date')} AS month_key
FROM cal_first c JOIN dim_listing l ON c.listing_id = l.listing_id""",
}


def with_ctes(body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in CTES.items())
    return f"WITH {ctes}\n{body}"


def _dq(table: str, rules: list[tuple[str, str, str]], source: str) -> str:
    """Report rows from one aggregation: rules are (name, severity, SQL count)."""
    parts = [
        f"SELECT '{table}' AS table_name, '{name}' AS rule, '{sev}' AS severity, CAST(({expr}) AS BIGINT) AS violations "
        f"FROM {source}"
        for name, sev, expr in rules
    ]
    return "\nUNION ALL\n".join(parts)


def _dup(cols: str, source: str) -> str:
    return f"(SELECT COALESCE(SUM(n - 1), 0) FROM (SELECT count(*) AS n FROM {source} GROUP BY {cols}) d)"


def _missing(child: str, parent: str) -> str:
    return (
        f"(SELECT count(*) FROM (SELECT DISTINCT listing_id FROM {child} WHERE listing_id IS NOT NULL) c "
        f"WHERE listing_id NOT IN (SELECT listing_id FROM {parent} WHERE listing_id IS NOT NULL))"
    )


# The warehouse's constraints, spelled out from its DDL.
NOT_NULL = {
    "dim_neighbourhood": "neighbourhood_key neighbourhood neighbourhood_group",
    "dim_listing": "listing_key listing_id",
    "dim_date": "date_key full_date day month month_name quarter year day_name day_of_week week_of_year month_key",
    "fact_reviews": "review_key listing_key date_key review_id review_count month_key",
    "fact_availability": "availability_key listing_key date_key available month_key",
}
UNIQUE = {
    "dim_neighbourhood": ["neighbourhood_key", "neighbourhood"],
    "dim_listing": ["listing_key", "listing_id"],
    "dim_date": ["date_key", "full_date"],
    "fact_reviews": ["review_key", "review_id"],
    "fact_availability": ["availability_key", "listing_key, date_key"],
}
WIDTHS = {
    "dim_neighbourhood": {"neighbourhood": 255, "neighbourhood_group": 255},
    "dim_listing": {"host_name": 255, "property_type": 255, "room_type": 100},
    "dim_date": {"month_name": 20, "day_name": 20},
}
# The same breaks that the checked star has, as CTEs named bad_<table>.
BAD_STAR = """,
bad_dim_neighbourhood AS (
  SELECT * REPLACE (CASE WHEN neighbourhood_key % 10 <> 6 THEN neighbourhood_key END AS neighbourhood_key,
                    CASE neighbourhood_key % 10 WHEN 2 THEN NULL WHEN 3 THEN repeat('n', 256) ELSE neighbourhood END AS neighbourhood,
                    CASE neighbourhood_key % 10 WHEN 4 THEN NULL WHEN 5 THEN repeat('g', 300) ELSE neighbourhood_group END AS neighbourhood_group)
  FROM dim_neighbourhood UNION ALL SELECT * FROM dim_neighbourhood WHERE neighbourhood_key % 10 = 1),
bad_dim_listing AS (
  SELECT * REPLACE (CASE WHEN listing_key % 50 <> 7 THEN listing_key END AS listing_key,
                    CASE WHEN listing_key % 50 <> 2 THEN listing_id END AS listing_id,
                    CASE WHEN listing_key % 50 = 3 THEN repeat('h', 256) ELSE host_name END AS host_name,
                    CASE WHEN listing_key % 50 = 4 THEN repeat('p', 256) ELSE property_type END AS property_type,
                    CASE WHEN listing_key % 50 = 5 THEN repeat('r', 101) ELSE room_type END AS room_type,
                    neighbourhood_key + CASE WHEN listing_key % 50 = 6 THEN 100000 ELSE 0 END AS neighbourhood_key)
  FROM dim_listing UNION ALL SELECT * FROM dim_listing WHERE listing_key % 50 = 1),
bad_dim_date AS (
  SELECT * REPLACE (CASE WHEN date_key % 11 = 8 THEN NULL WHEN date_key % 7 = 2 THEN -date_key ELSE date_key END AS date_key,
                    CASE WHEN date_key % 11 <> 1 THEN day END AS day,
                    CASE WHEN date_key % 11 <> 2 THEN month END AS month,
                    CASE WHEN date_key % 11 <> 3 THEN quarter END AS quarter,
                    CASE WHEN date_key % 11 <> 4 THEN year END AS year,
                    CASE WHEN date_key % 11 <> 5 THEN week_of_year END AS week_of_year,
                    CASE WHEN date_key % 11 <> 6 THEN month_key END AS month_key,
                    CASE WHEN date_key % 7 <> 3 THEN full_date END AS full_date,
                    CASE WHEN date_key % 11 = 7 THEN NULL WHEN date_key % 7 = 4 THEN repeat('m', 21) ELSE month_name END AS month_name,
                    CASE date_key % 7 WHEN 5 THEN repeat('d', 21) WHEN 6 THEN NULL ELSE day_name END AS day_name,
                    CASE WHEN date_key % 7 <> 0 THEN day_of_week END AS day_of_week)
  FROM dim_date UNION ALL SELECT * FROM dim_date WHERE date_key % 7 = 1),
bad_fact_reviews AS (
  SELECT * REPLACE (CASE WHEN review_key % 40 <> 6 THEN review_key END AS review_key,
                    CASE WHEN review_key % 40 <> 7 THEN review_id END AS review_id,
                    CASE WHEN review_key % 40 <> 8 THEN month_key END AS month_key,
                    CASE review_key % 40 WHEN 2 THEN -listing_key WHEN 3 THEN NULL ELSE listing_key END AS listing_key,
                    CASE WHEN review_key % 40 <> 4 THEN date_key END AS date_key,
                    CASE WHEN review_key % 40 <> 5 THEN review_count END AS review_count)
  FROM fact_reviews UNION ALL SELECT * FROM fact_reviews WHERE review_key % 40 = 1),
bad_fact_availability AS (
  SELECT * REPLACE (CASE WHEN availability_key % 40 <> 5 THEN availability_key END AS availability_key,
                    CASE WHEN availability_key % 40 <> 6 THEN month_key END AS month_key,
                    CASE availability_key % 40 WHEN 2 THEN -listing_key WHEN 7 THEN NULL ELSE listing_key END AS listing_key,
                    CASE WHEN availability_key % 40 <> 3 THEN date_key END AS date_key,
                    CASE WHEN availability_key % 40 <> 4 THEN available END AS available)
  FROM fact_availability UNION ALL SELECT * FROM fact_availability WHERE availability_key % 40 = 1)
"""


def _constraints() -> str:
    parts = []
    for name in NOT_NULL:
        bad = f"bad_{name}"
        rules = [(f"{c}_not_null", "fatal", f"SELECT count(*) FROM {bad} WHERE {c} IS NULL") for c in NOT_NULL[name].split()]
        rules += [(k.replace(", ", "_") + "_unique", "fatal", _dup(k, bad)) for k in UNIQUE[name]]
        rules += [(f"{c}_width_le_{n}", "fatal", f"SELECT count(*) FROM {bad} WHERE length({c}) > {n}") for c, n in WIDTHS.get(name, {}).items()]
        parts.append(_dq(name, rules, "(SELECT 1) one"))
    broken_fk = (
        "SELECT count(*) FROM bad_dim_listing WHERE neighbourhood_key IS NOT NULL AND neighbourhood_key NOT IN "
        "(SELECT neighbourhood_key FROM bad_dim_neighbourhood WHERE neighbourhood_key IS NOT NULL)"
    )
    parts.append(_dq("dim_listing", [("fk_neighbourhood_key", "fatal", broken_fk)], "(SELECT 1) one"))
    parts += [_bad_keys(dim, key, rule, "fatal") for dim, key, rule in BAD_KEYS]
    return "\nUNION ALL\n".join(parts)


BAD_KEYS = [("dim_listing", "listing_key", "orphan_listing_key"), ("dim_date", "date_key", "invalid_date_key")]


def _bad_keys(dim: str, key: str, rule: str, severity: str) -> str:
    return "\nUNION ALL\n".join(
        _dq(fact, [(rule, severity, _orphans(f"bad_{fact}", f"bad_{dim}", key))], "(SELECT 1) one") for fact in ("fact_reviews", "fact_availability")
    )


def _orphans(fact: str, dim: str, key: str) -> str:
    return f"SELECT count(*) FROM {fact} f LEFT JOIN {dim} d ON f.{key} = d.{key} WHERE d.{key} IS NULL"


def _recommend(filter_dates: str, guests: int, having: str) -> str:
    return f"""
SELECT l.listing_id, n.neighbourhood, l.accommodates, l.price,
       CAST(SUM(CAST(a.available AS INTEGER)) AS BIGINT) AS days_available
FROM fact_availability a JOIN dim_date d ON a.date_key = d.date_key
JOIN dim_listing l ON a.listing_key = l.listing_key
JOIN dim_neighbourhood n ON l.neighbourhood_key = n.neighbourhood_key
WHERE {filter_dates} AND a.available AND l.accommodates >= {guests}
GROUP BY l.listing_id, n.neighbourhood, l.accommodates, l.price
HAVING SUM(CAST(a.available AS INTEGER)) {having}
ORDER BY l.price ASC NULLS FIRST, l.listing_id LIMIT 5"""


LINEITEM_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


def _star_counts() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}"
        for t in ("dim_neighbourhood", "dim_listing", "dim_date", "fact_reviews", "fact_availability")
    )


def _listing_rules_sql(source: str) -> str:
    return _dq(
        "listings",
        [
            ("listing_id_unique", "fatal", _dup("listing_id", source)),
            ("listing_id_not_null", "fatal", f"SELECT count(*) FROM {source} WHERE listing_id IS NULL"),
            ("price_not_negative", "fatal", f"SELECT count(*) FROM {source} WHERE price < 0"),
            ("accommodates_positive", "fatal", f"SELECT count(*) FROM {source} WHERE accommodates <= 0"),
            ("bedrooms_not_negative", "fatal", f"SELECT count(*) FROM {source} WHERE bedrooms < 0"),
            ("min_nights_le_max_nights", "warning",
             f"SELECT count(*) FROM {source} WHERE minimum_nights > maximum_nights"),
            ("rating_between_1_and_5", "fatal",
             f"SELECT count(*) FROM {source} WHERE review_scores_rating < 1 OR review_scores_rating > 5"),
        ],
        "(SELECT 1) one",
    )


# Step -> what goes in, what comes out.
STEPS = {
    "neighbourhoods_duplicates": ("raw_neighbourhoods", "stg_neighbourhoods"),
    "listings_nights_range": ("stg_listings", "clean_listings"),
    "reviews_orphans": ("stg_reviews", "clean_reviews"),
    "calendar_duplicates": ("raw_calendar", "stg_calendar"),
    "calendar_orphans": ("stg_calendar", "clean_calendar"),
    "dim_date_dates": ("(SELECT date FROM clean_calendar UNION ALL SELECT date FROM clean_reviews) u WHERE date IS NOT NULL", "dim_date"),
    "dim_neighbourhood_duplicates": ("stg_neighbourhoods", "nb_first"),
    "dim_neighbourhood_nulls": ("nb_first", "dim_neighbourhood"),
    "dim_listing_duplicates": ("clean_listings", "lst_first"),
    "dim_listing_lookup": ("lst_first", "lst_keyed WHERE neighbourhood_key IS NOT NULL"),
    "fact_reviews_lookup": ("clean_reviews", "fact_reviews"),
    "fact_availability_duplicates": ("clean_calendar", "cal_first"),
    "fact_availability_lookup": ("cal_first", "fact_availability"),
}


def _steps() -> str:
    counted = "\nUNION ALL\n".join(
        f"SELECT '{step}' AS step, (SELECT count(*) FROM {a}) AS rows_in, (SELECT count(*) FROM {b}) AS rows_out" for step, (a, b) in STEPS.items()
    )
    return f"SELECT step, rows_in, rows_out, rows_in - rows_out AS dropped FROM ({counted}) s"


def queries() -> dict[str, str]:
    shifted_reviews = "(SELECT * REPLACE (CAST(date + INTERVAL 27 YEAR AS DATE) AS date) FROM clean_reviews)"
    body = {
        "q1_cheapest_most_available": """
SELECT l.listing_id, l.price, CAST(SUM(CAST(a.available AS INTEGER)) AS BIGINT) AS days_available
FROM fact_availability a JOIN dim_date d ON a.date_key = d.date_key JOIN dim_listing l ON a.listing_key = l.listing_key
WHERE d.year = 2024 AND d.month = 1 AND a.available
GROUP BY l.listing_id, l.price
ORDER BY days_available DESC, l.price ASC NULLS FIRST, l.listing_id LIMIT 1""",
        "q2_most_reviewed": """
SELECT l.listing_id, CAST(COUNT(r.review_id) AS BIGINT) AS total_reviews
FROM fact_reviews r JOIN dim_date d ON r.date_key = d.date_key JOIN dim_listing l ON r.listing_key = l.listing_key
WHERE d.year = 1997 AND d.month = 11
GROUP BY l.listing_id ORDER BY total_reviews DESC, l.listing_id LIMIT 10""",
        "q3_priciest_neighbourhood": """
SELECT n.neighbourhood, round(AVG(CAST(l.price AS DOUBLE)), 6) AS avg_price
FROM dim_listing l JOIN dim_neighbourhood n ON l.neighbourhood_key = n.neighbourhood_key
GROUP BY n.neighbourhood ORDER BY avg_price DESC NULLS LAST, n.neighbourhood LIMIT 1""",
        "q4_family_stay": _recommend("d.year = 2024 AND d.month = 1", 4, ">= 7"),
        "q5_range_stay": _recommend("d.full_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-14'", 5, "= 5"),
        "drill_across": f"""
, sr AS (SELECT listing_id, date FROM {shifted_reviews} s),
fr AS (SELECT l.listing_key, {month_key('sr.date')} AS month_key, CAST(SUM(1) AS BIGINT) AS reviews
       FROM sr JOIN dim_listing l ON sr.listing_id = l.listing_id GROUP BY 1, 2),
fa AS (SELECT listing_key, month_key, CAST(SUM(CAST(available AS INTEGER)) AS BIGINT) AS available_days
       FROM fact_availability GROUP BY 1, 2)
SELECT l.listing_id, COALESCE(fr.month_key, fa.month_key) AS month_key,
       CAST(COALESCE(fr.reviews, 0) AS BIGINT) AS reviews, CAST(COALESCE(fa.available_days, 0) AS BIGINT) AS available_days
FROM fr FULL OUTER JOIN fa ON fr.listing_key = fa.listing_key AND fr.month_key = fa.month_key
JOIN dim_listing l ON l.listing_key = COALESCE(fr.listing_key, fa.listing_key)""",
        "dim_neighbourhood": "SELECT * FROM dim_neighbourhood",
        "dim_date": "SELECT * FROM dim_date",
        "dim_listing": "SELECT * FROM dim_listing",
        "fact_reviews": "SELECT * FROM fact_reviews",
        "fact_availability": "SELECT * FROM fact_availability",
        "fact_surrogate_key": f"""
SELECT *, CAST(row_number() OVER (ORDER BY {LINEITEM_ORDER}) AS BIGINT) AS line_key FROM lineitem""",
        "conform_types": """
SELECT listing_id, host_id, host_name, price, host_is_superhost, CAST(latitude AS DECIMAL(9,6)) AS latitude,
       CAST(longitude AS DECIMAL(9,6)) AS longitude, property_type, room_type, accommodates,
       CAST(bathrooms AS DECIMAL(4,1)) AS bathrooms, bedrooms, beds FROM clean_listings""",
        "full_refresh": "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, CAST(sum({key}) AS BIGINT) AS key_sum, "
            f"CAST(sum({key} % 1009 * (({rest}) % 1013)) AS BIGINT) AS content_sum FROM {t}"
            for t, key, rest in [
                ("dim_neighbourhood", "neighbourhood_key", "length(neighbourhood) * 7 + length(neighbourhood_group)"),
                ("dim_listing", "listing_key", "listing_id + COALESCE(neighbourhood_key, 0) * 31 + COALESCE(accommodates, 0) * 7"),
                ("dim_date", "date_key", "year * 31 + month * 17 + day + week_of_year * 5 + day_of_week * 3 + quarter"),
                ("fact_reviews", "review_key", "review_id + listing_key * 31 + date_key * 7 + COALESCE(reviewer_id, 0)"),
                ("fact_availability", "availability_key",
                 "listing_key * 31 + date_key * 7 + CAST(available AS INT) + COALESCE(minimum_nights, 0) * 3 + COALESCE(maximum_nights, 0)"),
            ]
        ),
        "append_batches": f"""
SELECT CAST(row_number() OVER (ORDER BY CASE WHEN year(r.date) <= 1995 THEN 1 WHEN year(r.date) <= 1997 THEN 2 ELSE 3 END, r.date,
         r.review_id NULLS FIRST, l.listing_key, r.reviewer_id NULLS FIRST) AS BIGINT) AS review_key,
       l.listing_key, {date_key('r.date')} AS date_key, r.review_id, r.reviewer_id, CAST(1 AS INTEGER) AS review_count, {month_key('r.date')} AS month_key
FROM clean_reviews r JOIN dim_listing l ON r.listing_id = l.listing_id""",
        "table_row_counts": _star_counts(),
        "stg_listings": "SELECT * FROM stg_listings",
        "stg_reviews": "SELECT * FROM stg_reviews",
        "stg_neighbourhoods": "SELECT * FROM stg_neighbourhoods",
        "stg_calendar": "SELECT * FROM stg_calendar",
        "clean_listings": "SELECT * FROM clean_listings",
        "clean_reviews_semi": "SELECT * FROM clean_reviews",
        "clean_calendar_semi": "SELECT * FROM clean_calendar",
        "cleaning_metrics": _steps(),
        "stg_reviews_extra": "SELECT *, ' r' || review_id AS \"Review Source\" FROM clean_reviews",
        "union_all_dates": "SELECT 'calendar' AS source, date FROM clean_calendar UNION ALL SELECT 'reviews', date FROM clean_reviews",
        "normalise_headers": "SELECT neighbourhood_group, neighbourhood FROM raw_neighbourhoods",
        "scan_csv_typed": "SELECT * FROM stg_listings",
        "scan_csv_plain": """
SELECT * REPLACE (comments || chr(10) || 'the "end",' AS comments) FROM stg_reviews""",
        "scan_csv_many": """
SELECT *, CASE WHEN listing_id % 2 = 1 THEN listing_id || '.00' END AS price FROM stg_calendar""",
        "staging_roundtrip": "SELECT * FROM clean_reviews",
        "cast_ids": "SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN o_orderkey + 9007199254740992 ELSE o_orderkey END AS parsed_id FROM orders",
        "parse_date_lenient": f"""
SELECT o_orderkey, date_text, {date('date_text')} AS parsed_date FROM (
  SELECT o_orderkey, CASE o_orderpriority
      WHEN '1-URGENT' THEN replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '/')
      WHEN '2-HIGH' THEN substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 8) || '31'
      WHEN '3-MEDIUM' THEN 'not a date'
      ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date_text
  FROM orders) t""",
        "parse_currency": f"""
SELECT p_partkey, price_text, {money('price_text')} AS price FROM (
  SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN 'call us'
                         WHEN p_size % 10 = 1 THEN '-$' || format('{{:,.2f}}', p_retailprice)
                         ELSE '$' || format('{{:,.2f}}', p_retailprice) END AS price_text
  FROM part) t""",
        "parse_numeric_lenient": f"""
SELECT event_id, value_text, {num('value_text')} AS value FROM (
  SELECT event_id, CASE event_type WHEN 'error' THEN printf('%.2f', value) || 'x'
                                   WHEN 'signup' THEN ' ' || printf('%.2f', value) || ' '
                                   WHEN 'view' THEN 'nan'
                                   WHEN 'click' THEN printf('%.2f', value) || 'e2'
                                   ELSE printf('%.2f', value) END AS value_text
  FROM events) t""",
        "parse_flag": f"""
SELECT event_id, flag_text, {flag('flag_text')} AS flag FROM (
  SELECT event_id, CASE event_type WHEN 'click' THEN 't' WHEN 'view' THEN 'f' WHEN 'error' THEN 'x' END AS flag_text
  FROM events) t""",
        "flag_to_bit": """
SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 0 END AS bit FROM events""",
        "strip_text": f"""
SELECT p_partkey, {strip("chr(9) || ' ' || p_name || chr(10) || '  '")} AS name, '' AS blank FROM part""",
        "null_tokens": f"""
SELECT event_id, {text('t')} AS event_type FROM (
  SELECT event_id, CASE event_type WHEN 'error' THEN 'N/A' WHEN 'view' THEN 'null' WHEN 'click' THEN ''
                                   WHEN 'signup' THEN ' NA ' ELSE event_type END AS t
  FROM events) x""",
        "dedup_exact": "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem",
        "dedup_keep_first": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey NULLS FIRST,
     l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
     l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn
  FROM lineitem) t WHERE rn = 1""",
        "dedup_composite": """
SELECT listing_id, date, available, minimum_nights, maximum_nights FROM (
  SELECT *, row_number() OVER (PARTITION BY listing_id, date
            ORDER BY available NULLS FIRST, minimum_nights NULLS FIRST, maximum_nights NULLS FIRST) AS rn
  FROM stg_calendar) t WHERE rn = 1""",
        "drop_null_rows": """
SELECT listing_id, review_scores_rating, host_is_superhost, host_since FROM stg_listings
WHERE review_scores_rating IS NOT NULL AND host_is_superhost IS NOT NULL AND host_since IS NOT NULL""",
        "lookup_left": "SELECT listing_id, neighbourhood, neighbourhood_key FROM lst_keyed",
        "lookup_inner": """
SELECT r.listing_id, r.review_id, l.listing_key FROM clean_reviews r JOIN dim_listing l ON r.listing_id = l.listing_id""",
        "lookup_misses": """
SELECT listing_id, neighbourhood FROM lst_keyed WHERE neighbourhood_key IS NULL ORDER BY listing_id LIMIT 5""",
        "missing_parent_ids": """
SELECT DISTINCT listing_id, 'reviews' AS child FROM stg_reviews
WHERE listing_id IS NOT NULL AND listing_id NOT IN (SELECT listing_id FROM clean_listings WHERE listing_id IS NOT NULL)
UNION ALL
SELECT DISTINCT listing_id, 'calendar' AS child FROM stg_calendar
WHERE listing_id IS NOT NULL AND listing_id NOT IN (SELECT listing_id FROM clean_listings WHERE listing_id IS NOT NULL)""",
        "union_dates": "SELECT date FROM clean_calendar UNION SELECT date FROM clean_reviews",
        "dq_listings": """,
bad_listings AS (
  SELECT * REPLACE (CASE WHEN listing_id % 40 <> 2 THEN listing_id END AS listing_id,
                    CASE WHEN listing_id % 40 = 3 THEN 0 ELSE accommodates END AS accommodates,
                    CASE WHEN listing_id % 40 = 4 THEN -1 ELSE bedrooms END AS bedrooms,
                    CASE WHEN listing_id % 40 = 5 THEN maximum_nights + 1 ELSE minimum_nights END AS minimum_nights)
  FROM clean_listings UNION ALL SELECT * FROM clean_listings WHERE listing_id % 40 = 1)
"""
        + _listing_rules_sql("bad_listings"),
        "dq_reviews": """,
bad_reviews AS (
  SELECT * REPLACE (CASE WHEN review_id % 30 <> 2 THEN listing_id END AS listing_id, CASE WHEN review_id % 30 <> 3 THEN date END AS date)
  FROM clean_reviews UNION ALL SELECT * FROM clean_reviews WHERE review_id % 30 = 1)
"""
        + _dq(
            "reviews",
            [
                ("review_id_unique", "fatal", _dup("review_id", "bad_reviews")),
                ("listing_id_not_null", "fatal", "SELECT count(*) FROM bad_reviews WHERE listing_id IS NULL"),
                ("date_not_null", "fatal", "SELECT count(*) FROM bad_reviews WHERE date IS NULL"),
            ],
            "(SELECT 1) one",
        ),
        "dq_neighbourhoods": """,
bad_neighbourhoods AS (
  SELECT * REPLACE (CASE WHEN ascii(right(neighbourhood, 1)) % 5 <> 1 THEN neighbourhood END AS neighbourhood)
  FROM stg_neighbourhoods UNION ALL SELECT * FROM stg_neighbourhoods WHERE ascii(right(neighbourhood, 1)) % 5 = 2)
"""
        + _dq(
            "neighbourhoods",
            [
                ("neighbourhood_not_null", "fatal", "SELECT count(*) FROM bad_neighbourhoods WHERE neighbourhood IS NULL"),
                ("neighbourhood_group_not_null", "fatal", "SELECT count(*) FROM bad_neighbourhoods WHERE neighbourhood_group IS NULL"),
                ("neighbourhood_unique", "fatal", _dup("neighbourhood", "bad_neighbourhoods")),
            ],
            "(SELECT 1) one",
        ),
        "dq_calendar": """,
bad_calendar AS (
  SELECT * REPLACE (CASE WHEN listing_id % 30 <> 2 THEN listing_id END AS listing_id, CASE WHEN listing_id % 30 <> 3 THEN date END AS date,
                    CASE WHEN listing_id % 30 <> 4 THEN available END AS available)
  FROM clean_calendar UNION ALL SELECT * FROM clean_calendar WHERE listing_id % 30 = 1)
"""
        + _dq(
            "calendar",
            [
                ("listing_id_not_null", "fatal", "SELECT count(*) FROM bad_calendar WHERE listing_id IS NULL"),
                ("date_not_null", "fatal", "SELECT count(*) FROM bad_calendar WHERE date IS NULL"),
                ("available_not_null", "fatal", "SELECT count(*) FROM bad_calendar WHERE available IS NULL"),
                ("listing_id_date_unique", "fatal", _dup("listing_id, date", "bad_calendar")),
            ],
            "(SELECT 1) one",
        ),
        "dq_relationships": _dq(
            "reviews", [("listing_id_in_listings", "warning", _missing("stg_reviews", "clean_listings"))], "(SELECT 1) one"
        )
        + "\nUNION ALL\n"
        + _dq("calendar", [("listing_id_in_listings", "warning", _missing("stg_calendar", "clean_listings"))],
              "(SELECT 1) one"),
        "dq_duplicates": _dq(
            "lineitem",
            [
                ("l_orderkey_unique", "report", _dup("l_orderkey", "lineitem")),
                ("l_orderkey_l_linenumber_unique", "report", _dup("l_orderkey, l_linenumber", "lineitem")),
            ],
            "(SELECT 1) one",
        ),
        "dq_constraints": BAD_STAR + _constraints(),
        "orphan_facts": BAD_STAR + _bad_keys(*BAD_KEYS[0], "report"),
        "invalid_date_keys": BAD_STAR + _bad_keys(*BAD_KEYS[1], "report"),
        "check_unique_listings": """
SELECT CAST(count(*) AS BIGINT) AS total_listings, CAST(count(DISTINCT listing_id) AS BIGINT) AS unique_listings
FROM dim_listing""",
        "check_unique_neighbourhoods": """
SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(count(DISTINCT neighbourhood) AS BIGINT) AS unique_neighbourhoods
FROM dim_neighbourhood""",
        "check_unique_reviews": """
SELECT CAST(count(*) AS BIGINT) AS total_reviews, CAST(count(DISTINCT review_id) AS BIGINT) AS unique_reviews
FROM fact_reviews""",
        "check_unique_listing_date": """
SELECT CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count(DISTINCT concat(COALESCE(CAST(listing_key AS VARCHAR), ''), '-',
                                  COALESCE(CAST(date_key AS VARCHAR), ''))) AS BIGINT) AS unique_listing_date
FROM fact_availability""",
    }
    out = {}
    for k, v in body.items():
        if v.lstrip().startswith(","):
            # extra CTEs appended to the shared chain
            out[k] = with_ctes("").rstrip() + v
        else:
            out[k] = with_ctes(v)
    return out
