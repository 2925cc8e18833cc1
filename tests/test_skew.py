"""A hot listing holding a third of the calendar: results stay exact and the
dedup combines copies map-side before the shuffle."""

import contextlib
import datetime as dt
import io
import random

import pandas as pd
from pyspark.sql import functions as F

from innkeeper import schemas
from innkeeper.operators.dedup import keep_first
from innkeeper.operators.keys import dense_key
from innkeeper.plans import staging as S
from innkeeper.plans import warehouse as W
from innkeeper.sources.standin import as_read_from_csv


def _calendar(n_rows=6000, hot_share=3, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_rows):
        lid = 7 if i % hot_share == 0 else rnd.randint(1, 200)
        day = dt.date(2027, 1, 1) + dt.timedelta(days=rnd.randint(0, 59))
        rows.append((str(lid), day.isoformat(), rnd.choice("tf"), "1", str(rnd.randint(2, 9))))
    return rows


def test_hot_listing_fact_is_exact(spark):
    rows = _calendar()
    raw = as_read_from_csv(spark.createDataFrame(rows, schemas.RAW_CALENDAR))
    cal = S.stage_calendar(raw)
    listings = spark.createDataFrame([(i,) for i in range(1, 201)], "listing_id long")
    dim = dense_key(listings, ["listing_id"], "listing_key", n_buckets=4)
    dim = dim.withColumn("listing_key", F.col("listing_key").cast("int"))
    fact = W.fact_availability(cal, dim, dim_rows=None)
    got = sorted((r["listing_key"], r["date_key"], r["available"], r["maximum_nights"]) for r in fact.collect())

    pdf = pd.DataFrame(rows, columns=["listing_id", "date", "available", "min", "max"]).drop_duplicates()
    pdf["available"] = pdf["available"] == "t"
    pdf["max"] = pdf["max"].astype(int)
    pdf = pdf.sort_values(["listing_id", "date", "available", "max"]).drop_duplicates(["listing_id", "date"])
    want = sorted(
        (int(r.listing_id), int(r.date.replace("-", "")), bool(r.available), int(r.max)) for r in pdf.itertuples()
    )
    assert got == want  # listing_key == listing_id here (ids 1..200 in order)
    keys = sorted(r["availability_key"] for r in fact.select("availability_key").collect())
    assert keys == list(range(1, len(want) + 1))


def test_keep_first_combines_map_side(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 1, "b")], "k int, o int, p string")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        keep_first(df, ["k"], ["o"]).explain()
    assert "partial_min" in out.getvalue()
