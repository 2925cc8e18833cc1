"""Q1-Q5 on random small stars against a pandas rendering of the question SQL
(inner joins, WHERE, GROUP BY, HAVING, ORDER BY with NULL price lowest, plus the
natural-key tie-breaks this library adds)."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from innkeeper import schemas
from innkeeper.functions import columns as C
from innkeeper.plans import analytics as A
from innkeeper.plans.warehouse import Star


def _star(spark, seed):
    rnd = random.Random(seed)
    nb = [(1, "Born", "G"), (2, "Gracia", "G"), (3, "Sants", "H")]
    listings = []
    for key in range(1, 41):
        price = None if rnd.random() < 0.15 else float(rnd.choice([50, 60, 60, 80, 120]))
        listings.append((key, 1000 + key, rnd.choice([1, 2, 3, None]), price, rnd.randint(1, 8)))
    days = [dt.date(2026, 12, 20) + dt.timedelta(days=i) for i in range(50)]
    avail = []
    for key, *_ in listings:
        for d in days:
            if rnd.random() < 0.7:
                avail.append((key, d, rnd.random() < 0.75))
    reviews = [(i, rnd.randint(1, 40), rnd.choice(days)) for i in range(1, 300)]
    spark_dates = spark.createDataFrame([(d,) for d in days], "d date")
    attrs = C.date_attributes("d")
    dim_date = spark_dates.select(*[attrs[f.name].cast(f.dataType).alias(f.name) for f in schemas.DIM_DATE.fields])
    dim_listing = spark.createDataFrame(
        listings, "listing_key int, listing_id long, neighbourhood_key int, price double, accommodates int"
    )
    fa = spark.createDataFrame(avail, "listing_key int, d date, available boolean").select(
        "listing_key", C.date_key("d").alias("date_key"), "available", C.month_key("d").alias("month_key")
    )
    fr = spark.createDataFrame(reviews, "review_id long, listing_key int, d date").select(
        "review_id", "listing_key", C.date_key("d").alias("date_key"), C.month_key("d").alias("month_key")
    ).withColumn("review_count", F.lit(1))
    star = Star(
        dim_neighbourhood=spark.createDataFrame(nb, "neighbourhood_key int, neighbourhood string, neighbourhood_group string"),
        dim_listing=dim_listing, dim_date=dim_date, fact_reviews=fr, fact_availability=fa,
    )
    pdf = {
        "nb": pd.DataFrame(nb, columns=["neighbourhood_key", "neighbourhood", "neighbourhood_group"]),
        "l": pd.DataFrame(listings, columns=["listing_key", "listing_id", "neighbourhood_key", "price", "accommodates"]),
        "a": pd.DataFrame(avail, columns=["listing_key", "d", "available"]),
        "r": pd.DataFrame(reviews, columns=["review_id", "listing_key", "d"]),
    }
    return star, pdf


def _cheapest_first(df, extra):
    df = df.assign(_null=df["price"].isna().map({True: 0, False: 1}), _p=df["price"].fillna(0))
    return df.sort_values(["_null", "_p"] + extra[0], ascending=[True, True] + extra[1])


def _rows(df, cols):
    return [tuple(None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in r) for r in df[cols].itertuples(index=False)]


def test_questions_match_pandas(spark):
    for seed in range(3):
        star, p = _star(spark, seed)
        a = p["a"].merge(p["l"], on="listing_key")
        jan = a[(a["d"].map(lambda d: (d.year, d.month)) == (2027, 1)) & a["available"]]

        g = jan.groupby(["listing_id", "price"], dropna=False).size().reset_index(name="days_available")
        g = g.assign(_null=g["price"].isna().map({True: 0, False: 1}), _p=g["price"].fillna(0))
        want1 = g.sort_values(["days_available", "_null", "_p", "listing_id"], ascending=[False, True, True, True]).head(3)
        got1 = [tuple(r) for r in A.cheapest_most_available(star, 2027, 1, n=3).collect()]
        assert got1 == _rows(want1, ["listing_id", "price", "days_available"]), seed

        r = p["r"].merge(p["l"], on="listing_key")
        dec = r[r["d"].map(lambda d: (d.year, d.month)) == (2026, 12)]
        c = dec.groupby("listing_id").size().reset_index(name="total_reviews")
        want2 = c.sort_values(["total_reviews", "listing_id"], ascending=[False, True]).head(10)
        assert [tuple(x) for x in A.most_reviewed(star, 2026, 12).collect()] == _rows(want2, ["listing_id", "total_reviews"])

        ln = p["l"].merge(p["nb"], on="neighbourhood_key")
        avg = ln.groupby("neighbourhood")["price"].mean().round(6).reset_index(name="avg_price")
        avg = avg.assign(_nn=avg["avg_price"].isna()).sort_values(["_nn", "avg_price", "neighbourhood"], ascending=[True, False, True])
        assert [tuple(x) for x in A.priciest_neighbourhoods(star, 3).collect()] == _rows(avg, ["neighbourhood", "avg_price"])

        an = a.merge(p["nb"], on="neighbourhood_key")
        cols = ["listing_id", "neighbourhood", "accommodates", "price", "days_available"]
        m = an[(an["d"].map(lambda d: (d.year, d.month)) == (2027, 1)) & an["available"] & (an["accommodates"] >= 4)]
        g4 = m.groupby(["listing_id", "neighbourhood", "accommodates", "price"], dropna=False).size().reset_index(name="days_available")
        g4 = _cheapest_first(g4[g4["days_available"] >= 7], (["listing_id"], [True])).head(5)
        assert [tuple(x) for x in A.recommend_month(star, 4, 7, 2027, 1).collect()] == _rows(g4, cols), seed

        lo, hi = dt.date(2026, 12, 29), dt.date(2027, 1, 2)
        m5 = an[(an["d"] >= lo) & (an["d"] <= hi) & an["available"] & (an["accommodates"] >= 3)]
        g5 = m5.groupby(["listing_id", "neighbourhood", "accommodates", "price"], dropna=False).size().reset_index(name="days_available")
        g5 = _cheapest_first(g5[g5["days_available"] == 5], (["listing_id"], [True])).head(5)
        assert [tuple(x) for x in A.recommend_range(star, 3, lo, hi).collect()] == _rows(g5, cols), seed
