"""Hand-made raw extracts (all STRING, as a CSV read gives them)."""

from innkeeper import schemas
from innkeeper.sources.standin import as_read_from_csv


def listing(i, nb, price, acc, min_n="1", max_n="30", rating="4.5", superhost="t"):
    row = {c: None for c in schemas.LISTING_COLUMNS}
    row.update(
        id=str(i), host_id=str(100 + i), host_name=f" Host {i} ", host_since="2020-01-0" + str(1 + i % 9),
        host_is_superhost=superhost, neighbourhood_cleansed=nb, neighbourhood_group_cleansed="G",
        latitude="41.38", longitude="2.17", property_type="Entire rental unit", room_type="Entire home/apt",
        accommodates=str(acc), bathrooms="1.5", bedrooms="1", beds="2", price=price,
        minimum_nights=min_n, maximum_nights=max_n, review_scores_rating=rating,
    )
    return [row[c] for c in schemas.LISTING_COLUMNS] + [f"Listing {i}"]


def raw(spark):
    listings = [
        listing(1, "Gracia", "$100.00", 4),
        listing(2, "Gracia", "$80.00", 5),
        listing(3, "Born", None, 6),  # NULL price: ranks cheapest
        listing(4, "Nowhere", "$50.00", 2),  # neighbourhood not in the dimension
        listing(5, "Born", "$1,200.00", 8, min_n="9", max_n="3"),  # dropped by the nights rule
    ]
    reviews = [
        ("1", "10", "2026-11-02", "7", " Ann ", 'Great, "cozy"\nplace'),
        ("1", "11", "2026-11-20", "8", "Bob", "ok"),
        ("2", "12", "2026-11-21", "9", "Cy", "fine"),
        ("5", "13", "2026-11-22", "9", "Di", "orphan: listing 5 is dropped"),
    ]
    calendar = []
    for lid in ("1", "2", "3", "4", "5"):
        for d in range(1, 32):
            day = f"2027-01-{d:02d}"
            avail = "f" if (lid == "2" and d in (12,)) or (lid == "1" and d > 20) else "t"
            calendar.append((lid, day, avail, "1", "30"))
    calendar.append(("1", "2027-01-05", "t", "1", "30"))  # exact duplicate
    calendar.append(("3", "2027-01-06", "f", "1", "30"))  # same listing/date, other value
    neighbourhoods = [("G", "Gracia"), ("G", "Gracia"), ("G ", " Born"), (None, "Sants"), ("G", "Sants")]
    return {
        "listings": as_read_from_csv(spark.createDataFrame(listings, schemas.RAW_LISTINGS)),
        "reviews": as_read_from_csv(spark.createDataFrame(reviews, schemas.RAW_REVIEWS)),
        "calendar": as_read_from_csv(spark.createDataFrame(calendar, schemas.RAW_CALENDAR)),
        "neighbourhoods": as_read_from_csv(
            spark.createDataFrame(neighbourhoods, "`Neighbourhood_Group ` string, ` neighbourhood` string")
        ),
    }
