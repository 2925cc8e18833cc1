import pytest

from innkeeper import session
from innkeeper.plans import analytics as A
from innkeeper.plans import pipeline as P
from tests.fixtures import raw


@pytest.fixture(scope="module")
def star(spark):
    return P.full_refresh(spark, raw(spark), session.scratch_path(spark, "test-q"), enforce=False)


def test_q1_most_available_then_cheapest(star):
    assert [tuple(r) for r in A.cheapest_most_available(star, 2027, 1, n=3).collect()] == [
        (4, 50.0, 31), (3, None, 30), (2, 80.0, 30)]


def test_q2_most_reviewed(star):
    assert [tuple(r) for r in A.most_reviewed(star, 2026, 11).collect()] == [(1, 2), (2, 1)]


def test_q3_priciest_neighbourhood_null_average_last(star):
    assert [tuple(r) for r in A.priciest_neighbourhoods(star, 2).collect()] == [("Gracia", 90.0), ("Born", None)]


def test_q4_null_price_ranks_first_and_capacity(star):
    got = [r["listing_id"] for r in A.recommend_month(star, 4, 7, 2027, 1).collect()]
    assert got == [3, 2, 1]


def test_q5_every_day_of_range(star):
    # listing 2 is unavailable on 2027-01-12: 4 of 5 days -> out; listing 3: 5 of 5 -> in
    assert [r["listing_id"] for r in A.recommend_range(star, 5, "2027-01-10", "2027-01-14").collect()] == [3]
    assert [r["listing_id"] for r in A.recommend_range(star, 5, "2027-01-13", "2027-01-15").collect()] == [3, 2]


def test_drill_across(star):
    got = {(r["listing_id"], r["month_key"]): (r["reviews"], r["available_days"]) for r in A.drill_across(star).collect()}
    assert got[(1, 202611)] == (2, 0)
    assert got[(1, 202701)] == (0, 20)
    assert got[(4, 202701)] == (0, 31)


def test_question_plans_prune_and_aggregate_before_join(star):
    plan = A.cheapest_most_available(star, 2027, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "202701" in plan
