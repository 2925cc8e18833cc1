"""The post-load checks over the planted breaks: every rule family finds some, in a plan without Expand."""

from innkeeper import catalog
from tests.conftest import SF_SMALL


def test_every_rule_family_is_violated(spark):
    report = catalog.dq_constraints(spark, SF_SMALL)
    rows = {(r.table_name, r.rule): r.violations for r in report.collect()}
    assert not [k for k, n in rows.items() if not n], "a constraint without a planted break"
    found = {rule for (_, rule), n in rows.items() if n}
    for family in ("_not_null", "_unique", "_width_le_"):
        assert any(family in rule for rule in found), family
    assert {"fk_neighbourhood_key", "orphan_listing_key", "invalid_date_key"} <= found
    assert all(r.violations > 0 for r in catalog.orphan_facts(spark, SF_SMALL).collect())
    assert all(r.violations > 0 for r in catalog.invalid_date_keys(spark, SF_SMALL).collect())
    for query in (catalog.dq_listings, catalog.dq_reviews, catalog.dq_neighbourhoods, catalog.dq_calendar):
        assert all(r.violations > 0 for r in query(spark, SF_SMALL).collect()), query.__name__
    assert "Expand" not in report._jdf.queryExecution().optimizedPlan().toString()


def test_questions_read_the_written_star(spark):
    plan = catalog.q1_cheapest_most_available(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan
    assert plan.count("FileScan parquet") <= 3
