"""Every registered query runs, and equals its comparison SQL."""

import pytest
from comparison import connect, differences

from shelfwise.plans import all_queries, comparison_sql

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), comparison_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF_DIR), db, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_quality_rules_find_something(spark):
    report = {r["rule"]: r for r in QUERIES["quality_report"](spark, SF_DIR).collect()}
    for rule in ("completeness:address", "length:product_level_4", "sales_amount", "margin", "weight:kg", "date:bounds",
                 "unique:barcode", "one product_article per barcode"):
        assert report[rule]["violations"] > 0, rule
    assert all(0 <= r["rate"] <= 1 for r in report.values())


def test_saved_models_predict_the_same(spark):
    rows = QUERIES["save_and_load_model"](spark, SF_DIR).collect()
    assert [r["same"] for r in rows] == [True]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_fact_keys_are_shuffled_as_bytes(spark):
    """Nearly every row has keys of its own: their digests make most of what is shuffled."""
    facts = QUERIES["build_facts"](spark, SF_DIR)
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("unhex(") >= 4
    assert facts.filter("product_key rlike '^[0-9a-f]{32}$'").count() == facts.count()
