"""Every registered query against its SQL, and the class sizes known for the fixture."""

import pytest

import __spark_entry__
from check_oracle import compare, connect
from helpers import plan
from workload.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert compare(QUERIES[name](spark, SF), db, ORACLE[name]) == ""


def test_all_queries_are_registered():
    assert QUERIES.items() <= __spark_entry__.queries().items() and ORACLE.items() <= __spark_entry__.oracle_sql().items()


@pytest.mark.parametrize("name", ["rejects_by_reason", "lead_updates", "upsert_last_wins", "merge_conditional", "error_log"])
def test_query_equals_sql_when_nothing_is_small(spark, db, no_broadcast, name):
    assert compare(__spark_entry__.queries()[name](spark, SF), db, __spark_entry__.oracle_sql()[name]) == ""


def test_class_sizes(spark):
    queries = __spark_entry__.queries()
    reasons = {r[0]: r[1] for r in __spark_entry__.entry(spark).collect()}
    assert reasons == {
        "missing_required": 1167, "missing_product_group": 115, "unknown_customer": 961,
        "unknown_contact": 1251, "unknown_product": 499,
    }
    assert queries["lead_updates"](spark, SF).count() == 683
    assert queries["lead_inserts"](spark, SF).count() == 1324
    assert queries["dedup_leads"](spark, SF).count() == 654
    assert tuple(queries["deal_buckets"](spark, SF).first()) == (904, 18, 402)


def test_scans_read_only_what_is_used(spark):
    text = plan(__spark_entry__.queries()["rejects_by_reason"](spark, SF))
    assert "l_extendedprice" not in text and "o_totalprice" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
