"""Every registered query against its SQL oracle on the smallest test tables."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck_connection


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, con=duck_connection(SF_SMALL))


def test_every_query_has_an_oracle():
    from shopscope.plans.catalog import QUERIES
    from shopscope.plans.oracle import oracle_sql

    assert set(QUERIES) == set(oracle_sql())


def test_all_queries_match_oracle(results):
    bad = {k: v for k, v in results.items() if v[0] != "ok"}
    assert not bad, bad


def test_entry_contract(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["rank", "shop_id", "turnover"]
    rows = df.collect()
    assert len(rows) == 10
    assert [r["rank"] for r in rows] == list(range(1, 11))


def test_queries_match_oracle_in_another_session_setting(spark):
    # A caller's session may use another time zone and ANSI off; results
    # must not depend on either. newSession() has its own SQL settings.
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    other.conf.set("spark.sql.ansi.enabled", "false")
    res = compare(other, SF_SMALL, con=duck_connection(SF_SMALL))
    bad = {k: v for k, v in res.items() if v[0] != "ok"}
    assert not bad, bad
