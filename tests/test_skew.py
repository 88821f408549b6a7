"""A shop holding a large share of all payments: plans stay exact.

Broadcasts are switched off and AQE's skew thresholds lowered so the
sort-merge and aggregate-first paths run, with the hot shop's partition
split; results must equal the broadcast plans.
"""

import math

import pytest

from shopscope.operators import pays_of_shops, select_shops, shop_with_pay_day
from shopscope.plans import jobs as J
from shopscope.sources.lines import parse_pay_lines

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _rows(df):
    return sorted(tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect())


@pytest.fixture()
def skewed_pays(spark, tables):
    _, pays, _ = tables
    hot = [(f"h{i},1,2016-01-{1 + i % 28:02d} 10:00:00",) for i in range(4000)]
    extra = spark.createDataFrame(hot, "value string").repartition(8)
    return pays.unionByName(parse_pay_lines(extra))


def test_skewed_results_match_broadcast_plans(spark, tables, skewed_pays, skew_conf):
    shops, _, _ = tables
    pays = skewed_pays
    sel = select_shops(shops)
    semi_smj = pays_of_shops(pays, sel)                       # planner: sort-merge (broadcast off)
    joined = shop_with_pay_day(shops, pays, broadcast_max_rows=None)   # planner: sort-merge
    scores = J.popularity_scores(shops, pays, broadcast_max_rows=0)
    revenue = J.revenue_report(shops, pays, broadcast_max_rows=0)
    got = [_rows(semi_smj), _rows(joined), _rows(scores), _rows(revenue)]

    for k in SKEW_CONF:
        spark.conf.unset(k)
    want = [_rows(pays_of_shops(pays, sel, broadcast_max_rows=100)), _rows(shop_with_pay_day(shops, pays)),
            _rows(J.popularity_scores(shops, pays)), _rows(J.revenue_report(shops, pays))]
    assert got == want
    hot = {r[0]: r for r in got[2]}["1"]
    assert hot[0] == "1"


def test_aqe_splits_the_hot_shop(spark, tables, skewed_pays, skew_conf):
    shops, _, _ = tables
    df = shop_with_pay_day(shops, skewed_pays, broadcast_max_rows=None)
    assert len(df.collect()) == 4016                # collect() runs this DataFrame's own adaptive plan
    final_plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in final_plan and "skew=true" in final_plan
