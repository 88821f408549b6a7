"""Invariants between operators on the driver tables."""

import pytest
from pyspark.sql import functions as F

from shopscope.operators import (
    active_days,
    day_counts,
    day_max,
    day_stats,
    pay_count,
    pay_total,
    pays_of_shops,
    select_shops,
    visit_stats,
)
from shopscope.plans import jobs as J
from shopscope.sources.standin import STANDIN_CITIES, STANDIN_KEYWORD, standin_tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def standin(spark):
    return standin_tables(spark, SF_SMALL)


def test_count_relations(standin):
    _, pays, _ = standin
    a0 = {r.shop_id: r.pay_count for r in pay_count(pays).collect()}
    dc = day_counts(pays)
    a3 = {r.shop_id: r.pay_total for r in pay_total(dc).collect()}
    a2 = {r.shop_id: r.day_max for r in day_max(dc).collect()}
    a4 = {r.shop_id: r.active_days for r in active_days(dc).collect()}
    a6 = {r.shop_id: (r.visits, r.distinct_days) for r in visit_stats(pays).collect()}
    assert a3 == a0
    assert set(a2) == set(a3) == set(a4)
    for k in a3:
        assert a2[k] <= a3[k] and a4[k] <= a3[k]
        assert a6[k] == (a3[k], a4[k])
    fused = {r.shop_id: (r.day_max, r.pay_total, r.active_days) for r in day_stats(dc).collect()}
    assert fused == {k: (a2[k], a3[k], a4[k]) for k in a3}


def test_stats_rows_are_selected_shops_with_pays(standin):
    shops, pays, _ = standin
    sel = select_shops(shops, STANDIN_CITIES, STANDIN_KEYWORD)
    sp = pays_of_shops(pays, sel)
    with_pays = {r.shop_id for r in sp.select("shop_id").distinct().collect()}
    assert {r.shop_id for r in day_stats(day_counts(sp)).collect()} == with_pays


def test_simplified_matches_real_score_when_priced(standin):
    shops, pays, _ = standin
    kw = {"cities": STANDIN_CITIES, "keyword": STANDIN_KEYWORD}
    real = J.popularity_scores(shops, pays, **kw)
    simp = J.popularity_simplified_scores(shops, pays, **kw)
    priced = {r.shop_id for r in shops.filter(F.col("per_pay") > 0).select("shop_id").collect()}
    r = {x.shop_id: x.popularity for x in real.collect()}
    s = {x.shop_id: x.popularity_simplified for x in simp.collect()}
    assert set(r) == set(s)
    for k in r:
        if k in priced:
            assert abs(r[k] - s[k]) < 1e-12


def test_per_city_top_equals_global_top_within_city(standin):
    shops, pays, _ = standin
    kw = {"cities": STANDIN_CITIES, "keyword": STANDIN_KEYWORD}
    per_city = J.popularity_top_per_city(shops, pays, **kw).collect()
    for city in STANDIN_CITIES:
        only = shops.filter(F.col("city_name") == city)
        glob = [r.shop_id for r in J.popularity_top(only, pays, **kw).collect()]
        assert [r.shop_id for r in sorted((x for x in per_city if x.city_name == city), key=lambda x: x.rank)] == glob


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_order_lookup_equals_inner_join(spark, sf_dir):
    # The stand-in looks the paying user up with a left join to orders
    # grouped on their key; it equals the oracle's inner join when every
    # lineitem has exactly one order.
    from shopscope.sources.standin import standin_pays

    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert orders.select("o_orderkey").distinct().count() == orders.count()
    assert li.join(orders, li.l_orderkey == orders.o_orderkey, "left_anti").count() == 0
    assert standin_pays(spark, sf_dir).filter(F.col("user_id").isNull()).count() == 0
