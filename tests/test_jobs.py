"""End-to-end jobs on the hand-made fixtures, against FIXTURES.md values."""

import math

from shopscope.operators import (
    active_days,
    day_counts,
    day_max,
    day_revenue,
    day_stats,
    exists_gate,
    pay_count,
    pay_days_list,
    pay_total,
    pays_of_shops,
    revenue_stats,
    row_count,
    select_shops,
    shop_with_pay_count,
    shop_with_pay_day,
    top_k,
    top_k_per_group,
    visit_stats,
)
from shopscope.plans import jobs as J
from shopscope.plans.sql import popularity_sql, register_views


def test_turnover_ranking(tables):
    shops, pays, _ = tables
    got = [(r.rank, r.shop_id, r.turnover) for r in J.turnover_top(shops, pays).collect()]
    assert got == [(1, "7", 400), (2, "4", 300), (3, "1", 240), (4, "2", 100), (5, "5", 30), (6, "3", 0)]
    assert [r.shop_id for r in J.turnover_top(shops, pays, k=2).collect()] == ["7", "4"]


def test_avg_daily_turnover(tables):
    shops, pays, _ = tables
    got = {r.shop_id: r.avg_daily_turnover for r in J.avg_daily_turnover_top(shops, pays).collect()}
    # shop 7: 400 over 2 days; shop 4: 300 over 4 days; shop 1: 240 over 2 days
    assert got["7"] == 200.0 and got["4"] == 75.0 and got["1"] == 120.0


def test_selection_and_semi_join(tables):
    shops, pays, _ = tables
    sel = select_shops(shops)
    assert sorted(r.shop_id for r in sel.collect()) == ["1", "2", "3", "6", "7"]
    sp = pays_of_shops(pays, sel)
    assert sorted({r.shop_id for r in sp.collect()}) == ["1", "2", "3", "7"]
    assert sp.count() == 10
    # duplicate shop rows do not duplicate payments
    assert pays_of_shops(pays, sel.unionAll(sel)).count() == 10


def test_day_counts_and_stats(tables):
    shops, pays, _ = tables
    sp = pays_of_shops(pays, select_shops(shops))
    dc = {(r.shop_id, r.day[5:]): r.n for r in day_counts(sp).collect()}
    assert dc == {("1", "01-01"): 2, ("1", "01-02"): 1, ("2", "01-01"): 1, ("2", "01-03"): 1,
                  ("3", "01-01"): 1, ("7", "01-01"): 3, ("7", "01-05"): 1}
    st = {r.shop_id: (r.pay_total, r.day_max, r.active_days) for r in day_stats(day_counts(sp)).collect()}
    assert st == {"1": (3, 2, 2), "2": (2, 1, 2), "3": (1, 1, 1), "7": (4, 3, 2)}
    c = day_counts(sp)
    assert {r.shop_id: r.day_max for r in day_max(c).collect()} == {k: v[1] for k, v in st.items()}
    assert {r.shop_id: r.pay_total for r in pay_total(c).collect()} == {k: v[0] for k, v in st.items()}
    assert {r.shop_id: r.active_days for r in active_days(c).collect()} == {k: v[2] for k, v in st.items()}
    assert row_count(c).collect()[0].n_rows == 7


def test_popularity_ranking_nan_first(tables):
    shops, pays, _ = tables
    top = J.popularity_top(shops, pays).collect()
    assert [r.shop_id for r in top] == ["3", "2", "1", "7"]
    assert math.isnan(top[0].popularity)
    assert [r.popularity for r in top[1:]] == [1.0, 0.7849999999999999, 0.6199999999999999]


def test_popularity_per_city(tables):
    shops, pays, _ = tables
    got = sorted((r.city_name, r.rank, r.shop_id) for r in J.popularity_top_per_city(shops, pays).collect())
    assert got == [("上海", 1, "2"), ("北京", 1, "1"), ("广州", 1, "3"), ("广州", 2, "7")]


def test_popularity_integer_job(tables):
    shops, pays, _ = tables
    got = {r.shop_id: r.popularity_int for r in J.popularity_integer_scores(shops, pays).collect()}
    assert got["3"] is None
    assert abs(got["1"] - 11.2) < 1e-9 and abs(got["2"] - 7.3) < 1e-9 and abs(got["7"] - 14.0) < 1e-9


def test_simplified_equals_real_with_price(tables):
    shops, pays, _ = tables
    real = {r.shop_id: r.popularity for r in J.popularity_scores(shops, pays).collect()}
    simp = {r.shop_id: r.popularity_simplified for r in J.popularity_simplified_scores(shops, pays).collect()}
    for sid in ("1", "2", "7"):
        assert abs(real[sid] - simp[sid]) < 1e-12


def test_popularity_sql_form(spark, tables):
    shops, pays, _ = tables
    got = {r.shop_id: r.popularity for r in popularity_sql(spark, shops, pays).collect()}
    # The EXISTS gate is uncorrelated: shop 7 (first category 火锅, 广州) opens it,
    # so every shop with payments and a shop row is scored, including 4 and 5.
    assert set(got) == {"1", "2", "3", "4", "5", "7"}
    assert got["3"] is None                                    # no price
    assert abs(got["2"] - (0.7 * 1.0 + 0.3 * 1.0)) < 1e-12
    closed = popularity_sql(spark, shops, pays, category="烧烤")
    assert closed.count() == 0


def test_exists_gate(tables):
    shops, pays, _ = tables
    assert exists_gate(pays, shops).count() == pays.count()
    assert exists_gate(pays, shops, category="美食", cities=["杭州"]).count() == pays.count()
    assert exists_gate(pays, shops, category="烧烤").count() == 0


def test_join_operators(tables):
    shops, pays, _ = tables
    wc = {r.shop_id: r.pay_count for r in shop_with_pay_count(shops, pays).collect()}
    assert wc == {"1": 3, "2": 2, "3": 1, "4": 5, "5": 1, "7": 4}
    assert {r.shop_id: r.pay_count for r in pay_count(pays).collect()}["99"] == 1
    wd = shop_with_pay_day(shops, pays)
    assert wd.count() == 16 and "day" in wd.columns and "per_pay" in wd.columns


def test_list_and_visit_stats(tables):
    _, pays, _ = tables
    lists = {r.shop_id: r for r in pay_days_list(pays).collect()}
    assert [(x.day, x.n) for x in lists["4"].day_counts] == [
        ("2016-01-01", 2), ("2016-01-02", 1), ("2016-01-03", 1), ("2016-01-04", 1)]
    vs = {r.shop_id: (r.visits, r.distinct_days) for r in visit_stats(pays).collect()}
    for sid, r in lists.items():
        assert vs[sid] == (r.n_pays, r.n_days)


def test_revenue(tables):
    shops, pays, _ = tables
    sel = select_shops(shops)
    rev = {(r.shop_id, r.day): r.revenue for r in day_revenue(sel, pays_of_shops(pays, sel)).collect()}
    assert rev[("7", "2016-01-01")] == 300 and rev[("1", "2016-01-01")] == 160
    stats = {r.shop_id: (r.max_day_revenue, r.total_revenue, r.active_days)
             for r in J.revenue_report(shops, pays).collect()}
    assert stats == {"1": (160, 240, 2), "2": (50, 100, 2), "3": (0, 0, 1), "7": (300, 400, 2)}
    assert {r.shop_id for r in revenue_stats(day_revenue(sel, pays)).collect()} == {"1", "2", "3", "7"}


def test_top_k_helpers(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 3.0), ("c", "y", 3.0), ("d", "y", float("nan"))],
                               "shop_id string, g string, v double")
    assert [r.shop_id for r in top_k(df, "v", 3).collect()] == ["d", "b", "c"]
    per = sorted((r.g, r.rank, r.shop_id) for r in top_k_per_group(df, "g", "v", 1).collect())
    assert per == [("x", 1, "b"), ("y", 1, "d")]


def test_register_views(spark, tables):
    shops, pays, views = tables
    register_views(shops, pays, views)
    assert spark.sql("SELECT COUNT(*) AS n FROM pays").collect()[0].n == 17
    assert spark.sql("SELECT COUNT(*) AS n FROM shopInfo").collect()[0].n == 7
    assert spark.sql("SELECT COUNT(*) AS n FROM views").collect()[0].n == 3


def _rows(df):
    return sorted(tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect())


def test_selection_plans_agree(tables):
    """Broadcast-filter-first and aggregate-first plans give the same rows."""
    shops, pays, _ = tables
    for job in (J.popularity_scores, J.popularity_top, J.popularity_top_per_city,
                J.popularity_integer_scores, J.popularity_simplified_scores, J.revenue_report,
                J.selected_revenue):
        small = _rows(job(shops, pays))
        assert small == _rows(job(shops, pays, broadcast_max_rows=0)), job.__name__
        assert small == _rows(job(shops, pays, broadcast_max_rows=None)), job.__name__
    sel = select_shops(shops)
    assert _rows(pays_of_shops(pays, sel, broadcast_max_rows=10)) == _rows(pays_of_shops(pays, sel, 0))


def test_zero_price_rules(tables):
    shops, pays, _ = tables
    excl = {r.shop_id for r in J.popularity_scores(shops, pays, zero_price="exclude").collect()}
    assert excl == {"1", "2", "7"}
    null = {r.shop_id: r.popularity for r in J.popularity_scores(shops, pays, zero_price="null").collect()}
    assert null["3"] is None and null["2"] == 1.0
    simp = {r.shop_id: r.popularity for r in J.popularity_scores(shops, pays, zero_price="simplified").collect()}
    assert abs(simp["3"] - (0.7 * 3 / 5 + 0.3 * (1 / 1) / 1)) < 1e-12
    top = [r.shop_id for r in J.popularity_top(shops, pays, zero_price="exclude").collect()]
    assert top == ["2", "1", "7"]


def test_fits_broadcast_checks_rows_and_bytes(tables):
    from shopscope.operators.selection import fits_broadcast

    shops, _, _ = tables
    assert fits_broadcast(shops, 7)
    assert not fits_broadcast(shops, 6)
    assert not fits_broadcast(shops, None)
    cols = ("shop_id", "city_name", "score", "per_pay")
    # 7 rows x (16 + 8 + 8) + id bytes (7) + city bytes (7 x 6) = 273
    assert fits_broadcast(shops, 100, columns=cols, max_bytes=273)
    assert not fits_broadcast(shops, 100, columns=cols, max_bytes=272)


def test_revenue_with_shop_copies(tables):
    """Copies of a shop each contribute, without joining every copy to every day."""
    shops, pays, _ = tables
    copies = shops.unionAll(shops.filter("shop_id = '7'")).unionAll(shops.filter("shop_id = '7'"))
    sel = select_shops(copies)
    rev = {(r.shop_id, r.day): r.revenue for r in day_revenue(sel, pays_of_shops(pays, sel)).collect()}
    assert rev[("7", "2016-01-01")] == 3 * 300 and rev[("1", "2016-01-01")] == 160
    stats = {r.shop_id: (r.max_day_revenue, r.total_revenue, r.active_days)
             for r in J.revenue_report(copies, pays).collect()}
    assert stats["7"] == (900, 1200, 2) and stats["1"] == (160, 240, 2)
