"""Relational operators: selection, aggregation, ranking."""

from shopscope.operators.aggregates import (
    active_days,
    day_counts,
    day_max,
    day_revenue,
    day_stats,
    pay_count,
    pay_days_list,
    pay_total,
    revenue_from_counts,
    revenue_stats,
    row_count,
    shop_with_pay_count,
    shop_with_pay_day,
    visit_stats,
)
from shopscope.operators.ranking import top_k, top_k_per_group
from shopscope.operators.selection import (
    city_shops,
    exists_gate,
    keyword_shops,
    pays_of_shops,
    select_shops,
)

__all__ = [
    "active_days",
    "city_shops",
    "day_counts",
    "day_max",
    "day_revenue",
    "day_stats",
    "exists_gate",
    "keyword_shops",
    "pay_count",
    "pay_days_list",
    "pay_total",
    "pays_of_shops",
    "revenue_from_counts",
    "revenue_stats",
    "row_count",
    "select_shops",
    "shop_with_pay_count",
    "shop_with_pay_day",
    "top_k",
    "top_k_per_group",
    "visit_stats",
]
