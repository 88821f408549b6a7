"""Shop selection predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopscope.fixed import DEFAULT_CITIES, DEFAULT_KEYWORD

CATEGORY_COLUMNS = ("cate_1_name", "cate_2_name", "cate_3_name")


def category_contains(keyword: str = DEFAULT_KEYWORD, columns: Iterable[str] = CATEGORY_COLUMNS) -> Column:
    """Any category column contains ``keyword`` (case-sensitive).

    Typed shop rows never hold null categories (blank is ""), so the plain
    ``contains`` is used; that keeps the predicate pushable to the scan.
    """
    cond = None
    for name in columns:
        term = F.col(name).contains(keyword)
        cond = term if cond is None else (cond | term)
    return cond


def city_in(cities: Iterable[str] = DEFAULT_CITIES, column: str = "city_name") -> Column:
    """Exact membership of the city in a fixed list (an In/InSet literal)."""
    return F.col(column).isin(list(cities))


def category_equals(value: str = DEFAULT_KEYWORD, column: str = "cate_1_name") -> Column:
    """First-level category equals ``value`` (the SQL form's narrower test)."""
    return F.col(column) == F.lit(value)
