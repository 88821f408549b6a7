"""Column functions: cleaning rules, predicates and scores."""

from shopscope.functions.clean import (
    blank_to_empty,
    blank_to_zero,
    epoch_to_day,
    is_int_text,
    java_trim,
    pay_day,
    register_sql_functions,
    text_to_day,
)
from shopscope.functions.predicates import category_contains, category_equals, city_in
from shopscope.functions.scores import (
    popularity,
    popularity_integer,
    popularity_simplified,
    turnover,
)

__all__ = [
    "blank_to_empty",
    "blank_to_zero",
    "category_contains",
    "category_equals",
    "city_in",
    "epoch_to_day",
    "is_int_text",
    "java_trim",
    "pay_day",
    "popularity",
    "popularity_integer",
    "popularity_simplified",
    "register_sql_functions",
    "text_to_day",
    "turnover",
]
