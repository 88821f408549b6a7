"""Turnover and popularity scores as column expressions.

Counts are exact integers and every product of two integers is taken in
bigint, so the double results are reproducible bit for bit. The original
int products wrap past 2^31; bigint does not (the results agree below).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopscope.functions._util import as_col

from shopscope.fixed import ACTIVITY_WEIGHT, SCORE_SCALE, SCORE_WEIGHT

ZERO_PRICE_RULES = ("nan", "null", "fail", "simplified")


def turnover(pay_count, per_pay) -> Column:
    """Number of payments times the average spend, in bigint."""
    return as_col(pay_count).cast("bigint") * as_col(per_pay).cast("bigint")


def _zero_price(per_pay: Column, value: Column, rule: str, fallback: Column | None = None) -> Column:
    if rule == "nan":
        return F.when(per_pay == 0, F.lit(float("nan"))).otherwise(value)
    if rule == "null":
        return F.when(per_pay == 0, F.lit(None).cast("double")).otherwise(value)
    if rule == "fail":
        return F.when(per_pay == 0, F.raise_error(F.lit("popularity: per_pay is 0")).cast("double")).otherwise(value)
    if rule == "simplified" and fallback is not None:
        return F.when(per_pay == 0, fallback).otherwise(value)
    raise ValueError(f"zero_price must be one of {ZERO_PRICE_RULES}, got {rule!r}")


def popularity(score, per_pay, total, days, day_max, zero_price: str = "nan") -> Column:
    """``(0.7*score)/5 + ((0.3*(total*per_pay))/days)/(day_max*per_pay)``.

    Real arithmetic in exactly this order. A shop with per_pay = 0 has no
    defined score: ``zero_price`` picks NaN (the original result, which sorts
    first in a descending order), null, a job failure, or the simplified form.
    """
    score, per_pay = as_col(score), as_col(per_pay)
    total, days, day_max = as_col(total), as_col(days), as_col(day_max)
    money_total = total.cast("bigint") * per_pay.cast("bigint")
    money_max = day_max.cast("bigint") * per_pay.cast("bigint")
    value = (F.lit(SCORE_WEIGHT) * score) / SCORE_SCALE + (
        (F.lit(ACTIVITY_WEIGHT) * money_total) / days
    ) / money_max
    fallback = popularity_simplified(score, total, days, day_max)
    return _zero_price(per_pay, value, zero_price, fallback)


def popularity_simplified(score, total, days, day_max) -> Column:
    """The price cancels, ``0.7*score/5 + 0.3*(total/days)/day_max``."""
    score, total, days, day_max = (as_col(c) for c in (score, total, days, day_max))
    return (F.lit(SCORE_WEIGHT) * score) / SCORE_SCALE + (
        F.lit(ACTIVITY_WEIGHT) * (total / days)
    ) / day_max


def _idiv(a: Column, b) -> Column:
    """Integral division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def popularity_integer(per_pay, visits, days, day_max, zero_price: str = "null") -> Column:
    """The integer-arithmetic variant.

    ``0.7*(per_pay div 5) + 0.3*(((visits*per_pay) div days) div (day_max*per_pay))``.
    Note it weighs per_pay where the rating is meant, exactly as the
    original variant does. Every ``div`` is integral. per_pay = 0 has no
    value (the original throws): null by default, or ``"fail"``.
    """
    per_pay, visits, days, day_max = (as_col(c) for c in (per_pay, visits, days, day_max))
    p = per_pay.cast("bigint")
    value = F.lit(SCORE_WEIGHT) * _idiv(p, SCORE_SCALE) + F.lit(ACTIVITY_WEIGHT) * _idiv(
        _idiv(visits.cast("bigint") * p, days.cast("bigint")), day_max.cast("bigint") * p
    )
    if zero_price not in ("null", "fail", "nan"):
        raise ValueError("zero_price for the integer score must be 'null', 'nan' or 'fail'")
    return _zero_price(per_pay, value, zero_price)
