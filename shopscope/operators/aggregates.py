"""Counting operators.

Every aggregate here is a ``groupBy().agg()`` of decomposable functions
(count, sum, max), so Spark combines map-side before the shuffle: a shop
holding a third of all payments still sends at most one partial row per
(shop, day) per input partition. Per-day counts are taken first and the
per-shop statistics are computed from them, so per-shop work is bounded
by the number of days, not of payments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.operators.selection import BROADCAST_MAX_SHOPS, fits_broadcast


def pay_count(pays: DataFrame) -> DataFrame:
    """A0: payments per shop -> (shop_id, pay_count)."""
    return pays.groupBy("shop_id").agg(F.count(F.lit(1)).alias("pay_count"))


def shop_with_pay_count(shops: DataFrame, pays: DataFrame) -> DataFrame:
    """J-count: each shop row with its payment count (inner join).

    Shops without payments drop out; duplicate shop rows stay duplicated.
    The count side has one row per shop, so the join moves per-shop rows,
    never payment rows.
    """
    return shops.join(pay_count(pays), on="shop_id", how="inner")


def shop_with_pay_day(shops: DataFrame, pays: DataFrame,
                      broadcast_max_rows: int | None = BROADCAST_MAX_SHOPS) -> DataFrame:
    """J-day: one row per payment with its shop's columns and the day.

    The output has a row per payment, so the payments cannot be reduced
    first. When the shop table passes the measured size check it is
    broadcast and payments are joined where they are read; otherwise the
    planner sort-merges (AQE splits a hot shop's partition).
    """
    if fits_broadcast(shops, broadcast_max_rows, columns=tuple(shops.columns)):
        shops = F.broadcast(shops)
    return shops.join(pays.select("shop_id", "day"), on="shop_id", how="inner")


def day_counts(pays: DataFrame) -> DataFrame:
    """A1: payments per (shop, day) -> (shop_id, day, n)."""
    return pays.groupBy("shop_id", "day").agg(F.count(F.lit(1)).alias("n"))


def day_stats(counts: DataFrame) -> DataFrame:
    """A234: from A1, per shop: busiest day, total payments, active days."""
    return counts.groupBy("shop_id").agg(
        F.max("n").alias("day_max"),
        F.sum("n").alias("pay_total"),
        F.count(F.lit(1)).alias("active_days"),
    )


def day_max(counts: DataFrame) -> DataFrame:
    """A2: payments on the busiest day of each shop."""
    return counts.groupBy("shop_id").agg(F.max("n").alias("day_max"))


def pay_total(counts: DataFrame) -> DataFrame:
    """A3: total payments of each shop (sum of its day counts)."""
    return counts.groupBy("shop_id").agg(F.sum("n").alias("pay_total"))


def active_days(counts: DataFrame) -> DataFrame:
    """A4: days with at least one payment, per shop."""
    return counts.groupBy("shop_id").agg(F.count(F.lit(1)).alias("active_days"))


def pay_days_list(pays: DataFrame) -> DataFrame:
    """A5: each shop's payment days with multiplicity.

    The list keeps duplicates as (day, n) pairs sorted by day instead of
    one element per payment: the same multiset, but its length is bounded
    by the number of calendar days rather than by a shop's payments.
    Columns: shop_id, day_counts (array<struct<day, n>>), n_pays, n_days.
    """
    return day_counts(pays).groupBy("shop_id").agg(
        F.sort_array(F.collect_list(F.struct("day", "n"))).alias("day_counts"),
        F.sum("n").alias("n_pays"),
        F.count(F.lit(1)).alias("n_days"),
    )


def visit_stats(pays: DataFrame) -> DataFrame:
    """Payments and distinct payment days per shop, without any list."""
    return pays.groupBy("shop_id").agg(
        F.count(F.lit(1)).alias("visits"),
        F.count_distinct("day").alias("distinct_days"),
    )


def revenue_from_counts(counts: DataFrame, shops: DataFrame) -> DataFrame:
    """A7 from per-(shop, day) counts: money = count x average spend.

    A shop listed twice contributes once per copy, as joining every payment
    to every copy would: sum over copies of n x per_pay = n x (sum of the
    copies' per_pay). The prices are summed per shop first, so the join is
    one row per (shop, day) however many copies a shop has.
    """
    prices = shops.groupBy("shop_id").agg(F.sum(F.col("per_pay").cast("bigint")).alias("price_sum"))
    joined = counts.join(prices, on="shop_id", how="inner")
    return joined.select("shop_id", "day", (F.col("n") * F.col("price_sum")).alias("revenue"))


def day_revenue(shops: DataFrame, pays: DataFrame) -> DataFrame:
    """Money per (shop, day) = payments that day x average spend.

    Payments are counted per (shop, day) first and only then joined to the
    shop rows, so the join moves day counts, not payments.
    """
    return revenue_from_counts(day_counts(pays), shops)


def revenue_stats(revenue: DataFrame) -> DataFrame:
    """Per shop, the best day's money, total money and active days."""
    return revenue.groupBy("shop_id").agg(
        F.max("revenue").alias("max_day_revenue"),
        F.sum("revenue").alias("total_revenue"),
        F.count(F.lit(1)).alias("active_days"),
    )


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """The number of rows of a result, as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))
