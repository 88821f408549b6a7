"""Whole jobs: read-clean-select-aggregate-score-rank as one lazy plan.

Every job takes typed (shops, pays) DataFrames from any reader and returns
a DataFrame that the caller's action runs. A job that selects shops writes the
selection to the shared folder when it is built, once, and reads its size from
that write (two numbers); no rows are collected inside a job. Parameters
default to the original fixed values.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.functions.predicates import DEFAULT_CITIES, DEFAULT_KEYWORD
from shopscope.functions.scores import (
    popularity,
    popularity_integer,
    popularity_simplified,
    turnover,
)
from shopscope.operators.aggregates import (
    day_counts,
    day_stats,
    pay_count,
    revenue_from_counts,
    revenue_stats,
)
from shopscope.operators.ranking import DEFAULT_K, top_k, top_k_per_group
from shopscope.operators.selection import (
    BROADCAST_MAX_BYTES,
    BROADCAST_MAX_SHOPS,
    broadcast_measures,
    in_shops,
    likely_few,
    select_shops,
)
from shopscope.shared import materialised

# Shop columns the selection jobs broadcast (join key plus the attributes the
# scores and reports read); the size check measures exactly these.
BROADCAST_COLUMNS = ("shop_id", "city_name", "score", "per_pay")


def shop_turnover(shops: DataFrame, pays: DataFrame) -> DataFrame:
    """Turnover (payments x average spend) of every shop with payments."""
    joined = shops.select("shop_id", "per_pay").join(pay_count(pays), on="shop_id", how="inner")
    return joined.select("shop_id", turnover("pay_count", "per_pay").alias("turnover"))


def turnover_top(shops: DataFrame, pays: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """The ``k`` shops with the largest turnover -> (rank, shop_id, turnover)."""
    return top_k(shop_turnover(shops, pays), "turnover", k).select("rank", "shop_id", "turnover")


def avg_daily_turnover_top(shops: DataFrame, pays: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """The ``k`` shops with the largest average daily turnover.

    Average over the days with at least one payment:
    turnover / active days -> (rank, shop_id, avg_daily_turnover).
    """
    stats = day_stats(day_counts(pays))
    joined = shops.select("shop_id", "per_pay").join(stats, on="shop_id", how="inner")
    scored = joined.select(
        "shop_id",
        (turnover("pay_total", "per_pay") / F.col("active_days")).alias("avg_daily_turnover"),
    )
    return top_k(scored, "avg_daily_turnover", k).select("rank", "shop_id", "avg_daily_turnover")


def selected_day_counts(shops: DataFrame, pays: DataFrame, cities: Iterable[str] = DEFAULT_CITIES,
                        keyword: str = DEFAULT_KEYWORD,
                        broadcast_max_rows: int | None = BROADCAST_MAX_SHOPS) -> tuple[DataFrame, DataFrame]:
    """Selected shops and their payments per (shop, day): (selected, counts).

    The selection is evaluated once: it is written to the shared folder with
    the columns the jobs read, and everything after reads it from there.
    Two exact plans, chosen by the size the write observed:

    * at most ``broadcast_max_rows`` selected shops: they are broadcast and
      payments are filtered where they are read (no shuffle of payments),
      then counted per (shop, day) with a map-side partial count;
    * more: every payment is first counted per (shop, day) (map-side
      partial count, so a hot shop ships at most one row per day and input
      partition), and only those counts are joined to the distinct
      selected ids. Raw payments are never shuffled by shop. Above Spark's
      runtime filter size a Bloom filter of the ids reaches the payment scan,
      so most other payments are not counted at all.

    The returned ``selected`` carries the broadcast hint in the first case,
    so the later join of per-shop statistics to shop attributes is also a
    broadcast.
    """
    chosen = select_shops(shops, cities, keyword).select(*BROADCAST_COLUMNS)
    n, size = broadcast_measures(chosen, BROADCAST_COLUMNS)
    selected, seen = materialised(chosen, "selected-shops", n=n, bytes=size)
    if broadcast_max_rows is not None and seen["n"] <= broadcast_max_rows and seen["bytes"] <= BROADCAST_MAX_BYTES:
        selected = F.broadcast(selected)
        return selected, day_counts(in_shops(pays, F.broadcast(selected.select("shop_id"))))
    return selected, day_counts(pays).join(likely_few(selected), on="shop_id", how="inner")


def _selected_stats(shops, pays, cities, keyword, broadcast_max_rows):
    selected, counts = selected_day_counts(shops, pays, cities, keyword, broadcast_max_rows)
    return selected, day_stats(counts)


def popularity_scores(shops: DataFrame, pays: DataFrame, cities: Iterable[str] = DEFAULT_CITIES,
                      keyword: str = DEFAULT_KEYWORD, zero_price: str = "nan",
                      broadcast_max_rows: int | None = BROADCAST_MAX_SHOPS) -> DataFrame:
    """J2 before ranking: popularity (N10) of each selected shop with payments.

    -> (shop_id, city_name, popularity). ``zero_price`` is a rule of
    ``scores.popularity`` or ``"exclude"`` (no row for a shop without price). One scan of the payments, two
    aggregations (per shop-day, then per shop) and one join with the
    selected shops, which have at most one statistics row each.
    """
    selected, stats = _selected_stats(shops, pays, cities, keyword, broadcast_max_rows)
    joined = stats.join(selected.select("shop_id", "city_name", "score", "per_pay"), on="shop_id", how="inner")
    if zero_price == "exclude":
        # Shops without a price have no score: leave them out of the result.
        joined, zero_price = joined.filter(F.col("per_pay") != 0), "nan"
    return joined.select(
        "shop_id",
        "city_name",
        popularity("score", "per_pay", "pay_total", "active_days", "day_max", zero_price).alias("popularity"),
    )


def popularity_top(shops: DataFrame, pays: DataFrame, cities: Iterable[str] = DEFAULT_CITIES,
                   keyword: str = DEFAULT_KEYWORD, k: int = DEFAULT_K, zero_price: str = "nan",
                   broadcast_max_rows: int | None = BROADCAST_MAX_SHOPS) -> DataFrame:
    """The ``k`` most popular selected shops over all cities together."""
    scores = popularity_scores(shops, pays, cities, keyword, zero_price, broadcast_max_rows)
    return top_k(scores, "popularity", k).select("rank", "shop_id", "city_name", "popularity")


def popularity_top_per_city(shops: DataFrame, pays: DataFrame, cities: Iterable[str] = DEFAULT_CITIES,
                            keyword: str = DEFAULT_KEYWORD, k: int = DEFAULT_K,
                            zero_price: str = "nan",
                            broadcast_max_rows: int | None = BROADCAST_MAX_SHOPS) -> DataFrame:
    """The ``k`` most popular selected shops of each city separately."""
    scores = popularity_scores(shops, pays, cities, keyword, zero_price, broadcast_max_rows)
    return top_k_per_group(scores, "city_name", "popularity", k).select(
        "city_name", "rank", "shop_id", "popularity"
    )


def popularity_integer_scores(shops: DataFrame, pays: DataFrame, cities: Iterable[str] = DEFAULT_CITIES,
                              keyword: str = DEFAULT_KEYWORD, zero_price: str = "null",
                              broadcast_max_rows: int | None = BROADCAST_MAX_SHOPS) -> DataFrame:
    """The integer-arithmetic score (N11) of each selected shop.

    Visits, distinct payment days and the busiest day all come from the
    per-day counts (sum, count and max of them), so no per-shop list of
    payments is ever built.
    """
    selected, stats = _selected_stats(shops, pays, cities, keyword, broadcast_max_rows)
    joined = stats.join(selected.select("shop_id", "per_pay"), on="shop_id", how="inner")
    return joined.select(
        "shop_id",
        popularity_integer("per_pay", "pay_total", "active_days", "day_max", zero_price).alias("popularity_int"),
    )


def popularity_simplified_scores(shops: DataFrame, pays: DataFrame, cities: Iterable[str] = DEFAULT_CITIES,
                                 keyword: str = DEFAULT_KEYWORD,
                                 broadcast_max_rows: int | None = BROADCAST_MAX_SHOPS) -> DataFrame:
    """The price-free popularity of each selected shop with payments."""
    selected, stats = _selected_stats(shops, pays, cities, keyword, broadcast_max_rows)
    joined = stats.join(selected.select("shop_id", "score"), on="shop_id", how="inner")
    return joined.select(
        "shop_id",
        popularity_simplified("score", "pay_total", "active_days", "day_max").alias("popularity_simplified"),
    )


def selected_revenue(shops: DataFrame, pays: DataFrame, cities: Iterable[str] = DEFAULT_CITIES,
                     keyword: str = DEFAULT_KEYWORD,
                     broadcast_max_rows: int | None = BROADCAST_MAX_SHOPS) -> DataFrame:
    """A7 over the selected shops: money per (shop, day)."""
    selected, counts = selected_day_counts(shops, pays, cities, keyword, broadcast_max_rows)
    return revenue_from_counts(counts, selected)


def revenue_report(shops: DataFrame, pays: DataFrame, cities: Iterable[str] = DEFAULT_CITIES,
                   keyword: str = DEFAULT_KEYWORD,
                   broadcast_max_rows: int | None = BROADCAST_MAX_SHOPS) -> DataFrame:
    """Money-based daily statistics of the selected shops.

    -> (shop_id, max_day_revenue, total_revenue, active_days).
    """
    return revenue_stats(selected_revenue(shops, pays, cities, keyword, broadcast_max_rows))
