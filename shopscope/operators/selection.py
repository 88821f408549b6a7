"""Shop selection and the payment filters that follow it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.functions.predicates import (
    DEFAULT_CITIES,
    DEFAULT_KEYWORD,
    category_contains,
    category_equals,
    city_in,
)


def keyword_shops(shops: DataFrame, keyword: str = DEFAULT_KEYWORD) -> DataFrame:
    """Shops with ``keyword`` in any of their three categories."""
    return shops.filter(category_contains(keyword))


def city_shops(shops: DataFrame, cities: Iterable[str] = DEFAULT_CITIES) -> DataFrame:
    """Shops in one of ``cities``."""
    return shops.filter(city_in(cities))


def select_shops(shops: DataFrame, cities: Iterable[str] = DEFAULT_CITIES,
                 keyword: str = DEFAULT_KEYWORD) -> DataFrame:
    """keyword shops of the given cities."""
    return shops.filter(category_contains(keyword) & city_in(cities))


# Bounds for broadcasting a shop side: rows, and bytes of the broadcast
# columns (string bytes plus 8 per other value and 16 per row). Both are
# checked on the actual rows before any broadcast, whatever the size of
# the shop table.
BROADCAST_MAX_SHOPS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def fits_broadcast(shops: DataFrame, max_rows: int | None = BROADCAST_MAX_SHOPS,
                   columns=("shop_id",), max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Size check for a broadcast: at most ``max_rows`` rows and
    ``max_bytes`` bytes in ``columns``?

    Runs one job over the (filtered) shop side: a count and a byte sum,
    aggregated map-side so each partition ships one partial row, and one
    row returns to the driver. (A row limit would not help: it gathers the
    raw rows of every partition into a single task.) When the shop side is
    itself a join, that job computes it once more than the main job does;
    for a shop table read from files it is a filtered scan.
    ``max_rows=None`` skips the check (AQE's choice from the measured size
    of the side's shuffle output).
    """
    if max_rows is None:
        return False
    n, size = broadcast_measures(shops, columns)
    stats = shops.select(*columns).agg(n.alias("n"), size.alias("bytes")).first()
    return stats["n"] <= max_rows and stats["bytes"] <= max_bytes


def broadcast_measures(shops: DataFrame, columns) -> tuple[Column, Column]:
    """Aggregates that give the rows and bytes a broadcast of ``columns`` would hold."""
    types = dict(shops.dtypes)
    width = F.lit(16)
    for c in columns:
        width = width + (F.coalesce(F.octet_length(c), F.lit(0)) if types[c] == "string" else F.lit(8))
    return F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))


def likely_few(ids: DataFrame) -> DataFrame:
    """Distinct ids behind a comparison every id passes: Spark builds a runtime
    Bloom filter only of a side that has a filter of its own."""
    return ids.select("shop_id").distinct().filter(F.col("shop_id") >= F.lit(""))


def pays_of_shops(pays: DataFrame, shops: DataFrame, broadcast_max_rows: int | None = None) -> DataFrame:
    """J-semi: payments whose shop is among ``shops``.

    A left semi join (``in_shops``): no id list goes through the driver. With
    ``broadcast_max_rows`` the shop side is counted first and broadcast
    only when it is within that bound (payments are then filtered where
    they are read, without a shuffle); otherwise, or without the bound, the
    planner sort-merges, and AQE turns that into a broadcast only when the
    shuffled shop side measures under its bound at run time,
    with AQE splitting a hot shop's partition. A scan above Spark's runtime
    filter size is then thinned by a Bloom filter of the ids first. Duplicate
    shop rows do not duplicate payments.
    """
    ids = shops.select("shop_id")
    if broadcast_max_rows is not None and fits_broadcast(ids, broadcast_max_rows):
        ids = F.broadcast(ids)
    else:
        ids = likely_few(ids)
    return in_shops(pays, ids)


def in_shops(pays: DataFrame, ids: DataFrame) -> DataFrame:
    """Payments whose shop_id is among ``ids`` (one column), shop_id first.

    Written as a membership filter, which Catalyst plans as the left semi
    join: unlike a join, it first moves a filter below the projection that
    derives payment columns (and below a join under it), so the columns are
    derived for the chosen payments alone.
    """
    rows = pays.filter(F.col("shop_id").isin(ids))
    return rows.select("shop_id", *(rows[f"`{c}`"] for c in rows.columns if c.lower() != "shop_id"))


def exists_gate(pays: DataFrame, shops: DataFrame, category: str = DEFAULT_KEYWORD,
                cities: Iterable[str] = DEFAULT_CITIES) -> DataFrame:
    """J-exists: all payments if any shop of ``cities`` has first category
    ``category``, otherwise none.

    The condition is uncorrelated (it does not look at the payment's shop),
    exactly as in the SQL form it comes from. It is planned as a one-row
    subquery evaluated once, not as a join.
    """
    gate = shops.filter(category_equals(category) & city_in(cities)).select("shop_id").exists()
    return pays.filter(gate)
