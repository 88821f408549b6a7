"""Registered queries over the stand-in tables of a test-data folder.

Each entry takes (spark, sf_dir) and returns a DataFrame over the whole
tables. Keys follow the operator inventory; the same keys carry an
independent SQL oracle in ``shopscope.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.functions.clean import epoch_to_day, ntz_epoch_seconds
from shopscope.operators import aggregates as A
from shopscope.operators import selection as S
from shopscope.plans import jobs as J
from shopscope.plans.sql import days_sql, popularity_sql
from shopscope.shared import new_path, text_files
from shopscope.sources.lines import (
    parse_pay_json,
    parse_pay_lines,
    parse_shop_json,
    parse_shop_lines,
    parse_view_json,
    parse_view_lines,
)
from shopscope.sources.readers import read_or_quarantine, read_pays, read_shops, read_views
from shopscope.sources.schema import LOG_COLUMNS, SHOP_COLUMNS
from shopscope.sources.standin import (
    STANDIN_CATEGORY,
    STANDIN_CITIES,
    STANDIN_KEYWORD,
    pay_file_lines,
    pay_file_records,
    shop_file_lines,
    shop_file_records,
    standin_pays,
    standin_shops,
    standin_table,
    standin_views,
    to_csv_lines,
    to_json_lines,
    view_file_lines,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The driver-facing score queries give null where a shop has no price
# (per_pay = 0); the library default is NaN, the original value.
DRIVER_ZERO_PRICE = "null"


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _shops(spark, sf_dir):
    return standin_shops(spark, sf_dir)


def _pays(spark, sf_dir):
    return standin_pays(spark, sf_dir)


def _selection_kwargs():
    return {"cities": STANDIN_CITIES, "keyword": STANDIN_KEYWORD}


# --- sources ---------------------------------------------------------------

@query("shop_info_typed")
def shop_info_typed(spark, sf_dir):
    """Shop rows written as comma lines and read back typed."""
    return parse_shop_lines(to_csv_lines(_shops(spark, sf_dir), SHOP_COLUMNS))


@query("shop_info_json")
def shop_info_json(spark, sf_dir):
    """Shop rows written as JSON lines (bare numbers) and read back."""
    return parse_shop_json(to_json_lines(_shops(spark, sf_dir), SHOP_COLUMNS))


@query("user_pay_daily")
def user_pay_daily(spark, sf_dir):
    """S2 + N3: payment lines read back, with the derived day."""
    return parse_pay_lines(to_csv_lines(_pays(spark, sf_dir), LOG_COLUMNS))


@query("user_pay_json")
def user_pay_json(spark, sf_dir):
    """Payment JSON lines read back, with the derived day."""
    return parse_pay_json(to_json_lines(_pays(spark, sf_dir), LOG_COLUMNS))


@query("user_view_log")
def user_view_log(spark, sf_dir):
    """S3: page-view lines read back."""
    return parse_view_lines(to_csv_lines(standin_views(spark, sf_dir), LOG_COLUMNS))


@query("user_view_json")
def user_view_json(spark, sf_dir):
    """Page-view JSON lines read back."""
    return parse_view_json(to_json_lines(standin_views(spark, sf_dir), LOG_COLUMNS))


@query("shop_info_exact_fields")
def shop_info_exact_fields(spark, sf_dir):
    """only shop lines with exactly ten fields (a third category) are kept."""
    lines = to_csv_lines(_shops(spark, sf_dir), SHOP_COLUMNS)
    return parse_shop_lines(lines, bad_rows="drop", required_fields=10)


# --- files: lines written as text files and read from there ------------------
# The files hold the stand-in rows and, derived from them, lines that each rule
# must accept, repair or refuse (``standin.shop_file_lines`` and the like).

@query("shop_file_rows")
def shop_file_rows(spark, sf_dir):
    """The good shop lines of files with nine-field, blank and bad lines, read in at least 4 splits."""
    path = text_files(shop_file_lines(_shops(spark, sf_dir)), "shop-lines")
    return read_shops(spark, path, bad_rows="drop", min_partitions=4)


@query("shop_file_exact_fields")
def shop_file_exact_fields(spark, sf_dir):
    """of the same files, only lines with exactly ten fields."""
    path = text_files(shop_file_lines(_shops(spark, sf_dir)), "shop-lines")
    return read_shops(spark, path, bad_rows="drop", required_fields=10)


@query("shop_file_quarantine")
def shop_file_quarantine(spark, sf_dir):
    """The bad lines of the same files and their reasons, written as a table and read back."""
    path, refused = text_files(shop_file_lines(_shops(spark, sf_dir)), "shop-lines"), new_path(spark, "refused")
    read_or_quarantine(spark, path, "shop", refused)
    return spark.read.parquet(refused).filter(F.contains("file", F.lit("shop-lines"))).select("line", "reason")


@query("pay_file_rows")
def pay_file_rows(spark, sf_dir):
    """Payment files with short lines and time stamps that begin with a tab."""
    path = text_files(pay_file_lines(_pays(spark, sf_dir)), "pay-lines")
    return read_pays(spark, path, bad_rows="drop", min_partitions=8)


@query("view_file_rows")
def view_file_rows(spark, sf_dir):
    """S3: page-view files with blank and short lines."""
    return read_views(spark, text_files(view_file_lines(standin_views(spark, sf_dir)), "view-lines"), bad_rows="drop")


@query("shop_file_json")
def shop_file_json(spark, sf_dir):
    """JSON-lines shop files with quoted numbers, missing keys, bad integers and broken lines."""
    return read_shops(spark, text_files(shop_file_records(_shops(spark, sf_dir)), "shop-records"), fmt="json", bad_rows="drop")


@query("pay_file_json")
def pay_file_json(spark, sf_dir):
    """JSON-lines payment files; bad lines are kept beside the good rows."""
    return read_pays(spark, text_files(pay_file_records(_pays(spark, sf_dir)), "pay-records"), fmt="json", bad_rows="keep")


@query("view_file_json")
def view_file_json(spark, sf_dir):
    """JSON-lines page-view files."""
    return read_views(spark, text_files(to_json_lines(standin_views(spark, sf_dir), LOG_COLUMNS), "view-records"), fmt="json")


# --- functions and filters -------------------------------------------------

@query("epoch_to_day")
def epoch_to_day_q(spark, sf_dir):
    """Epoch seconds of every event to its (UTC) day."""
    ev = standin_table(spark, sf_dir, "events").select("event_id", "ts")
    secs = ntz_epoch_seconds("ts")
    return ev.select("event_id", secs.alias("epoch_s"), epoch_to_day(secs, "UTC").alias("day"))


@query("view_days_sql")
def view_days_sql(spark, sf_dir):
    """Page views per day, by the SQL function toDayStr over a temp view."""
    events = standin_table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return days_sql(spark, events.select(ntz_epoch_seconds("ts").alias("epoch_s")))


@query("keyword_shops")
def keyword_shops(spark, sf_dir):
    return S.keyword_shops(_shops(spark, sf_dir), STANDIN_KEYWORD)


@query("city_shops")
def city_shops(spark, sf_dir):
    return S.city_shops(_shops(spark, sf_dir), STANDIN_CITIES)


@query("selected_shops")
def selected_shops(spark, sf_dir):
    return S.select_shops(_shops(spark, sf_dir), **_selection_kwargs())


# --- joins -----------------------------------------------------------------

@query("selected_pays")
def selected_pays(spark, sf_dir):
    shops = S.select_shops(_shops(spark, sf_dir), **_selection_kwargs())
    return S.pays_of_shops(_pays(spark, sf_dir), shops, broadcast_max_rows=S.BROADCAST_MAX_SHOPS)


@query("exists_gate_pays")
def exists_gate_pays(spark, sf_dir):
    return S.exists_gate(_pays(spark, sf_dir), _shops(spark, sf_dir), STANDIN_CATEGORY, STANDIN_CITIES)


@query("closed_gate_pays")
def closed_gate_pays(spark, sf_dir):
    """J-exists with a gate that no shop opens: no payment passes, whatever its shop."""
    return S.exists_gate(_pays(spark, sf_dir), _shops(spark, sf_dir), STANDIN_CATEGORY, ("NOWHERE",))


@query("shop_with_pay_count")
def shop_with_pay_count(spark, sf_dir):
    return A.shop_with_pay_count(_shops(spark, sf_dir), _pays(spark, sf_dir))


@query("shop_with_pay_day")
def shop_with_pay_day(spark, sf_dir):
    return A.shop_with_pay_day(_shops(spark, sf_dir), _pays(spark, sf_dir))


# --- aggregates ------------------------------------------------------------

@query("shop_pay_count")
def shop_pay_count(spark, sf_dir):
    return A.pay_count(_pays(spark, sf_dir))


@query("shop_day_count")
def shop_day_count(spark, sf_dir):
    return A.day_counts(_pays(spark, sf_dir))


@query("shop_day_max")
def shop_day_max(spark, sf_dir):
    return A.day_max(A.day_counts(_pays(spark, sf_dir)))


@query("shop_pay_total")
def shop_pay_total(spark, sf_dir):
    return A.pay_total(A.day_counts(_pays(spark, sf_dir)))


@query("shop_active_days")
def shop_active_days(spark, sf_dir):
    return A.active_days(A.day_counts(_pays(spark, sf_dir)))


@query("shop_day_stats")
def shop_day_stats(spark, sf_dir):
    return A.day_stats(A.day_counts(_pays(spark, sf_dir)))


@query("shop_pay_days_list")
def shop_pay_days_list(spark, sf_dir):
    """A5, with the (day, n) list rendered as text ``day:n,day:n,...``."""
    lists = A.pay_days_list(_pays(spark, sf_dir))
    rendered = F.array_join(
        F.transform("day_counts", lambda x: F.concat(x["day"], F.lit(":"), x["n"].cast("string"))), ","
    )
    return lists.select("shop_id", rendered.alias("day_list"), "n_pays", "n_days")


@query("shop_visit_stats")
def shop_visit_stats(spark, sf_dir):
    return A.visit_stats(_pays(spark, sf_dir))


@query("shop_day_revenue")
def shop_day_revenue(spark, sf_dir):
    return J.selected_revenue(_shops(spark, sf_dir), _pays(spark, sf_dir), **_selection_kwargs())


@query("shop_revenue_stats")
def shop_revenue_stats(spark, sf_dir):
    return J.revenue_report(_shops(spark, sf_dir), _pays(spark, sf_dir), **_selection_kwargs())


@query("shop_day_count_rows")
def shop_day_count_rows(spark, sf_dir):
    return A.row_count(A.day_counts(_pays(spark, sf_dir)))


# --- whole jobs ------------------------------------------------------------

@query("shop_turnover_top10")
def shop_turnover_top10(spark, sf_dir):
    return J.turnover_top(_shops(spark, sf_dir), _pays(spark, sf_dir))


@query("shop_avg_daily_turnover_top10")
def shop_avg_daily_turnover_top10(spark, sf_dir):
    return J.avg_daily_turnover_top(_shops(spark, sf_dir), _pays(spark, sf_dir))


@query("popularity_score")
def popularity_score(spark, sf_dir):
    return J.popularity_scores(_shops(spark, sf_dir), _pays(spark, sf_dir), zero_price=DRIVER_ZERO_PRICE,
                               **_selection_kwargs())


@query("popularity_top10")
def popularity_top10(spark, sf_dir):
    """J2 as the original prints it: rank and shop id (NaN scores first)."""
    top = J.popularity_top(_shops(spark, sf_dir), _pays(spark, sf_dir), **_selection_kwargs())
    return top.select("rank", "shop_id")


@query("popularity_top10_per_city")
def popularity_top10_per_city(spark, sf_dir):
    top = J.popularity_top_per_city(_shops(spark, sf_dir), _pays(spark, sf_dir), **_selection_kwargs())
    return top.select("city_name", "rank", "shop_id")


@query("popularity_top3_per_city")
def popularity_top3_per_city(spark, sf_dir):
    """T3 with a k below the number of shops of a city."""
    top = J.popularity_top_per_city(_shops(spark, sf_dir), _pays(spark, sf_dir), k=3, **_selection_kwargs())
    return top.select("city_name", "rank", "shop_id")


@query("popularity_score_integer")
def popularity_score_integer(spark, sf_dir):
    return J.popularity_integer_scores(_shops(spark, sf_dir), _pays(spark, sf_dir), **_selection_kwargs())


@query("popularity_score_simplified")
def popularity_score_simplified(spark, sf_dir):
    return J.popularity_simplified_scores(_shops(spark, sf_dir), _pays(spark, sf_dir), **_selection_kwargs())


@query("popularity_sql")
def popularity_sql_q(spark, sf_dir):
    return popularity_sql(spark, _shops(spark, sf_dir), _pays(spark, sf_dir), STANDIN_CATEGORY, STANDIN_CITIES)
