"""The popularity job in SQL text (J4), and temp views for ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.fixed import ACTIVITY_WEIGHT, SCORE_SCALE, SCORE_WEIGHT
from shopscope.functions.clean import register_sql_functions
from shopscope.functions.predicates import DEFAULT_CITIES, DEFAULT_KEYWORD

VIEW_NAMES = {"shops": "shopInfo", "pays": "pays", "views": "views"}


def register_views(shops: DataFrame, pays: DataFrame, views: DataFrame | None = None) -> None:
    """Name the inputs ``shopInfo``, ``pays`` and ``views`` for SQL."""
    shops.createOrReplaceTempView(VIEW_NAMES["shops"])
    pays.createOrReplaceTempView(VIEW_NAMES["pays"])
    if views is not None:
        views.createOrReplaceTempView(VIEW_NAMES["views"])


# The gate does not look at the payment's shop: all payments count when any
# shop of the cities has the category, none otherwise (a one-row subquery). A
# shop without a price has no popularity (division by zero gives NULL).
POPULARITY_SQL = """
WITH visits AS (
  SELECT shop_id, toDayText(time_stamp) AS visit_day, count(shop_id) AS n
  FROM pays
  WHERE (SELECT count(*) > 0 FROM shopInfo WHERE city_name IN ({city_params}) AND cate_1_name = :category)
  GROUP BY ALL
), activity AS (
  SELECT shop_id, sum(n) AS total, max(n) AS busiest, count(visit_day) AS active_days
  FROM visits
  GROUP BY shop_id
)
SELECT shop_id,
       :score_weight * (score / :score_scale)
         + :activity_weight * try_divide(per_pay * total / active_days, per_pay * busiest) AS popularity
FROM shopInfo JOIN activity USING (shop_id)
"""


def popularity_sql(spark: SparkSession, shops: DataFrame, pays: DataFrame,
                   category: str = DEFAULT_KEYWORD, cities: Iterable[str] = DEFAULT_CITIES) -> DataFrame:
    """The SQL-form popularity of every shop -> (shop_id, popularity), over
    the temp views ``pays`` and ``shopInfo``, which it registers."""
    register_sql_functions(spark)
    register_views(shops, pays)
    cities = list(cities)
    params = {"category": category, "score_weight": SCORE_WEIGHT, "activity_weight": ACTIVITY_WEIGHT,
              "score_scale": SCORE_SCALE}
    params.update({f"city{i}": c for i, c in enumerate(cities)})
    city_params = ", ".join(f":city{i}" for i in range(len(cities)))
    text = POPULARITY_SQL.replace("{city_params}", city_params)
    return spark.sql(text, args=params)


DAYS_SQL = "SELECT toDayStr(epoch_s) AS day, count(*) AS n FROM moments GROUP BY ALL"


def days_sql(spark: SparkSession, moments: DataFrame) -> DataFrame:
    """U1 in SQL: rows per day of a table with epoch seconds -> (day, n), days of UTC.

    ``toDayStr`` formats in the session's zone, so the seconds are moved by that
    zone's distance from UTC first and the days do not depend on the session.
    """
    register_sql_functions(spark)
    wall = F.timestamp_seconds("epoch_s")
    here = F.unix_timestamp(F.to_utc_timestamp(wall, spark.conf.get("spark.sql.session.timeZone")))
    moments.select(here.alias("epoch_s")).createOrReplaceTempView("moments")
    return spark.sql(DAYS_SQL)
