import math

import pytest
from pyspark.sql import functions as F

from shopscope.functions import (
    blank_to_empty,
    blank_to_zero,
    category_contains,
    category_equals,
    city_in,
    epoch_to_day,
    java_trim,
    pay_day,
    popularity,
    popularity_integer,
    popularity_simplified,
    register_sql_functions,
    text_to_day,
    turnover,
)


def _one(spark, expr, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).collect()[0].r


def test_blank_rules(spark):
    df = spark.createDataFrame([(None,), ("",), ("12",), ("-3",), ("+4",), ("4x",), (" 5",), ("１２",), ("-٣",),
                                ("2147483648",), ("+",), ("1.0",)], "x string")
    got = [(r.e, r.z) for r in df.select(blank_to_empty("x").alias("e"), blank_to_zero("x").alias("z")).collect()]
    assert got == [("", 0), ("", 0), ("12", 12), ("-3", -3), ("+4", 4), ("4x", None), (" 5", None),
                   ("１２", 12), ("-٣", -3), ("2147483648", None), ("+", None), ("1.0", None)]


def test_java_trim_and_day(spark):
    df = spark.createDataFrame(
        [("\t 2016-01-03 12:00:00 \n",), ("2016-01-03",), (" 2016-1-3 ",), ("2016-01-03 12:00:00",)], "t string")
    rows = df.select(java_trim("t").alias("tr"), pay_day("t").alias("d"), text_to_day("t").alias("d2")).collect()
    assert rows[0].tr == "2016-01-03 12:00:00" and rows[0].d == "2016-01-03"
    assert rows[1].d == "2016-01-03"
    assert rows[2].d == " 2016-1-3 "      # trimmed length <= 10: the untrimmed text
    assert rows[3].d2 == "2016-01-03"
    assert rows[0].d2 == "\t 2016-01-"     # no trimming in the text rule


def test_epoch_to_day(spark):
    s = 1451606400 + 23 * 3600           # 2016-01-01 23:00:00 UTC
    assert _one(spark, epoch_to_day(F.lit(s))) == "2016-01-01"            # session zone is UTC
    assert _one(spark, epoch_to_day(F.lit(s), "UTC")) == "2016-01-01"
    assert _one(spark, epoch_to_day(F.lit(s), "Asia/Shanghai")) == "2016-01-02"
    assert _one(spark, epoch_to_day(F.lit(-1), "UTC")) == "1969-12-31"


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT toDayStr(86400 * 3 + 5) AS a, toDayText('2016-01-03 12:00:00') AS b, "
                  "toDayText('2016-01-03') AS c").collect()[0]
    assert (r.a, r.b, r.c) == ("1970-01-04", "2016-01-03", "2016-01-03")


def test_predicates(spark):
    df = spark.createDataFrame(
        [("北京", "美食", "火锅", ""), ("杭州", "火锅", "", ""), ("上海", "美食", "其他", "小火锅"), ("广州", "火", "锅", "")],
        "city_name string, cate_1_name string, cate_2_name string, cate_3_name string")
    got = [tuple(r) for r in df.select(category_contains().alias("k"), city_in().alias("c"),
                                      category_equals().alias("e")).collect()]
    assert got == [(True, True, False), (True, False, True), (True, True, False), (False, True, False)]


def test_turnover_is_bigint(spark):
    df = spark.createDataFrame([(3, 2_000_000_000)], "n long, p int")
    assert df.select(turnover("n", "p").alias("t")).collect()[0].t == 6_000_000_000


def test_popularity_values(spark):
    df = spark.createDataFrame(
        [(4, 80, 3, 2, 2), (5, 50, 2, 2, 1), (3, 100, 4, 2, 3), (3, 0, 1, 1, 1)],
        "score int, per_pay int, total long, days long, day_max long")
    rows = df.select(popularity("score", "per_pay", "total", "days", "day_max").alias("p"),
                     popularity("score", "per_pay", "total", "days", "day_max", "null").alias("n"),
                     popularity_simplified("score", "total", "days", "day_max").alias("s")).collect()
    assert rows[0].p == 0.7849999999999999
    assert rows[1].p == 1.0
    assert rows[2].p == 0.6199999999999999
    assert math.isnan(rows[3].p) and rows[3].n is None
    for r in rows[:3]:
        assert abs(r.p - r.s) < 1e-12
    with pytest.raises(Exception, match="per_pay is 0"):
        df.select(popularity("score", "per_pay", "total", "days", "day_max", "fail")).collect()
    simp = df.select(popularity("score", "per_pay", "total", "days", "day_max", "simplified").alias("x")).collect()
    assert simp[3].x == pytest.approx(0.7 * 3 / 5 + 0.3)


def test_popularity_integer(spark):
    df = spark.createDataFrame(
        [(80, 3, 2, 2), (50, 2, 2, 1), (100, 4, 2, 3), (0, 1, 1, 1)],
        "per_pay int, visits long, days long, day_max long")
    rows = df.select(popularity_integer("per_pay", "visits", "days", "day_max").alias("p")).collect()
    assert [r.p for r in rows] == [pytest.approx(11.2), pytest.approx(7.3), pytest.approx(14.0), None]
    with pytest.raises(Exception):
        df.select(popularity_integer("per_pay", "visits", "days", "day_max", "fail")).collect()
