"""Rules the earlier tests left loose: one parse per line, strict integers, nulls in rendered lines, stand-in users."""

import pytest

from shopscope.functions.clean import blank_to_zero, is_int_text, java_trim
from shopscope.sources import lines as L
from shopscope.sources.standin import to_csv_lines


@pytest.mark.parametrize("parse, call", [
    (L.parse_shop_lines, "split("), (L.parse_pay_lines, "split("), (L.parse_view_lines, "split("),
    (L.parse_shop_json, "from_json("), (L.parse_pay_json, "from_json("), (L.parse_view_json, "from_json(")])
@pytest.mark.parametrize("policy", ["fail", "drop"])
def test_a_line_is_parsed_once(spark, tmp_path, parse, call, policy):
    path = tmp_path / "x.txt"
    path.write_text("a,b,c\n")
    plan = parse(spark.read.text(str(path)), policy)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("jsontostructs(" if call == "from_json(" and "from_json(" not in plan else call) <= 1


@pytest.mark.parametrize("text", ["5\n", "5\r", "\n5", "5\u0085", " 5", "5 "])
def test_integers_are_strict(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(is_int_text("t").alias("ok"), blank_to_zero("t").alias("n")).first()
    assert (row.ok, row.n) == (False, None)


def test_trim_takes_trailing_line_ends(spark):
    df = spark.createDataFrame([("\n a\u0085 \r\n",)], "t string")
    assert df.select(java_trim("t")).first()[0] == "a\u0085"


def test_null_fields_keep_their_place(spark):
    df = spark.createDataFrame([(None, "5", "2016-01-01")], "a string, b string, c string")
    assert to_csv_lines(df, ["a", "b", "c"]).first()[0] == ",5,2016-01-01"


def test_short_lines_are_dropped_and_blanks_read_as_zero(spark):
    rows = spark.createDataFrame([("1,x,2,,4,,1,a,b",), ("1,x,2",), ("2,y,,z,4,5,6,a,b",)], "value string")
    got = L.parse_shop_lines(rows, "drop").select("shop_id", "location_id", "per_pay", "cate_3_name").collect()
    assert [tuple(r) for r in got] == [("1", 2, 0, "")]
