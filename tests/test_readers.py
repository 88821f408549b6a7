import pytest

from shopscope.sources import read_pays, read_shops, read_tables, read_views
from shopscope.sources.lines import parse_pay_lines, parse_shop_lines
from shopscope.sources.readers import ensure_min_partitions
from shopscope.sources.schema import PAY_SCHEMA, SHOP_SCHEMA, VIEW_SCHEMA
from tests.conftest import write_lines


def _by_id(df):
    return {r["shop_id"]: r.asDict() for r in df.collect()}


def test_shop_csv_types_and_blanks(tables):
    shops, _, _ = tables
    assert [f.name for f in shops.schema] == [f.name for f in SHOP_SCHEMA]
    assert [f.dataType for f in shops.schema] == [f.dataType for f in SHOP_SCHEMA]
    rows = _by_id(shops)
    assert len(rows) == 7
    assert rows["2"]["comment_cnt"] == 0          # blank integer -> 0
    assert rows["2"]["cate_3_name"] == ""         # trailing empty field dropped -> ""
    assert rows["3"]["per_pay"] == 0
    assert rows["5"]["score"] == 0
    assert rows["7"]["cate_2_name"] == ""         # inner blank string -> ""
    assert rows["1"]["cate_3_name"] == "重庆火锅"
    assert rows["6"]["per_pay"] == 120


def test_pay_csv_day_rule(tables):
    _, pays, _ = tables
    assert [f.name for f in pays.schema] == [f.name for f in PAY_SCHEMA]
    days = {(r.user_id, r.shop_id): (r.time_stamp, r.day) for r in pays.collect()}
    assert days[("u2", "2")] == (" 2016-01-03 12:00:00", "2016-01-03")   # trimmed, then cut
    assert days[("u1", "1")] == ("2016-01-01 10:00:00", "2016-01-01")
    assert pays.count() == 17


def test_view_csv_keeps_full_time(tables):
    _, _, views = tables
    assert [f.name for f in views.schema] == [f.name for f in VIEW_SCHEMA]
    assert {r.time_stamp for r in views.collect()} >= {"2016-01-02 10:30:00"}


def test_json_readers_match_csv(spark, fixture_dir, tables):
    shops_csv, pays_csv, views_csv = tables
    shops, pays, views = read_tables(spark, str(fixture_dir / "shop_info.json"),
                                     str(fixture_dir / "user_pay.json"),
                                     str(fixture_dir / "user_view.json"), fmt="json")
    assert sorted(shops.collect()) == sorted(shops_csv.collect())
    assert sorted(pays.collect()) == sorted(pays_csv.collect())
    assert sorted(views.collect()) == sorted(views_csv.collect())


def test_json_missing_key_and_null_are_blank(spark, tmp_path):
    p = write_lines(tmp_path / "s.json", [
        '{"shop_id": "9", "city_name": null, "per_pay": 12, "cate_1_name": "火锅", "cate_2_name": ""}',
    ])
    row = read_shops(spark, p, fmt="json").collect()[0]
    assert row.city_name == "" and row.score == 0 and row.per_pay == 12 and row.cate_3_name == ""


MALFORMED_SHOP = [
    "8,北京,1,30,4,3,1,火锅",            # 8 fields: bad
    "9,北京,1,30,4,3,1,火锅,锅底",       # 9 fields, no trailing comma: accepted
    "10,北京,1,30,4,3,1,火锅,锅,底,extra",  # 11 fields: accepted, last ignored
    "11,北京,1,30,4x,3,1,火锅,锅,底",     # bad integer
    "",                                  # empty line
    "12,北京,1, 30,4,3,1,火锅,锅,底",     # integer with a blank: bad (no trimming)
    "13,北京,1,99999999999,4,3,1,火锅,锅,底",  # out of int range: bad
]


def test_shop_bad_rows_drop_and_keep(spark, tmp_path):
    p = write_lines(tmp_path / "bad_shops.txt", MALFORMED_SHOP)
    dropped = read_shops(spark, p, bad_rows="drop")
    assert sorted(r.shop_id for r in dropped.collect()) == ["10", "9"]
    rows = _by_id(dropped)
    assert rows["9"]["cate_3_name"] == ""
    assert rows["10"]["cate_3_name"] == "底"
    kept = read_shops(spark, p, bad_rows="keep").collect()
    assert len(kept) == len(MALFORMED_SHOP)
    bad = [r for r in kept if r["_bad"] is not None]
    assert len(bad) == 5
    assert {r["_bad"] for r in bad} == {MALFORMED_SHOP[i] for i in (0, 3, 4, 5, 6)}


def test_shop_bad_rows_fail(spark, tmp_path):
    p = write_lines(tmp_path / "bad_shops.txt", MALFORMED_SHOP)
    with pytest.raises(Exception, match="malformed shop line"):
        read_shops(spark, p).collect()


def test_required_fields_exact(spark, tmp_path):
    p = write_lines(tmp_path / "s.txt", MALFORMED_SHOP[:3])
    only10 = read_shops(spark, p, bad_rows="drop", required_fields=10)
    assert [r.shop_id for r in only10.collect()] == []
    p2 = write_lines(tmp_path / "s2.txt", ["1,a,1,1,1,1,1,x,y,z", "2,a,1,1,1,1,1,x,y"])
    assert [r.shop_id for r in read_shops(spark, p2, bad_rows="drop", required_fields=10).collect()] == ["1"]


@pytest.mark.parametrize("line", [",,", "u1,5", ""])
def test_pay_bad_lines(spark, tmp_path, line):
    p = write_lines(tmp_path / "p.txt", ["u1,1,2016-01-01 10:00:00", line])
    assert read_pays(spark, p, bad_rows="drop").count() == 1
    with pytest.raises(Exception, match="malformed pay line"):
        read_pays(spark, p).collect()


def test_pay_extra_fields_ignored(spark, tmp_path):
    p = write_lines(tmp_path / "p.txt", ["u1,1,2016-01-01 10:00:00,extra,more"])
    r = read_pays(spark, p).collect()[0]
    assert (r.user_id, r.shop_id, r.time_stamp, r.day) == ("u1", "1", "2016-01-01 10:00:00", "2016-01-01")


def test_view_bad_rows_keep(spark, tmp_path):
    p = write_lines(tmp_path / "v.txt", ["u1,1,t", "u2"])
    rows = read_views(spark, p, bad_rows="keep").collect()
    assert sorted((r.user_id, r._bad) for r in rows) == [("u1", None), ("u2", "u2")]


def test_min_partitions(spark, fixture_dir):
    text = spark.read.text(str(fixture_dir / "user_pay.txt"))
    assert ensure_min_partitions(text, 10).rdd.getNumPartitions() >= 10
    assert read_pays(spark, str(fixture_dir / "user_pay.txt"), min_partitions=6).rdd.getNumPartitions() >= 6


def test_spread_deals_one_file_over_tasks(spark, tmp_path):
    import gzip

    from pyspark.sql import functions as F

    # One gzip file (one split, whatever its size) of many identical lines.
    path = tmp_path / "pays.txt.gz"
    with gzip.open(path, "wt") as fh:
        fh.write("u1,1,2016-01-01 10:00:00\n" * 4000)
    plain = read_pays(spark, str(path))
    spread = read_pays(spark, str(path), spread=True, min_partitions=8)
    assert plain.rdd.getNumPartitions() == 1
    per_task = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) == 8 and max(r["count"] for r in per_task) == 500
    assert sorted(spread.collect()) == sorted(plain.collect())


def test_unknown_policy_rejected(spark, fixture_dir):
    with pytest.raises(ValueError):
        parse_shop_lines(spark.read.text(str(fixture_dir / "shop_info.txt")), bad_rows="ignore")
    with pytest.raises(ValueError):
        read_pays(spark, str(fixture_dir / "user_pay.txt"), fmt="xml")


def test_parsers_accept_any_line_column(spark):
    lines = spark.createDataFrame([("u1,1,2016-01-01 10:00:00",)], "line string")
    assert parse_pay_lines(lines, value_col="line").collect()[0].day == "2016-01-01"


def test_json_malformed_lines(spark, tmp_path):
    good = '{"user_id": "u1", "shop_id": "1", "time_stamp": "2016-01-01 10:00:00"}'
    lines = [good, '{"user_id": "u2", "shop_id": ', "not json", "", '{"shop_id": "1", "per_pay": "4x"}']
    p = write_lines(tmp_path / "p.json", lines[:4])
    assert [r.user_id for r in read_pays(spark, p, fmt="json", bad_rows="drop").collect()] == ["u1"]
    kept = read_pays(spark, p, fmt="json", bad_rows="keep").collect()
    assert sorted(r._bad for r in kept if r._bad is not None) == sorted(lines[1:4])
    with pytest.raises(Exception, match="malformed pay line"):
        read_pays(spark, p, fmt="json").collect()
    s = write_lines(tmp_path / "s.json", [lines[4]])
    assert read_shops(spark, s, fmt="json", bad_rows="drop").count() == 0
