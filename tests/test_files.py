"""File reading in depth: JSON source, splits at the scan, quarantine, null lines; and the shared folder."""

import json

import pytest

from shopscope.plans import jobs as J
from shopscope.shared import materialised, shared_folder
from shopscope.sinks import write_result
from shopscope.sources import lines as L
from shopscope.sources import quarantined, read_or_quarantine, read_pays, read_shops, read_views
from shopscope.sources.readers import split_scan
from shopscope.sources.standin import STANDIN_CITIES, STANDIN_KEYWORD, standin_tables
from tests.conftest import SF_SMALL, write_lines
from tests.test_plans import plan_text

JSON_SHOPS = [
    '{"shop_id": "1", "city_name": "a", "per_pay": "12", "score": 3}', "", '{"shop_id": 2, "per_pay": null}', '{"shop_id": "3", "score": "4x"}',
    '{"shop_id": "4"', "not json", '{"shop_id": "5", "comment_cnt": 99999999999, "score": " 1"}', "{}", "null", "7", "   "]


@pytest.mark.parametrize("policy", ["drop", "keep"])
def test_json_source_gives_the_line_parsers_rows(spark, tmp_path, policy):
    path = write_lines(tmp_path / "s.json", JSON_SHOPS)
    want = L.parse_shop_json(spark.read.text(path), policy)
    got = read_shops(spark, path, fmt="json", bad_rows=policy)
    assert "from_json" not in plan_text(got) and "Scan json" in plan_text(got)
    assert got.columns == want.columns and got.count() == want.count()
    parts = [c for c in want.columns if c != "_bad"]
    assert sorted(got.select(*parts).collect()) == sorted(want.select(*parts).collect())
    if policy == "keep":
        mine, theirs = (sorted(r["_bad"] for r in t.select("_bad").collect() if r["_bad"] is not None) for t in (got, want))
        assert len(mine) == len(theirs) == 8
        # a well-formed record with a bad integer is kept as the record that was read
        assert {x for x in theirs if x not in mine} == {JSON_SHOPS[3], JSON_SHOPS[6]}
        assert [json.loads(x) for x in mine if x not in theirs] == [
            {"shop_id": "3", "score": "4x"}, {"shop_id": "5", "score": " 1", "comment_cnt": "99999999999"}]


@pytest.mark.parametrize("line", ["", "not json", '{"shop_id": "3", "score": "4x"}'])
def test_json_fail_policy(spark, tmp_path, line):
    path = write_lines(tmp_path / "s.json", [JSON_SHOPS[0], line])
    for columns in (["shop_id"], ["score"], []):  # whatever the caller reads of it
        with pytest.raises(Exception, match="malformed shop line"):
            read_shops(spark, path, fmt="json").select(*columns).collect()
    assert read_shops(spark, path, fmt="json", bad_rows="drop").count() == 1


def test_null_lines_are_bad(spark):
    nulls = spark.createDataFrame([(None,), ("u,1,2016-01-01",)], "value string")
    for parse in (L.parse_pay_lines, L.parse_view_lines):
        assert sorted((r.user_id, r._bad is None) for r in parse(nulls, "keep").collect()) == [("", False), ("u", True)]
        assert parse(nulls, "drop").count() == 1
        with pytest.raises(Exception, match="malformed"):
            parse(nulls).collect()
    assert [r._bad for r in L.parse_shop_lines(spark.createDataFrame([(None,)], "value string"), "keep").collect()] == [""]
    assert [r._bad for r in L.parse_pay_json(spark.createDataFrame([(None,)], "value string"), "keep").collect()] == [""]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_splits_are_made_at_the_scan(spark, tmp_path, fmt):
    rows = [("u%d" % i, str(i % 7), "2016-01-01 10:00:00") for i in range(5000)]
    path = write_lines(tmp_path / "p.txt", [",".join(r) if fmt == "csv" else json.dumps(dict(zip(L.LOG_COLUMNS, r))) for r in rows])
    plain, split = read_pays(spark, path, fmt, "drop"), read_pays(spark, path, fmt, "drop", min_partitions=12)
    assert plain.rdd.getNumPartitions() < 12 <= split.rdd.getNumPartitions()
    assert "Exchange" not in plan_text(split)
    assert sorted(split.collect()) == sorted(plain.collect())
    # the rows belong to the caller's session: its views see them
    split.createOrReplaceTempView("split_pays")
    assert spark.sql("SELECT count(*) AS n FROM split_pays").first().n == 5000
    assert spark.conf.get("spark.sql.files.openCostInBytes") != "1"


def test_split_scan_keeps_the_callers_settings(spark, tmp_path):
    path = write_lines(tmp_path / "t.txt", ["1970-01-02 00:00:00"] * 10)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    hours = split_scan(other, lambda s: s.read.text(path), 3).selectExpr("unix_timestamp(value) AS s").distinct().collect()
    assert [r.s for r in hours] == [86400 - 9 * 3600]


def test_quarantine_holds_what_the_reader_drops(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = write_lines(tmp_path / "in" / "good.txt", ["1,a,1,1,1,1,1,x,y,z", "2,a,1,1,1,1,1,x,y"])
    bad = ["", "3,a,1,1,1,1,1,x", "4,a,1x,1, 2,1,1,x,y", ",,,"]
    write_lines(tmp_path / "in" / "bad.txt", bad)
    out = str(tmp_path / "refused")
    rows = read_or_quarantine(spark, str(tmp_path / "in"), "shop", out)
    assert sorted(r.shop_id for r in rows.collect()) == ["1", "2"]
    refused = spark.read.parquet(out).collect()
    assert {r.file.rsplit("/", 1)[1] for r in refused} == {"bad.txt"}
    assert {r.line: r.reason for r in refused} == {
        "": "blank line", bad[1]: "8 fields", bad[2]: "not an integer: location_id, score", ",,,": "1 fields"}
    assert quarantined(spark, good, "shop").count() == 0
    assert {r.line for r in quarantined(spark, good, "shop", required_fields=10).collect()} == {"2,a,1,1,1,1,1,x,y"}


def test_json_quarantine(spark, tmp_path):
    path = write_lines(tmp_path / "s.json", JSON_SHOPS)
    found = {r.line: r.reason for r in quarantined(spark, path, "shop", "json").collect()}
    assert len(found) == 8 and found["   "] == "blank line" and found["7"] == "not JSON" and found[JSON_SHOPS[3]] == "not an integer: score"
    assert read_views(spark, path, "json", "drop").count() + quarantined(spark, path, "view", "json").count() == len(JSON_SHOPS)


# --- the selection, evaluated once -------------------------------------------

@pytest.mark.parametrize("job", [J.popularity_scores, J.popularity_integer_scores, J.popularity_simplified_scores, J.revenue_report])
@pytest.mark.parametrize("bound", [J.BROADCAST_MAX_SHOPS, 0])
def test_the_selection_is_read_from_its_table(spark, job, bound):
    shops, pays, _ = standin_tables(spark, SF_SMALL)
    plan = plan_text(job(shops, pays, STANDIN_CITIES, STANDIN_KEYWORD, broadcast_max_rows=bound))
    assert "selected-shops" in plan
    for shop_table in ("s_suppkey", "r_name", "p_type", "n_nationkey"):  # no shop-side join is planned again
        assert shop_table not in plan


def test_size_comes_from_the_write(spark):
    from shopscope.operators.selection import broadcast_measures

    shops, _, _ = standin_tables(spark, SF_SMALL)
    n, size = broadcast_measures(shops, ("shop_id", "score"))
    table, seen = materialised(shops, "shops", n=n, bytes=size)
    assert seen["n"] == table.count() == shops.count() and seen["bytes"] > 16 * seen["n"]
    empty, seen = materialised(shops.limit(0), "shops", n=n, bytes=size)
    assert seen == {"n": 0, "bytes": 0} and empty.count() == 0


def test_large_selections_thin_the_scan_by_a_bloom_filter(spark):
    from shopscope.operators.selection import pays_of_shops, select_shops

    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    shops, pays, _ = standin_tables(spark, SF_SMALL)
    want = sorted(J.popularity_simplified_scores(shops, pays, STANDIN_CITIES, STANDIN_KEYWORD).collect())
    spark.conf.set(key, "0")
    try:
        big = J.popularity_simplified_scores(shops, pays, STANDIN_CITIES, STANDIN_KEYWORD, broadcast_max_rows=0)
        assert "might_contain" in plan_text(big)
        plan = plan_text(big)  # the filter stands below the first count, on the payment scan
        assert plan.index("might_contain") > plan.index("partial_count(1)") and sorted(big.collect()) == want
        semi = pays_of_shops(pays, select_shops(shops, STANDIN_CITIES, STANDIN_KEYWORD))
        assert "might_contain" in plan_text(semi)
        assert semi.count() == pays_of_shops(pays, select_shops(shops, STANDIN_CITIES, STANDIN_KEYWORD), 10).count()
    finally:
        spark.conf.unset(key)


# --- sink and folder ----------------------------------------------------------

def test_a_hot_value_of_one_task_is_split(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id", "IF(id < 15000, 'hot', CAST(id % 5 AS STRING)) AS city").coalesce(1)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        write_result(rows, str(tmp_path / "salted"), partition_by="city")
        write_result(rows, str(tmp_path / "plain"), partition_by="city", salt=1)
    finally:
        spark.conf.set(key, old)
    files = {n: len(list((tmp_path / n / "city=hot").glob("*.parquet"))) for n in ("salted", "plain")}
    assert 1 < files["salted"] <= 8 and files["plain"] <= files["salted"]
    assert sorted(spark.read.parquet(str(tmp_path / "salted")).select("id").collect()) == sorted(rows.select("id").collect())


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    out = str(tmp_path / "days")
    write_result(spark.createDataFrame([("a", 1), ("b", 2)], "day string, n int"), out, partition_by="day")
    for _ in range(2):  # a run may be repeated
        write_result(spark.createDataFrame([("b", 3)], "day string, n int"), out, mode="overwrite", partition_by="day", overwrite_partitions=True)
        assert sorted((r.day, r.n) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 3)]
    with pytest.raises(ValueError):
        write_result(spark.range(1), out, overwrite_partitions=True)


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
    assert shared_folder(spark)
