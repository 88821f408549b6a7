import pytest

from shopscope.plans import jobs as J
from shopscope.sinks import write_result


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_write_result_round_trip(spark, tables, tmp_path, fmt):
    shops, pays, _ = tables
    top = J.turnover_top(shops, pays)
    out = str(tmp_path / f"top.{fmt}")
    write_result(top, out, fmt=fmt, header="true") if fmt == "csv" else write_result(top, out, fmt=fmt)
    reader = spark.read.option("header", "true").option("inferSchema", "true") if fmt == "csv" else spark.read
    back = reader.format(fmt).load(out)
    assert sorted((int(r["rank"]), str(r["shop_id"])) for r in back.collect()) == \
        [(r["rank"], r["shop_id"]) for r in top.collect()]
    with pytest.raises(Exception):
        write_result(top, out, fmt=fmt)          # default mode refuses to overwrite
    write_result(top, out, fmt=fmt, mode="overwrite")


def test_partitioned_write_and_noop(spark, tables, tmp_path):
    shops, pays, _ = tables
    scores = J.popularity_scores(shops, pays)
    out = str(tmp_path / "by_city")
    write_result(scores, out, partition_by="city_name")
    assert spark.read.parquet(out).count() == scores.count()
    write_result(scores, None, fmt="noop", mode="overwrite")
    with pytest.raises(ValueError):
        write_result(scores, out, fmt="xls")


def test_partitioned_write_rebalances_by_value(spark, tables, tmp_path):
    import glob
    import os

    shops, pays, _ = tables
    from shopscope.operators import shop_with_pay_day

    joined = shop_with_pay_day(shops, pays).repartition(8)          # rows of every day in every task
    plain, rebalanced = str(tmp_path / "plain"), str(tmp_path / "rebalanced")
    write_result(joined, plain, partition_by="day", rebalance=False)
    write_result(joined, rebalanced, partition_by="day")

    def files_per_day(root):
        return [len(glob.glob(os.path.join(d, "*.parquet"))) for d in glob.glob(os.path.join(root, "day=*"))]

    assert max(files_per_day(rebalanced)) == 1 < max(files_per_day(plain))
    assert sorted(spark.read.parquet(rebalanced).collect()) == sorted(spark.read.parquet(plain).collect())


def test_partitioned_write_splits_a_large_value(spark, tmp_path):
    import glob
    import os

    from shopscope.operators import shop_with_pay_day
    from shopscope.sources.standin import standin_tables
    from tests.conftest import SF_SMALL

    shops, pays, _ = standin_tables(spark, SF_SMALL)
    joined = shop_with_pay_day(shops, pays)                  # ~6,000 rows over five cities
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "2k")
    try:
        out = str(tmp_path / "by_city")
        write_result(joined, out, partition_by="city_name")
    finally:
        spark.conf.set(key, old)
    per_city = [len(glob.glob(os.path.join(d, "*.parquet"))) for d in glob.glob(os.path.join(out, "city_name=*"))]
    assert len(per_city) == 5 and min(per_city) > 1          # each city's rows written by several tasks
    assert spark.read.parquet(out).count() == joined.count()
