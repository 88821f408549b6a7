import pytest

from shopscope.plans.cli import JOBS, main, parse_args


def _paths(fixture_dir, ext="txt"):
    return [str(fixture_dir / f"{n}.{ext}") for n in ("shop_info", "user_pay", "user_view")]


def test_cli_turnover_writes_result(spark, fixture_dir, tmp_path):
    out = str(tmp_path / "top")
    main(["turnover", *_paths(fixture_dir), "--out", out, "--k", "3"], spark=spark)
    got = sorted((r["rank"], r["shop_id"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, "7"), (2, "4"), (3, "1")]


def test_cli_every_job_runs_on_json(spark, fixture_dir, tmp_path):
    for job in JOBS:
        out = str(tmp_path / job)
        main([job, *_paths(fixture_dir, "json"), "--format", "json", "--zero-price", "null", "--out", out], spark=spark)
        assert spark.read.parquet(out).count() >= 1, job


@pytest.mark.parametrize("argv", [["popularity-scores"], ["turnover", "one", "two"], ["popularity-integer", "--zero-price", "nan", "--out", "x"]])
def test_cli_refuses_what_it_would_cut_or_change(argv):
    with pytest.raises(SystemExit):
        parse_args(argv)


def test_cli_kept_bad_rows_change_no_ranking(spark, fixture_dir, tmp_path):
    shop, pay, view = _paths(fixture_dir)
    more = tmp_path / "pay.txt"
    more.write_text(open(pay, encoding="utf-8").read().rstrip("\n") + "\n" + "u9,2\n" * 50, encoding="utf-8")
    want = [r.shop_id for r in main(["turnover", shop, pay, view], spark=spark).collect()]
    assert [r.shop_id for r in main(["turnover", shop, str(more), view, "--bad-rows", "keep"], spark=spark).collect()] == want


def test_cli_per_city_parameters(spark, fixture_dir):
    df = main(["popularity-per-city", *_paths(fixture_dir), "--cities", "广州", "--k", "1"], spark=spark)
    assert [(r.city_name, r.shop_id) for r in df.collect()] == [("广州", "3")]


def test_cli_explain_does_not_run(spark, fixture_dir, tmp_path, capsys):
    out = str(tmp_path / "never")
    main(["popularity", *_paths(fixture_dir), "--explain", "--out", out], spark=spark)
    import os
    assert not os.path.exists(out)


def test_cli_partitioned_output(spark, fixture_dir, tmp_path):
    import os

    out = str(tmp_path / "scores")
    df = main(["popularity-scores", *_paths(fixture_dir), "--zero-price", "null", "--out", out,
               "--partition-by", "city_name"], spark=spark)
    assert sorted(d for d in os.listdir(out) if d.startswith("city_name=")) == \
        sorted(f"city_name={c}" for c in {r.city_name for r in df.collect()})
    assert spark.read.parquet(out).count() == df.count()
