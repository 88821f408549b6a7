"""Run a job on shop / payment / view files.

    spark-submit --py-files shopscope.zip shopscope/plans/cli.py JOB [SHOP PAY VIEW] [options]
    python -m shopscope turnover shop_info.txt user_pay.txt user_view.txt --out top.parquet

The three paths are any Hadoop paths (local, HDFS, object store); without any
the default paths are used. With ``--out`` the result is written by the
executors; without it a ranked result is shown, and the jobs that return a row
for every shop are refused.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.functions.predicates import DEFAULT_CITIES, DEFAULT_KEYWORD
from shopscope.operators.ranking import DEFAULT_K
from shopscope.plans import jobs as J
from shopscope.plans.sql import popularity_sql
from shopscope.session import build_session
from shopscope.sinks import SINK_FORMATS, write_result
from shopscope.sources.lines import BAD_COLUMN
from shopscope.sources.readers import FORMATS, read_tables

DEFAULT_PATHS = ("data/shop_info.txt", "data/user_pay.txt", "data/user_view.txt")

# Every job has the same shape: the three inputs plus parameters in, one
# DataFrame out (the views table is read for every job, as in the original,
# and no job uses it further).
Job = Callable[..., DataFrame]


def _sel(p):
    return {"cities": p.cities, "keyword": p.keyword}


JOBS: dict[str, Job] = {
    "turnover": lambda spark, shops, pays, views, p: J.turnover_top(shops, pays, p.k),
    "avg-daily-turnover": lambda spark, shops, pays, views, p: J.avg_daily_turnover_top(shops, pays, p.k),
    "popularity": lambda spark, shops, pays, views, p: J.popularity_top(shops, pays, k=p.k, zero_price=p.zero_price,
                                                                        **_sel(p)),
    "popularity-per-city": lambda spark, shops, pays, views, p: J.popularity_top_per_city(
        shops, pays, k=p.k, zero_price=p.zero_price, **_sel(p)),
    "popularity-scores": lambda spark, shops, pays, views, p: J.popularity_scores(
        shops, pays, zero_price=p.zero_price, **_sel(p)),
    "popularity-integer": lambda spark, shops, pays, views, p: J.popularity_integer_scores(
        shops, pays, zero_price=p.zero_price, **_sel(p)),
    "popularity-simplified": lambda spark, shops, pays, views, p: J.popularity_simplified_scores(shops, pays,
                                                                                                  **_sel(p)),
    "revenue": lambda spark, shops, pays, views, p: J.revenue_report(shops, pays, **_sel(p)),
    "popularity-sql": lambda spark, shops, pays, views, p: popularity_sql(spark, shops, pays, p.keyword, p.cities),
}


#: Jobs whose result is a short ranking; the others return a row for every shop.
RANKED = ("turnover", "avg-daily-turnover", "popularity", "popularity-per-city")
ZERO_PRICE = {"popularity-integer": ("null", "fail")}


def parse_args(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="shopscope", description=__doc__.split("\n\n")[0])
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("paths", nargs="*", help="SHOP PAY VIEW (all three, or none for the defaults)")
    ap.add_argument("--format", default="csv", choices=FORMATS)
    ap.add_argument("--bad-rows", default="fail", choices=("fail", "drop", "keep"))
    ap.add_argument("--min-partitions", type=int, default=None)
    ap.add_argument("--spread", action="store_true",
                    help="deal log lines over the cluster after reading (few large unsplittable files)")
    ap.add_argument("--k", type=int, default=DEFAULT_K)
    ap.add_argument("--cities", nargs="+", default=list(DEFAULT_CITIES))
    ap.add_argument("--keyword", default=DEFAULT_KEYWORD)
    ap.add_argument("--zero-price", default=None, choices=("nan", "null", "fail", "simplified", "exclude"))
    ap.add_argument("--out", default=None)
    ap.add_argument("--out-format", default="parquet", choices=SINK_FORMATS)
    ap.add_argument("--partition-by", nargs="+", default=None, help="output columns to partition the files by")
    ap.add_argument("--mode", default="errorifexists")
    ap.add_argument("--explain", action="store_true", help="print the formatted physical plan instead of running")
    args = ap.parse_args(argv)
    if len(args.paths) not in (0, 3):
        ap.error("give all three paths, or none for the defaults")
    allowed = ZERO_PRICE.get(args.job, ("nan", "null", "fail", "simplified", "exclude"))
    args.zero_price = args.zero_price or allowed[0]
    if args.zero_price not in allowed:
        ap.error(f"{args.job} knows --zero-price {' and '.join(allowed)} only")
    if args.job not in RANKED and not (args.out or args.explain):
        ap.error(f"{args.job} returns a row for every shop: give --out")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    paths = args.paths or DEFAULT_PATHS
    shops, pays, views = read_tables(spark, *paths, fmt=args.format, bad_rows=args.bad_rows,
                                     min_partitions=args.min_partitions, spread=args.spread)
    return JOBS[args.job](spark, *(good_rows(t) for t in (shops, pays, views)), args)


def good_rows(table: DataFrame) -> DataFrame:
    """Jobs compute on good lines only, also where bad ones were kept."""
    return table.filter(F.col(BAD_COLUMN).isNull()).drop(BAD_COLUMN) if BAD_COLUMN in table.columns else table


def main(argv=None, spark: SparkSession | None = None) -> DataFrame:
    args = parse_args(argv)
    spark = spark or build_session(app_name=f"shopscope-{args.job}")
    result = run(spark, args)
    if args.explain:
        result.explain("formatted")
    elif args.out:
        write_result(result, args.out, fmt=args.out_format, mode=args.mode, partition_by=args.partition_by)
    else:
        result.show(args.k * max(1, len(args.cities)), truncate=False)
    return result


if __name__ == "__main__":
    main()
