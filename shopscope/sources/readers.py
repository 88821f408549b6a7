"""File readers: comma lines or JSON lines, from any Hadoop path."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.sources import lines as L
from shopscope.sources.schema import raw_string_schema

FORMATS = ("csv", "json")

_PARSERS = {
    ("csv", "shop"): L.parse_shop_lines,
    ("csv", "pay"): L.parse_pay_lines,
    ("csv", "view"): L.parse_view_lines,
    ("json", "shop"): L.parse_shop_json,
    ("json", "pay"): L.parse_pay_json,
    ("json", "view"): L.parse_view_json,
}


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster."""
    return int(spark.sparkContext.defaultParallelism)


def ensure_min_partitions(df: DataFrame, min_partitions: int | None, *keys: str) -> DataFrame:
    """At least ``min_partitions`` partitions of any table (repartition only if fewer).

    With ``keys`` the rows are hash-partitioned on them, which a join or
    aggregation on those keys can reuse; without, round-robin. The readers do
    not use it: they ask the scan for more splits (S7), which moves no rows.
    """
    if not min_partitions or df.rdd.getNumPartitions() >= min_partitions:
        return df
    return df.repartition(min_partitions, *keys) if keys else df.repartition(min_partitions)


#: What a scan's splits are set by.
SPLIT_COUNT, SPLIT_COST = "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes"


def split_scan(spark: SparkSession, load: Callable[[SparkSession], DataFrame], min_partitions: int | None) -> DataFrame:
    """The table ``load`` reads, in at least ``min_partitions`` splits.

    The files are split finer where they are read, so no row is shuffled. The
    split settings are those of a session, so the scan is made in a session of
    its own with the caller's settings, and named in the caller's by a view that
    is dropped at once. A file that cannot be split (gzip) is one split, and
    one of fewer lines than splits leaves some empty.
    """
    if not min_partitions:
        return load(spark)
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(SPLIT_COUNT, str(int(min_partitions)))
    own.conf.set(SPLIT_COST, "1")
    view = f"scan_{uuid.uuid4().hex}"
    load(own).createGlobalTempView(view)
    try:
        return spark.table(f"global_temp.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)


def spread_lines(lines: DataFrame, partitions: int) -> DataFrame:
    """Deal raw lines round-robin over ``partitions`` tasks, whatever file
    they came from.

    For inputs where a few unsplittable files (gzip, for instance) hold a
    large share of the rows: reading such a file stays one task, since its
    decompression is sequential, but the parsing and partial aggregation
    after it are then spread. Round-robin rather than a hash of the line,
    so a group of identical lines is spread too; Spark sorts each input
    partition first, so a re-run task deals the same rows. It shuffles the
    raw lines once, so it is an option, not a default.
    """
    return lines.repartition(max(partitions, lines.rdd.getNumPartitions()))


def _check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {fmt!r}")


def _read_json(spark: SparkSession, path, kind: str, bad_rows: str, min_partitions: int | None) -> DataFrame:
    """JSON lines through Spark's JSON source: declared schema, corrupt lines in a column.

    The source passes over blank lines; where they matter (``fail``, ``keep``) a
    scan of the text adds them. A line that is an array of records gives its
    records. ``_bad`` of a record with a bad integer is the record as it was read.
    """
    L._check_policy(bad_rows)
    schema = raw_string_schema([*L.KINDS[kind][0], L._CORRUPT])
    records = split_scan(
        spark, lambda s: s.read.schema(schema).option("columnNameOfCorruptRecord", L._CORRUPT).json(path), min_partitions)
    if bad_rows != "drop":
        blank = spark.read.text(path).filter(F.trim("value") == "")
        empty = [F.lit(None).cast("string").alias(f.name) for f in schema.fields[:-1]]
        records = records.unionByName(blank.select(*empty, F.col("value").alias(L._CORRUPT)))
    return L.typed_records(records, kind, bad_rows)


def _read(spark: SparkSession, path, kind: str, fmt: str, bad_rows: str, min_partitions: int | None,
          spread: bool = False, **kwargs) -> DataFrame:
    _check_format(fmt)
    if fmt == "json" and not spread:
        return _read_json(spark, path, kind, bad_rows, min_partitions)
    if spread:
        text = spread_lines(spark.read.text(path), min_partitions or default_parallelism(spark))
    else:
        text = split_scan(spark, lambda s: s.read.text(path), min_partitions)
    return _PARSERS[(fmt, kind)](text, bad_rows=bad_rows, **kwargs)


def quarantined(spark: SparkSession, path, kind: str, fmt: str = "csv", required_fields: int | None = None) -> DataFrame:
    """The bad lines of the files: (file, line, reason). Together with
    ``read_*(..., bad_rows="drop")`` every line is in one of the two tables
    (but for JSON arrays of records, which the JSON source reads)."""
    _check_format(fmt)
    text = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    return L.reasons(text, kind, fmt, "line", required_fields).select("file", "line", "reason")


def read_or_quarantine(spark: SparkSession, path, kind: str, quarantine: str, fmt: str = "csv",
                       mode: str = "errorifexists", **kwargs) -> DataFrame:
    """The good rows of the files; the bad lines are written as a table at
    ``quarantine`` with their file and reason."""
    quarantined(spark, path, kind, fmt, kwargs.get("required_fields")).write.mode(mode).parquet(quarantine)
    return _read(spark, path, kind, fmt, "drop", kwargs.pop("min_partitions", None), **kwargs)


def read_shops(spark: SparkSession, path, fmt: str = "csv", bad_rows: str = "fail",
               min_partitions: int | None = None, required_fields: int | None = None,
               spread: bool = False) -> DataFrame:
    """The shop master table."""
    extra = {"required_fields": required_fields} if fmt == "csv" and required_fields else {}
    return _read(spark, path, "shop", fmt, bad_rows, min_partitions, spread, **extra)


def read_pays(spark: SparkSession, path, fmt: str = "csv", bad_rows: str = "fail",
              min_partitions: int | None = None, spread: bool = False) -> DataFrame:
    """The payment log, with the derived ``day``.

    ``spread=True`` deals the lines over the cluster after reading (see
    ``spread_lines``), for logs where a few unsplittable files dominate.
    """
    return _read(spark, path, "pay", fmt, bad_rows, min_partitions, spread)


def read_views(spark: SparkSession, path, fmt: str = "csv", bad_rows: str = "fail",
               min_partitions: int | None = None, spread: bool = False) -> DataFrame:
    """The page-view log."""
    return _read(spark, path, "view", fmt, bad_rows, min_partitions, spread)


def read_tables(spark: SparkSession, shop_path, pay_path, view_path, fmt: str = "csv",
                bad_rows: str = "fail", min_partitions: int | None = None, spread: bool = False):
    """The three inputs of every job, as (shops, pays, views).

    ``spread`` applies to the two logs; the shop table is a dimension.
    """
    return (
        read_shops(spark, shop_path, fmt, bad_rows, min_partitions),
        read_pays(spark, pay_path, fmt, bad_rows, min_partitions, spread),
        read_views(spark, view_path, fmt, bad_rows, min_partitions, spread),
    )
