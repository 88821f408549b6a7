"""Sinks: write a result DataFrame out, partition by partition on executors."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SINK_FORMATS = ("parquet", "csv", "json", "orc", "text", "noop")


def write_result(df: DataFrame, path: str | None, fmt: str = "parquet", mode: str = "errorifexists",
                 partition_by=None, rebalance: bool = True, salt: int = 8, overwrite_partitions: bool = False,
                 **options) -> None:
    """K2: distributed write of a result.

    Each task writes its own partition; Spark's commit protocol makes the
    output appear atomically, and a lost task is simply re-run. ``noop``
    runs the whole plan without storing anything (used for timing).

    With ``partition_by``, every task would write one file per value it
    holds (tasks x values files). Unless ``rebalance=False``, the rows are
    first clustered by those columns with Spark's rebalance hint; AQE then
    merges small partitions and splits the partition of a value holding
    many rows along the tasks its rows come from. A value whose rows come from
    one task could not be split that way, so rows are clustered by the value
    and a ``salt`` (the row's hash, so a re-run task deals the same rows): a
    value goes to at most ``salt`` partitions, which are merged while small.
    ``maxRecordsPerFile`` may be passed as an option to cap file size.

    ``overwrite_partitions`` with mode ``overwrite`` replaces only the
    partition values that the result holds, so a day's run can be repeated
    without touching other days.
    """
    if fmt not in SINK_FORMATS:
        raise ValueError(f"format must be one of {SINK_FORMATS}, got {fmt!r}")
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if cols and rebalance:
        df = _salted(df, cols, salt) if salt > 1 else df.hint("rebalance", *cols)
    writer = df.write.mode(mode).format(fmt).options(**options)
    if cols:
        writer = writer.partitionBy(*cols)
    if overwrite_partitions:
        if not cols or mode != "overwrite":
            raise ValueError("overwrite_partitions needs partition_by and mode='overwrite'")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with _least_partition(df.sparkSession):
        if fmt == "noop":
            writer.save()
        else:
            writer.save(path)


@contextmanager
def _least_partition(spark: SparkSession):
    """Spark merges partitions up to its least size even where the advisory size
    is below that; while writing, the advisory size decides."""
    least, aim = "spark.sql.adaptive.coalescePartitions.minPartitionSize", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    set_before = spark.conf.get(least, None)
    spark.conf.set(least, str(min(_bytes(spark.conf.get(least)), _bytes(spark.conf.get(aim)))))
    try:
        yield
    finally:
        spark.conf.set(least, set_before) if set_before else spark.conf.unset(least)


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", size.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def _salted(df: DataFrame, cols: list[str], salt: int) -> DataFrame:
    """Rebalanced by ``cols`` and the row's hash in ``salt`` values (maps cannot be hashed and are left out)."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    name = "_salt"
    while name in df.columns:
        name += "_"
    return df.withColumn(name, F.pmod(F.xxhash64(*hashed), F.lit(salt))).hint("rebalance", *cols, name).drop(name)
