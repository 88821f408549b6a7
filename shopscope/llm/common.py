"""Helpers of the corpus operators: shared folder, null-safe input, text batches."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.shared import materialised, shared_folder

#: Text bytes that one step inside a task works on at once (a longer text is a batch of its own).
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it. (On a cluster
    without that path, send the package with ``--py-files`` as usual.)"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a local one only for a local master without the setting."""
    return shared_folder(spark)


def shared_uri(spark: SparkSession) -> str:
    """The shared folder as a URI that file libraries outside Spark take too."""
    path = shared_dir(spark)
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path[5:]
    return path if "://" in path else f"file://{path}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows as a table in the shared folder and reads it: lineage
    ends there, and a lost executor costs no earlier stage again. The table
    goes when the driver's JVM ends."""
    return materialised(df, name)[0]


def free_name(name: str, *tables: DataFrame) -> str:
    """``name``, longer where one of the tables has such a column."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name in taken:
        name += "_"
    return name


def released() -> None:
    """Hands memory that a task's worker no longer uses back to the system: the
    worker lives on for later tasks, and so would what the allocators keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch between rows, so that each part holds about ``limit`` text bytes."""
    n = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for i, size in enumerate(n):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def hash_sample(rows: DataFrame, label: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, all where there are fewer, chosen
    by a hash of the id; ``weight`` is how many rows one chosen row stands for. An
    id is chosen once, with its largest label, however many rows have it (the
    null id too). Rows need doc_id and the label; only counts go to the driver.
    -> doc_id, the label, weight."""
    rows = rows.groupBy("doc_id").agg(F.max(label).alias(label))
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = F.lit(1.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == F.lit(value), F.lit(max(1.0, n / per_label))).otherwise(weight)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    return rows.withColumn("weight", weight).filter(share * F.col("weight") < 1)


def texts_of(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """(the columns of ``chosen``, one row an id, and text): each chosen id with the
    least of its rows' texts, whatever the partitioning; a null id is not found."""
    found = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")
    return found.groupBy(*chosen.columns).agg(F.min("text").alias("text"))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(s, s + n)`` for each pair."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def worker_file(name: str) -> str:
    """Path of a public tokenizer file on the machine that asks."""
    import public_tokenizers

    return name if os.path.isabs(name) else public_tokenizers.path(name)
