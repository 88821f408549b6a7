"""Training-data pipeline over ``documents``: five operators, one after another.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``. Stages accept null values in any column,
empty texts, repeated rows, empty tables and additional columns; each
operator's module says what it does with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopscope.llm import contain, packing, simhash, suffixes, toxicity
from shopscope.llm.common import documents, saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of long repeated strings."""
    return suffixes.without_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return contain.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in packed sequences."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: Tokens, learned scores and fingerprint trees have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
