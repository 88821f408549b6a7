"""Exact histogram of encoded lengths with suffix sums.

Documents are encoded in Arrow batches, only their lengths are shuffled, and
equal lengths are counted map-side first. Suffix sums are made in two steps:
inside blocks of lengths, and over the (few) block totals. One row of the
histogram then answers, for its length as context limit, how many documents
and tokens reach it and what a truncation there keeps.

A null or empty text has only its end token, if one is asked for. Rows with
any doc_id, null ones and repeated ones too, are counted one by one. An empty
table has an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopscope.llm.common import saved, text_slices
from shopscope.llm.encode import WORD_BPE, encoder

#: Lengths in one block of the two-step suffix sums.
BLOCK = 2048


def token_lengths(docs: DataFrame, tokenizer: str = WORD_BPE, end_tokens: int = 1) -> DataFrame:
    """``n_tokens`` of every row, the end token included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                _, counts = encoder(tokenizer).flat(part.column("text"))
                yield pa.RecordBatch.from_arrays([pa.array(counts + end_tokens, pa.int64())], ["n_tokens"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """From a column ``n_tokens``: for each length its documents and tokens, and
    docs_at_least / tokens_at_least (suffix sums), docs_at_most (for quantiles)
    and truncated_total (tokens left when every document is cut there)."""
    # written: it is read twice below, and encoding is what costs
    counted = saved(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")
    counted = counted.withColumns({"tokens": F.col("n_tokens") * F.col("n_docs"), "block": F.floor(F.col("n_tokens") / BLOCK)})
    blocks = counted.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("later_docs"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("later_tokens"),
        F.sum("d").over(everything).alias("all_docs"), F.sum("t").over(everything).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = counted.withColumns({"d": F.sum("n_docs").over(inside), "t": F.sum("tokens").over(inside)}).join(blocks, "block")
    docs, tokens = F.col("d") + F.col("later_docs"), F.col("t") + F.col("later_tokens")
    return rows.select(
        "n_tokens", "n_docs", "tokens", docs.alias("docs_at_least"), tokens.alias("tokens_at_least"),
        (F.col("all_docs") - docs + F.col("n_docs")).alias("docs_at_most"),
        (F.col("all_tokens") - tokens + F.col("n_tokens") * docs).alias("truncated_total"),
        (F.col("all_docs")).alias("all_docs"), F.col("all_tokens").alias("all_tokens"))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """For any context limits: documents that reach them, tokens those hold,
    and the tokens left after truncation, whether or not a document has that length."""
    wanted = hist.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit long")
    total = hist.agg(F.coalesce(F.max("all_tokens"), F.lit(0)).alias("total"))
    # the smallest length at or above the limit carries the limit's suffix sums
    found = F.broadcast(wanted).join(hist, F.col("n_tokens") >= F.col("context_limit"), "left").groupBy("context_limit").agg(
        F.min(F.struct("n_tokens", "docs_at_least", "tokens_at_least")).alias("s"))
    return found.crossJoin(F.broadcast(total)).select(  # one total beside the stated limits
        "context_limit", F.coalesce("s.docs_at_least", F.lit(0)).alias("docs_at_least"),
        F.coalesce("s.tokens_at_least", F.lit(0)).alias("tokens_at_least"),
        (F.col("total") - F.coalesce("s.tokens_at_least", F.lit(0))
         + F.col("context_limit") * F.coalesce("s.docs_at_least", F.lit(0))).alias("truncated_total"))


def quantiles(hist: DataFrame, at: list[float]) -> DataFrame:
    """The smallest length that at least a share ``q`` of the documents do not exceed."""
    wanted = hist.sparkSession.createDataFrame([(float(q),) for q in at], "q double")
    return F.broadcast(wanted).join(hist, F.col("docs_at_most") >= F.col("q") * F.col("all_docs")).groupBy("q").agg(
        F.min("n_tokens").alias("n_tokens"))
