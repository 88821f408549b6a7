"""The registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopscope.llm import alignment, bytebpe, contain, langid, lengths, packing, quality, simhash, suffixes, toxicity, warc, wavelet, whitening
from shopscope.llm.common import documents, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op2_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.written_and_read(documents(spark, sf_dir))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.predicted(docs, langid.fit(docs))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contain.contained(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.histogram(lengths.token_lengths(documents(spark, sf_dir)))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(documents(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir)).select(*quality.REPORT)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(documents(spark, sf_dir)))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op12_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(documents(spark, sf_dir))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_wavelet, op3_language, op4_warc, op5_decontaminate, op6_token_counts, op7_suffixes, op8_quality, op9_toxicity,
    op10_packing, op11_whitening, op12_bytebpe, op13_alignment)}
ORACLE_SQL: dict[str, str] = {"op4_warc": warc.ORACLE, "op8_quality": quality.ORACLE}
