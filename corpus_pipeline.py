"""The corpus pipeline: each stage is one operator of ``ionloom.llm``, written as Parquet and read again for the next.

Stages take (spark, docs, sf_dir).  All but the last return the columns of ``documents``; the last returns packed pieces.
Near duplicates are taken at five words and a similarity of 0.8; exactly one row of a group stays, also where rows repeat or
have no doc_id.  No stage is expressible in SQL; the tests compare each with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ionloom.llm import decontaminate, ngram_join, packing, suffix_dedup, toxicity
from ionloom.llm.common import discard, table, written

NEAR = ngram_join.JoinParams(words=5, num=80, den=100)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance model rejects go; it learns from the rows at hand."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked rows stays, the one with the least doc_id."""
    return ngram_join.drop_near_duplicates(docs, NEAR)


def drop_repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 200 bytes that occur again are cut out of the texts."""
    return suffix_dedup.drop_repeated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their window, place and step group."""
    return packing.with_crc(packing.pack(docs))


STAGES = [("toxicity", drop_toxic), ("ngram_join", near_duplicates), ("suffix_dedup", drop_repeated), ("decontamination", drop_leaks), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), ()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(*before)
        before = (docs,)
    return STAGES[-1][1](spark, docs, sf_dir)
