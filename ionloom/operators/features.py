"""Peptide-spectrum matches: construction, threshold, order and score features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionloom.constants import FEATURES


def second_mass(least: Column, most: Column) -> Column:
    """The larger theoretical mass, or null where both are the same."""
    return F.when(least != most, most)


def ratio(matched: Column, total: Column) -> Column:
    """matched / total as a double; null where total is 0."""
    return F.when(total != 0, matched.cast("double") / total.cast("double"))


def with_features(psms: DataFrame) -> DataFrame:
    return psms.withColumns({"ions_matched_ratio": ratio(F.col("ions_matched"), F.col("ions_total")), "mass_error": F.abs(F.col("experimental_mass") - F.col("theoretical_mass"))})


def feature_array(psms: DataFrame) -> DataFrame:
    return psms.withColumn("features", F.array(*(F.col(c).cast("double") for c in FEATURES)))


def above_threshold(psms: DataFrame, threshold: float = float("-inf")) -> DataFrame:
    return psms.where(F.col("xcorr") >= threshold)


def best_first(psms: DataFrame, seq_no: str) -> DataFrame:
    """Descending xcorr; of equal scores the later row comes first."""
    return psms.orderBy(F.desc("xcorr"), F.desc(seq_no))
