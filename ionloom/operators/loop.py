"""Local outlier probabilities (Kriegel, Kroeger, Schubert and Zimek 2009) within groups such as one precursor's matches.

``with_loop`` deals groups of any size as blocks of points; ``loop_scores`` is the same for one group in memory.  With n <= k rows all others are
neighbours; one row alone, or rows without spread, have PLOF 0 and LoOP 0.  Null features make the row's results null.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionloom.constants import EXTENT, NEIGHBOURS
from ionloom.operators import neighbours
from ionloom.session import discard, written

_BLOCK = 512


def nearest(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and squared distances of each row's k nearest others; ties go to the earlier row."""
    n = len(x)
    k = min(k, n - 1)
    at, d2 = np.zeros((n, k), np.int64), np.zeros((n, k))
    for s in range(0, n, _BLOCK):
        d = ((x[s : s + _BLOCK, None, :] - x[None, :, :]) ** 2).sum(2)
        d[np.arange(len(d)), np.arange(s, s + len(d))] = np.inf
        order = np.argsort(d, axis=1, kind="stable")[:, :k]
        at[s : s + _BLOCK] = order
        d2[s : s + _BLOCK] = np.take_along_axis(d, order, 1)
    return at, d2


def loop_scores(x: np.ndarray, k: int = NEIGHBOURS, extent: float = EXTENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """PLOF, nPLOF and LoOP of each row."""
    n = len(x)
    if n < 2:
        return np.zeros(n), np.zeros(n), np.zeros(n)
    at, d2 = nearest(x, k)
    pdist = extent * np.sqrt(d2.mean(1))
    around = pdist[at].mean(1)
    plof = np.where(around > 0, pdist / np.where(around > 0, around, 1) - 1, 0.0)
    nplof = extent * math.sqrt(float((plof**2).mean()))
    if nplof == 0:
        return plof, np.zeros(n), np.zeros(n)
    loop = np.array([max(0.0, math.erf(v / (nplof * math.sqrt(2)))) for v in plof])
    return plof, np.full(n, nplof), loop


def erf(x: Column) -> Column:
    """The error function for x >= 0 by its series of positive terms, 1 from 6 on."""
    z = 2 * x * x
    terms = F.aggregate(F.sequence(F.lit(0), F.lit(150)), F.struct(x.alias("t"), F.lit(0.0).alias("sum")), lambda a, i: F.struct((a["t"] * z / (2 * i + 3)).alias("t"), (a["sum"] + a["t"]).alias("sum")))
    return F.when(x >= 6, 1.0).otherwise(2 / math.sqrt(math.pi) * F.exp(-x * x) * terms["sum"])


def numbered(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` written once, with ``loop_row``, a number that rises with keys and order, and ``loop_group``, the keys as text."""
    rows = df.withColumn("loop_group", F.to_json(F.struct(*keys))).repartitionByRange("loop_group", *order).sortWithinPartitions("loop_group", *order)
    return written(rows.withColumn("loop_row", F.monotonically_increasing_id()), "numbered")


def prepared(rows: DataFrame, features: list[str], k: int, size: int = neighbours.BLOCK) -> tuple[DataFrame, DataFrame]:
    """Packed blocks and block pairs of the rows whose features are all numbers."""
    whole = rows.select(F.col("loop_group").alias("grp"), F.col("loop_row").alias("row"), *(F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)))
    names = [f"x{i}" for i in range(len(features))]
    for c in names:
        whole = whole.where(F.col(c).isNotNull() & ~F.isnan(c))
    packed = written(neighbours.blocks(whole, names, size), "blocks")
    return packed, written(neighbours.partners(packed, k), "pairs")


def with_loop(df: DataFrame, keys: list[str], features: list[str], order: list[str], k: int = NEIGHBOURS, extent: float = EXTENT, size: int = neighbours.BLOCK) -> DataFrame:
    """``df`` with plof, nplof and loop_score, within each group of ``keys``.

    A group of any size is dealt as blocks (see ``neighbours``): one pass finds each row's probabilistic distance, a second one the mean of
    its neighbours' distances; the rest are aggregates and joins.  The tables in between are written to the shared folder.
    """
    rows = numbered(df, keys, order)
    packed, pairs = prepared(rows, features, k, size)
    pdist = written(neighbours.of_nearest(packed, pairs, k, lambda b: extent * np.sqrt(b.mean(b.d2))), "pdist")
    around = neighbours.of_nearest(packed, pairs, k, lambda b: b.mean(b.value), pdist)
    each = neighbours.unpacked(packed, pdist=pdist, around=around)
    each = written(each.select("grp", "row", F.when(F.col("around") > 0, F.col("pdist") / F.col("around") - 1).otherwise(0.0).alias("plof")), "plof")
    spread = each.groupBy("grp").agg((extent * F.sqrt(F.avg(F.col("plof") * F.col("plof")))).alias("nplof"))
    score = F.when(F.col("nplof") > 0, erf(F.greatest(F.col("plof"), F.lit(0.0)) / (F.col("nplof") * math.sqrt(2)))).otherwise(0.0)
    found = each.join(spread, "grp").select(F.col("row").alias("loop_row"), "plof", "nplof", score.alias("loop_score"))
    discard(packed, pairs, pdist)
    return rows.join(found, "loop_row", "left").select(*df.columns, "plof", "nplof", "loop_score")


def with_pdist(df: DataFrame, keys: list[str], features: list[str], order: list[str], k: int = NEIGHBOURS, extent: float = EXTENT, size: int = neighbours.BLOCK) -> DataFrame:
    """``df`` with pdist, the probabilistic distance to the k nearest others in its group; 0 for a row alone, null without features."""
    rows = numbered(df, keys, order)
    packed, pairs = prepared(rows, features, k, size)
    pdist = written(neighbours.of_nearest(packed, pairs, k, lambda b: extent * np.sqrt(b.mean(b.d2))), "pdist")
    found = written(neighbours.unpacked(packed, pdist=pdist).select(F.col("row").alias("loop_row"), "pdist"), "pdist")
    discard(packed, pairs, pdist)
    return rows.join(found, "loop_row", "left").select(*df.columns, "pdist")
