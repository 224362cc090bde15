"""Cross-correlation of binned peaks and theoretical ions as relational steps (Eng 1994, 2008, 2013).

Steps: binned peaks, their normalised heights, the background by a range window over bins, and the sum over each candidate's ion
bins.  All are keyed by scan, but with the bin, the part or the peptide beside it in some, so a search shuffles several times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ionloom.params import XcorrParams


#: Ions of candidates that one task takes.
IONS_A_TASK = 1_000_000


def bin_of(mz: Column, p: XcorrParams) -> Column:
    return F.floor(mz / p.bin_size + 1 - p.bin_offset).cast("long")


def binned(peaks: DataFrame, p: XcorrParams, scan: str = "scan") -> DataFrame:
    """Largest square root of intensity in each bin of a scan; weak peaks are left out."""
    kept = peaks.where(F.col("intensity") >= p.minimum_intensity)
    return kept.groupBy(scan, bin_of(F.col("mz"), p).alias("bin")).agg(F.max(F.sqrt("intensity")).alias("height"))


def normalised(bins: DataFrame, p: XcorrParams, scan: str = "scan") -> DataFrame:
    """Heights scaled so that each of ``windows`` equal parts of a scan's bins has the maximum 50."""
    last = F.max("bin").over(Window.partitionBy(scan))
    part = F.floor(F.col("bin") * p.windows / (last + 1)).cast("long")
    top = F.max("height").over(Window.partitionBy(scan, "part"))
    return bins.withColumn("part", part).withColumn("y", F.when(top > 0, F.col("height") * 50 / top).otherwise(0.0)).select(scan, "bin", "y")


def corrected(heights: DataFrame, bins: DataFrame, p: XcorrParams, scan: str = "scan", tasks: int | None = None) -> DataFrame:
    """y and y less the mean of the ``background`` bins on either side, at observed bins and at ``bins``.

    Empty bins count: they are added with height 0, so that they get their (negative) background.
    """
    points = heights.select(scan, "bin", "y").unionByName(bins.select(scan, "bin", F.lit(0.0).alias("y")))
    points = _over(points, tasks, scan).groupBy(scan, "bin").agg(F.max("y").alias("y"))
    near = Window.partitionBy(scan).orderBy("bin").rangeBetween(-p.background, p.background)
    return points.withColumn("fast", F.col("y") - (F.sum("y").over(near) - F.col("y")) / (2 * p.background))


def _over(rows: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    return rows if tasks is None else rows.repartition(tasks, *keys)


def tasks_for(ion_bins: DataFrame) -> int:
    """A number of tasks that grows with the ions, so that what one task sorts doesn't."""
    return max(ion_bins.sparkSession.sparkContext.defaultParallelism, -(-ion_bins.count() // IONS_A_TASK))


def scores(heights: DataFrame, ion_bins: DataFrame, p: XcorrParams, scan: str = "scan", peptide: str = "peptide", tasks: int | None = None) -> DataFrame:
    """xcorr, ions_total and ions_matched of each (scan, peptide) in ``ion_bins`` (scan, peptide, bin), each shuffle over ``tasks`` if given."""
    around = (-1, 0, 1) if p.use_flanking_peaks else (0,)
    known = ion_bins.select(scan, "bin") if tasks is None else _over(ion_bins.select(scan, "bin"), tasks, scan).distinct()
    wanted = known.select(scan, F.explode(F.array(*(F.col("bin") + k for k in around))).alias("bin")).distinct()
    at = corrected(heights, wanted, p, scan, tasks)
    if p.use_flanking_peaks:
        sides = F.sum("fast").over(Window.partitionBy(scan).orderBy("bin").rangeBetween(-1, 1)) - F.col("fast")
        at = at.withColumn("fast", F.col("fast") + 0.5 * sides)
    hits = _over(ion_bins, tasks, scan, "bin").join(at, [scan, "bin"])
    return _over(hits, tasks, scan, peptide).groupBy(scan, peptide).agg((F.sum("fast") * 0.005).alias("xcorr"), F.count(F.lit(1)).alias("ions_total"), F.count_if(F.col("y") > 0).alias("ions_matched"))
