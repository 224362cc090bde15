"""The search as a stream over a watched folder, and progress tables."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ionloom.constants import SPECTRUM_SCHEMA
from ionloom.session import scratch_dir


def watch_spectra(spark: SparkSession, path: str, per_trigger: int = 100) -> DataFrame:
    """Spectra as Parquet files arrive; ``per_trigger`` bounds a batch, which is the back-pressure."""
    return spark.readStream.schema(SPECTRUM_SCHEMA).option("maxFilesPerTrigger", per_trigger).parquet(path)


def run_stream(spectra: DataFrame, step: Callable[[DataFrame], Any], sink: Callable[[Any, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Every batch goes through ``step`` and ``sink``; the sink must replace what a repeated batch wrote."""
    writer = spectra.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: sink(step(df), n))
    return (writer.trigger(availableNow=True) if once else writer).start()


def progress(spectra: DataFrame, finished: DataFrame, enqueued: DataFrame) -> DataFrame:
    """For each search: spectra in all, spectra finished, and whether all are in and finished (spectra are counted, not precursors)."""
    total = spectra.groupBy("uuid").agg(F.countDistinct("ms_run", "spectrum_id").alias("total"))
    done = finished.groupBy("uuid").agg(F.countDistinct("ms_run", "spectrum_id").alias("finished"))
    flags = enqueued.groupBy("uuid").agg(F.bool_or("is_search_fully_enqueued").alias("enqueued"))
    out = total.join(done, "uuid", "left").join(flags, "uuid", "left").select("uuid", "total", F.coalesce("finished", F.lit(0)).alias("finished"), F.coalesce("enqueued", F.lit(False)).alias("enqueued"))
    return out.withColumn("is_finished", F.col("enqueued") & (F.col("total") == F.col("finished")))


def finished_counts(spark: SparkSession, path: str) -> DataFrame:
    """Spectra of each search that are searched, from the rows (uuid, ms_run, spectrum_id) that batches left under their number.

    A repeated batch replaced its own rows and a spectrum that came in two batches counts once, so the counts hold after any restart.
    """
    rows = spark.read.schema("uuid string, ms_run string, spectrum_id string, batch string").parquet(path)
    return rows.groupBy("uuid").agg(F.countDistinct("ms_run", "spectrum_id").alias("finished"))


class Progress(StreamingQueryListener):
    """The last batches of all streams of a session as dictionaries; ``told`` is called for each, as it ends."""

    def __init__(self, told: Callable[[dict], None] = lambda row: None, most: int = 1000) -> None:
        self.batches: deque[dict] = deque(maxlen=most)
        self.ended: deque[str | None] = deque(maxlen=most)
        self.told = told

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"query": str(p.id), "batch": p.batchId, "rows": p.numInputRows, "ms": p.batchDuration}
        self.batches.append(row)
        self.told(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.append(event.exception)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` and its number of rows, which is known as soon as an action has run over it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def event_counters(events: DataFrame, prefix: str, key: str) -> DataFrame:
    """Events of each counter, named {prefix}_{key}."""
    return events.groupBy(F.concat(F.col(prefix).cast("string"), F.lit("_"), F.col(key).cast("string")).alias("counter")).agg(F.count(F.lit(1)).alias("n"))


def live_flags(events: DataFrame, idle: str, now) -> DataFrame:
    """Flags whose last sign of life is at most ``idle`` (an interval) before ``now``."""
    return events.groupBy("key").agg(F.max("at").alias("last")).where(F.col("last") >= now - F.expr(f"interval {idle}"))


def counts_by_stream(spark: SparkSession, path: str, only: str, schema, keys: list[str], name: str) -> DataFrame:
    """Counts of a folder's files by ``keys``, computed incrementally and read back when all files are in."""
    source = spark.readStream.schema(schema).option("pathGlobFilter", only).option("recursiveFileLookup", "true").parquet(path)
    out = f"{scratch_dir(spark)}/{name}-{__import__('uuid').uuid4().hex}"
    counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    def keep(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/state")

    counted.writeStream.outputMode("complete").option("checkpointLocation", f"{out}/checkpoint").foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/state")
