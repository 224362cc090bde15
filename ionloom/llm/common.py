"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

#: Characters that separate words in the word-based contracts.
WORD_SPACE = " \t\n\x0b\x0c\r"


#: Bytes of one Arrow batch that Spark hands to a Python worker, and of the slices that the operators work on.
BATCH_BYTES, SLICE_BYTES = 8 << 20, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches are cut by bytes, so that a run of long texts doesn't fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``column`` takes ``most`` bytes at most (a longer row comes alone).

    At the end freed memory goes back to the system, as workers stay alive between tasks.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, end - at)
            at = end
    give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only for a local master without that setting."""
    try:
        found = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001  an entry without a value
        found = None
    if found:
        return found
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = f"file://{tempfile.mkdtemp(prefix='ionloom-')}"
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: it cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: Column, n: int, held: int) -> Column:
    """True where crc32(doc_id as text) mod ``n`` is ``held``; a null id is in no held-out fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n == held, F.lit(False))


def sample_ids(rows: DataFrame, kind: str, most: int) -> DataFrame:
    """doc_id and ``kind`` of at most ``most`` rows of every kind, chosen by a hash of doc_id, as a small written table.

    The kinds are few (classes or languages), so the table has a proven bound and can be broadcast.
    """
    h = F.xxhash64(F.col("doc_id").cast("string"))
    rows = rows.select("doc_id", kind).dropDuplicates(["doc_id"])
    share = rows.groupBy(kind).agg((F.lit(1.2 * most) / F.count(F.lit(1))).alias("share"))
    near = rows.join(F.broadcast(share), kind).where(F.pmod(h, F.lit(1 << 20)) <= F.col("share") * (1 << 20))
    first = F.row_number().over(Window.partitionBy(kind).orderBy(h, "doc_id"))
    return written(near.withColumn("first", first).where(F.col("first") <= most).select("doc_id", kind), "sample")


def ids_and_texts(batch: pa.RecordBatch, text: str = "text") -> tuple[pa.Array, list[str]]:
    """The batch's doc_id array and its texts, null texts as empty ones."""
    return batch.column("doc_id"), [t or "" for t in batch.column(text).to_pylist()]


def auc(y, x) -> float:
    """Area under the ROC curve, ties counted half."""
    y, x = np.asarray(y), np.asarray(x, float)
    _, inv = np.unique(x, return_inverse=True)
    order = np.argsort(x, kind="stable")
    rank = np.empty(len(x))
    rank[order] = np.arange(1, len(x) + 1)
    rank = (np.bincount(inv, rank) / np.bincount(inv))[inv]
    n1 = int(y.sum())
    return float((rank[y == 1].sum() - n1 * (n1 + 1) / 2) / max(1, n1 * (len(y) - n1)))
