"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; ``conf`` adds settings."""
    b = SparkSession.builder.appName("ionloom").config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC").config("spark.sql.parquet.compression.codec", "zstd")
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only for a local master without that setting."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = f"file://{tempfile.mkdtemp(prefix='ionloom-')}"
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: it cuts the lineage and survives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def dealt(df: DataFrame, rows_a_task: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over as many tasks as its rows ask for, and over all cores at least: a small file would be one task, and a fixed number of tasks would grow with the table."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_a_task))
    return df.repartition(n, *keys)


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
