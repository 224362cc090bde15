"""Connected components as Spark joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionloom.llm.common import discard, written


#: Edges a task, and nodes whose roots a task holds at once.
PER_TASK = 100_000


def _local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contract a task's edges: every node points at the least node that it reaches within edges of ``PER_TASK`` nodes."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    def found() -> pa.RecordBatch:
        below = [(x, r) for x in list(root) if (r := find(x)) != x]
        root.clear()
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in below], pa.int64()), pa.array([x[1] for x in below], pa.int64())], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        if len(root) >= PER_TASK:
            yield found()
    yield found()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the least node of the component.

    Alternating stars (Kiveris et al. 2014): neighbours are linked to the least neighbour, first the larger ones, then the
    smaller ones, until nothing changes; the number of rounds grows with the logarithm of the edges.  Minima are partial aggregates and
    the join back can be split where one node has very many neighbours.  Each round is written to the shared folder, by as many tasks
    as its edges need, so few edges aren't dealt over all shuffle partitions; edges never grow from round to round.
    """
    e = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = written(e.mapInArrow(_local_roots, "a long, b long"), "components")
    while True:
        tasks = max(2, -(-e.count() // PER_TASK))
        # large star: for a node x with least neighbour m (itself included), link every larger neighbour to m
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        large = written(large.coalesce(tasks).mapInArrow(_local_roots, "a long, b long"), "components")
        discard(e)
        # small star: link a node and its smaller neighbours to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "m").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct().coalesce(tasks), "components")
        discard(large)
        if e.join(e.select(F.col("a").alias("b")), "b", "left_semi").coalesce(tasks).isEmpty():
            break
    # stars now: no root is itself below another node
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
