"""The k nearest others of every point within its group, for groups of any size.

Points are sorted along a space-filling curve and cut into blocks of up to ``BLOCK`` points, one packed row each.  For two blocks the boxes bound all distances
between their points: enough near blocks give each block a radius that surely holds k others of each of its points, and only blocks that reach into that
radius are paired with it.  A task streams a block's partners, nearest box first, and keeps the k best of each of its points, so it holds one
block's bests whatever the group's size.  Of equal distances the lower row number counts as nearer.

What a second step needs of the neighbours (their mean of some value) is found in a second pass over the same pairs; links are never written out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1024
#: Rows whose distances to a partner block are computed at a time, and bytes of one Arrow batch of packed blocks.
ROWS, BATCH_BYTES = 256, 16 << 20
BLOCKS = "grp string, block long, n long, ids binary, x binary, lo array<double>, hi array<double>"


def _curve(features: list[str]) -> Column:
    """Place on a Z-order curve of the features, scaled to their group's range (``lo_i``, ``hi_i``)."""
    used = features[:60]
    bits = min(10, max(1, 60 // len(used)))
    place = F.lit(0).cast("long")
    for i, f in enumerate(used):
        span = F.col(f"hi_{i}") - F.col(f"lo_{i}")
        q = F.when(span > 0, F.floor((F.col(f) - F.col(f"lo_{i}")) / span * ((1 << bits) - 1))).otherwise(0).cast("long")
        for b in range(bits):
            place = place + F.shiftleft(F.shiftright(q, b).bitwiseAND(F.lit(1)), b * len(used) + i)
    return place


def blocks(points: DataFrame, features: list[str], size: int = BLOCK) -> DataFrame:
    """Packed blocks of points (grp: string, row: long, features: finite doubles)."""
    points.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ends = points.groupBy("grp").agg(*(g(f).alias(f"{name}_{i}") for i, f in enumerate(features) for g, name in ((F.min, "lo"), (F.max, "hi"))))
    rows = points.join(ends, "grp").withColumn("z", _curve(features)).select("grp", "z", "row", F.array(*(F.col(f).cast("double") for f in features)).alias("x"))
    width = len(features)
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def packed(grp: str, nr: int, ids: np.ndarray, x: np.ndarray) -> tuple:
        return grp, nr, len(ids), ids.tobytes(), x.tobytes(), x.min(0).tolist(), x.max(0).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nr = TaskContext.get().partitionId(), 0
        held: tuple = (None, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, width)))
        schema = pa.schema([("grp", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("x", pa.binary()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))])

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=pa.schema([f.with_name(c) for f, c in zip(schema, names, strict=True)]))

        for batch in batches:
            grps = np.array(batch.column("grp").to_pylist(), object)
            ids = batch.column("row").to_numpy(zero_copy_only=False)
            z = batch.column("z").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            cuts = np.flatnonzero(grps[1:] != grps[:-1]) + 1 if len(grps) > 1 else np.zeros(0, int)
            out = []
            for a, b in zip([0, *cuts], [*cuts, len(grps)], strict=True):
                if a == b:
                    continue
                if held[0] != grps[a] and len(held[1]):
                    out.append(packed(held[0], (part << 32) + nr, *held[2:]))
                    nr, held = nr + 1, (None, *(v[:0] for v in held[1:]))
                held = (grps[a], *(np.concatenate([u, v[a:b]]) for u, v in zip(held[1:], (z, ids, x), strict=True)))
                while len(held[1]) > size:
                    # where the curve jumps farthest, so that a block is a compact cell
                    least = max(1, size // 4)
                    end = least + int(np.argmax(held[1][least : size + 1] ^ held[1][least - 1 : size]))
                    out.append(packed(held[0], (part << 32) + nr, held[2][:end], held[3][:end]))
                    nr, held = nr + 1, (held[0], *(v[end:] for v in held[1:]))
            if out:
                yield batch_of(out)
        if len(held[1]):
            yield batch_of([packed(held[0], (part << 32) + nr, *held[2:])])

    return rows.repartitionByRange("grp", "z", "row").sortWithinPartitions("grp", "z", "row").mapInArrow(run, BLOCKS)


def partners(packed: DataFrame, k: int) -> DataFrame:
    """block, other and d2 (least squared distance of their boxes) of all blocks that may hold one of the k nearest of a block's points.

    A group's boxes, one row a block, come together in one task; its points don't.
    """
    boxes = packed.select("grp", "block", "n", "lo", "hi")
    sizes = boxes.groupBy("grp").agg(F.count(F.lit(1)).alias("blocks"))
    boxes = boxes.join(sizes, "grp")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi, n = np.array(pdf["lo"].tolist()), np.array(pdf["hi"].tolist()), pdf["n"].to_numpy()
        at, found = pdf["block"].to_numpy(), []
        for i in range(len(pdf)):
            far = (np.maximum(hi - lo[i], hi[i] - lo) ** 2).sum(1)
            near = (np.maximum(0, np.maximum(lo - hi[i], lo[i] - hi)) ** 2).sum(1)
            order = np.argsort(far, kind="stable")
            enough = np.flatnonzero(np.cumsum(n[order]) > k)  # the point itself is one of them
            radius = far[order[enough[0]]] if len(enough) else np.inf
            some = np.flatnonzero(near <= radius)
            found.append(pd.DataFrame({"block": at[i], "other": at[some], "d2": near[some]}))
        return pd.concat(found)

    alone = boxes.where("blocks = 1").select("block", F.col("block").alias("other"), F.lit(0.0).alias("d2"))
    return alone.unionAll(boxes.where("blocks > 1").select("grp", "block", "n", "lo", "hi").groupBy("grp").applyInPandas(run, "block long, other long, d2 double"))


class Best:
    """The k nearest others of each row of one block so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.d2 = np.full((len(ids), k), np.inf)
        self.at = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.value = np.zeros((len(ids), k))

    def add(self, ids: np.ndarray, x: np.ndarray, value: np.ndarray, least: float) -> None:
        if least > self.d2.max():  # every row has k others nearer than the partner's box
            return
        for a in range(0, len(self.ids), ROWS):
            s = slice(a, a + ROWS)
            d = ((self.x[s, None, :] - x[None, :, :]) ** 2).sum(2)
            d[self.ids[s, None] == ids[None, :]] = np.inf
            d = np.concatenate([self.d2[s], d], 1)
            at = np.concatenate([self.at[s], np.broadcast_to(ids, (d.shape[0], len(ids)))], 1)
            values = np.concatenate([self.value[s], np.broadcast_to(value, (d.shape[0], len(ids)))], 1)
            pick = np.argpartition(d, self.k - 1, axis=1)[:, : self.k]
            last = np.take_along_axis(d, pick, 1).max(1)
            tied = np.flatnonzero(((d <= last[:, None]).sum(1) > self.k) & np.isfinite(last))
            for i in tied:  # of equal distances the lower row number
                pick[i] = np.lexsort((at[i], d[i]))[: self.k]
            self.d2[s], self.at[s], self.value[s] = (np.take_along_axis(v, pick, 1) for v in (d, at, values))

    def mean(self, what: np.ndarray) -> np.ndarray:
        """Mean over the neighbours, 0 where there are none."""
        some = np.isfinite(self.d2)
        n = some.sum(1)
        return np.divide(np.where(some, what, 0.0).sum(1), n, out=np.zeros(len(n)), where=n > 0)


def of_nearest(packed: DataFrame, pairs: DataFrame, k: int, result: Callable[[Best], np.ndarray], value: DataFrame | None = None) -> DataFrame:
    """block and the packed doubles ``value``: ``result`` of each block's bests, in the order of its ids.

    ``value`` (block, value) gives the points a number that ``result`` finds in ``Best.value``; it is 0 without it.
    """
    packs = packed.select("block", "ids", "x")
    packs = packs.join(value, "block") if value is not None else packs.withColumn("value", F.lit(None).cast("binary"))
    own = packs.select("block", F.lit(0).alias("kind"), F.lit(0.0).alias("d2"), "ids", "x", "value")
    others = pairs.join(packs.withColumnRenamed("block", "other"), "other").select("block", F.lit(1).alias("kind"), "d2", "ids", "x", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, block = None, None
        done = lambda: pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "value": pa.array([result(best).astype(float).tobytes()], pa.binary())})
        for batch in batches:
            for i in range(len(batch)):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                x = np.frombuffer(batch.column("x")[i].as_py()).reshape(len(ids), -1)
                if batch.column("kind")[i].as_py() == 0:
                    if best is not None:
                        yield done()
                    best, block = Best(ids, x, k), batch.column("block")[i].as_py()
                else:
                    held = batch.column("value")[i].as_py()
                    best.add(ids, x, np.frombuffer(held) if held is not None else np.zeros(len(ids)), batch.column("d2")[i].as_py())
        if best is not None:
            yield done()

    return own.unionAll(others).repartition("block").sortWithinPartitions("block", "kind", "d2").mapInArrow(run, "block long, value binary")


def unpacked(packed: DataFrame, **values: DataFrame) -> DataFrame:
    """grp, row and one double for each of ``values`` (block, value)."""
    rows, names = packed.select("grp", "block", "ids"), tuple(values)
    for name, v in values.items():
        rows = rows.join(v.withColumnRenamed("value", name), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                yield pa.RecordBatch.from_pydict({"grp": pa.repeat(batch.column("grp")[i], len(ids)), "row": pa.array(ids), **{c: pa.array(np.frombuffer(batch.column(c)[i].as_py())) for c in names}})

    return rows.select("grp", "ids", *names).mapInArrow(run, ", ".join(["grp string, row long", *(f"{c} double" for c in names)]))
