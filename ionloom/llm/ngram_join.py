"""Operator 2: n-gram Jaccard self-join with count vectors in R-trees.

Words are hashed into shingles, and a document is the set of its distinct shingles.  Documents with equal sets form one class.  Shingles
are hashed into groups; a document's group counts are a point.  Two sets share at most the sum of the coordinate minima of
their points, and for linked sets of a and b shingles that sum is at least (a + b) t / (1 + t).

Which points can meet on a cluster: linked sets differ in at most r = (a + b)(1 - t) / (1 + t) shingles.  Shingles are dealt
by hash into more than r blocks, so in one block at least both sets hold the same shingles.  A block's key is the sum of its
shingles' hashes.  There are spare blocks for the empty ones, which need no key that way; sizes are handled in bands, as r
depends on the size, and a set has keys for every band that a linked set may be in.  Every link has a common key.

1. Texts are read once for digests and points, and once a class for its keys.  Neighbours (by class number) within a key are
   bounded, verified and contracted to components.
2. Keys whose classes still lie in different components are cut into units: tiles of the classes outside the key's largest
   component against tiles of that component and against each other, ``tile`` classes and ``weight`` shingles at most each.
   A unit's points are bulk-loaded into an R-tree.  A node keeps the coordinate maxima, the least size and, if it is one, the
   component below it.  A search leaves out nodes whose summed minima fall short and nodes of its own component.  A class with
   a point left on either side stays.
3. What stays of a unit gets its texts; units with the same classes left are one.  The search runs again, pairs are verified on
   the exact sets, linked components are merged at once, and only merging links come out: fewer than a unit has classes.

So no link between components is lost, no stage makes a row for each pair, and a group of near copies costs about its size.

Scale: keys come from each set by itself and are grouped by one shuffle of 16 bytes a key.  The window over a key only looks at the
row before and after, so it streams.  Copies of one text are counted with partial aggregates.  A key whose o classes outside the
largest component stay unlinked costs o / ``tile`` copies of each of them, in units of bounded size.

Edge cases: null text, or one without words, has an empty set, is linked with nothing and is its own component; with fewer words
than a shingle the whole sequence is one shingle.  Rows with the same doc_id or repeated rows are linked if their sets are.  A null doc_id
is ignored in the minimum; a component with null ids only has a null id.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard as zs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ionloom.llm.common import discard, give_back, slices, table, written
from ionloom.llm.components import components

#: A point has a power of two of groups between these, with a few shingles in each.
LEAST_GROUPS, MOST_GROUPS, A_GROUP = 64, 2048, 2
_COUNT = np.uint16
#: Largest count of a group in a point.
FULL = np.iinfo(_COUNT).max


@dataclass(frozen=True)
class JoinParams:
    words: int = 3
    #: similarity threshold as a fraction
    num: int = 90
    den: int = 100
    band: float = 1.25
    #: most classes and most shingles of a tile (a larger set comes alone)
    tile: int = 512
    weight: int = 2_000_000
    leaf: int = 16
    #: most shingles whose sets a task keeps between units
    kept: int = 2_000_000


_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; words are split at ASCII white space, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, _U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
    k = min(k, len(words))
    s = h[: len(h) - k + 1]
    for i in range(1, k):
        s = _mix(s) * _U(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i]
    return np.unique(_mix(s + _U(k)))


def linked(a: np.ndarray, b: np.ndarray, p: JoinParams) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return p.den * both >= p.num * (len(a) + len(b) - both)


@cache
def band_starts(p: JoinParams, most: int) -> list[int]:
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * p.band))))
    return out


def keys(s: np.ndarray, p: JoinParams) -> np.ndarray:
    """The set's keys: hashes of the contents of its blocks, for its own band and each larger one that a linked set may be in."""
    n = len(s)
    if not n:
        return np.zeros(0, _U)
    starts = band_starts(p, 1 << (2 * (n * p.den // p.num)).bit_length())
    j = int(np.searchsorted(starts, n, "right")) - 1
    out = []
    last = int(np.searchsorted(starts, n * p.den // p.num, "right")) - 1
    for band in range(j, last + 1):
        top = starts[band + 1] - 1
        r = 2 * top * (p.den - p.num) // (p.den + p.num)
        blocks = r + 1 + (r // 32 + 2 if r else 0)
        block = ((s >> _U(33)) % _U(blocks)).astype(np.int64)
        by = np.argsort(block, kind="stable")
        at = np.flatnonzero(np.r_[True, np.diff(block[by]) > 0])
        sums = np.zeros(blocks, _U)
        held = block[by][at]
        sums[held] = np.add.reduceat(_mix(s)[by], at)
        if blocks - len(held) < blocks - r:  # a common block that isn't empty is left
            use = held
        else:
            use = np.arange(blocks)
        out.append(_mix(_mix(sums[use]) + (use.astype(_U) << _U(12)) + _U(band)))
    return np.concatenate(out)


def point(s: np.ndarray) -> np.ndarray:
    groups = min(MOST_GROUPS, max(LEAST_GROUPS, 1 << (-(-len(s) // A_GROUP) - 1).bit_length() if len(s) else 0))
    return np.minimum(np.bincount((s & _U(groups - 1)).astype(np.int64), minlength=groups), FULL).astype(_COUNT)


def folded(points: list[np.ndarray]) -> np.ndarray:
    """The points as rows of as many groups as the smallest has."""
    groups = min(map(len, points), default=0)
    fold = lambda x: x if len(x) == groups else np.minimum(x.reshape(-1, groups).sum(0, dtype=np.int64), FULL).astype(_COUNT)
    return np.stack([fold(x) for x in points]) if points else np.zeros((0, LEAST_GROUPS), _COUNT)


def _unpacked(column: pa.Array) -> list[np.ndarray]:
    d = zs.ZstdDecompressor()
    return [np.frombuffer(d.decompress(x), _COUNT) for x in column.to_pylist()]


def may_link(minima: np.ndarray, n, m, p: JoinParams) -> np.ndarray:
    """Whether summed minima reach what a link needs; sets so large that a count may be at its limit always may."""
    return (minima.sum(1, dtype=np.int64) >= needed(n, m, p)) | (np.maximum(n, m) > FULL)


def needed(a, b, p: JoinParams):
    """Shingles that linked sets of a and b shingles share at least."""
    return -(-(a + b) * p.num // (p.num + p.den))


class RTree:
    """Bulk-loaded over points sorted by component, size and counts; each level holds maxima, least sizes and components."""

    def __init__(self, pts: np.ndarray, sizes: np.ndarray, comps: np.ndarray, p: JoinParams):
        self.p, self.order = p, np.lexsort((*(pts[:, i] for i in (2, 1, 0)), sizes, comps))
        hi, lo, c = pts[self.order], sizes[self.order], comps[self.order]
        self.levels = [(hi, lo, c)]
        while len(hi) > p.leaf:
            at = np.arange(0, len(hi), p.leaf)
            same = np.minimum.reduceat(c, at) == np.maximum.reduceat(c, at)
            hi, lo, c = np.maximum.reduceat(hi, at), np.minimum.reduceat(lo, at), np.where(same, c[at], -1)
            self.levels.append((hi, lo, c))

    def search(self, x: np.ndarray, n: int, comp: int) -> np.ndarray:
        """Numbers of the points outside the component whose summed minima reach what a link needs."""
        at = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            hi, lo, c = self.levels[level]
            at = at[c[at] != comp]
            at = at[may_link(np.minimum(hi[at], x), n, lo[at], self.p)]
            if level:
                at = (at[:, None] * self.p.leaf + np.arange(self.p.leaf)).reshape(-1)
                at = at[at < len(self.levels[level - 1][0])]
        return self.order[at]


def _read(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]


def _digests(p: JoinParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, small = zs.ZstdCompressor(level=3), zs.ZstdCompressor(level=1)
        for batch in slices(batches):
            texts = _read(batch)
            n, digests, points = [], [], []
            for t in texts:
                s = shingle_set(t, p.words)
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                points.append(small.compress(point(s).tobytes()) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(n, pa.int64()), *(pa.array(c, pa.binary()) for c in (digests, points, [z.compress(t) for t in texts]))], ["doc_id", "key", "n", "digest", "p", "z"])

    return run


def _key_rows(p: JoinParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zs.ZstdDecompressor()
        for batch in slices(batches, "z", 1 << 18):
            ks = [keys(shingle_set(d.decompress(z), p.words), p).view(np.int64) for z in batch.column("z").to_pylist()]
            cs = np.repeat(batch.column("cid").to_numpy(), [len(k) for k in ks])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ks)), pa.array(cs)], ["k", "cid"])

    return run


def _bounded(p: JoinParams):
    """Pairs whose summed minima reach what a link needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "pa"):
            ends = (_unpacked(batch.column(c)) for c in ("pa", "pb"))
            minima = np.fromiter((np.minimum(*folded([x, y])).sum(dtype=np.int64) for x, y in zip(*ends, strict=True)), np.int64, len(batch))
            ok = may_link(minima[:, None], batch.column("na").to_numpy(), batch.column("nb").to_numpy(), p)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok))

    return run


def _verified(p: JoinParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zs.ZstdDecompressor()
        for batch in slices(batches, "za", 1 << 18):
            ok = [linked(shingle_set(d.decompress(x), p.words), shingle_set(d.decompress(y), p.words), p) for x, y in zip(batch.column("za").to_pylist(), batch.column("zb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _units(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Runs of equal ``names``; rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        change = np.zeros(max(0, len(batch) - 1), bool)
        for c in names:
            v = batch.column(c)
            change |= pc.not_equal(v[1:], v[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(batch)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(s, e - s)
            if held and any(held[0].column(c)[0] != part.column(c)[0] for c in names):
                yield pa.Table.from_batches(held)
                held = []
            if e > s:
                held.append(part)
    if held:
        yield pa.Table.from_batches(held)
    give_back()


def _search(t: pa.Table, p: JoinParams) -> Iterator[tuple[int, np.ndarray]]:
    """A unit's rows of side 1 and 2, each with the rows of side 0 and 2 outside its component that the bound leaves."""
    n, comp, side = (t.column(c).to_numpy() for c in ("n", "comp", "side"))
    pts = folded(_unpacked(t.column("p")))
    inside, asking = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    if not len(inside) or not len(asking):
        return
    tree = RTree(pts[inside], n[inside], comp[inside], p)
    for i in asking:
        found = inside[tree.search(pts[i], n[i], comp[i])]
        found = found[(side[found] == 0) | (found > i)]
        if len(found):
            yield int(i), found


MARKED = "unit binary, cid long, n long, comp long, p binary, side int"


def _tree_marks(p: JoinParams):
    """The rows of each unit that have a point left on the other side, under a name that units of the same rows share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _units(batches, ["k", "u", "v"]):
            mark = np.zeros(len(t), bool)
            for i, found in _search(t, p):
                mark[i] = True
                mark[found] = True
            if mark.any():
                left = t.filter(pa.array(mark)).select(["cid", "n", "comp", "p", "side"]).sort_by("cid").combine_chunks()
                unit = xxhash.xxh3_128_digest(left.column("cid").to_numpy().tobytes() + left.column("side").to_numpy().tobytes())
                for batch in left.to_batches():
                    yield pa.RecordBatch.from_arrays([pa.array([unit] * len(batch), pa.binary()), *batch.columns], [c.split()[0] for c in MARKED.split(", ")])

    return run


class _Sets(OrderedDict):
    """Shingle sets by class, ``kept`` shingles in all at most, the least recently used go first."""

    def __init__(self, p: JoinParams):
        super().__init__()
        self.p, self.total, self.d = p, 0, zs.ZstdDecompressor()

    def of(self, cid: int, z: bytes) -> np.ndarray:
        if cid in self:
            self.move_to_end(cid)
            return self[cid]
        s = self[cid] = shingle_set(self.d.decompress(z), self.p.words)
        self.total += len(s)
        while self.total > self.p.kept and len(self) > 2:
            self.total -= len(self.popitem(last=False)[1])
        return s


def _merging_links(p: JoinParams):
    """Links between components of a unit; those that earlier links of the unit have merged are not compared again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(p)
        for t in _units(slices(batches, "z"), ["unit"]):
            cid, comp, z = t.column("cid").to_numpy(), t.column("comp").to_numpy(), t.column("z")
            root: dict[int, int] = {}

            def find(x: int, root=root) -> int:
                while root.setdefault(x, x) != x:
                    root[x] = x = root[root[x]]
                return x

            a, b = [], []
            for i, found in _search(t, p):
                x = None
                for j in found.tolist():
                    if find(int(comp[i])) == find(int(comp[j])):
                        continue
                    x = sets.of(int(cid[i]), z[i].as_py()) if x is None else x
                    if linked(x, sets.of(int(cid[j]), z[j].as_py()), p):
                        root[find(int(comp[i]))] = find(int(comp[j]))
                        a.append(int(cid[i]))
                        b.append(int(cid[j]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _dealt(named: DataFrame, p: JoinParams) -> DataFrame:
    """(k, u, v, cid, comp, n, side): the units of the open keys among ``named`` (k, cid, comp, n).

    Side 0 is searched, side 1 searches, side 2 does both.  A key's largest component is only searched.  Tile v of it meets
    every tile u >= 0 of the others in the unit (u, v); tiles of the others meet each other in units (-1 - i, j).  A key that is
    one tile of either is one unit.
    """
    counts = named.groupBy("k", "comp").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    keys_ = counts.groupBy("k").agg(F.max(F.struct("rows", "shingles", "comp")).alias("main"), F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"), F.count(F.lit(1)).alias("comps"))
    tiles = lambda rows, shingles: F.greatest(F.lit(1), F.ceil(rows / p.tile), F.ceil(shingles / p.weight)).cast("int")
    keys_ = keys_.where("comps > 1 and rows > 2").select("k", F.col("main.comp").alias("main"), tiles(F.col("main.rows"), F.col("main.shingles")).alias("vs"), tiles(F.col("rows") - F.col("main.rows"), F.col("shingles") - F.col("main.shingles")).alias("us"))
    rows = named.join(keys_, "k")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cid"), F.when(F.col("comp") == F.col("main"), F.col("vs")).otherwise(F.col("us"))).cast("int"))
    unit = lambda u, v, side: F.struct(u.cast("int").alias("u"), v.cast("int").alias("v"), side.cast("int").alias("side"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    own, zero = F.col("own"), F.lit(0)
    single = (F.col("us") == 1) & (F.col("vs") == 1)
    main = F.transform(upto(F.col("us")), lambda u: unit(u, own, zero))
    across = F.transform(upto(F.col("vs")), lambda v: unit(own, v, F.lit(1)))
    among = F.transform(upto(F.col("us")), lambda j: unit(-1 - F.least(own, j), F.greatest(own, j), F.when(j == own, 2).when(j > own, 0).otherwise(1)))
    units = F.when(F.col("comp") == F.col("main"), main).when(single, F.array(unit(zero, zero, F.lit(2)))).otherwise(F.concat(across, among))
    return rows.select("k", "cid", "comp", "n", F.explode(units).alias("w")).select("k", "w.u", "w.v", "cid", "comp", "n", "w.side")


def _grouped(docs: DataFrame, p: JoinParams) -> DataFrame:
    """doc_id, key, n, digest, comp and component_id for every row of ``docs`` (doc_id, text, key); comp is null without words."""
    rows = docs.mapInArrow(_digests(p), "doc_id long, key binary, n long, digest binary, p binary, z binary")
    rows = written(rows.withColumn("rid", F.monotonically_increasing_id()), "join-rows")
    # one row a class, the one of the least number
    classes = written(rows.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("one"), F.min("rid").alias("cid")), "join-classes")
    # texts and points are moved the same way at every size
    texts = lambda cids: rows.select(F.col("rid").alias("cid"), "z").join(cids.select("cid").hint("merge"), "cid", "left_semi")
    points = rows.select(F.col("rid").alias("cid"), "n", "p")

    by_key = Window.partitionBy("k").orderBy("cid")
    found = texts(classes).mapInArrow(_key_rows(p), "k long, cid long")
    near = found.withColumn("before", F.lag("cid").over(by_key)).withColumn("after", F.lead("cid").over(by_key))
    near = written(near.where("before is not null or after is not null"), "join-keys")
    edges = written(near.where("before is not null").select(F.col("before").alias("a"), F.col("cid").alias("b")).distinct(), "join-edges")
    active = edges.select(F.col("a").alias("cid")).union(edges.select("b")).distinct()
    live = written(points.join(active.hint("merge"), "cid", "left_semi"), "join-points")
    end = lambda t, x, *cols: t.select(F.col("cid").alias(x), *(F.col(c).alias(c + x) for c in cols)).hint("merge")
    pairs = edges.join(end(live, "a", "n", "p"), "a").join(end(live, "b", "n", "p"), "b").select("a", "b", "na", "nb", "pa", "pb").mapInArrow(_bounded(p), "a long, b long")
    pairs = written(pairs, "join-near")
    discard(edges)
    used = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    used = written(texts(used), "join-texts")
    links = pairs.join(end(used, "a", "z"), "a").join(end(used, "b", "z"), "b").select("a", "b", "za", "zb").mapInArrow(_verified(p), "a long, b long")
    links = written(links, "join-links")
    discard(pairs, used)

    comps = written(components(links), "join-components")
    state = live.select("cid", "n").join(comps, F.col("cid") == F.col("node"), "left").select("cid", "n", F.coalesce("root", "cid").alias("comp"))
    named = written(near.select("k", "cid").join(state, "cid"), "join-named")
    discard(near)
    dealt = _dealt(named, p).join(live.select("cid", "p").hint("merge"), "cid").repartition("k", "u", "v").sortWithinPartitions("k", "u", "v")
    marked = written(dealt.mapInArrow(_tree_marks(p), MARKED).dropDuplicates(["unit", "cid"]), "join-marked")
    discard(named, live)
    left = marked.join(rows.select(F.col("rid").alias("cid"), "z").hint("merge"), "cid").repartition("unit").sortWithinPartitions("unit")
    more = written(left.mapInArrow(_merging_links(p), "a long, b long").distinct(), "join-more")
    discard(marked)
    # the components so far are stars already, only new links are contracted
    all_comps = components(comps.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more))

    named = classes.join(all_comps, F.col("cid") == F.col("node"), "left").select("digest", "one", F.coalesce("root", "cid").alias("comp"))
    least = named.groupBy("comp").agg(F.min("one").alias("component_id"))
    named = written(named.join(least, "comp").select("digest", "comp", "component_id"), "join-named")
    discard(links, comps, more, classes)
    return rows.select("doc_id", "key", "n", "digest").join(named, "digest", "left")


def jaccard_components(docs: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """doc_id, n_shingles, component_id for every row; component_id is the least doc_id that links reach."""
    out = _grouped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(None).cast("binary").alias("key")), p)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """One row of each group of linked rows, with all its columns: the one with the least (doc_id, text digest), nulls last.

    Rows without words are linked to none and all stay.  Rows of equal doc_id and text share a key; where such a key is chosen,
    the least of its rows over all columns stays, by an aggregate with partial minima.
    """
    # the digest of doc_id and text; the id has no colon
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col("text"), F.lit(""))).cast("binary")))
    rows = _grouped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", key.alias("key")), p).select("doc_id", "key", "comp")
    first = rows.where("comp is not null").groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("r"))
    counts = rows.where("comp is not null").groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    kept = written(first.select(F.col("r.key").alias("key")).join(counts, "key"), "near-kept")
    alone = kept.where("copies = 1").select("key").unionAll(rows.where("comp is null").select("key").distinct())
    alone, several = written(alone, "near-alone"), written(kept.where("copies > 1").select("key"), "near-several")
    keyed = docs.withColumn("near_key__", key)
    one = keyed.join(alone, F.col("near_key__") == alone.key, "left_semi").select(*docs.columns)
    least = keyed.join(several, F.col("near_key__") == several.key, "left_semi").groupBy("near_key__").agg(F.min(F.struct(*docs.columns)).alias("r"))
    return one.unionAll(least.select("r.*"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
