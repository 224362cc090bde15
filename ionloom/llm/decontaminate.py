"""Operator 4: benchmark decontamination with SimHash windows of the items' sizes.

For every item length (in words) all windows of that many words are candidates if enough of their shingles occur in the
benchmark at all; with fewer, the similarity cannot reach the threshold, so this loses nothing.  A window's SimHash sums
the 128 signs of its shingles, each as often as it occurs.  Items of that length are indexed by 64 blocks of fingerprint bits: two
fingerprints within the radius differ in no more blocks than bits, so entries that agree on 28 blocks are all that can be within it, and
about one in a thousand others agrees on as many.  Survivors of the Hamming test are verified by the exact weighted-shingle similarity: the sum of the smaller
counts over the sum of the larger ones, at least 0.8.

A text with fewer words than the item is one clipped window, the whole text.  There is one a text and item length, so it needs
no fingerprint: an inverted index of the items' shingles counts what they share, and items that share enough are verified.

With 0.8 a pair's signs differ with probability 0.152, 19.4 bits on average (deviation 4.1); a radius of 36 misses about one
borderline pair in 50,000, and no copy.

Scale: one pass over the documents without a shuffle.  The benchmark goes to the tasks in blocks of ``block_items`` items and
``block_bytes`` of text at most, one pass and one broadcast of that bounded size for each block; an item whose texts fill several
blocks is merged by one aggregation of the hits.

Edge cases: null text on either side matches nothing; items with fewer words than a shingle are one shingle and must occur as
they are; an item_id gives one row a document, with the best window over all its texts; repeated documents are found one by one; a null doc_id stays null; extra columns are ignored by
``contaminated`` and kept by ``drop_contaminated``; empty tables give no matches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.llm.common import slices, table, written

HITS = "doc_id long, item_id long, similarity double, first_word long, n_words long"
FOUND = HITS + ", digest string"
_U = np.uint64


@dataclass(frozen=True)
class DecontaminationParams:
    words: int = 5
    threshold: float = 0.8
    radius: int = 36
    block_items: int = 50_000
    block_bytes: int = 16 << 20
    index_blocks: int = 64
    bitmap_log2: int = 22


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(text: str) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-word shingles in order; the words from place i on start at shingle i."""
    if len(h) < k:
        return np.zeros(0, _U)
    s = h[: len(h) - k + 1]
    for i in range(1, k):
        s = _mix(s) * _U(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i]
    return _mix(s + _U(k))


def signs(s: np.ndarray) -> np.ndarray:
    """The 128 signs of each shingle."""
    two = np.stack([_mix(s), _mix(s ^ _U(0x9E3779B97F4A7C15))], 1)
    return np.unpackbits(two.view(np.uint8), axis=1).astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Sign sums to two 64-bit words a row."""
    return np.packbits(sums > 0, axis=1).view(_U)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    x, y = Counter(a.tolist()), Counter(b.tolist())
    both = sum(min(n, y[k]) for k, n in x.items())
    return both / (len(a) + len(b) - both)


class BlockIndex:
    """Fingerprints by the values of their blocks of bits: for every block the entries in order of its value.

    Two fingerprints within the radius differ in that many blocks at most, so of ``blocks`` blocks at least ``blocks`` - radius agree.  Entries are
    counted over the query's value in every block; no entry within the radius has fewer, and few of the others have as many: with 64 blocks of
    2 bits a random entry agrees on 16 (deviation 3.5), and a radius of 36 asks for 28.
    """

    def __init__(self, prints: np.ndarray, radius: int, blocks: int = 64):
        self.prints, self.radius = prints, radius
        bits = np.unpackbits(prints.view(np.uint8), axis=1)
        # a radius as wide as the blocks asks for finer ones
        count = min(bits.shape[1], max(16, blocks, radius + 1))
        cuts = np.array_split(np.arange(bits.shape[1]), count)
        self.first = np.array([cut[0] for cut in cuts])
        self.shift = np.concatenate([np.arange(len(cut), dtype=np.uint8) for cut in cuts])  # blocks have 8 bits at most
        self.least, self.width = count - radius, 1 << max(map(len, cuts))
        values = self._values(prints)
        # postings of all blocks and values in one array, and where each begins
        order = np.argsort(values, axis=0, kind="stable")
        self.entries = order.T.ravel().astype(np.int32)
        ends = [np.searchsorted(v[o], np.arange(self.width + 1)) + i * len(prints) for i, (v, o) in enumerate(zip(values.T, order.T, strict=True))]
        self.begin = np.stack(ends)

    def _values(self, prints: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(prints.view(np.uint8), axis=1)
        return np.add.reduceat(bits << self.shift, self.first, axis=1, dtype=np.uint8)

    def candidates(self, prints: np.ndarray, room: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (queries, entries) that agree on enough blocks, for some queries at a time: ``room`` bounds what their postings take."""
        n, values, block = len(self.prints), self._values(prints), np.arange(len(self.first))
        step = max(1, room // (n * len(block)))
        for a in range(0, len(prints), step):
            v = values[a : a + step].astype(np.intp)
            if self.least <= 0:
                agree = np.ones(len(v) * n, bool)
            else:
                at, size = self.begin[block, v], self.begin[block, v + 1] - self.begin[block, v]
                per_query, size = size.sum(1), size.ravel()
                place = np.arange(size.sum()) + np.repeat(at.ravel() - np.r_[0, np.cumsum(size)[:-1]], size)
                agree = np.bincount(self.entries[place] + np.repeat(np.arange(len(v)) * n, per_query), minlength=len(v) * n) >= self.least
            q, e = np.divmod(np.flatnonzero(agree), n)
            yield q + a, e

    def search(self, prints: np.ndarray) -> list[tuple[int, int]]:
        """All (query, entry) pairs within the radius."""
        out = []
        for q, e in self.candidates(prints):
            near = np.bitwise_count(self.prints[e] ^ prints[q]).sum(1) <= self.radius
            out += zip(q[near].tolist(), e[near].tolist(), strict=True)
        return out


class ShingleIndex:
    """Items of one length by their distinct shingles."""

    def __init__(self, own: list[np.ndarray]):
        sets = [np.unique(s) for s in own]
        keys, items = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(keys, kind="stable")
        self.n, self.keys, self.items = len(sets), keys[order], items[order]

    def search(self, s: np.ndarray, least: int) -> np.ndarray:
        """Items that hold at least ``least`` of the shingles ``s``, repeated ones counted as often as they are in ``s``."""
        first, last = np.searchsorted(self.keys, s, "left"), np.searchsorted(self.keys, s, "right")
        found = [self.items[a:b] for a, b in zip(first, last, strict=True) if a < b]
        return np.flatnonzero(np.bincount(np.concatenate(found), minlength=self.n) >= least) if found else np.zeros(0, np.int64)


class Benchmark:
    """A block of items, grouped by their length in words."""

    def __init__(self, items: list[tuple[int, str]], p: DecontaminationParams):
        self.p, by = p, {}
        for item_id, text in items:
            h = word_hashes(text or "")
            if len(h):
                by.setdefault(len(h), []).append((item_id, shingles(h, min(p.words, len(h)))))
        self.by_length = {}
        for n, found in sorted(by.items()):
            prints = np.concatenate([fingerprints(signs(s).sum(0, keepdims=True)) for _, s in found])
            self.by_length[n] = ([i for i, _ in found], [s for _, s in found], BlockIndex(prints, p.radius, p.index_blocks))
        self.clipped = {n: ShingleIndex(own) for n, (_, own, _) in self.by_length.items() if n > p.words}
        self.sizes = sorted({min(p.words, n) for n in by})
        self.known = {k: np.unique(np.concatenate([s for n, (_, ss, _) in self.by_length.items() if min(p.words, n) == k for s in ss])) for k in self.sizes}
        self.bitmap = {}
        for k, s in self.known.items():
            self.bitmap[k] = np.zeros(1 << p.bitmap_log2, bool)
            self.bitmap[k][(s & _U((1 << p.bitmap_log2) - 1)).astype(np.int64)] = True

    def _hits(self, s: np.ndarray, k: int) -> np.ndarray:
        hit = self.bitmap[k][(s & _U((1 << self.p.bitmap_log2) - 1)).astype(np.int64)]
        at = np.flatnonzero(hit)
        if len(at):
            known = self.known[k]
            place = np.minimum(np.searchsorted(known, s[at]), len(known) - 1)
            hit[at] = known[place] == s[at]
        return hit

    def matches(self, text: str) -> list[tuple[int, float, int, int]]:
        """(item_id, similarity, first word, words) of the best window for every item that the text holds or is a part of."""
        h, p, out = word_hashes(text), self.p, []
        for k in self.sizes:
            s = shingles(h, k)
            hit = self._hits(s, k)
            if not hit.any():
                continue
            before = np.r_[0, np.cumsum(hit)]
            # only the places around hits get sign sums
            reach = max(n for n in self.by_length if min(p.words, n) == k)
            spots = np.flatnonzero(hit)
            breaks = np.flatnonzero(np.diff(spots) > reach)
            for first, last in zip(spots[np.r_[0, breaks + 1]], spots[np.r_[breaks, len(spots) - 1]], strict=True):
                lo, hi = max(0, int(first) - reach), min(len(s), int(last) + reach + 1)
                out += self._region(s, before, lo, hi, k)
            out += self._whole(s, int(before[-1]), k)
        best: dict[int, tuple[float, int, int]] = {}
        for item, sim, at, n in out:
            if item not in best or (-sim, at) < (-best[item][0], best[item][1]):
                best[item] = (sim, at, n)
        return [(i, *v) for i, v in sorted(best.items(), key=lambda x: str(x[0]))]

    def _whole(self, s: np.ndarray, hits: int, k: int) -> Iterator[tuple[int, float, int, int]]:
        """Items with more shingles than the text."""
        t = self.p.threshold
        for n, index in self.clipped.items():
            m = n - k + 1
            least = int(np.ceil((m + len(s)) * t / (1 + t) - 1e-9))
            if min(self.p.words, n) != k or len(s) >= m or hits < least:
                continue
            ids, own, _ = self.by_length[n]
            for e in index.search(s, least):
                sim = similarity(s, own[e])
                if sim >= t:
                    yield ids[e], sim, 0, len(s) + k - 1

    def _region(self, s: np.ndarray, before: np.ndarray, lo: int, hi: int, k: int, piece: int = 1 << 15) -> Iterator[tuple[int, float, int, int]]:
        for c in range(lo, hi, piece):
            reach = max(n for n in self.by_length if min(self.p.words, n) == k) - k + 1
            part = s[c : min(hi, c + piece + reach)]
            sums = np.concatenate([np.zeros((1, 128), np.int32), np.cumsum(signs(part), axis=0, dtype=np.int32)])
            for n, (ids, own, index) in self.by_length.items():
                if min(self.p.words, n) != k:
                    continue
                m = n - k + 1
                least = int(np.ceil(2 * m * self.p.threshold / (1 + self.p.threshold) - 1e-9))
                starts = np.arange(c, min(c + piece, hi - m + 1))
                starts = starts[before[starts + m] - before[starts] >= least] if len(starts) else starts
                if not len(starts):
                    continue
                prints = fingerprints(sums[starts - c + m] - sums[starts - c])
                for q, e in index.search(prints):
                    at = int(starts[q])
                    sim = similarity(s[at : at + m], own[e])
                    if sim >= self.p.threshold:
                        yield ids[e], sim, at, n


def _blocks(benchmark: DataFrame, p: DecontaminationParams) -> Iterator[tuple[list[tuple[int, str]], bool]]:
    """Items in blocks of a bounded number and bounded bytes (a longer text comes alone), and whether the block goes on with the last one's item.

    Repeated items count once.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where("text is not null").distinct().orderBy("item_id", "text")
    block: list[tuple[int, str]] = []
    size, goes_on = 0, False
    for r in items.toLocalIterator():
        more = len(r.text.encode("utf-8", "surrogatepass"))
        if block and (len(block) >= p.block_items or size + more > p.block_bytes):
            yield block, goes_on
            goes_on = r.item_id == block[-1][0]
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += more
    if block:
        yield block, goes_on


def _best_of_blocks(hits: DataFrame) -> DataFrame:
    """One row a document row and item where an item's texts lie in several blocks.

    A document row has no key, but rows of one doc_id and text match alike in every block: they are counted by block, and as many
    are left of the best window.
    """
    key = ["doc_id", "digest", "item_id"]
    each = F.struct((-F.col("similarity")).alias("worse"), "first_word", "n_words", "similarity")
    by_block = hits.groupBy(*key, "block").agg(F.min(each).alias("best"), F.count(F.lit(1)).alias("rows"))
    best = by_block.groupBy(*key).agg(F.min("best").alias("best"), F.max("rows").alias("rows"))
    rows = best.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return rows.select("doc_id", "item_id", "best.similarity", "best.first_word", "best.n_words")


def contaminated(docs: DataFrame, benchmark: DataFrame, p: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """A row for every document and item whose passage it holds, with the best window; other documents have none."""
    docs, spark, out, split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), docs.sparkSession, None, False
    for nr, (block, goes_on) in enumerate(_blocks(benchmark, p)):
        shared, split = spark.sparkContext.broadcast(block), split or goes_on

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = Benchmark(shared.value, p)
            for batch in slices(batches):
                rows = []
                for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    found = known.matches(t) if t else []
                    digest = xxhash.xxh3_128_hexdigest(t.encode("utf-8", "surrogatepass")) if found else ""
                    rows += [(d, *m, digest) for m in found]
                cols = zip(*rows, strict=True) if rows else [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in FOUND.split(", ")])

        part = docs.mapInArrow(run, FOUND).withColumn("block", F.lit(nr))
        out = part if out is None else out.unionAll(part)
    if out is None:
        return spark.createDataFrame([], HITS)
    return _best_of_blocks(out) if split else out.drop("digest", "block")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, p: DecontaminationParams = DecontaminationParams()) -> DataFrame:
    """The rows of ``docs`` that hold no item's passage, with all their columns."""
    schema, spark = docs.schema, docs.sparkSession
    for i, (block, _) in enumerate(_blocks(benchmark, p)):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = Benchmark(shared.value, p)
            for batch in slices(batches):
                yield batch.filter(pa.array([not (t and known.matches(t)) for t in batch.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
        if i % 8 == 7:
            docs = written(docs, "decontaminate")
    return docs


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
