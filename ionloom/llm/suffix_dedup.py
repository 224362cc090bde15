"""Operator 10: removal of repeated byte strings with a sampled suffix array.

Every byte that lies in a string of ``length`` bytes which also starts anywhere else is removed.

1. Rows are classed by the digest of their text.  A class with two rows or more is repeated as a whole.  One row a class goes on.
2. Of every window of ``length`` bytes the ``gram``-byte string with the least hash (the leftmost of equals) is the window's
   anchor.  Equal windows have their anchor at the same place, so only suffixes that start at anchors are sorted: about
   one in 70.  Anchors whose leading ``gram`` bytes, named by a 64-bit hash, occur once are dropped.
3. Each anchor left carries the bytes of the windows it stands for.  Sampled splitters range-partition these suffixes by
   their leading bytes, so equal leading bytes never cross a border.  A bucket sorts its suffixes, and the reversed bytes
   before them, by multikey quicksort over 8-byte words and takes the common prefixes of neighbours from both orders.  A
   window with o bytes before its anchor is repeated if another suffix shares o bytes to the left and length - o to the right:
   both have the same segment in both orders.
4. Runs of repeated windows become byte spans, are merged in each text and cut out.

Scale: texts move compressed; a text without a repeated anchor leaves after step 2.  Grams that are frequent in a sample of
the texts (``Hot``) are known to be repeated, so they skip the search for partners.  Their suffixes are cut into blocks of
``offset_block`` offsets and dealt by the core, the bytes that all windows of the block share; where a core is frequent too,
they are cut into single windows and dealt by the window, and windows that the sample holds twice are repeated for sure and
don't travel at all.  So a passage in a third of all texts fills no bucket.  The lists of frequent strings are bounded, the most
frequent first: a string that found no place in a list of m holds less than one row in m.  Classes are counted with
partial sums.

Edge cases: null text is empty; texts under ``length`` bytes lose nothing; repeated rows (also with equal or null doc_id) are
copies of each other; texts of any length are read in pieces of ``piece`` positions; extra columns are ignored by
``repeated_spans`` and kept by ``drop_repeated``.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ionloom.llm.common import discard, give_back, slices, table, written


#: Compressed bytes of the texts that are worked on together.
SLICE = 1 << 18


@dataclass(frozen=True)
class SuffixParams:
    length: int = 200
    gram: int = 64
    piece: int = 1 << 20
    bucket: int = 10_000
    sample: int = 64
    hot: int = 16
    most_hot: int = 10_000
    most_windows: int = 100_000
    offset_block: int = 9


@dataclass(frozen=True)
class Hot:
    """Frequent grams, frequent cores, and windows seen twice or more; cores and windows by their 128-bit digests."""

    grams: frozenset
    cores: frozenset
    windows: frozenset


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOW = np.uint64(0xFF)


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-byte strings, k a power of two, by doubling."""
    h, step = _BYTES[b], 1
    while step < k:
        h = h[:-step] * np.uint64(0x9E3779B97F4A7C15 + 2 * step) + h[step:]
        step *= 2
    return _mix(h)


def anchors(b: np.ndarray, p: SuffixParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hash, place, and the least and largest offset of the windows of every anchor of one piece."""
    w = p.length - p.gram + 1
    if len(b) < p.length:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
    h = gram_hashes(b, p.gram)
    n = len(h) - w + 1
    blocks = -(-len(h) // w)
    v = np.full(blocks * w, np.uint64(2**64 - 1))
    v[: len(h)] = h & ~_LOW
    v = v.reshape(blocks, w) | np.arange(w, dtype=np.uint64)
    right = np.minimum.accumulate(v, axis=1).reshape(-1)
    left = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    start = np.arange(n)
    a, z = left[:n], right[w - 1 : w - 1 + n]
    first = (a | _LOW) <= (z | _LOW)
    owner = np.where(first, start // w * w + (a & _LOW).astype(np.int64), (start + w - 1) // w * w + (z & _LOW).astype(np.int64))
    at = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    own, last = owner[at], np.r_[at[1:], n] - 1
    return h[own], own, own - last, own - at


def text_anchors(b: np.ndarray, p: SuffixParams) -> Iterator[tuple]:
    for c in range(0, max(0, len(b) - p.length + 1), p.piece):
        g, a, lo, hi = anchors(b[c : c + p.piece + p.length - 1], p)
        yield g, a + c, lo, hi


def _packed(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return a << 16 | lo << 8 | hi


def _unpack(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return x >> 16, x >> 8 & 0xFF, x & 0xFF


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, doc_id and packed text; of equal rows of a slice the first one."""
    c = zs.ZstdCompressor(level=1)
    for batch in slices(batches):
        seen, first = set(), []
        for row in zip(batch.column("key").to_pylist(), batch.column("doc_id").to_pylist(), strict=True):
            first.append(row not in seen)
            seen.add(row)
        batch = batch.filter(pa.array(first))
        z = pa.array([c.compress(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), z], ["key", "doc_id", "z"])


def _anchor_rows(p: SuffixParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zs.ZstdDecompressor()
        for batch in slices(batches, "z", SLICE):
            g, tid, x = [], [], []
            for t, z in zip(batch.column("tid").to_pylist(), batch.column("z").to_pylist(), strict=True):
                for gs, a, lo, hi in text_anchors(np.frombuffer(d.decompress(z), np.uint8), p):
                    g.append(gs.view(np.int64))
                    tid.append(np.full(len(a), t, np.int64))
                    x.append(_packed(a, lo, hi))
            if g:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (g, tid, x)], ["g", "tid", "x"])

    return run


def _blocks(a: int, lo: int, hi: int, p: SuffixParams) -> Iterator[tuple[int, int, int, int]]:
    """Blocks of an anchor's offsets: least and largest offset, and the place of the core, which every window of the block holds."""
    for s in range(lo - lo % p.offset_block, hi + 1, p.offset_block):
        e = s + p.offset_block - 1
        yield max(lo, s), min(hi, e), a - s, a - e + p.length


def _dealt(b: bytes, a: int, lo: int, hi: int, p: SuffixParams, hot: Hot) -> Iterator[tuple[bytes, int, int]]:
    """For an anchor with a frequent gram: the string to deal by, least and largest offset."""
    for low, high, first, last in _blocks(a, lo, hi, p):
        name = xxhash.xxh3_128_digest(b[first:last])
        if name not in hot.cores:
            yield name, low, high
        else:
            for o in range(low, high + 1):
                yield xxhash.xxh3_128_digest(b[a - o : a - o + p.length]), o, o


def _frequent_rows(p: SuffixParams, grams: frozenset):
    """Digests of the cores and windows at anchors with a frequent gram."""
    names = np.array(sorted(grams), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, digest = zs.ZstdDecompressor(), xxhash.xxh3_128_digest
        for batch in slices(batches, "z", SLICE):
            for z in batch.column("z").to_pylist():
                b = d.decompress(z)
                for g, *where in text_anchors(np.frombuffer(b, np.uint8), p):
                    hot = np.isin(g.view(np.int64), names)
                    places = list(zip(*(x[hot].tolist() for x in where), strict=True))
                    cores = [digest(b[first:last]) for a, lo, hi in places for _, _, first, last in _blocks(a, lo, hi, p)]
                    windows = [digest(b[a - o : a - o + p.length]) for a, lo, hi in places for o in range(lo, hi + 1)]
                    yield pa.RecordBatch.from_arrays([pa.array(cores + windows, pa.binary()), pa.array([True] * len(cores) + [False] * len(windows), pa.bool_())], ["name", "core"])

    return run


def _sure_spans(p: SuffixParams, hot: Hot):
    """Spans of the windows that the sample holds twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zs.ZstdDecompressor()
        for batch in slices(batches, "z", SLICE):
            for t, z, gs, xs in zip(*(batch.column(c).to_pylist() for c in ("tid", "z", "gs", "xs")), strict=True):
                if hot.grams.isdisjoint(gs):
                    continue
                b = d.decompress(z)
                found = sorted((x >> 16) - o for g, x in zip(gs, xs, strict=True) if g in hot.grams for name, o, _ in _dealt(b, x >> 16, x >> 8 & 0xFF, x & 0xFF, p, hot) if name in hot.windows)
                if found:
                    at = np.array(found, np.int64)
                    cuts = np.flatnonzero(np.diff(at) > 1)
                    start, stop = at[np.r_[0, cuts + 1]], at[np.r_[cuts, len(at) - 1]] + p.length
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(start), t, np.int64)), pa.array(start), pa.array(stop)], ["tid", "start", "stop"])

    return run


def _suffix_rows(p: SuffixParams, hot: Hot):
    """The bytes around each anchor, with its leading 8 bytes as a number; frequent grams as ``_dealt`` cuts them."""
    w = p.length - p.gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zs.ZstdDecompressor()
        for batch in slices(batches, "z", SLICE):
            for t, z, gs, xs in zip(*(batch.column(c).to_pylist() for c in ("tid", "z", "gs", "xs")), strict=True):
                b = d.decompress(z)
                rows = []
                for g, x in zip(gs, xs, strict=True):
                    a, lo, hi = x >> 16, x >> 8 & 0xFF, x & 0xFF
                    lead = int.from_bytes(b[a : a + 8], "big") - (1 << 63)
                    for name, lo, hi in _dealt(b, a, lo, hi, p, hot) if g in hot.grams else [(None, lo, hi)]:
                        if name not in hot.windows:
                            block = int.from_bytes(name[:8], "big", signed=True) if name else 0
                            rows.append((lead, g, block, t, a << 16 | lo << 8 | hi, b[a - hi : a], b[a : a - lo + p.length]))
                for i in range(0, len(rows), 5_000):
                    part = rows[i : i + 5_000]
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], SUFFIX_NAMES)

    assert w < 256, "offsets are kept in 8 bits"
    return run


SUFFIX_NAMES = ["lead", "g", "block", "tid", "x", "before", "after"]
SUFFIXES = "lead long, g long, block long, tid long, x long, before binary, after binary"


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of equally long byte rows by multikey quicksort: split by one 8-byte word, go on to the next among equals only."""
    n, width = rows.shape
    words = np.zeros((n, -(-width // 8) * 8), np.uint8)
    words[:, :width] = rows
    words = words.view(">u8").astype(np.uint64)
    order, live, seg = np.arange(n), np.arange(n), np.zeros(n, np.int64)
    for d in range(words.shape[1]):
        # live: places in order that are not settled yet; seg: the segment of equal prefixes each lies in
        key = words[order[live], d]
        by = np.lexsort((key, seg))
        order[live] = order[live][by]
        key, seg = key[by], seg[by]
        new = np.r_[True, (seg[1:] != seg[:-1]) | (key[1:] != key[:-1])]
        alone = new & np.r_[new[1:], True]
        seg = np.cumsum(new)[~alone]
        live = live[~alone]
        if not len(live):
            break
    return order


def _segments(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and for each place the common prefix with the row before it (0 at first)."""
    order = multikey_order(rows)
    s = rows[order]
    differ = s[1:] != s[:-1]
    common = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return order, np.r_[0, common]


def repeated_windows(before: list[bytes], after: list[bytes], lo: np.ndarray, hi: np.ndarray, p: SuffixParams) -> np.ndarray:
    """Matrix [suffix, offset]: True where the suffix's window with that offset is also the window of another."""
    n, w = len(before), p.length - p.gram + 1
    right = np.frombuffer(b"".join(x.ljust(p.length, b"\0") for x in after), np.uint8).reshape(n, p.length)
    left = np.frombuffer(b"".join(x.rjust(w - 1, b"\0") for x in before), np.uint8).reshape(n, w - 1)[:, ::-1]
    (by_right, right_lcp), (by_left, left_lcp) = _segments(right), _segments(left)
    out = np.zeros((n, w), bool)
    seg_r, seg_l = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for o in range(int(lo.min()), int(hi.max()) + 1):
        rows = np.flatnonzero((lo <= o) & (o <= hi))
        if len(rows) < 2:
            continue
        seg_r[by_right] = np.cumsum(right_lcp < p.length - o)
        seg_l[by_left] = np.cumsum(left_lcp < o)
        key = seg_r[rows] * (n + 1) + seg_l[rows]
        s = np.argsort(key, kind="stable")
        same = key[s][1:] == key[s][:-1]
        out[rows[s], o] = np.r_[same, False] | np.r_[False, same]
    return out


def _spans(tid: np.ndarray, x: np.ndarray, found: np.ndarray, p: SuffixParams) -> pa.RecordBatch:
    a = x >> 16
    edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    return pa.RecordBatch.from_arrays([pa.array(tid[row]), pa.array(a[row] - last), pa.array(a[row] - first + p.length)], ["tid", "start", "stop"])


def _bucket(p: SuffixParams):
    """Rows come sorted by lead, g and block; whole groups (of g and block) are taken together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def work(t: pa.Table) -> pa.RecordBatch:
            x = t.column("x").to_numpy()
            _, lo, hi = _unpack(x)
            found = repeated_windows(t.column("before").to_pylist(), t.column("after").to_pylist(), lo, hi, p)
            return _spans(t.column("tid").to_numpy(), x, found, p)

        for batch in batches:
            held.append(batch)
            if sum(len(b) for b in held) < p.bucket:
                continue
            t = pa.Table.from_batches(held)
            g, block = t.column("g").to_numpy(), t.column("block").to_numpy()
            change = np.flatnonzero((g[1:] != g[:-1]) | (block[1:] != block[:-1])) + 1
            if not len(change):
                continue
            cut = int(change[-1])
            yield work(t.slice(0, cut))
            held = t.slice(cut).combine_chunks().to_batches()
        if held:
            yield work(pa.Table.from_batches(held))
        give_back()

    return run


def _cut_rows(p: SuffixParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = zs.ZstdDecompressor()
        for batch in slices(batches, "z", SLICE):
            for key, z, spans in zip(*(batch.column(c).to_pylist() for c in ("key", "z", "spans")), strict=True):
                b = d.decompress(z)
                merged: list[list[int]] = []
                for s in sorted((s["start"], s["stop"]) for s in spans or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                kept, at = [], 0
                for s, e in merged:
                    kept.append(b[at:s])
                    at = e
                kept = b"".join((*kept, b[at:]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key], pa.binary()), pa.array([len(b)], pa.int64()), pa.array([len(b) - len(kept)], pa.int64()), pa.array([len(merged)], pa.int64()), pa.array([hashlib.sha256(kept).hexdigest()]), pa.array([kept.decode("utf-8", "ignore") if merged else None])],
                    CUT_NAMES,
                )

    return run


CUT_NAMES = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
CUT = "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"
_NOTHING = hashlib.sha256(b"").hexdigest()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", F.coalesce(F.col("text"), F.lit(""))).withColumn("key", F.unhex(F.sha2("text", 256)))


def _hot(sample: DataFrame, p: SuffixParams) -> Hot:
    """What is frequent in the sampled texts; three lists of bounded length."""
    grams = sample.mapInArrow(_anchor_rows(p), "g long, tid long, x long").groupBy("g").count()
    grams = frozenset(r.g for r in grams.where(F.col("count") >= p.hot).orderBy(F.desc("count"), "g").limit(p.most_hot).collect())
    if not grams:
        return Hot(grams, grams, grams)
    found = sample.mapInArrow(_frequent_rows(p, grams), "name binary, core boolean").groupBy("core", "name").count()
    found = written(found.where("count >= 2"), "suffix-frequent").orderBy(F.desc("count"), "name")
    cores = found.where(F.col("core") & (F.col("count") >= p.hot)).limit(p.most_hot).collect()
    windows = found.where(~F.col("core")).limit(p.most_windows).collect()
    return Hot(grams, frozenset(bytes(r.name) for r in cores), frozenset(bytes(r.name) for r in windows))


def repeated_spans(docs: DataFrame, p: SuffixParams = SuffixParams()) -> DataFrame:
    """One row a distinct text: key (its SHA-256), n_bytes, n_removed, n_spans, kept_sha256, and kept, the text that is left without
    partly cut characters (null if nothing was cut)."""
    spark = docs.sparkSession
    rows = _keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    classes = rows.groupBy("key").agg(F.min("doc_id").alias("one"), F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("text")).cast("long").alias("n_bytes"))
    classes = written(classes, "suffix-classes")
    # by key and doc_id, so that the copies of one text are dealt out evenly
    small = rows.mapInArrow(_compress, "key binary, doc_id long, z binary")
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias("id")
    ones = small.select("key", name("doc_id"), "z").join(classes.select("key", name("one")), ["key", "id"], "left_semi")
    # rows of one text under one id (or none) are one row; they lie in one partition already
    ones = ones.dropDuplicates(["key", "id"])
    texts = written(ones.select("key", F.monotonically_increasing_id().alias("tid"), "z"), "suffix-texts")

    found = texts.select("tid", "z").mapInArrow(_anchor_rows(p), "g long, tid long, x long")
    hot = _hot(texts.where(F.pmod(F.xxhash64("key"), F.lit(p.sample)) == 0).select("tid", "z"), p)
    known = F.broadcast(spark.createDataFrame([(g, True) for g in sorted(hot.grams)], "g long, hot boolean"))  # most_hot rows at most
    found = found.join(known, "g", "left").select("g", "tid", "x", F.col("hot").isNotNull().alias("hot"))
    # a hot gram is repeated for sure; a salt keeps its rows apart
    salt = F.when(F.col("hot"), F.col("tid")).otherwise(F.lit(0).cast("long"))
    pairs = found.withColumn("salt", salt).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g", "salt"))).where("n >= 2 or hot")
    per_text = pairs.groupBy("tid").agg(F.collect_list("g").alias("gs"), F.collect_list("x").alias("xs"))
    live = written(texts.join(per_text, "tid"), "suffix-live")
    discard(texts)

    wide = live.select("tid", "z", "gs", "xs").mapInArrow(_suffix_rows(p, hot), SUFFIXES)
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sorted_rows = wide.repartitionByRange(n, "lead", "g", "block").sortWithinPartitions("lead", "g", "block")
    spans = sorted_rows.mapInArrow(_bucket(p), "tid long, start long, stop long")
    if hot.windows:
        spans = spans.unionAll(live.select("tid", "z", "gs", "xs").mapInArrow(_sure_spans(p, hot), "tid long, start long, stop long"))
    spans = spans.groupBy("tid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    cut = live.select("tid", "key", "z").join(spans, "tid").select("key", "z", "spans").mapInArrow(_cut_rows(p), CUT)
    whole = (F.col("copies") >= 2) & (F.col("n_bytes") >= p.length)
    # classes of several rows are repeated as a whole or too short, so their cuts, one for each repeated row, aren't needed
    cut = cut.drop("n_bytes").withColumnRenamed("key", "k")
    return classes.join(cut, (F.col("key") == F.col("k")) & (F.col("copies") == 1), "left").select(
        "key", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(whole, F.lit(_NOTHING)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )


def drop_repeated(docs: DataFrame, p: SuffixParams = SuffixParams()) -> DataFrame:
    """``docs`` with repeated strings cut out of text (partly cut characters go too) and n_chars, if there, counted anew."""
    out = written(repeated_spans(docs, p).where("n_removed > 0").select("key", "kept"), "suffix-kept")
    row = F.struct(*docs.columns)  # the columns stay together, so their names can't clash
    rows = docs.select(row.alias("row"), F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("key")).join(out, "key", "left")
    cols = {c: F.col("row").getField(c) for c in docs.columns}
    cols["text"] = F.coalesce("kept", cols["text"])
    if "n_chars" in cols:
        cols["n_chars"] = F.when(F.col("kept").isNull(), cols["n_chars"]).otherwise(F.length("kept")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*(c.alias(name) for name, c in cols.items()))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _keyed(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = written(repeated_spans(docs.select("doc_id", "text")).drop("kept"), "suffix-found")
    whole = F.lower(F.hex("key"))
    return docs.select("doc_id", "key").join(found, "key").select("doc_id", "n_bytes", "n_removed", "n_spans", F.coalesce("kept_sha256", whole).alias("kept_sha256"))
