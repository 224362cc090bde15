"""Operator 3: hierarchical packing of token streams into windows of several lengths.

Every document is tokenised and closed by ``end_id``.  Whole windows of the longest tier are cut off first; what is left of a
document is routed to the shortest tier that holds it.  Then each tier is packed, longest first: an item opens a window,
the gap takes the longest waiting items of this and shorter tiers that fit, and a last gap is closed by cutting a piece
off a waiting item, whose rest is routed again.  So every window is full and its length is a power of two.  Windows of a
tier are dealt to step groups that hold ``group_tokens`` tokens each.

Scale: the work is one pass over the input partitions, without a shuffle; a task holds at most ``buffer_tokens`` waiting
tokens and a bounded cache of words.  Only the tail of a task makes windows below the shortest tier (powers of two).

Edge cases: null text is empty and yields the single token ``end_id``; repeated rows are packed once each; a null doc_id
stays null; extra columns are ignored; an empty table gives no rows.  Texts of any length are cut into whole windows.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.llm.common import ids_and_texts, slices, table

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, window int, step_group long"


@dataclass(frozen=True)
class PackingParams:
    ranks: str = "byte_bpe_50k.tiktoken"
    #: the same vocabulary with its added tokens, which stand for themselves in a text
    added: str = "byte_bpe_50k.json"
    tiers: tuple[int, ...] = (1024, 512, 256, 128, 64)
    end_id: int = 0
    buffer_tokens: int = 1 << 20
    group_tokens: int = 1 << 15
    cached_words: int = 400_000


def added_tokens(path: str) -> dict[str, int]:
    """Content and id of the vocabulary's added tokens."""
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def word_encoder(ranks_path: str, cached: int, added: dict[str, int] | None = None) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit values.

    Added tokens are cut out first and get their ids.  The pre-tokenizer never joins characters across a space that is followed by a non-space character, so a text is
    encoded chunk by chunk there, and chunks are looked up in a bounded cache.
    """
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    odd, cut = re.compile(r" (?:\s|\Z)"), re.compile(r" (?=\S)")
    cache: dict[str, bytes] = {}

    def ids(s: str) -> bytes:
        return array("I", encode(s)).tobytes()

    class Known(dict):
        def __missing__(self, w: str) -> bytes:
            got = ids(" " + w)
            if len(w) <= 40:
                if len(self) >= cached:
                    self.clear()
                self[w] = got
            return got

    cache = Known()

    def plain(text: str) -> bytes:
        if not text:
            return b""
        first, *rest = cut.split(text) if odd.search(text) else text.split(" ")
        if not first and rest:  # a text that begins with a space
            return b"".join(map(cache.__getitem__, rest))
        return ids(first) + b"".join(map(cache.__getitem__, rest))

    if not added:
        return plain
    known = {w: array("I", [i]).tobytes() for w, i in added.items()}
    apart = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def of(text: str) -> bytes:
        parts = apart.split(text)
        return plain(text) if len(parts) == 1 else b"".join(known[x] if i % 2 else plain(x) for i, x in enumerate(parts))

    return of


class Packer:
    """Packs items of one task; ``take`` and ``close`` yield finished windows as (length, pieces)."""

    def __init__(self, p: PackingParams):
        self.p, self.waiting, self.tokens = p, [[] for _ in p.tiers], 0

    def _route(self, n: int) -> int:
        return max(i for i, t in enumerate(self.p.tiers) if n <= t)

    def _put(self, item: tuple) -> None:
        """item: (length, order, row, start); the order makes ties repeatable."""
        insort(self.waiting[self._route(item[0])], item)
        self.tokens += item[0]

    def _best(self, gap: int, tier: int) -> tuple | None:
        """The longest waiting item of this or a shorter tier that fits."""
        for i in range(tier, len(self.waiting)):
            k = bisect_right(self.waiting[i], (gap, float("inf")))
            if k:
                self.tokens -= self.waiting[i][k - 1][0]
                return self.waiting[i].pop(k - 1)
        return None

    def _longer(self) -> tuple | None:
        """A waiting item to cut: the longest of the shortest tier that has any."""
        for w in reversed(self.waiting):
            if w:
                self.tokens -= w[-1][0]
                return w.pop()
        return None

    def take(self, row: int, n: int) -> Iterator[tuple]:
        top, start = self.p.tiers[0], 0
        while n - start >= top:
            yield top, [(row, start, top)]
            start += top
        if start < n:
            self._put((n - start, row, row, start))

    def flush(self) -> Iterator[tuple]:
        for tier, size in enumerate(self.p.tiers):
            while self.waiting[tier] and self.tokens >= size:
                yield size, self._fill(size, tier)

    def _fill(self, size: int, tier: int) -> list[tuple]:
        gap, pieces = size, []
        while gap:
            if (item := self._best(gap, tier)) is None:
                n, order, row, start = self._longer()  # longer than the gap
                self._put((n - gap, order, row, start + gap))
                item = (gap, order, row, start)
            pieces.append((item[2], item[3], item[0]))
            gap -= item[0]
        return pieces

    def close(self) -> Iterator[tuple]:
        yield from self.flush()
        while self.tokens:
            size = min(self.p.tiers[0], 1 << (self.tokens.bit_length() - 1))
            yield size, self._fill(size, 0)


def _pack_batches(p: PackingParams, ranks_path: str, added: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, packer, held, n_rows, n_windows = word_encoder(ranks_path, p.cached_words, added), Packer(p), {}, 0, 0
        per_tier: dict[int, int] = {}
        end = array("I", [p.end_id]).tobytes()
        tier_no = {1 << k: k for k in range(32)}

        def table_of(windows: Iterator[tuple]) -> pa.RecordBatch | None:
            nonlocal n_windows
            cols: list[list] = [[] for _ in range(9)]
            for size, pieces in windows:
                offset, seq = 0, part << 40 | n_windows
                k = per_tier[size] = per_tier.get(size, -1) + 1
                group = part << 40 | tier_no[size] << 34 | k // max(1, p.group_tokens // size)
                n_windows += 1
                for row, start, n in pieces:
                    doc_id, ids = held[row]
                    for c, v in zip(cols, (doc_id, start, n, ids[4 * start : 4 * (start + n)], len(ids) // 4, seq, offset, size, group), strict=True):
                        c.append(v)
                    offset += n
            if not cols[0]:
                return None
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = [c.split()[0] for c in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for batch in slices(batches):
            ids, texts = ids_and_texts(batch)
            for doc_id, text in zip(ids.to_pylist(), texts, strict=True):
                held[n_rows] = (doc_id, encode(text) + end)
                n = len(held[n_rows][1]) // 4
                if n >= p.tiers[0] and (out := table_of(packer.take(n_rows, n))):
                    yield out
                elif n < p.tiers[0]:
                    for _ in packer.take(n_rows, n):
                        pass
                n_rows += 1
            if packer.tokens >= p.buffer_tokens:
                if out := table_of(packer.flush()):
                    yield out
                alive = {item[2] for w in packer.waiting for item in w}
                held = {r: held[r] for r in alive}
            elif len(held) > sum(map(len, packer.waiting)):
                alive = {item[2] for w in packer.waiting for item in w}
                held = {r: held[r] for r in alive}
        if out := table_of(packer.close()):
            yield out

    return run


def pack(docs: DataFrame, params: PackingParams = PackingParams(), ranks_path: str | None = None) -> DataFrame:
    """Pieces of all documents with their ids, window, place in the window and step group."""
    path = ranks_path or public_tokenizers.path(params.ranks)
    added = added_tokens(public_tokenizers.path(params.added))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_pack_batches(params, path, added), PIECES)


def with_crc(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "step_group")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_crc(pack(table(spark, sf_dir, "documents")))
