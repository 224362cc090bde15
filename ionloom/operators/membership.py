"""Known targets by a blocked Bloom filter in front of the exact lookup.

The filter is a table: one row for each block of 4,096 bits, built by ``bit_or``, which merges before and after the shuffle.  A key has one block
and five bits of it.  Rows that the filter rules out are no targets; only the others meet the targets, and these are few, so the targets
need no shuffle: they are probed by what is left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionloom.operators.candidates import without_targets

WORDS = 64
BITS = WORDS * 64
#: Bits that a key sets, from slices of one hash.
HASHES = 5
BITS_PER_KEY = 12
#: Filters up to this size (some 45 million keys) go to all tasks; beyond it the exact join does all the work.
MAX_BYTES = 64 << 20


@dataclass(frozen=True)
class TargetFilter:
    """``rows``: block long, words array<long>; blocks that no key has may be missing."""

    rows: DataFrame
    blocks: int

    @property
    def bytes(self) -> int:
        return self.blocks * WORDS * 8


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS_PER_KEY // BITS))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def _places(key: Column) -> list[Column]:
    h = F.xxhash64(key)
    return [F.shiftrightunsigned(h, 12 * i).bitwiseAND(F.lit(BITS - 1)).cast("int") for i in range(HASHES)]


def build_filter(targets: DataFrame, key: str = "sequence", blocks: int | None = None) -> TargetFilter:
    """The filter of the keys; null keys are left out, as they equal nothing."""
    keys = targets.where(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    blocks = blocks or blocks_for(keys.count())
    bits = keys.select(_block(F.col("key"), blocks).alias("block"), F.explode(F.array(*_places(F.col("key")))).alias("place"))
    words = bits.groupBy("block", F.expr(f"place div {WORDS}").cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, place % {WORDS})")).alias("bits"))
    by_block = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("found"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.try_element_at("found", w), F.lit(0).cast("long")))
    return TargetFilter(by_block.select("block", filled.alias("words")), blocks)


def probed(rows: DataFrame, known: TargetFilter, key: str = "sequence", mark: str = "maybe_target") -> DataFrame:
    """``rows`` with ``mark``: false only where the key is no target.  Nothing is shuffled; the filter's size must have been checked."""
    table = known.rows.select(F.col("block").alias("_filter_block"), F.col("words").alias("_filter_words"))
    hit = F.lit(True)
    for place in _places(F.col(key)):
        hit = hit & (F.getbit(F.get("_filter_words", F.floor(place / WORDS).cast("int")), place % WORDS) == 1)
    joined = rows.withColumn("_filter_block", _block(F.col(key), known.blocks)).join(F.broadcast(table), "_filter_block", "left")
    return joined.withColumn(mark, F.coalesce(hit, F.lit(False))).drop("_filter_block", "_filter_words")


def _split(rows: DataFrame, targets: DataFrame, known: TargetFilter, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows that are no targets by the filter, the others, and the targets among the others' keys."""
    marked = probed(rows, known, key)
    maybe = marked.where("maybe_target").drop("maybe_target")
    return marked.where("not maybe_target").drop("maybe_target"), maybe, targets.select(key).join(maybe.select(key).distinct(), key, "left_semi")


def without_known(rows: DataFrame, targets: DataFrame, known: TargetFilter, key: str = "sequence") -> DataFrame:
    """As ``without_targets``: rows whose key is no target; repeated rows and null keys stay.

    ``rows`` are read three times, so costly ones are to be written before.
    """
    if known.bytes > MAX_BYTES:
        return without_targets(rows, targets, key)
    clear, maybe, found = _split(rows, targets, known, key)
    return clear.unionByName(without_targets(maybe, found, key))


def only_known(rows: DataFrame, targets: DataFrame, known: TargetFilter, key: str = "sequence") -> DataFrame:
    """Rows whose key is a target."""
    if known.bytes > MAX_BYTES:
        return rows.join(targets.select(key), key, "left_semi")
    _, maybe, found = _split(rows, targets, known, key)
    return maybe.join(found, key, "left_semi")
