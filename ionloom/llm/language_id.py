"""Operator 1: language identification with language-bitmask n-gram filters.

One Bloom filter a language, all bit-sliced into one array: position p holds a bitmask with bit l set if language l's
filter has p.  The AND of an n-gram's k positions is the bitmask of all languages that contain it.  A document's n-grams
are looked up at once; the popcounts per language are corrected for that language's false-positive rate f by
(hits - n f) / (1 - f), and the largest corrected count decides.  The score is its share of all corrected counts.

N-grams are ``n`` UTF-8 bytes of the lower-cased text with everything but letters as blanks.  A language's filter holds
the n-grams with a share of at least ``min_share`` in its training text and at least ``min_ratio`` of the largest share
in any language (foreign passages inside documents stay out that way).

Bounds: fitted on at most ``max_docs`` documents a language, picked in one pass by their ids, before texts move; a language keeps at most 1 / min_share n-grams, and the
filter has ``positions`` entries of 1, 2, 4 or 8 bytes (up to 64 languages, else ValueError).  Every text is scored over its
whole length, one Arrow batch at a time and a million n-grams of a text at a time, without a shuffle.

Edge cases: a null text, or one without a letter, gives ``und`` and score 0; ties go to the language first in order; if no
n-gram is known, or nothing could be learned, the first language or ``und`` with score 0.  Rows with null lang or null
doc_id are not learned from; of rows that repeat a doc_id one is.  Repeated rows are scored one by one; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.llm.common import fold, ids_and_texts, sample_ids, slices, table

_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_LETTER = re.compile(r"[^\W\d_]")
_KEEP = np.full(256, 32, np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class LanguageParams:
    n: int = 5
    positions_log2: int = 20
    min_share: float = 2e-5
    min_ratio: float = 0.2
    max_docs: int = 3000


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    masks: bytes
    width: int
    rates: tuple[float, ...]
    params: LanguageParams


def gram_blocks(text: str, n: int, size: int = 1 << 20) -> Iterator[np.ndarray]:
    """The text's n-grams of bytes, packed into 64-bit values, ``size`` at a time."""
    kept = _KEEP[np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)]
    for a in range(0, len(kept) - n + 1, size):
        b = kept[a : a + size + n - 1].astype(np.uint64)
        g = b[: len(b) - n + 1].copy()
        for i in range(1, n):
            g <<= np.uint64(8)
            g |= b[i : len(b) - n + 1 + i]
        yield g


def grams(text: str, n: int) -> np.ndarray:
    """All n-grams of the text."""
    return np.concatenate([np.zeros(0, np.uint64), *gram_blocks(text, n)])


def slots(g: np.ndarray, log2: int) -> list[np.ndarray]:
    return [((g * np.uint64(m)) >> np.uint64(64 - log2)).astype(np.int64) for m in _MIX]


def _count_batches(n: int, most: int = 1 << 20):
    def counted(lang: str, found: list[np.ndarray]) -> pa.RecordBatch:
        g, c = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(c.astype(np.int64))], ["lang", "g", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            by: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for g in gram_blocks(text, n):
                    by.setdefault(lang, []).append(g)
                    if sum(map(len, by[lang])) >= most and len(g) == most:  # within a very long text
                        yield counted(lang, by.pop(lang))
            for lang, found in by.items():
                yield counted(lang, found)

    return run


def fit(docs: DataFrame, params: LanguageParams = LanguageParams()) -> LanguageModel | None:
    """Learn from text and lang of the rows outside the held-out fold; None if there are none."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~fold(F.col("doc_id"), 4, 2))
    langs = tuple(sorted(r.lang for r in rows.select("lang").distinct().limit(65).collect()))
    if not langs:
        return None
    if len(langs) > 64:
        raise ValueError("a bitmask has room for 64 languages")
    picked = F.broadcast(sample_ids(rows, "lang", params.max_docs))  # ids only, 64 languages at most
    sample = rows.join(picked, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    counts = sample.select("lang", "text").mapInArrow(_count_batches(params.n), "lang string, g long, c long").groupBy("lang", "g").agg(F.sum("c").alias("c"))
    total = counts.groupBy("lang").agg(F.sum("c").alias("total"))
    shares = counts.join(F.broadcast(total), "lang").select("lang", "g", (F.col("c") / F.col("total")).alias("share")).where(F.col("share") >= params.min_share)
    top = shares.groupBy("g").agg(F.collect_list(F.struct("lang", "share")).alias("of"), F.max("share").alias("top"))
    kept = top.select("g", F.filter("of", lambda x: x.share >= params.min_ratio * F.col("top")).alias("of")).select("g", F.col("of.lang").alias("langs")).toPandas()
    width = next(w for w in (1, 2, 4, 8) if len(langs) <= 8 * w)
    masks = np.zeros(1 << params.positions_log2, f"u{width}")
    at = {x: i for i, x in enumerate(langs)}
    bits = np.array([sum(1 << at[x] for x in ls) for ls in kept["langs"]], np.uint64).astype(masks.dtype)
    g = kept["g"].to_numpy(np.int64).view(np.uint64)
    for s in slots(g, params.positions_log2):
        np.bitwise_or.at(masks, s, bits)
    fill = [float(((masks >> masks.dtype.type(i)) & masks.dtype.type(1)).mean()) for i in range(len(langs))]
    return LanguageModel(langs, masks.tobytes(), width, tuple(x ** len(_MIX) for x in fill), params)


def predictor(model: LanguageModel) -> callable:
    """A function from texts to (language, score) pairs."""
    p, langs = model.params, model.langs
    masks = np.frombuffer(model.masks, f"u{model.width}")
    rates, one = np.array(model.rates), masks.dtype.type(1)

    def counts(found: np.ndarray) -> np.ndarray:
        """How many of the masks have each language."""
        if model.width == 1:
            by = np.bincount(found, minlength=256)
            return np.array([by[(np.arange(256) >> i) & 1 == 1].sum() for i in range(len(langs))], float)
        return np.array([int(((found >> masks.dtype.type(i)) & one).sum()) for i in range(len(langs))], float)

    def of(text: str) -> tuple[str, float]:
        if not text or not _LETTER.search(text):
            return "und", 0.0
        hits, n = np.zeros(len(langs)), 0
        for g in gram_blocks(text, p.n):
            a, b, c = slots(g, p.positions_log2)
            hits, n = hits + counts(masks[a] & masks[b] & masks[c]), n + len(g)
        fixed = np.maximum((hits - n * rates) / (1 - rates), 0)
        k = int(fixed.argmax())
        return langs[k], float(fixed[k] / fixed.sum()) if fixed.sum() > 0 else 0.0

    return of


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = predictor(shared.value)
        for batch in slices(batches):
            ids, texts = ids_and_texts(batch)
            got = [of(t) for t in texts]
            yield pa.RecordBatch.from_arrays([ids, pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, fit(docs))
    return out.select("doc_id", fold(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
