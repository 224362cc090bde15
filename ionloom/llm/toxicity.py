"""Operator 9: toxicity by compression distance.

Zstandard dictionaries are trained, one on windows of ordinary text and one a tier on segments of toxic text.  A document
is cut into windows of about 64 bytes; each window is compressed once with the ordinary dictionary alone and once with
each toxic dictionary in front of it.  Since all share the ordinary part, the lengths differ only where toxic material
helps, so the saved bytes are the window's compression distance.  Mean, largest savings and the share of saving windows of every
tier go through a logistic curve that is calibrated on training rows; ``threshold`` turns the score into a verdict.

Toxic segments: words of toxic training windows with a gram that occurs in several toxic documents and in a smaller share of
ordinary ones.  ``tiers`` lists how many times smaller and the gram's bytes; the first tier has the plainest words, and the curve
weighs what the later ones save.  A window that several documents have counts for one of them only, which keeps copies of a
text from lifting its own words.  If no gram of a tier is marked, its dictionary is trained on all toxic windows; if there are
too few samples to train on, a dictionary holds their own bytes.

Bounds: the model is fitted on at most ``max_docs`` labelled documents and ``max_windows`` windows a class
(``ToxicityParams``).  Scoring covers every byte of every text, one Arrow batch at a time, without a shuffle.

Edge cases: null and empty texts score like a document without any saving.  Rows with a null label or null doc_id are not
learned from; of rows that repeat a doc_id one is.  Repeated rows are scored one by one.  Extra columns are ignored by ``score`` and kept by ``drop_toxic``.
Without labels of both classes every score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.llm.common import fold, ids_and_texts, sample_ids, slices, table, written


@dataclass(frozen=True)
class ToxicityParams:
    window: int = 64
    ordinary_dict: int = 8192
    toxic_dict: int = 4096
    level: int = 7
    max_docs: int = 4000
    max_windows: int = 100_000
    min_docs: int = 18
    #: share in toxic documents over that in ordinary ones, and bytes of a gram, for each toxic dictionary
    tiers: tuple[tuple[float, int], ...] = ((40.0, 5), (8.0, 5), (3.0, 6))
    threshold: float = 0.7


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: tuple[bytes, ...]
    weights: tuple[float, ...]
    params: ToxicityParams


def windows(text: str, size: int) -> list[bytes]:
    """Lower-cased words joined by single spaces, cut after the word that reaches ``size`` bytes; longer words are split."""
    out, cur, n = [], [], 0
    for w in text.lower().encode("utf-8", "surrogatepass").split():
        for part in (w,) if len(w) <= 4 * size else (w[i : i + size] for i in range(0, len(w), size)):
            cur.append(part)
            n += len(part) + 1
            if n >= size:
                out.append(b" " + b" ".join(cur))
                cur, n = [], 0
    if cur:
        out.append(b" " + b" ".join(cur))
    return out


def _compressor(dictionary: bytes, p: ToxicityParams) -> zs.ZstdCompressor:
    d = zs.ZstdCompressionDict(dictionary, dict_type=zs.DICT_TYPE_RAWCONTENT)
    c = zs.ZstdCompressionParameters.from_level(p.level, source_size=p.window + 20, dict_size=len(dictionary), write_content_size=0, write_dict_id=0, write_checksum=0, format=zs.FORMAT_ZSTD1_MAGICLESS)
    d.precompute_compress(compression_params=c)
    return zs.ZstdCompressor(dict_data=d, compression_params=c)


def savings(model: ToxicityModel) -> callable:
    """A function from windows to the bytes that each toxic dictionary saves in each, one row a dictionary."""
    a = _compressor(model.ordinary, model.params)
    tiers = [_compressor(x + model.ordinary, model.params) for x in model.toxic]

    def of(ws: list[bytes]) -> np.ndarray:
        plain = np.fromiter((len(a.compress(w)) for w in ws), np.float64, len(ws))
        return np.array([plain - np.fromiter((len(t.compress(w)) for w in ws), np.float64, len(ws)) for t in tiers]).reshape(len(tiers), len(ws))

    return of


def features(saved: np.ndarray) -> np.ndarray:
    """For each row of ``saved``: mean, largest, mean of the two largest, and shrunken sum of savings over 2 bytes."""
    n = saved.shape[1]
    if not n:
        return np.zeros(4 * len(saved))
    top = np.sort(saved, 1)[:, ::-1][:, :2]
    return np.stack([saved.mean(1), top[:, 0], top.mean(1), np.maximum(saved - 2, 0).sum(1) / (n + 5)], 1).reshape(-1)


def _matrix(model: ToxicityModel, texts: list[str | None], of: callable) -> np.ndarray:
    return np.array([features(of(windows(t or "", model.params.window))) for t in texts], float).reshape(-1, 4 * len(model.toxic))


def _scores(model: ToxicityModel, x: np.ndarray) -> np.ndarray:
    *w, const = model.weights
    return 1 / (1 + np.exp(-np.clip(x @ np.array(w) + const, -700, 700)))


def _features_batches(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = savings(model)
        for batch in slices(batches):
            ids, texts = ids_and_texts(batch)
            yield pa.RecordBatch.from_arrays([ids, pa.array(_matrix(model, texts, of).tolist(), pa.list_(pa.float64()))], ["doc_id", "f"])

    return run


def _score_batches(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = savings(model)
        for batch in slices(batches):
            ids, texts = ids_and_texts(batch)
            yield pa.RecordBatch.from_arrays([ids, pa.array(_scores(model, _matrix(model, texts, of)))], ["doc_id", "score"])

    return run


FEATURES = "doc_id long, f array<double>"


def _window_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for doc, t in zip(*ids_and_texts(batch), strict=True):
                if ws := windows(t, size):
                    yield pa.RecordBatch.from_arrays([pa.array(ws, pa.binary()), pa.array([doc.as_py()] * len(ws), pa.int64())], ["w", "doc"])

    return run


def toxic_segments(toxic: list[tuple[bytes, int]], ordinary: list[tuple[bytes, int]], ratio: float, gram: int, min_docs: int) -> list[bytes]:
    """Words with a marked gram of ``gram`` bytes; grams are counted once a document, over (window, document) pairs without repeated windows."""

    def grams(w: bytes) -> set[bytes]:
        return {w[i : i + gram] for i in range(len(w) - gram + 1)}

    def counted(pairs: list[tuple[bytes, int]]) -> tuple[Counter, int]:
        c, n = Counter(), 0
        for _, part in groupby(sorted(pairs, key=itemgetter(1)), itemgetter(1)):  # one document's grams at a time
            c.update(set().union(*(grams(w) for w, _ in part)))
            n += 1
        return c, max(1, n)

    (t, nt), (o, no) = counted(toxic), counted(ordinary)
    least = max(2, min(min_docs, nt // 30))
    marks = {g for g, k in t.items() if k >= least and k / nt >= ratio * (o[g] + 0.5) / no}
    out = []
    for w, _ in sorted(toxic):
        out += [s for x in w.split() if grams(s := b" " + x) & marks]
    return out


def _train(size: int, samples: list[bytes]) -> bytes:
    try:
        return zs.train_dictionary(size, samples).as_bytes()
    except zs.ZstdError:  # too few samples to train on: their own bytes
        return b"".join(dict.fromkeys(samples))[-size:]


def _dictionaries(toxic: list[tuple[bytes, int]], ordinary: list[tuple[bytes, int]], p: ToxicityParams) -> ToxicityModel:
    segments = [toxic_segments(toxic, ordinary, ratio, gram, p.min_docs) or [w for w, _ in toxic] for ratio, gram in p.tiers]
    return ToxicityModel(_train(p.ordinary_dict, [w for w, _ in ordinary]), tuple(_train(p.toxic_dict, x) for x in segments), (), p)


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps for a small ridge logistic regression; the last weight is the constant."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (q * (1 - q))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (y - q) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel | None:
    """Learn from labelled rows outside the held-out fold; None without both classes."""
    known = labels.where("toxic is not null and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("y")).dropDuplicates(["doc_id"])
    known = known.where(~fold(F.col("doc_id"), 3, 1))
    shares = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if len(shares) < 2:
        return None
    sample = F.broadcast(sample_ids(known, "y", params.max_docs))
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(sample, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    # dictionaries from three fifths of the sample, the curve from the rest, whose texts they haven't seen
    rows = written(rows.withColumn("curve", F.pmod(F.xxhash64("doc_id"), F.lit(5)) >= 3), "toxicity-sample")
    found = {}
    for y in (0, 1):
        cut = rows.where((F.col("y") == y) & ~F.col("curve")).select("doc_id", "text").mapInArrow(_window_rows(params.window), "w binary, doc long").groupBy("w").agg(F.min("doc").alias("doc"))
        found[y] = [(bytes(r.w), r.doc) for r in cut.orderBy(F.xxhash64("w"), "w").limit(params.max_windows).collect()]
    if not found[0] or not found[1]:
        return None
    model = _dictionaries(found[1], found[0], params)
    got = rows.where("curve").select("doc_id", "text").mapInArrow(_features_batches(model), FEATURES).join(sample, "doc_id").orderBy("doc_id", "f").toPandas()
    if got["y"].nunique() < 2:
        return None
    x, y = np.stack(got["f"].to_list()).astype(float), got["y"].to_numpy(float)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    w = logistic((x - mean) / scale, y)
    w = np.r_[w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum()]
    # the sample is even between the classes; the constant moves to their shares among all labelled rows
    w[-1] += np.log(shares[1] / shares[0]) - np.log(max(1, y.sum()) / max(1, (1 - y).sum()))
    return ToxicityModel(model.ordinary, model.toxic, tuple(map(float, w)), params)


def score(docs: DataFrame, model: ToxicityModel | None, threshold: float | None = None) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score >= threshold) for every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        out = docs.select("doc_id", F.lit(0.0).alias("score"))
        t = ToxicityParams.threshold if threshold is None else threshold
    else:
        t = model.params.threshold if threshold is None else threshold
        out = docs.mapInArrow(_score_batches(model), "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= t).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    if model is None:
        return docs
    t, schema = model.params.threshold, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = savings(model)
        for batch in slices(batches):
            keep = _scores(model, _matrix(model, batch.column("text").to_pylist(), of)) < t
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = score(docs, model)
    return out.select("doc_id", fold(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")
