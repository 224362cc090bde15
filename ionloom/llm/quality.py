"""Operator 5: quality scores from random-indexing word vectors and a two-layer network.

Tokens are runs of letters, digits or other marks.  The vocabulary holds the tokens that occur at least ``min_count`` times
in the training sample, ``vocab`` at most; any other token stands for its shape (capitals, title, lower, digits, marks),
whose vector is mixed with one of ``rare`` index vectors, chosen by the token, so that repeats of a rare word show.
Every vocabulary entry has a sparse random index vector with ``nonzero`` entries of +1 or -1; its word vector is the sum of
the index vectors of its neighbours within ``window`` tokens in the sample, plus its own, scaled to unit length.

A document is pooled over all its tokens: the mean word vector, the mean products of neighbouring word vectors, and of
those two apart (which show repetition), and two length terms.  A numpy network with one hidden layer gives a logit; the temperature that minimises the
loss on a part of the sample kept out of training calibrates the probability.

Bounds: fitted on at most ``max_docs`` labelled documents a class; vectors and network have a fixed size.  Scoring covers
every text to its end, one Arrow batch at a time, without a shuffle.

Edge cases: null and empty texts are scored from their length terms and zero vectors.  Rows with a null label or doc_id are not
learned from; without documents of both classes every score is the share of label 1, or 0.5.  Of rows that repeat a doc_id one is learned from.  Repeated rows are scored one
by one; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.llm.common import fold, ids_and_texts, sample_ids, slices, table, written

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
SHAPES = ("\0UP", "\0Title", "\0low", "\0num", "\0mark")
_BLOCK = 1 << 18


@dataclass(frozen=True)
class QualityParams:
    dims: int = 32
    nonzero: int = 4
    window: int = 2
    vocab: int = 30_000
    min_count: int = 20
    max_docs: int = 6000
    rare: int = 2048
    hidden: int = 32
    epochs: int = 60
    threshold: float = 0.3
    seed: int = 7


@dataclass(frozen=True)
class QualityModel:
    words: tuple[str, ...]
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float
    params: QualityParams


def shape(token: str) -> str:
    c = token[0]
    if c.isalpha():
        return SHAPES[0] if len(token) > 1 and token.isupper() else SHAPES[1] if c.isupper() else SHAPES[2]
    return SHAPES[3] if c.isdigit() else SHAPES[4]


class _Numbers(dict):
    """Token to vocabulary number; unknown tokens get the number of their shape, or one of ``rare`` numbers of that shape."""

    def __init__(self, words: tuple[str, ...], rare: int = 0, most: int = 500_000):
        super().__init__((w, i) for i, w in enumerate(words))
        self.first, self.rare, self.most = dict(self), rare, most

    def __missing__(self, token: str) -> int:
        n = self.first[shape(token)]
        if self.rare:
            n = len(self.first) + n * self.rare + zlib.crc32(token.encode("utf-8", "surrogatepass")) % self.rare
        if len(token) <= 40:
            if len(self) >= self.most:
                self.clear()
                self.update(self.first)
            self[token] = n
        return n


def numbers_of(text: str, known: _Numbers) -> np.ndarray:
    found = _TOKEN.findall(text)
    return np.fromiter(map(known.__getitem__, found), np.int32, len(found))


def pooled(ids: np.ndarray, vectors: np.ndarray, n_chars: int) -> np.ndarray:
    """The document's features; long texts are summed block by block."""
    d = vectors.shape[1]
    out = np.zeros(2 * d + 4, np.float32)
    for i in range(0, len(ids), _BLOCK):
        v = vectors[ids[i : i + _BLOCK + 2]]
        out[:d] += v[:_BLOCK].sum(0)
        out[d : 2 * d] += np.einsum("ij,ij->j", v[: min(len(v) - 1, _BLOCK)], v[1 : _BLOCK + 1])
        if len(v) > 2:
            out[2 * d] += np.einsum("ij,ij->", v[: min(len(v) - 2, _BLOCK)], v[2:])
    out[:d] /= max(1, len(ids))
    out[d : 2 * d] /= max(1, len(ids) - 1)
    out[2 * d] /= max(1, len(ids) - 2)
    out[2 * d + 1] = out[d : 2 * d].sum()
    out[2 * d + 2] = np.log1p(len(ids))
    out[2 * d + 3] = np.log1p(n_chars / max(1, len(ids)))
    return out


def with_rare(vectors: np.ndarray, p: QualityParams) -> np.ndarray:
    """Below the vocabulary's vectors, for each shape ``rare`` vectors: the shape's plus an index vector of the number's own."""
    own = np.random.default_rng(p.seed + 1).normal(size=(p.rare, vectors.shape[1]))
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    both = vectors[: len(SHAPES), None, :] + own[None]
    both /= np.maximum(1e-9, np.linalg.norm(both, axis=2, keepdims=True))
    return np.concatenate([vectors, both.reshape(-1, vectors.shape[1])]).astype(np.float32)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        c = Counter()
        for t in ids_and_texts(batch)[1]:
            c.update(_TOKEN.findall(t))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["w", "c"])


def index_vectors(words: tuple[str, ...], p: QualityParams) -> np.ndarray:
    r = np.random.default_rng(p.seed)
    out = np.zeros((len(words), p.dims), np.float32)
    for _ in range(p.nonzero):
        out[np.arange(len(words)), r.integers(0, p.dims, len(words))] += r.choice(np.array([-1, 1], np.float32), len(words))
    return out


def _context_sums(words: tuple[str, ...], p: QualityParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, index = _Numbers(words), index_vectors(words, p)
        total = np.zeros_like(index)
        for batch in slices(batches):
            for t in ids_and_texts(batch)[1]:
                ids = numbers_of(t, known)
                for k in range(1, p.window + 1):
                    if len(ids) > k:
                        np.add.at(total, ids[k:], index[ids[:-k]])
                        np.add.at(total, ids[:-k], index[ids[k:]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    return run


def _pool_batches(words: tuple[str, ...], vectors: np.ndarray, rare: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Numbers(words, rare)
        for batch in slices(batches):
            ids, texts = ids_and_texts(batch)
            yield pa.RecordBatch.from_arrays([ids, pa.array([pooled(numbers_of(t, known), vectors, len(t)).tobytes() for t in texts], pa.binary())], ["doc_id", "x"])

    return run


def train_network(x: np.ndarray, y: np.ndarray, p: QualityParams):
    """Adam on the log loss with classes weighted evenly in the batches as they come; returns the weights."""
    r = np.random.default_rng(p.seed)
    n, d = x.shape
    w = [r.normal(0, (2 / d) ** 0.5, (d, p.hidden)), np.zeros(p.hidden), r.normal(0, (1 / p.hidden) ** 0.5, p.hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for epoch in range(p.epochs):
        order, rate = r.permutation(n), 3e-3 * (0.95**epoch)
        for i in range(0, n, 128):
            k = order[i : i + 128]
            h = x[k] @ w[0] + w[1]
            a = np.maximum(h, 0)
            q = 1 / (1 + np.exp(-np.clip(a @ w[2] + w[3], -30, 30)))
            dz = (q - y[k]) / len(k)
            dh = np.outer(dz, w[2]) * (h > 0)
            step += 1
            for j, g in enumerate((x[k].T @ dh + 1e-4 * w[0], dh.sum(0), a.T @ dz + 1e-4 * w[2], np.array([dz.sum()]))):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                w[j] -= rate * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.999**step)) + 1e-8)
    return w


def logits(x: np.ndarray, w) -> np.ndarray:
    return np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3]


def best_temperature(z: np.ndarray, y: np.ndarray) -> float:
    def loss(t: float) -> float:
        s = z / t
        return float(np.mean(np.logaddexp(0, s) - y * s))

    return min(np.exp(np.linspace(-1.5, 2.5, 161)), key=loss)


def fit(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> QualityModel | float:
    """The model, or the constant score where the labels don't have both classes."""
    known = labels.where("quality is not null and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("y")).dropDuplicates(["doc_id"])
    known = known.where(~fold(F.col("doc_id"), 5, 0))
    shares = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if len(shares) < 2:
        return float(next(iter(shares), 0.5))
    ids = F.broadcast(sample_ids(known, "y", params.max_docs))
    rows = docs.select("doc_id", "text").join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    sample = written(rows.repartition(12, F.xxhash64("doc_id")), "quality-sample")
    texts = sample.select("doc_id", "text")
    top = texts.mapInArrow(_word_counts, "w string, c long").groupBy("w").agg(F.sum("c").alias("c")).where(F.col("c") >= params.min_count).orderBy(F.desc("c"), "w").limit(params.vocab)
    words = (*SHAPES, *(r.w for r in top.collect()))
    parts = [np.frombuffer(r.sums, np.float32).reshape(-1, params.dims) for r in texts.mapInArrow(_context_sums(words, params), "sums binary").toLocalIterator()]
    sums = np.sum(parts, 0) if parts else np.zeros((len(words), params.dims), np.float32)
    vectors = index_vectors(words, params) + sums / (1 + np.abs(sums).mean(1, keepdims=True))
    vectors = (vectors / np.maximum(1e-9, np.linalg.norm(vectors, axis=1, keepdims=True))).astype(np.float32)
    vectors = with_rare(vectors, params)
    got = texts.mapInArrow(_pool_batches(words, vectors, params.rare), "doc_id long, x binary").groupBy("doc_id").agg(F.min("x").alias("x")).join(ids, "doc_id").orderBy("doc_id").toPandas()
    if got["y"].nunique() < 2:  # labels of one class, or none, have a document
        return float(shares[1] / (shares[0] + shares[1]))
    x = np.stack([np.frombuffer(b, np.float32) for b in got["x"]]).astype(float)
    y = got["y"].to_numpy(float)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    x = (x - mean) / scale
    part = np.random.default_rng(params.seed).random(len(x)) < 0.2
    if len(set(y[~part])) < 2 or len(set(y[part])) < 2:
        part = np.zeros(len(x), bool)
    w = train_network(x[~part], y[~part], params)
    # the sample holds more of the rarer class than all labelled rows do; the constant moves back to their shares
    w[3] = w[3] + np.log(shares[1] / shares[0]) - np.log(max(1, y.sum()) / max(1, (1 - y).sum()))
    check = part if part.any() else ~part
    t = best_temperature(logits(x[check], w), y[check])
    return QualityModel(words, vectors, mean, scale, w[0], w[1], w[2], float(w[3][0]), float(t), params)


def score(docs: DataFrame, model: QualityModel | float, threshold: float = QualityParams.threshold) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (score >= threshold) for every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not isinstance(model, QualityModel):
        out = docs.select("doc_id", F.lit(float(model)).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            known = _Numbers(m.words, m.params.rare)
            for batch in slices(batches):
                ids, texts = ids_and_texts(batch)
                x = np.array([pooled(numbers_of(t, known), m.vectors, len(t)) for t in texts], float).reshape(-1, len(m.mean))
                z = logits((x - m.mean) / m.scale, (m.w1, m.b1, m.w2, m.b2)) / m.temperature
                yield pa.RecordBatch.from_arrays([ids, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "score"])

        out = docs.mapInArrow(run, "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", fold(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")
