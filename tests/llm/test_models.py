"""Held-out accuracy and edge cases of the learned operators."""

import math

import pytest
from pyspark.sql import functions as F

from ionloom.llm import language_id, quality, toxicity
from ionloom.llm.common import auc, fold

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))


def test_language(spark, tables):
    got = language_id.op1_language_id(spark, DIR).join(tables[0].select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == tables[0].count() and 0.2 < len(held) / len(got) < 0.3
    assert (held.lang_pred == held.lang).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_language_filter_has_no_false_negatives():
    import numpy as np

    p = language_id.LanguageParams(positions_log2=12)
    g = language_id.grams("the quick brown fox", p.n)
    masks = np.zeros(1 << 12, "u1")
    for s in language_id.slots(g, 12):
        np.bitwise_or.at(masks, s, np.uint8(2))
    a, b, c = language_id.slots(g, 12)
    assert (masks[a] & masks[b] & masks[c] == 2).all()


def test_language_edge_cases(spark, docs, tables):
    model = language_id.fit(tables[0])
    got = {(r.doc_id, r.lang_pred) for r in language_id.predict(docs, model).collect()}
    assert {(90, "und"), (91, "und"), (92, "und")} <= got
    assert language_id.predict(docs, model).count() == docs.count()
    assert language_id.fit(docs.limit(0)) is None
    assert language_id.predict(docs, None).where("lang_pred <> 'und'").count() == 0


def test_quality(spark, tables):
    got = quality.op5_quality(spark, DIR).join(tables[1], "doc_id").toPandas()
    held = got[got.held_out]
    assert auc(held.quality, held.score) > 0.9
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_quality_edge_cases(spark, docs, tables):
    labels = tables[1]
    assert quality.fit(docs, labels.limit(0)) == 0.5
    assert quality.score(docs, 0.5).count() == docs.count()
    model = quality.fit(tables[0], labels.withColumn("quality", F.when(F.col("doc_id") % 7 > 0, F.col("quality"))), quality.QualityParams(epochs=3))
    got = quality.score(docs, model).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()


def test_models_without_documents_or_with_one_class(spark, tables):
    docs, labels = tables
    none = docs.limit(0)
    assert quality.fit(none, labels) == pytest.approx(quality.fit(docs.where("doc_id < 0"), labels))
    assert quality.score(none, quality.fit(none, labels)).count() == 0 and toxicity.fit(none, labels) is None
    ones = docs.join(labels.where("quality = 1"), "doc_id", "left_semi")
    share = quality.fit(ones, labels)
    assert isinstance(share, float) and 0 < share < 1
    assert quality.score(docs, share).where(F.col("score") != share).isEmpty()
    few = labels.where("doc_id < 400")
    twice = docs.where("doc_id < 400")
    twice = twice.unionByName(twice)
    a, b = (quality.fit(x, few, quality.QualityParams(epochs=2)) for x in (twice, docs))
    assert a.words and len(a.mean) == len(b.mean)


def test_toxicity(spark, tables):
    got = toxicity.op9_toxicity(spark, DIR).join(tables[1], "doc_id").toPandas()
    held = got[got.held_out]
    assert auc(held.toxic, held.score) > 0.75
    assert held[held.toxic == 0].predicted.mean() < 0.05
    assert ((got.score >= 0.7) == (got.predicted == 1)).all()


def test_toxicity_edge_cases(spark, docs, tables):
    assert toxicity.fit(docs, tables[1].limit(0)) is None
    assert toxicity.score(docs, None).where("score > 0").count() == 0
    assert toxicity.drop_toxic(docs, None).count() == docs.count()
    model = toxicity.fit(*tables)
    scored = toxicity.score(docs, model).toPandas()
    assert len(scored) == docs.count() and scored.score.between(0, 1).all()
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == (scored.predicted == 0).sum()


def test_windows_keep_all_words():
    text = "A b  c\n" + "x" * 500 + " d"
    found = toxicity.windows(text, 64)
    assert b"".join(w.replace(b" ", b"") for w in found) == text.lower().replace(" ", "").replace("\n", "").encode()
    assert toxicity.windows("", 64) == []


def test_folds(spark):
    import zlib

    df = spark.range(200).select(F.col("id").alias("doc_id"), fold(F.col("id"), 3, 1).alias("held"))
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in df.collect())
    assert spark.range(1).select(fold(F.lit(None).cast("long"), 3, 1).alias("x")).first().x is False


def test_toxicity_savings_by_plain_loops(spark, tables):
    """Scores from one compression after another, with compressors that were not used before."""
    model = toxicity.fit(*tables)
    rows = tables[0].orderBy("doc_id").limit(40).collect()
    got = {r.doc_id: r.score for r in toxicity.score(tables[0].orderBy("doc_id").limit(40), model).collect()}
    length = lambda dictionary, w: len(toxicity._compressor(dictionary, model.params).compress(w))
    for r in rows:
        found = toxicity.windows(r.text or "", model.params.window)
        z = model.weights[-1]
        for k, extra in enumerate(model.toxic):
            saved = sorted((length(model.ordinary, w) - length(extra + model.ordinary, w) for w in found), reverse=True)
            n = len(saved)
            f = (sum(saved) / n, saved[0], sum(saved[:2]) / len(saved[:2]), sum(max(0, s - 2) for s in saved) / (n + 5)) if n else (0, 0, 0, 0)
            z += sum(a * b for a, b in zip(f, model.weights[4 * k : 4 * k + 4], strict=True))
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-z))) < 1e-9
