"""Every statistic of the quality rules can decide, ordinary amounts and copies don't."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionloom.llm import quality_rules
from tests.llm.conftest import make, prose


def usual(rng, first, n):
    return [(first + i, prose(rng, rng.randrange(60, 200)), "en", "s") for i in range(n)]


def test_each_statistic_decides(spark):
    rng = random.Random(2)
    word = lambda lo, hi: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(lo, hi)))
    lines = lambda repeated, rest: "\n".join(x for _ in range(rest) for x in (prose(rng, 8), *(["x y z"] if repeated > _ else [])))
    odd = {
        "long words": " ".join(word(8, 14) for _ in range(100)),
        "short words": " ".join(word(1, 4) for _ in range(100)),
        "repeated lines": lines(20, 20),
        "symbols": " ".join(w + "#" * (i % 6 == 0) for i, w in enumerate(prose(rng, 120).split())),
        "a little of each": " ".join(word(5, 9) + "$" * (i % 9 == 0) for i in range(60)) + "\n" + lines(3, 4) + "\n" + 2 * (prose(random.Random(1), 8) + "\n"),
    }
    passage = prose(rng, 6)
    fine = {"one repeated line": lines(2, 14), "two symbols": prose(rng, 50) + " #1 5% " + prose(rng, 50), "repeated words": f"{prose(rng, 50)} {passage} {prose(rng, 50)} {passage} {prose(rng, 50)}"}
    rows = usual(rng, 0, 400) + [(1000 + i, t, "en", "s") for i, t in enumerate(odd.values())] + [(2000 + i, t, "en", "s") for i, t in enumerate(fine.values())]
    got = {r.doc_id: r for r in quality_rules.quality_rules(make(spark, rows)).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {name: got[1000 + i].kept for i, name in enumerate(odd)} == dict.fromkeys(odd, False)
    assert {name: got[2000 + i].kept for i, name in enumerate(fine)} == dict.fromkeys(fine, True)
    assert sum(not got[i].kept for i in range(400)) <= 2


def test_copies_reject_no_ordinary_rows(spark):
    """A group that is mostly copies has no spread of its own."""
    rng = random.Random(3)
    copy = prose(rng, 120)
    rows = [(i, copy, "en", "s") for i in range(200)] + usual(rng, 500, 30) + [(1000, prose(rng, 100).replace(" ", " ## "), "en", "s")]
    got = {r.doc_id: r for r in quality_rules.quality_rules(make(spark, rows)).collect()}
    assert [i for i, r in got.items() if not r.kept] == [1000]


def test_verdict_is_that_of_a_plain_reweighted_estimate(spark):
    rng = random.Random(8)
    rows = usual(rng, 0, 300) + [(1000 + i, prose(rng, 60).replace(" ", " # ", 3 * i), "en", "s") for i in range(20)]
    got = quality_rules.quality_rules(make(spark, rows)).toPandas()
    n = np.maximum(got.n_words, 1)
    x = np.stack([np.log1p(got.n_words), 3 * np.log1p(got.word_chars / n), np.log1p(got.n_symbols * 20 / n), np.log1p(got.n_dup_lines) / 2, np.log1p(got.n_repeat_words * 20 / n)], 1)
    low = lambda v: np.sort(v)[int(np.ceil(0.5 * len(v))) - 1]
    chi = lambda k, z: k * (1 - 2 / (9 * k) + z * np.sqrt(2 / (9 * k))) ** 3
    # the core's size is all that the raw estimate decides here: d2 orders the rows
    inside = np.argsort(got.d2.to_numpy())
    errors = []
    for size in range(len(x) // 2, len(x) + 1):
        core = x[inside[:size]]
        own = np.cov(core.T, bias=True)
        shape, added = own + np.diag(np.square(quality_rules.ORDINARY)), np.square(quality_rules.ORDINARY)
        k = max(1, (np.diag(own) / (np.diag(own) + added)).sum())
        r = np.einsum("ij,jk,ik->i", x - core.mean(0), np.linalg.inv(shape), x - core.mean(0))
        want = r / (max(1, low(r) / chi(k, 0)) * chi(k, 3.7190164854556804))
        errors.append(np.abs(got.judged / want - 1).max())
        if errors[-1] < 1e-6:
            assert (got.kept == (want <= 1)).all() and got.kept.nunique() == 2
    assert min(errors) < 1e-6


@pytest.mark.parametrize(("k", "share", "want"), [(1, 0.5, 0.455), (2, 0.5, 1.386), (5, 0.5, 4.351), (2, 0.975, 7.378), (5, 0.975, 12.833), (1, 0.9999, 15.137), (2, 0.9999, 18.421), (5, 0.9999, 25.745)])
def test_quantiles_of_chi_square(spark, k, share, want):
    got = spark.range(1).select(quality_rules._chi_square(F.lit(float(k)), share).alias("q")).first().q
    assert got == pytest.approx(want, rel=0.08)
