"""The fingerprint index of decontamination: it returns all within the radius and few others; blocks of the benchmark are bounded."""

import random

import numpy as np
import pytest

from ionloom.llm import decontaminate as D
from tests.llm.conftest import make, prose
from tests.llm.test_clipped_leaks import brute_leaks


def prints(n, seed):
    return np.random.default_rng(seed).integers(0, 1 << 63, (n, 2), dtype=np.uint64) * np.uint64(2) + np.random.default_rng(seed + 1).integers(0, 2, (n, 2), dtype=np.uint64)


def moved(p, bits, seed):
    """The fingerprints with ``bits`` of their bits flipped."""
    rng, b = np.random.default_rng(seed), np.unpackbits(p.view(np.uint8), axis=1)
    for row in b:
        row[rng.permutation(128)[:bits]] ^= 1
    return np.packbits(b, axis=1).view(np.uint64)


def test_few_random_entries_come_back():
    entries, queries = prints(5000, 1), prints(200, 5)
    found = [len(e) for _, e in D.BlockIndex(entries, 36).candidates(queries)]
    assert sum(found) / (200 * 5000) < 0.01


@pytest.mark.parametrize("radius", [0, 3, 36, 63, 64, 90, 127, 128])
def test_all_within_the_radius_come_back(radius):
    entries = prints(300, 2)
    queries = np.concatenate([moved(entries[:40], k, k) for k in sorted({0, max(0, radius - 1), radius, min(128, radius + 1)})])
    want = {(q, e) for q in range(len(queries)) for e in range(300) if np.bitwise_count(queries[q] ^ entries[e]).sum() <= radius}
    assert want and set(D.BlockIndex(entries, radius).search(queries)) == want


def test_recall_of_borderline_pairs(spark):
    """Windows with one word replaced, similarities from 0.8 up: the index loses none that plain comparison finds."""
    rng = random.Random(3)
    items = [(i, prose(rng, 50)) for i in range(60)]
    rows = []
    for i, t in items:
        w = t.split()
        w[rng.choice([0, 1, 2, 3, 25, 47])] = "zzz"
        rows.append((i, f"{prose(rng, 30)} {' '.join(w)} {prose(rng, 30)}"))
    want = brute_leaks(rows, items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in D.contaminated(make(spark, [(i, t, "en", "a") for i, t in rows]), bench).collect()}
    assert got == want and len(want) >= 54


@pytest.mark.parametrize("most", [1, 300, 1 << 20])
def test_blocks_are_bounded_by_bytes(spark, most):
    rng = random.Random(9)
    items = [(i // 5, prose(rng, 20)) for i in range(40)] + [(None, prose(rng, 20))] * 2
    bench = spark.createDataFrame(items, "item_id long, text string")
    p = D.DecontaminationParams(block_bytes=most)
    blocks = list(D._blocks(bench, p))
    assert all(len(b) == 1 or sum(len(t) for _, t in b) <= most for b, _ in blocks) and sum(len(b) for b, _ in blocks) == 41
    assert any(g for _, g in blocks) == (most < 1 << 20)
    texts = [" pause ".join(t for _, t in items[a : a + 7]) for a in range(0, 42, 7)]
    rows = [(i, t) for i, t in enumerate(texts)] * 2 + [(None, texts[0]), (3, None), (4, "")]
    docs = make(spark, [(i, t, "en", "a") for i, t in rows])
    key = lambda df: sorted(map(str, df.collect()))
    got = D.contaminated(docs, bench, p)
    assert key(got) == key(D.contaminated(docs, bench)) and got.columns == ["doc_id", "item_id", "similarity", "first_word", "n_words"]
    assert D.drop_contaminated(docs, bench, p).count() == 2
