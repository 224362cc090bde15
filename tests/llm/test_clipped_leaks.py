"""Documents with fewer words than the benchmark item are compared with it as a whole."""

import random
from collections import Counter

from ionloom.llm import decontaminate
from tests.llm.conftest import make, prose
from tests.llm.test_exact import words


def brute_leaks(rows, items, k=5, least=0.8):
    """As in test_exact, and a text with fewer shingles than the item is one window."""
    out = {}
    for d, t in rows:
        for item, it in items:
            w, v = words(t), words(it)
            kk = min(k, len(v))
            own = Counter(tuple(v[j : j + kk]) for j in range(len(v) - kk + 1))
            pos = [tuple(w[j : j + kk]) for j in range(len(w) - kk + 1)]
            m = min(len(v) - kk + 1, len(pos))
            for s in range(len(pos) - m + 1 if m > 0 else 0):
                both = sum((Counter(pos[s : s + m]) & own).values())
                sim = both / (m + sum(own.values()) - both)
                if sim >= least and sim > out.get((d, item), (0, 0, 0))[0]:
                    out[d, item] = (sim, s, m + kk - 1)
    return {(*key, *v) for key, v in out.items()}


def test_clipped_documents(spark):
    rng = random.Random(7)
    items = [(i, prose(rng, n)) for i, n in enumerate([4, 5, 8, 9, 9, 10, 12, 30, 60, 61, 90, 90])] + [(20, "word " * 40), (21, prose(rng, 12) + " word" * 30)]
    texts = []
    for _, t in items:
        w = t.split()
        texts += [" ".join(w[:-1]), " ".join(w[1:]), " ".join(w[:-2]), " ".join(w[: len(w) // 2] + w[len(w) // 2 + 1 :]), " ".join(w[: len(w) * 4 // 5 + 1]), " ".join(w[: len(w) // 2]), "x " + t + " y", t]
    rows = list(enumerate([*texts, "", "word " * 33, prose(rng, 20)]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(rows, items)
    docs = make(spark, [(i, t, "en", "a") for i, t in rows])
    for p in (decontaminate.DecontaminationParams(), decontaminate.DecontaminationParams(block_items=3)):
        assert {tuple(r) for r in decontaminate.contaminated(docs, bench, p).collect()} == want
    assert any(len(words(rows[d][1])) < len(words(items[i][1])) for d, i, *_ in want if i < 12)
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()} == {i for i, _ in rows} - {d for d, *_ in want}


def test_repeated_items_give_one_row_at_any_block_size(spark):
    rng = random.Random(8)
    text, other = prose(rng, 30), prose(rng, 25)
    bench = spark.createDataFrame([(1, text), (1, text), (1, other), (None, other), (2, text)], "item_id long, text string")
    docs = make(spark, [(7, f"a {text} b {other} c", "en", "a"), (7, other, "en", "a")])
    for n in (1, 2, 50_000):
        got = sorted(((r.doc_id, r.item_id, r.n_words) for r in decontaminate.contaminated(docs, bench, decontaminate.DecontaminationParams(block_items=n)).collect()), key=str)
        assert got == [(7, 1, 25), (7, 1, 30), (7, 2, 30), (7, None, 25), (7, None, 25)]
