"""Long texts go through the language filters in blocks; corrected popcounts come near the exact ones."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ionloom.llm import language_id as L
from tests.llm.conftest import prose


def model_of(sets, log2, width=1):
    """A model with the given n-grams by language."""
    masks = np.zeros(1 << log2, f"u{width}")
    for i, g in enumerate(sets):
        for s in L.slots(g, log2):
            np.bitwise_or.at(masks, s, masks.dtype.type(1 << i))
    fill = [float(((masks >> masks.dtype.type(i)) & masks.dtype.type(1)).mean()) for i in range(len(sets))]
    langs = tuple(f"l{i}" for i in range(len(sets)))
    return L.LanguageModel(langs, masks.tobytes(), width, tuple(f**3 for f in fill), L.LanguageParams(positions_log2=log2))


@pytest.mark.parametrize("size", [1, 7, 100, 1 << 20])
@pytest.mark.parametrize("text", ["", "a", "ab", "abc", "abcd", "Straße und ΣΟΦΟΣ " * 20, "\ud800x" * 9])
def test_blocks_hold_all_grams_in_order(size, text):
    want = f" {text.lower()} ".encode("utf-8", "surrogatepass")
    want = bytes(x if x >= 128 or 97 <= x < 123 else 32 for x in want)
    want = [int.from_bytes(want[i : i + 5], "big") for i in range(len(want) - 4)]
    assert [x for g in L.gram_blocks(text, 5, size) for x in g.tolist()] == want == L.grams(text, 5).tolist()


@pytest.mark.parametrize("width", [1, 2])
def test_correction_against_exact_sets(width):
    """With crowded filters raw popcounts are far too high; the corrected ones give the exact numbers' share."""
    rng = random.Random(4)
    own = [np.unique(L.grams(prose(rng, 900), 5))[:1800] for _ in range(2)]
    model = model_of([own[0], np.unique(np.r_[own[1], np.random.default_rng(1).integers(1, 1 << 39, 1500, dtype=np.uint64)])], 12, width)
    masks = np.frombuffer(model.masks, f"u{width}")
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=40_000)) + prose(rng, 300)
    g = L.grams(text, 5)
    exact = np.array([np.isin(g, s).sum() for s in own], float)
    a, b, c = L.slots(g, 12)
    raw = np.array([(((masks[a] & masks[b] & masks[c]) >> i) & 1).sum() for i in range(2)], float)
    fixed = (raw - len(g) * np.array(model.rates)) / (1 - np.array(model.rates))
    assert all(raw - exact > 0.2 * len(g)) and all(abs(fixed - exact) < 0.05 * len(g))
    lang, score = L.predictor(model)(text)
    near = np.maximum(fixed, 0)
    assert lang == model.langs[int(near.argmax())] and score == pytest.approx(near.max() / near.sum())


def test_a_long_text_takes_bounded_memory():
    rng = random.Random(5)
    one = prose(rng, 2000)
    model = model_of([np.unique(L.grams(one, 5)), np.unique(L.grams("zzzzz yyyyy xxxxx", 5))], 16)
    of, text = L.predictor(model), one * (32_000_000 // len(one))
    want = of(one)
    tracemalloc.start()
    got = of(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0] == want[0] == "l0" and abs(got[1] - want[1]) < 0.01
    assert peak < 5 * len(text) + (120 << 20)


def test_counts_of_a_long_text_come_in_parts():
    texts = ["abcde " * 400_000, "fghij"]
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b"]), pa.array(texts)], ["lang", "text"])
    total = {}
    for out in L._count_batches(5)(iter([batch])):
        for lang, g, c in zip(*(out.column(i).to_pylist() for i in range(3)), strict=True):
            total[lang, g] = total.get((lang, g), 0) + c
    for lang, text in zip("ab", texts, strict=True):
        g, c = np.unique(L.grams(text, 5), return_counts=True)
        assert {x: n for (of, x), n in total.items() if of == lang} == dict(zip(g.tolist(), c.tolist(), strict=True))
