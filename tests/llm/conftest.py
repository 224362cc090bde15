import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n long, score double, tid long, z string"


def make(spark, rows):
    """Documents with extra columns whose names clash with those used inside the operators."""
    return spark.createDataFrame([(i, t, lang, src, len(t) if t is not None else None, "k", 7, 0.5, 3, "z") for i, t, lang, src in rows], SCHEMA)


def prose(rng, n, stem=""):
    return " ".join(stem + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def corpus():
    """Copies, near copies, shared passages, nulls, empty and very long texts, ties and repeated rows."""
    rng = random.Random(11)
    out = []
    for i in range(60):
        out.append([i, prose(rng, rng.randrange(30, 200)), "en", "a"])
    base = out[0][1].split(" ")
    for i in range(60, 75):  # near copies of each other
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(len(w))] = "zq" + str(i)
        out.append([i, " ".join(w), "en", "hot"])
    for i in range(75, 80):
        out.append([i, out[1][1], "de", "hot"])
    passage = prose(rng, 60)
    for i in range(80, 90):
        out.append([i, prose(rng, 20) + " " + passage + " " + prose(rng, 20), "fr", "b"])
    out += [[90, None, None, None], [91, "", "en", None], [92, "   \n\t ", None, "b"], [93, "one", "en", "b"], [94, "one two", "en", "b"], [95, "One TWO", "en", "b"]]
    out += [[96, "ab" * 2000, "en", "b"], [97, "word " * 900, "en", "b"], [98, prose(rng, 9000), "en", "b"], [99, "äöü ßé 日本 　 x" * 30, "de", "b"]]
    out += [[5, out[5][1], "en", "a"], [None, out[2][1], "en", "a"], [None, "a text without an id but with some words in it", "en", "a"]]
    return [tuple(r) for r in out]


@pytest.fixture(scope="session")
def docs(spark):
    return make(spark, corpus())


@pytest.fixture(scope="session")
def rows():
    return corpus()
