"""Components against a plain union-find: paths, stars, loops, repeated edges and none."""

import random

import pyarrow as pa

from ionloom.llm import components as c


def plain(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def some_edges(rng):
    path = [(i, i + 1) for i in range(1000, 1300)]
    rng.shuffle(path)
    star = [(5000, 5000 - i) for i in range(1, 200)]
    loose = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    loose = [(a, b) for a, b in loose if a != b]
    return path + star + loose + path[:20]


def test_components(spark):
    edges = some_edges(random.Random(4))
    df = spark.createDataFrame([*edges, (7777, 7777)], "a long, b long").repartition(7)
    got = [(r.node, r.root) for r in c.components(df).collect()]
    assert len(got) == len(set(got)) and dict(got) == plain(edges)
    assert c.components(df.limit(0)).count() == 0


def test_contraction_in_parts_keeps_components(monkeypatch):
    monkeypatch.setattr(c, "PER_TASK", 40)
    edges = some_edges(random.Random(9))
    batches = [pa.RecordBatch.from_pydict({"a": [a for a, _ in edges[i : i + 25]], "b": [b for _, b in edges[i : i + 25]]}) for i in range(0, len(edges), 25)]
    out = list(c._local_roots(iter(batches)))
    found = [(a, b) for batch in out for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
    assert len(out) > 5 and all(b < a for a, b in found) and len(found) <= len(edges)
    assert plain(found) == plain(edges)
