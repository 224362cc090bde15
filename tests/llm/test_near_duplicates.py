"""One row of each group of near duplicates stays, on the corpus with repeated and null-id rows."""

from collections import Counter

import corpus_pipeline
from tests.llm.test_exact import brute_join, words


def test_one_row_a_group(docs, rows):
    out = corpus_pipeline.near_duplicates(docs.sparkSession, docs, "")
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    # own row numbers as ids name the groups, those without any doc_id too
    groups = {}
    for (i, _, root), (d, t, *_) in zip(sorted(brute_join([(n, t) for n, (_, t, *_) in enumerate(rows)], 5, 80, 100)), rows, strict=True):
        groups.setdefault(root if words(t) else -1 - i, []).append((d is None, d, t))
    want = Counter(min(g, key=lambda r: (r[0], -1 if r[1] is None else r[1]))[1:] for g in groups.values())
    assert got == want
    assert got[5, rows[5][1]] == 1 and (None, rows[2][1]) not in got and any(d is None for d, _ in got)


def test_copies_do_not_empty_each_other(docs, rows):
    near = corpus_pipeline.written(corpus_pipeline.near_duplicates(docs.sparkSession, docs, ""), "test")
    text = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated(docs.sparkSession, near, "").collect()}
    assert text[2] == rows[2][1] and text[5] == rows[5][1]
