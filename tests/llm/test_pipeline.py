"""The corpus pipeline, stage by stage, against brute-force decisions."""

import corpus_pipeline
from ionloom.llm import toxicity
from tests.llm.test_exact import brute_cut, brute_join, brute_leaks, words

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_join", "suffix_dedup", "decontamination", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    rows = lambda df: [(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()]

    def step(name, df):
        out = corpus_pipeline.written(stage[name](spark, df, DIR), "test")
        assert out.columns == docs.columns or name == "packing"
        return out

    first = step("toxicity", docs)
    model = toxicity.fit(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").collect()}

    second = step("ngram_join", first)
    assert [i for i, _ in rows(second)] == sorted(i for i, _, c in brute_join(rows(first), 5, 80, 100) if i == c)

    third = step("suffix_dedup", second)
    assert rows(third) == sorted((r[0], r[5].decode("utf-8", "ignore")) for r in brute_cut(rows(second), 200))
    assert all(r.n_chars == len(r.text) for r in third.collect() if r.text != dict(rows(second))[r.doc_id])

    fourth = step("decontamination", third)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    known = {tuple(w[i : i + 5]) for w in (words(t) for _, t in items) for i in range(len(w) - 4)}
    near = [r for r in rows(third) if any(tuple(w[i : i + 5]) in known for w in [words(r[1])] for i in range(len(w) - 4))]
    hit = {d for d, _ in brute_leaks(near, items)}
    assert [i for i, _ in rows(fourth)] == [i for i, _ in rows(third) if i not in hit]

    last = step("packing", fourth)
    assert {r.doc_id for r in last.select("doc_id").distinct().collect()} == {i for i, _ in rows(fourth)}
    ran = corpus_pipeline.run(spark, DIR)
    key = lambda df: sorted((r.doc_id, r.doc_tokens) for r in df.select("doc_id", "doc_tokens").distinct().collect())
    assert key(ran) == key(last)


def test_edge_rows(spark, docs, rows, tmp_path):
    """Nulls, empty and long texts, repeated ids and rows, clashing columns; then an empty table."""
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{DIR}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    held = spark.read.parquet(f"{tmp_path}/documents.parquet")
    toxic = {r.doc_id for r in held.select("doc_id").collect()} - {r.doc_id for r in corpus_pipeline.drop_toxic(spark, held, str(tmp_path)).select("doc_id").collect()}
    whole = [r for r in rows if r[0] not in toxic]
    first = {i for i, _, c in brute_join([r[:2] for r in whole if r[0] is not None], 5, 80, 100) if i == c}
    found = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    # the row without an id that equals another goes, the other stays
    assert found == first | {None}
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
