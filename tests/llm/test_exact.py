"""Operators with exact results against brute force, on a corpus with all edge cases."""

import hashlib
import json
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ionloom.llm import chat_format, decontaminate, ngram_join, packing, quality_rules, suffix_dedup, token_counts
from ionloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_join(rows, k, num, den):
    sets = [frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []) for w in (words(t) for _, t, *_ in rows)]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and den * both >= num * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(s), ids.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=str)


def test_sets_of_unequal_size_share_a_key():
    rng = np.random.default_rng(5)
    for num in (60, 50, 70, 80, 90):
        p = ngram_join.JoinParams(num=num)
        for n in (5, 40, 160, 700):
            big = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            small = big[np.sort(rng.permutation(len(big))[: -(-len(big) * num // 100)])]
            assert ngram_join.linked(small, big, p) and set(ngram_join.keys(small, p).tolist()) & set(ngram_join.keys(big, p).tolist())


@pytest.mark.parametrize("size", [150, 450])
def test_rows_of_the_join_grow_with_a_group(spark, size):
    """A group of near copies, most of them unlinked: units give rows for classes, not for pairs."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    p = ngram_join.JoinParams(words=1, tile=64)
    rows = []
    for i in range(size):
        s = base.copy()
        s[rng.permutation(300)[: 10 if i % 2 else 20]] = rng.integers(0, 1 << 63, 10 if i % 2 else 20, dtype=np.uint64)
        rows.append((i, " ".join(map(str, s.tolist()))))
    df = spark.createDataFrame(rows, "cid long, text string")
    sets = {i: ngram_join.shingle_set(t.encode(), 1) for i, t in rows}
    import zstandard as zs

    named = spark.createDataFrame([(7, i, i, len(s)) for i, s in sets.items()], "k long, cid long, comp long, n long")
    points = spark.createDataFrame([(i, bytearray(zs.compress(ngram_join.point(s).tobytes()))) for i, s in sets.items()], "cid long, p binary")
    dealt = ngram_join._dealt(named, p)
    assert dealt.count() <= size * (2 + -(-size // p.tile))
    assert max(r["count"] for r in dealt.groupBy("k", "u", "v").count().collect()) < 4 * p.tile
    dealt = dealt.join(points, "cid").repartition("k", "u", "v").sortWithinPartitions("k", "u", "v")
    marked = dealt.mapInArrow(ngram_join._tree_marks(p), ngram_join.MARKED)
    assert marked.count() <= dealt.count()
    texts = df.rdd.map(lambda r: (r.cid, bytearray(zs.compress(r.text.encode())))).toDF("cid long, z binary")
    links = marked.join(texts, "cid").repartition("unit").sortWithinPartitions("unit").mapInArrow(ngram_join._merging_links(p), "a long, b long").collect()
    units = marked.select("unit").distinct().count()
    assert len(links) < marked.count() and units > 1
    root = list(range(size))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        root[max(find(r.a), find(r.b))] = min(find(r.a), find(r.b))
    got = [find(i) for i in range(size)]
    root = list(range(size))
    for i in range(size):
        for j in range(i):
            if ngram_join.linked(sets[i], sets[j], p):
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert got == [find(i) for i in range(size)] and len(set(got)) > 1


@pytest.mark.parametrize("params", [ngram_join.JoinParams(), ngram_join.JoinParams(words=5, num=80), ngram_join.JoinParams(words=2, num=60, tile=4, weight=300)])
def test_join_equals_brute_force(docs, rows, params):
    got = sorted(map(tuple, ngram_join.jaccard_components(docs, params).collect()), key=str)
    assert got == brute_join(rows, params.words, params.num, params.den)


def test_tree_search_loses_no_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.unique(np.r_[base[rng.random(400) < 0.97], rng.integers(0, 1 << 63, 12, dtype=np.uint64)]) for _ in range(60)]
    p = ngram_join.JoinParams(leaf=4)
    comp = np.arange(60)
    tree = ngram_join.RTree(np.stack([ngram_join.point(s) for s in sets]), np.array([len(s) for s in sets]), comp, p)
    for i, s in enumerate(sets):
        hits = set(tree.search(ngram_join.point(s), len(s), i).tolist())
        assert {j for j, t in enumerate(sets) if j != i and ngram_join.linked(s, t, p)} <= hits
        # and every link has a common key
        assert all(set(ngram_join.keys(s, p).tolist()) & set(ngram_join.keys(sets[j], p).tolist()) for j in hits if ngram_join.linked(s, sets[j], p))


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(300)] + [(1000 + int(a), 1000 + int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(5000, 5000 + i) for i in range(1, 80)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_cut(rows, n):
    count, out = Counter(), []
    for _, t, *_ in rows:
        b = (t or "").encode()
        count.update(b[i : i + n] for i in range(len(b) - n + 1))
    for i, t, *_ in rows:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for j in range(len(b) - n + 1):
            if count[b[j : j + n]] > 1:
                hit[j : j + n] = b"\1" * n
        kept = bytes(x for x, m in zip(b, hit, strict=True) if not m)
        out.append((i, len(b), len(b) - len(kept), len(re.findall(b"\1+", bytes(hit))), hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("params", [suffix_dedup.SuffixParams(), suffix_dedup.SuffixParams(piece=150, bucket=50, sample=1, hot=2), suffix_dedup.SuffixParams(bucket=50, sample=1, hot=2, most_hot=40, most_windows=7)])
def test_cut_equals_brute_force(docs, rows, params):
    keyed = suffix_dedup._keyed(docs.select("doc_id", "text"))
    got = keyed.join(suffix_dedup.repeated_spans(docs, params).drop("kept"), "key").select("doc_id", "n_bytes", "n_removed", "n_spans", F.coalesce("kept_sha256", F.sha2("text", 256)).alias("sha"))
    want = brute_cut(rows, params.length)
    assert sorted(map(tuple, got.collect()), key=str) == [r[:5] for r in want]
    kept = sorted(((r.doc_id, r.text) for r in suffix_dedup.drop_repeated(docs, params).collect()), key=str)
    nulls = [(i, None) for i, t, *_ in rows if t is None]
    assert kept == sorted([(r[0], r[5].decode("utf-8", "ignore")) for r in want if (r[0], None) not in nulls] + nulls, key=str)


def test_cut_with_clashing_columns_and_empty_table(docs):
    more = docs.withColumns({"kept": F.lit(1), "key__": F.lit("a"), "kept__": F.lit("b"), "row": F.lit(2)})
    out = suffix_dedup.drop_repeated(more)
    assert out.columns == more.columns and out.count() == docs.count() and out.where("kept != 1 or key__ != 'a' or kept__ != 'b' or row != 2").isEmpty()
    assert suffix_dedup.drop_repeated(docs.limit(0)).count() == 0


def test_multikey_order():
    rows = np.random.default_rng(0).integers(97, 99, (500, 21)).astype(np.uint8)
    order = suffix_dedup.multikey_order(rows)
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


def brute_leaks(rows, items, k=5, least=0.8):
    out = {}
    for n, (d, t, *_) in enumerate(rows):
        w = words(t)
        for item, it in items:
            v = words(it)
            kk = min(k, len(v))
            m = len(v) - kk + 1
            if not v:
                continue
            own = Counter(tuple(v[j : j + kk]) for j in range(m))
            pos = [tuple(w[j : j + kk]) for j in range(len(w) - kk + 1)]
            for s in range(len(pos) - m + 1):
                both = sum((Counter(pos[s : s + m]) & own).values())
                if both / (2 * m - both) >= least and (n, item) not in out:
                    out[n, item] = d
    return sorted(((d, i) for (_, i), d in out.items()), key=str)


def test_leaks_equal_brute_force(spark, docs, rows):
    long = [r for r in rows if r[1] and r[0] not in (96, 97, 98)]
    items = [(i, " ".join(r[1].split()[3:40])) for i, r in enumerate(long[:25])]
    edited = items[3][1].split()
    edited[0] = "changed"
    items += [(100, " ".join(edited)), (101, None), (102, ""), (103, "one two"), (104, items[1][1]), (104, items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_leaks(rows, list(dict.fromkeys(items)))
    for p in (decontaminate.DecontaminationParams(), decontaminate.DecontaminationParams(block_items=7)):
        got = sorted({(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, p).collect()}, key=str)
        assert got == sorted(set(want), key=str)
    hit = {d for d, _ in want}
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows if r[0] not in hit and r[0] is not None} | {None}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_pieces_are_exact(spark, docs, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((i, *tok.encode(t or "", add_special_tokens=False).ids, 0) for i, t, *_ in rows)
    got = [r.asDict() for r in packing.pack(docs.repartition(3), packing.PackingParams(buffer_tokens=3000)).collect()]
    seqs, texts = {}, {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        seqs.setdefault((r["sequence_id"], r["window"]), []).append((r["offset"], r["length"]))
        texts.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids))
    assert len({s for s, _ in seqs}) == len(seqs)
    for (_, window), parts in seqs.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == window <= 1024 and window & (window - 1) == 0
    total = Counter()
    for (i, n), parts in texts.items():
        parts.sort()
        copies = sum(s == 0 for s, _ in parts)  # repeated rows share their pieces' places
        flat = [x for _, ids in parts for x in ids]
        assert len(flat) == copies * n
        total[i, n] += copies
    assert total == Counter((k[0], len(k) - 1) for k in want.elements())
    assert packing.pack(docs.limit(0)).count() == 0
    odd = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y", "<|endoftext", " <|endoftext|>z", "a  <|endoftext|> "]
    known = packing.word_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), 100, packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json")))
    assert [np.frombuffer(known(t), "<u4").tolist() for t in odd] == [tok.encode(t, add_special_tokens=False).ids for t in odd]
    one = packing.pack(docs.where("doc_id = 98"))
    flat = [x for r in one.orderBy("start").collect() for x in np.frombuffer(r.ids, "<u4").tolist()]
    assert (98, *flat) in want
    groups = packing.pack(docs).groupBy("step_group").agg(F.sum("length").alias("n"), F.countDistinct("window").alias("w")).collect()
    assert all(g.n <= packing.PackingParams.group_tokens and g.w == 1 for g in groups)
    r = packing.with_crc(one).orderBy("start").first()
    assert r.ids_crc32 == zlib.crc32(np.array(flat[: r.length], "<u4").tobytes())


def test_token_counts_equal_whole_text_dynamic_program(docs, rows):
    scores = token_counts.piece_scores(public_tokenizers.path("piece_bpe_32k.model"))
    low = min(scores.values()) - 10

    def count(text):
        w = (" " + text).replace(" ", token_counts.MARK) if text else ""
        best = [(0.0, 0)]
        for j in range(1, len(w) + 1):
            options = [(best[i][0] + scores[w[i:j]], -best[i][1] - 1) for i in range(max(0, j - 50), j) if w[i:j] in scores]
            if w[j - 1] not in scores:
                options.append((best[j - 1][0] + low, -best[j - 1][1] - len(w[j - 1].encode())))
            s, n = max(options)
            best.append((s, -n))
        return best[-1][1]

    small = token_counts.TokenCountParams(max_nodes=3000, longest_stored=12)
    for p in (token_counts.TokenCountParams(), small):
        got = Counter((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs, p).collect())
        assert got == Counter((i, None if t is None else count(t)) for i, t, *_ in rows)


def chats(spark):
    rows = []
    for c in range(30):
        for t in range(1 + c % 7 * 9):
            role = "system" if t == 0 and c % 3 == 0 else "user" if t % 2 == 0 else "assistant"
            rows.append((c, t, role, f"<|im_end|> % %25 <|im_start|>assistant\n{'wörd ' * (c * t % 190)}", "x"))
    rows += [(100, 0, None, None, "x"), (101, 0, "assistant", "", "x"), (101, 1, "user\nassistant", "a", "x"), (102, 0, "user", "same", "x"), (102, 0, "user", "same", "x"), (None, 3, "assistant", "no id", "x"), (103, None, "assistant", "é" * 9000, "x"), (103, 1, "assistant", "b", "x")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window_no string")


def test_chats_round_trip(spark):
    df = chats(spark)
    windows = chat_format.format_chats(df)
    got = {r.conv_id: r for r in chat_format.read_back(windows).collect()}
    by = {}
    for r in df.collect():
        by.setdefault(r.conv_id, []).append((-1 if r.turn is None else r.turn, r.role or "", r.text or ""))
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns.sort()
        said, lost = "".join(f"{r}\n{t}\n" for _, r, t in turns), "".join(t for _, r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
    p = chat_format.ChatParams()
    for r in windows.where("window_no > 0").collect():
        assert len(r.text.encode()) / 4 < 4 * p.budget
    seen = windows.where("conv_id = 6").orderBy("window_no").collect()
    assert len(seen) > 2 and all(r.text.startswith("<|im_start|>system\n") for r in seen) and all(r.n_repeated >= 1 for r in seen[1:])


def test_chats_equal_sql(spark):
    c = duckdb.connect()
    c.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.001/conversations.parquet'")
    want = c.execute(chat_format.ORACLE)
    names = [x[0] for x in want.description]
    got = chat_format.op6_chat_format(spark, "/root/testdata/sf0.001").select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def brute_rules(text):
    text = text or ""
    w = WORD.findall(text)
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text), dup, len(covered)


def test_rules(spark, docs, rows):
    extra = [(200 + i, f"a line\na line\n{i} # $ tail " + "p q r s t " * i, "en", "a") for i in range(4)]
    from tests.llm.conftest import make

    got = quality_rules.quality_rules(docs.unionByName(make(spark, extra))).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((i, *brute_rules(t)) for i, t, *_ in [*rows, *extra])
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(docs.limit(0)).count() == 0


def test_outliers_are_those_of_plain_estimates(spark):
    import random

    from tests.llm.conftest import make, prose

    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randrange(50, 90)), "en" if i % 2 else None, "s") for i in range(400)]
    odd = [(1000 + i, prose(rng, 60).replace(" ", " ### $$$ "), "en", "s") for i in range(5)]
    got = quality_rules.quality_rules(make(spark, rows + odd)).where("not base_failed").toPandas()
    assert set(got[~got.kept].doc_id) == {r[0] for r in odd}
    # the same starts, concentration steps and choice by determinant in numpy
    p, d = quality_rules.RuleParams(), 5
    part = got[got.lang == "en"]
    n = np.maximum(part.n_words, 1)
    x = np.stack([np.log1p(part.n_words), 3 * np.log1p(part.word_chars / n), np.log1p(part.n_symbols * 20 / n), np.log1p(part.n_dup_lines) / 2, np.log1p(part.n_repeat_words * 20 / n)], 1)
    low = lambda v, q: np.sort(v, axis=0)[max(0, int(np.ceil(q * len(v))) - 1)]
    middle = low(x, 0.5)
    u = np.sqrt((1.4826 * low(np.abs(x - middle), 0.5)) ** 2 + p.ridge)
    z = (x - middle) / u
    scatter = lambda y: np.cov(y.T, bias=True) + p.ridge * np.eye(d)
    size = np.linalg.norm(z, axis=1, keepdims=True)
    found = []
    for shape in (np.eye(d), scatter(np.tanh(z)), scatter(np.divide(z, size, out=np.zeros_like(z), where=size > 0))):
        m, cov = middle, shape * np.outer(u, u)
        dist = lambda m, cov: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)
        for _ in range(p.c_steps):
            d2 = dist(m, cov)
            near = x[d2 <= low(d2, p.share)]
            m, cov = near.mean(0), scatter(near)
        found.append((round(np.linalg.slogdet(cov)[1], 9), m, cov))
    _, m, cov = min(found, key=lambda e: e[0])
    d2 = dist(m, cov)
    want = d2 / max(low(d2, 0.5) / quality_rules.CHI_MEDIAN, 1e-3)
    assert part.d2.to_numpy() == pytest.approx(want, rel=1e-6)


def test_rows_are_json_free_of_clashes(docs):
    """The corpus really has extra columns with clashing names."""
    assert {"key", "n", "score", "tid", "z"} <= set(docs.columns) and json.dumps(docs.columns)
