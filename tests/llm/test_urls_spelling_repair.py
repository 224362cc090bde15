"""URL templates, spelling variants and conversation repair against brute force, with nulls, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from ionloom.llm import repair, spelling, url_templates
from ionloom.llm.queries import ORACLES, QUERIES


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# --- op11 -------------------------------------------------------------------------------------------------------------------------


PAGES = "page_id long, url string, html string, host string, n long, node string, verdict string"


def urls():
    rng = random.Random(3)
    out = [None, "", "no scheme/en/1", "http://", "http://COM", "https://a.COM/x", "http://example.com/en/1", "http://www.example.com/en/1", "http://m.www.example.com/en/", "http://Ünï.net/es/9", "http://x.net?/es/1", "http://x.net#/es/1", "http://x.net/es", "http://x.net//es/1", "a://b://c.net/fr/1", "http://notcom/", "http://h.org/" + "/".join(map(str, range(30)))]
    for i in range(40):
        out += [f"http://big.net/es/{i}", f"http://big.net/fr/{i}.html", f"http://big.net/en/{i}", f"http://site.org/u/name{chr(97 + i % 26)}{chr(97 + i // 26)}/deadbeef{i:04d}/"] + [f"http://big.net/only/page-{i}"] * (i < 3)
    for i in range(300):
        out.append(f"http://users.net/{'es' if i % 4 else 'xx'}/{''.join(rng.choice('abcdef') for _ in range(6))}/p/{i}?q={i}")
    return out + out[:40]


def plain_urls(rows, p):
    """The tree by plain recursion over each host's pages."""
    cut, labels = [], []
    for url in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = lowered(re.match("[^/?#]*", rest)[0])
        path = re.match("[^?#]*", rest[len(host) :])[0]
        fits = [(len(h + q), h + q, v) for h, q, v in url_templates.RULES if (host == h or host.endswith("." + h)) and path.startswith(q)]
        best = max(fits) if fits else (0, None, None)
        segs = [s for s in path.split("/") if s]
        segs = [*segs[: p.levels - 1], None] if len(segs) > p.levels else segs
        segs = ["<deep>" if s is None else "<h>" if re.fullmatch("[0-9a-fA-F-]{8,}", s) and re.search("[0-9]", s) and not re.fullmatch("[0-9-]+", s) else re.sub("[0-9]+", "<n>", s) for s in segs]
        cut.append((host, path, best[1], tuple(segs)))
        labels.append(best[2])
    place = {}

    def grow(pages, level, node):
        by = defaultdict(list)
        for i in pages:
            if len(cut[i][3]) > level:
                by[cut[i][3][level]].append(i)
            else:
                place[i] = node
        total, many = sum(map(len, by.values())), len(by) > p.most_branches
        pooled = defaultdict(list)
        for seg, ids in by.items():
            pooled["*" if many and len(ids) < p.rare * total else seg] += ids

        def shares(ids):
            lab = [labels[i] for i in ids if labels[i]]
            nxt = [cut[i][3][level + 1] if len(cut[i][3]) > level + 1 else None for i in ids]
            return (len(ids), nxt.count(None)), (len(ids), sum("<" in x for x in nxt if x)), (len(lab), lab.count("block"))

        groups = []
        for label in sorted(pooled, key=lambda s: (-len(pooled[s]), s)):
            mine = shares(pooled[label])
            for g in groups:
                if all(not a or not b or abs(x / a - y / b) <= math.sqrt(math.log(2 / p.alpha) / 2) * (1 / math.sqrt(a) + 1 / math.sqrt(b)) for (a, x), (b, y) in zip(shares(g[1]), mine, strict=True)):
                    g[1].extend(pooled[label])
                    break
            else:
                groups.append((label, list(pooled[label])))
        for label, ids in groups:
            grow(ids, level + 1, f"{node}/{label}")

    hosts = defaultdict(list)
    for i, c in enumerate(cut):
        hosts[c[0]].append(i)
    prior = sum(x == "block" for x in labels) / max(1, sum(x is not None for x in labels))
    out = [None] * len(rows)
    for ids in hosts.values():
        grow(ids, 0, "")
        nodes = defaultdict(list)
        for i in ids:
            nodes[place[i]].append(i)
        for node, members in nodes.items():
            lab = [labels[i] for i in members if labels[i]]
            bad = lab and (lab.count("block") + p.prior_rows * prior) / (len(lab) + p.prior_rows) >= p.purity and len(lab) >= p.labelled_share * len(members)
            for i in members:
                out[i] = (*cut[i][:3], labels[i] or ("block" if bad else "allow"), (node or "/") if cut[i][2] is None else None)
    return out


def test_url_templates_match_a_plain_tree(spark):
    rows = urls()
    p = url_templates.TemplateParams(levels=5, most_branches=8, rare=0.05)
    pages = spark.createDataFrame([(i if i % 50 else None, u, "h", "x", 1, "y", "z") for i, u in enumerate(rows)], PAGES)
    got = url_templates.judged(pages, p=p)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    want = Counter((i if i % 50 else None, *w) for i, w in enumerate(plain_urls(rows, p)))
    assert Counter(tuple(r)[:6] for r in got.collect()) == want
    free = Counter(w[3] for w in plain_urls(rows, p) if w[2] is None)
    assert free["block"] and free["allow"]


def test_url_query_on_the_table(spark):
    got = {r.page_id: tuple(r)[1:6] for r in QUERIES["op11_url_templates"](spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert got == {r.page_id: w for r, w in zip(rows, plain_urls([r.url for r in rows], url_templates.TemplateParams()), strict=True)}


@pytest.mark.parametrize("kind", ["fixture", "empty"])
def test_url_rules_match_sql(spark, tmp_path, kind):
    pages = spark.createDataFrame([(i, u, "h", "x", 1, "y", "z") for i, u in enumerate(urls() if kind == "fixture" else [])], PAGES)
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["url_rules"](spark, str(tmp_path))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        want = db.execute(ORACLES["url_rules"]).fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert QUERIES["op11_url_templates"](spark, str(tmp_path)).count() == len(want)


def test_a_crowded_node_becomes_a_wildcard(spark):
    names = ["".join(x) for x in itertools.product("abcdefgh", repeat=3)]
    pages = spark.createDataFrame([(i, f"http://h.net/{'es' if i % 2 else 'u'}/{n}") for i, n in enumerate(names)], "page_id long, url string")
    assert {r.template for r in url_templates.judged(pages).where("rule is null").collect()} <= {"/u/*", "/es/*"}


# --- op12 -------------------------------------------------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, ratio=5):
    near = {w: [v for v in counts if v != w and one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), counts[w], len(near[w]), form[w] and counts[form[w]]) for w in counts}


def plain_vocabulary(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


@pytest.mark.parametrize("words,chars", [(2048, 1 << 16), (3, 1 << 16), (2048, 40)])
def test_variants_match_all_pairs(spark, words, chars):
    rng = random.Random(words + chars)
    counts = {}
    for _ in range(60):
        base = "".join(rng.choice("abé") for _ in range(rng.randrange(6, 12)))
        counts[base] = rng.choice([25, 125, 125, 625])
        for _ in range(6):
            at = rng.randrange(len(base) + 1)
            v = rng.choice([base[:at] + rng.choice("abz") + base[at:], base[:at] + base[at + 1 :], base[:at] + rng.choice("abc") + base[at + 1 :]])
            if len(v) >= 6:
                counts.setdefault(v, rng.choice([5, 5, 6, 25]))
    counts |= {"a" * k: 5**k % 9973 + 5 for k in range(6, 30)} | {"aaaaaa" + "".join(x): 7 for x in itertools.product("ab", repeat=3)} | {"ÿ" * 6: 5, "x" * 3000: 9, "x" * 2999 + "y": 90, "x" * 1500 + "q" + "x" * 1500: 9}
    p = spelling.SpellingParams(unit_words=words, unit_chars=chars)
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), p)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(counts) and set(got) == plain_variants(counts)


def test_a_chain_of_forms_is_followed_to_its_end(spark):
    words = {"xyzwvuts"[:k] + "abcdefgh"[k:] + "tail": 5 ** (k + 1) for k in range(9)}
    got = {r.word: r.root for r in spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"xyzwvutstail"} and set(map(tuple, got.items())) == {(w, r) for w, _, r, *_ in plain_variants(words)}


def test_acceptor_is_minimal():
    words = sorted({"".join(x) + e for x in itertools.product("ab", repeat=4) for e in ("", "s", "ing")})
    a = spelling.Acceptor(words)
    seen, stack = {0}, [0]
    while stack:
        for to, _ in a.arcs[stack.pop()].values():
            if to not in seen:
                seen.add(to)
                stack.append(to)
    assert len(seen) == 8  # start and four letters; i and n; s and g end in the same state


@pytest.mark.parametrize("kind", ["fixture", "table", "empty", "nulls"])
def test_spelling_query_matches_brute_force(spark, docs, tmp_path, kind):
    folder = "/root/testdata/sf0.001" if kind == "table" else str(tmp_path)
    if kind != "table":
        {"fixture": docs.unionAll(docs).unionAll(docs), "empty": docs.limit(0), "nulls": docs.where("text is null or doc_id is null")}[kind].write.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    counts = plain_vocabulary(rows)
    got = [tuple(r) for r in QUERIES["op12_spelling"](spark, folder).collect()]
    assert len(got) == len(counts) and {(r[0], r[3]) for r in got} == set(counts.items())
    if kind != "fixture":
        assert set(got) == plain_variants(counts)


# --- op13 -------------------------------------------------------------------------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """All best edits by a table of (cost, letters) from the end, over rows (role, text) in order."""
    faults, seen = [], set()
    for role, text in rows:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    full = {"u": "user", "a": "assistant"}

    def inserts(best):
        for _ in range(3):
            best = [min([best[s]] + [(5 + best[t][0], "I" + best[t][1], ((full[c], ""), best[t][2])) for (s0, c), t in step.items() if s0 == s and c in "ua"], key=lambda x: x[:2]) for s in range(4)]
        return best

    best = inserts([(0, "", None) if s in (0, 3) else (10**9, "~", None) for s in range(4)])
    for (role, text), fault in zip(reversed(rows), reversed(faults), strict=True):
        new = []
        for s in range(4):
            options = [(2 + best[s][0], "D" + best[s][1], best[s][2])]
            if fault in (None, "truncated"):
                more = 5 if fault else 0
                for (s0, c), t in step.items():
                    if s0 == s and role[:1] == c:
                        options.append((more + best[t][0], "K" + best[t][1], ((role, text), best[t][2])))
                    if s0 == s and c in "ua":
                        options.append((1 + more + best[t][0], "R" + best[t][1], ((full[c], text), best[t][2])))
            new.append(min(options, key=lambda x: x[:2]))
        best = inserts(new)
    cost, audit, out = best[0]
    lines = []
    while out:
        lines.append(f"{out[0][0]}:{out[0][1]}")
        out = out[1]
    pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(rows)]
    return (faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), sum(x not in ("su", "ua", "au") for x in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_damage(rows):
    """(turn, role, text) by conv_id after damage."""
    out = {}
    for conv_id, turn, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        role, text, k = name(role), name(text), zlib.crc32(f"{name(conv_id)}:{name(turn)}".encode()) % 20
        mine = out.setdefault(conv_id, [])
        if k:
            mine += [(turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)] * (2 if k == 3 else 1)
    return out


def plain_rows(rows):
    out = set()
    for conv_id, mine in plain_damage(rows).items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in mine if t is not None}
        out.add((conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *plain_repair([r[1:] for r in mine])))
    return out


def conversations():
    rng = random.Random(5)
    out = [(10**6, 3, "user", "only one"), (None, 1, "user", "no id."), (None, None, None, None), (7, 0, None, "x."), (7, 1, "", "y."), (7, 2, "Su", "z."), (7, 2, "tool", "z."), (8, -(2**63), "user", "a."), (8, 2**63 - 1, "assistant", "b.")]
    for c in range(300, 420):
        for t in range(rng.randrange(1, 14)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool"])
            out.append((c, rng.choice([t, t, t, None, t + 5]), role, rng.choice(["Fine.", "Fine.", "cut off", "What? \n", " ", "", None, "Hä!", "x" * 30 + "."])))
    out += [(500, t % 40, "user", "Same.") for t in range(400)] + [(501, t, rng.choice(["user", "assistant"]), f"Nr {t}.") for t in range(1000)]
    return out + out[:60]


SCHEMA = "conv_id long, turn long, role string, text string, c long, symbol string, kind long, late string"


def test_repair_matches_a_plain_table(spark, tmp_path):
    rows = conversations()
    spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA).repartition(7).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op13_repair"](spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [tuple(r) for r in got.collect()]
    want = {(r[0], min(r[1], 2**63 - 1), *r[2:]) for r in plain_rows(rows)}
    assert len(got) == len(want) and set(got) == want


def test_repair_of_the_table_and_of_none(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in QUERIES["op13_repair"](spark, "/root/testdata/sf0.01").collect()} == plain_rows(rows)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op13_repair"](spark, str(tmp_path)).collect() == []


def test_blocks_give_the_letters_of_single_rows():
    """Every short symbol string, and long ones, against letters chosen with plain vectors of whole costs."""
    t = repair.tables()
    rng = random.Random(9)

    def plain(symbols):
        costs = [repair._inserted([0 if s in repair.ACCEPTS else 1 << 20 for s in range(4)])]
        for x in reversed(symbols):
            costs.append(repair._inserted([min(c + costs[-1][to] for _, c, to in repair._edits(x, s)) for s in range(4)]))
        costs.reverse()
        state, out = 0, ""
        for i in range(len(symbols) + 1):
            while True:
                to = repair.STEP[state][repair.WANTED[state]]
                choices = [(a, n) for a, c, n in (repair._edits(symbols[i], state) if i < len(symbols) else []) if c + costs[i + 1][n] == costs[i][state]]
                choices += [("I", to)] * (5 + costs[i][to] == costs[i][state])
                if not choices:
                    break
                letter, state = min(choices)
                out += letter
                if letter != "I":
                    break
        return costs[0][0], out

    some = [x for n in range(5) for x in itertools.product(range(9), repeat=n)]
    some += [[rng.randrange(9) for _ in range(rng.randrange(5, 80))] for _ in range(300)]
    for symbols in some:
        assert t.repair(np.array(symbols, np.uint8)) == plain(list(symbols))
