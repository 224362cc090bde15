"""Spelling variants: words that are one edit apart, by composing the minimised vocabulary with a one-edit transducer and itself.

The vocabulary is cut into units.  All pairs of a unit share a prefix, a suffix and the length ``m`` of the shorter word's middle, so
a unit is the part of the composition behind one initial state.  A pair with an edit behind the first half of the shorter word shares that half,
any other pair shares the last half; so each split gives a word two rows (four at first, as it may be the shorter or the longer one), and a
unit with too many words or characters is split again, until its middle is one letter or less (then it holds all words of two free letters at
most).  Nothing is capped.  ``upper`` keeps the halves apart: a unit yields only pairs whose common prefix is shorter, so that each pair is met once.

In a unit the middles become a minimal deterministic acceptor whose states carry the number of words behind them.  Composition with the edit and
the acceptor again runs over state pairs: the same state up to the first difference, then a replaced or an extra symbol, then equal
symbols on both sides; the words of a pair are the sums of the numbers passed over, so no strings are built.  Results of a state pair are kept for all
prefixes that lead there.

Edges: null texts have no words; repeated rows count as occurrences; a null doc_id damages nothing (its hash is null); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.llm.common import discard, give_back, table, written

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["m", "upper", "pre", "suf"]
NO_LIMIT = (1 << 31) - 1


@dataclass(frozen=True)
class SpellingParams:
    shortest: int = 6
    least_n: int = 5
    #: a word's form occurs at least so many times as often
    ratio: int = 5
    #: words and characters of a unit, beyond which it is split
    unit_words: int = 2048
    unit_chars: int = 1 << 16


def damaged_runs(docs: DataFrame, shortest: int, every: int = 199) -> DataFrame:
    """The lower-cased runs of letters of all texts; where ``every`` divides crc32(doc_id:run), one letter is deleted."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("word"))
    runs = runs.select("word", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "word").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("word")).cast("int")
    cut = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
    return runs.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, p: SpellingParams) -> DataFrame:
    """word and n of all words that are long and frequent enough."""
    return words.where(F.char_length("word") >= p.shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= p.least_n)


def _halves(rows: DataFrame) -> DataFrame:
    """Two rows of each: one that adds the first half of ``m`` letters to the prefix, and one that adds the last half to the suffix."""
    h = F.floor(F.col("m") / 2).cast("int")
    size = F.char_length("mid")
    front = F.struct((F.col("m") - h).alias("m"), F.col("upper"), F.concat("pre", F.substr("mid", F.lit(1), h)).alias("pre"), F.col("suf"), F.substr("mid", h + 1).alias("mid"))
    back = F.struct((F.col("m") - h).alias("m"), F.least("upper", F.char_length("pre") + h).cast("int").alias("upper"), F.col("pre"), F.concat(F.substr("mid", size - h + 1), "suf").alias("suf"), F.substr("mid", F.lit(1), size - h).alias("mid"))
    return rows.select(F.explode(F.array(front, back)).alias("x"), "n").select("x.*", "n").where(F.col("upper") > F.char_length("pre"))


class Acceptor:
    """Minimal acceptor of sorted distinct words: for each state its symbols with next state and number of words before them, and whether it accepts."""

    def __init__(self, words: list[str]):
        arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        path, last = [0], ""

        def close(depth: int) -> None:
            for i in range(len(path) - 1, depth, -1):
                state = path.pop()
                kept = known.setdefault((self.final[state], tuple(arcs[state].items())), state)
                arcs[path[-1]][last[i - 1]] = kept

        for word in words:
            same = next((i for i, (a, b) in enumerate(zip(word, last, strict=False)) if a != b), min(len(word), len(last)))
            close(same)
            for c in word[same:]:
                arcs.append({})
                self.final.append(False)
                arcs[path[-1]][c] = len(arcs) - 1
                path.append(len(arcs) - 1)
            self.final[path[-1]] = True
            last = word
        close(0)
        self.arcs: list[dict[str, tuple[int, int]]] = [{}] * len(arcs)
        behind = [0] * len(arcs)
        # words behind each state, from the ends of the words towards the start
        stack = [(0, False)]
        while stack:
            state, done = stack.pop()
            if done:
                n, self.arcs[state] = int(self.final[state]), {}
                for c, to in arcs[state].items():
                    self.arcs[state][c] = (to, n)
                    n += behind[to]
                behind[state] = n
            elif not behind[state]:
                stack.append((state, True))
                stack += [(to, False) for to in arcs[state].values() if not behind[to]]


def near_pairs(words: list[str], m: int, depth: int) -> Iterator[tuple[int, int]]:
    """Numbers of all pairs of the sorted ``words`` that are one edit apart, whose shorter word has ``m`` letters and which differ before place ``depth``."""
    a = Acceptor(words)
    arcs, final, size = a.arcs, a.final, [len(w) for w in words]
    memo: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def shared(p: int, q: int) -> list[tuple[int, int]]:
        """Ranks behind p and behind q of the suffixes that both accept."""
        found = memo.get((p, q))
        if found is None:
            found, stack = [], [(p, q, 0, 0)]
            while stack:
                s, t, i, j = stack.pop()
                if final[s] and final[t]:
                    found.append((i, j))
                other = arcs[t]
                for c, (to, skip) in arcs[s].items():
                    if c in other:
                        stack.append((to, other[c][0], i + skip, j + other[c][1]))
            memo[p, q] = found
        return found

    todo = [(0, 0, 0)] if depth > 0 else []
    while todo:
        state, base, at = todo.pop()
        out = list(arcs[state].items())
        for k, (b, (to, skip)) in enumerate(out):
            if at + 1 < depth:
                todo.append((to, base + skip, at + 1))
            for _, (to2, skip2) in out[k + 1 :]:  # a replaced symbol
                for i, j in shared(to, to2):
                    if size[base + skip + i] == m:
                        yield base + skip + i, base + skip2 + j
            if final[state] and final[to] and at == m:  # an extra symbol b at the end, or before another symbol c
                yield base, base + skip
            extra = arcs[to]
            for c, (to2, skip2) in out:
                if c != b and c in extra:
                    for i, j in shared(to2, extra[c][0]):
                        if size[base + skip2 + i] == m:
                            yield base + skip2 + i, base + skip + extra[c][1] + j


def _unit_rows(m: int, upper: int, pre: str, suf: str, rows: list[tuple[str, int]]) -> list[tuple[str, int, int, str]]:
    """word, number of near words, n and spelling of the most frequent one, for the words (middle, n) of one unit that have any."""
    rows.sort()
    words, n = [x[0] for x in rows], [x[1] for x in rows]
    near, best = [0] * len(words), [-1] * len(words)
    for i, j in near_pairs(words, m, min(upper - len(pre), m + 1)):
        for x, y in ((i, j), (j, i)):
            near[x] += 1
            # of equal n the smaller spelling; numbers don't follow it, as a middle can go on where another one ends
            if best[x] < 0 or (-n[y], pre + words[y] + suf) < (-n[best[x]], pre + words[best[x]] + suf):
                best[x] = y
    return [(pre + words[x] + suf, near[x], n[best[x]], pre + words[best[x]] + suf) for x in range(len(words)) if near[x]]


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words by unit; the rows come sorted by unit, and a unit's size is bounded."""
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def done(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        key, rows = [t.column(c).to_pylist() for c in KEY], list(zip(t.column("mid").to_pylist(), t.column("n").to_pylist(), strict=True))
        found = [r for at, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True) if end - at > 1 for r in _unit_rows(*(k[at] for k in key), rows[at:end])]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], f.type) for k, f in enumerate(schema)], schema=schema)

    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
        if not len(t):
            continue
        new = np.zeros(len(t) - 1, bool)
        for c in KEY:
            new |= pc.not_equal(t.column(c).slice(1), t.column(c).slice(0, len(t) - 1)).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        held = t.slice(starts[-1])  # the last unit may go on in the next batch
        yield done(t, starts)
    if held is not None:
        yield done(held, np.array([0, len(held)]))
    give_back()


def near_words(vocab: DataFrame, p: SpellingParams) -> DataFrame:
    """word, n_near, best_n and best (its most frequent near word; ties to the least in code-point order) of all words with a near word."""
    size = F.char_length("word").cast("int")
    rows = vocab.select(F.explode(F.array(size, size - 1)).alias("m"), F.lit(NO_LIMIT).alias("upper"), F.lit("").alias("pre"), F.lit("").alias("suf"), F.col("word").alias("mid"), "n")
    rows, made, found = written(_halves(rows), "spelling-units"), [], []
    while True:
        crowded = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("c"), F.sum(F.char_length("mid")).alias("chars"))
        crowded = written(crowded.where("m > 1").where((F.col("c") > p.unit_words) | ((F.col("c") > 1) & (F.col("chars") > p.unit_chars))).select(*KEY), "spelling-crowded")
        units = rows.join(crowded, KEY, "left_anti").repartition(*KEY).sortWithinPartitions(*KEY)
        found.append(written(units.mapInArrow(_compose, "word string, near long, best_n long, best string"), "spelling-near"))
        made += [rows, crowded]
        if crowded.isEmpty():
            break
        rows = written(_halves(rows.join(crowded, KEY, "left_semi")), "spelling-units")
    discard(*made)
    each = found[0]
    for f in found[1:]:
        each = each.unionAll(f)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return each.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root for rows (word, form): each word's link is replaced by its target's, until none moves.

    A form occurs several times as often as its word, so there are no rings and a chain's length is bounded by the logarithm of the largest count;
    the number of rounds grows with the logarithm of that length.
    """
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(at.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        discard(at)
        at = moved
        if at.where("moved").isEmpty():
            return at.select("word", "root")


def variants(vocab: DataFrame, p: SpellingParams = SpellingParams()) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of ``vocab`` (word, n)."""
    near = written(near_words(vocab, p), "spelling-best")
    rows = vocab.join(near, "word", "left")
    is_form = F.col("best_n") >= p.ratio * F.col("n")
    rows = written(rows.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, form, root, n, n_near, form_n of every frequent word of all documents."""
    p = SpellingParams()
    return variants(written(vocabulary(damaged_runs(table(spark, sf_dir, "documents"), p.shortest), p), "spelling-vocabulary"), p)
