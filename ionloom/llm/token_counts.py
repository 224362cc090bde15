"""Operator 8: token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

A text, with one space put in front, is cut into pre-tokens: a run of spaces with the characters up to the next space
(spaces become U+2581).  No vocabulary piece has that mark after another character, so the best segmentation of a text
is that of its pre-tokens.  Distinct pre-tokens enter a trie.  A node stands for a prefix and keeps its forward score,
the largest sum of piece scores over all segmentations of the prefix, and the tokens of that segmentation (fewer tokens
win a tie).  Pre-tokens with a common prefix share its nodes, so each score is computed once; the count of the last node
is stored for the pre-token.

Scores: the vocabulary file orders pieces by merge rank, so piece number r gets Zipf's log-probability -ln(r + 1) - ln H.
A character that no piece covers costs 10 more than the least score and counts as its UTF-8 bytes.

Scale: one pass without a shuffle; each task keeps a trie of at most ``max_nodes`` nodes and starts a new one when it is
full, which changes no count.

Edge cases: null text has null counts; the empty text has 0 tokens; repeated rows are counted one by one; extra columns
are ignored.  Very long pre-tokens are computed without being stored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionloom.llm.common import slices, table

MARK = "▁"
COUNTS = "doc_id long, n_tokens long, n_pretokens long"


@dataclass(frozen=True)
class TokenCountParams:
    model: str = "piece_bpe_32k.model"
    max_nodes: int = 600_000
    longest_stored: int = 64


def piece_scores(model_path: str) -> dict[str, float]:
    """Piece to log-probability; control, unknown and byte pieces have no text of their own."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    ranked = sorted(plain, key=lambda x: (-sp.get_score(sp.piece_to_id(x)), sp.piece_to_id(x)))
    const = math.log(sum(1 / (r + 1) for r in range(len(ranked))))
    return {x: -math.log(r + 1) - const for r, x in enumerate(ranked)}


class ForwardTrie:
    """Prefix nodes with forward scores and token counts; node 0 is the empty prefix."""

    def __init__(self, scores: dict[str, float], max_nodes: int, longest_stored: int):
        self.scores, self.max_nodes, self.longest_stored = scores, max_nodes, longest_stored
        #: every suffix of a piece, with the score of those that are pieces themselves
        self.suffixes = {x[i:]: None for x in scores for i in range(len(x))} | scores
        self.unknown = min(scores.values(), default=0.0) - 10
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best, self.count, self.stored = [0.0], [0], {}

    def _step(self, word: str, j: int, best: list[float], count: list[int], path: list[int]) -> tuple[float, int]:
        """Score and count of word[:j + 1]; path[i] is where best and count have word[:i]."""
        known, end = self.suffixes, j + 1
        if (s := known.get(word[j])) is None:
            at = path[j]
            top, n = best[at] + self.unknown, count[at] + len(word[j].encode("utf-8", "surrogatepass"))
        else:
            at = path[j]
            top, n = best[at] + s, count[at] + 1
        for i in range(j - 1, -1, -1):
            x = word[i:end]
            if x not in known:
                break  # no piece ends in this
            if (s := known[x]) is not None:
                at = path[i]
                v, c = best[at] + s, count[at] + 1
                if v > top or v == top and c < n:
                    top, n = v, c
        return top, n

    def tokens(self, word: str) -> int:
        if word in self.stored:
            return self.stored[word]
        if len(word) > self.longest_stored:
            best, count, path = [0.0], [0], list(range(len(word) + 1))
            for j in range(len(word)):
                v, c = self._step(word, j, best, count, path)
                best.append(v)
                count.append(c)
            return count[-1]
        if len(self.best) + len(word) > self.max_nodes:
            self.clear()
        node, path = 0, [0]
        for j, ch in enumerate(word):
            nxt = self.child.get((node, ch))
            if nxt is None:
                v, c = self._step(word, j, self.best, self.count, path)
                nxt = self.child[node, ch] = len(self.best)
                self.best.append(v)
                self.count.append(c)
            path.append(node := nxt)
        self.stored[word] = self.count[node]
        return self.count[node]


def text_counter(scores: dict[str, float], params: TokenCountParams) -> Callable[[str], tuple[int, int]]:
    """A function from a text to its tokens and pre-tokens."""
    trie = ForwardTrie(scores, params.max_nodes, params.longest_stored)
    runs = re.compile(" +[^ ]*")

    class Known(dict):
        def __missing__(self, w: str) -> int:
            n = trie.tokens(MARK + w)
            if len(w) < params.longest_stored:
                if len(self) >= params.max_nodes // 2:
                    self.clear()
                self[w] = n
            return n

    known = Known()

    def of(text: str) -> tuple[int, int]:
        if not text:
            return 0, 0
        if text[0] == " " or text[-1] == " " or "  " in text or MARK in text:
            words = [w.replace(" ", MARK) for w in runs.findall(" " + text)]
            return sum(map(trie.tokens, words)), len(words)
        words = text.split(" ")
        return sum(map(known.__getitem__, words)), len(words)

    return of


def count_tokens(docs: DataFrame, params: TokenCountParams = TokenCountParams(), model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, n_pretokens for every row."""
    path = model_path or public_tokenizers.path(params.model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = text_counter(piece_scores(path), params)
        for batch in slices(batches):
            got = [(None, None) if t is None else of(t) for t in batch.column("text").to_pylist()]
            cols = [pa.array([g[i] for g in got], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], ["doc_id", "n_tokens", "n_pretokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, COUNTS)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pre-tokens of each document, as ``op8_token_counts`` counts them."""
    return count_tokens(table(spark, sf_dir, "documents")).select("doc_id", "n_pretokens")


PRETOKEN_ORACLE = """
SELECT doc_id, CAST(CASE WHEN text = '' THEN 0 ELSE len(regexp_extract_all(' ' || text, ' +[^ ]*')) END AS BIGINT) AS n_pretokens FROM documents
"""
