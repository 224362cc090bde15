"""Conversation structure repair: the cheapest edits that make a conversation an optional system turn and user/assistant pairs.

Rows are symbols (a fault class and a role initial).  The cost to go from each state of the pattern is a vector of four numbers; less its least number it
is one of a few normalised vectors, as an inserted turn bounds every difference.  For each such vector and each block of ``BLOCK`` symbols a table, built
once a process, holds the normalised vector in front of the block and what the least number grew by.  A conversation is read from its
end, a lookup a block; then each block is expanded backward from the vector behind it and the edits are chosen from the front: the letter that is
least in ASCII among those that still reach the best cost, so ties are decided by the whole rest of the conversation.

Faults are found by aggregates over (conversation, role, text), equal rows are one row with a count, and rows go sorted by conversation into one
streamed pass: a conversation's symbols take a byte a row, its texts are hashed one by one as they come.  A digest is sequential, so a conversation's
rows pass through one task, but are never held there.

Edges: null ids, turns, roles and texts are as the contract says; a null conv_id is a conversation of its own (without an id crc32 is taken of a space);
rows of one turn are ordered by role and text; an empty table gives no rows; other columns are ignored; gaps beyond a long are cut to the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ionloom.llm.common import WORD_SPACE, give_back, table

BLOCK = 3
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: Symbols: a row that must go; then the role initials s, u, a and any other, whole and cut off.
ROLES = "sua?"
GONE, SYMBOLS = 0, 9
#: Pattern states: nothing yet, after s, after u, after a.  Next state by state and initial.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTS = (0, 3)
WANTED = tuple("a" if s == 2 else "u" for s in range(4))
FULL = {"u": "user", "a": "assistant"}
AUDIT_COLUMNS = "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _inserted(costs: list[int]) -> list[int]:
    """The cheapest cost of each state if turns may be inserted first."""
    out = list(costs)
    for _ in range(2):  # two inserted turns lead back to a state after an assistant turn
        out = [min(out[s], INSERT + out[STEP[s][WANTED[s]]]) for s in range(4)]
    return out


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of what can be done with a row."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        more = CUT_OFF if symbol > 4 else 0
        role = ROLES[(symbol - 1) % 4]
        if role in STEP[state]:
            out.append(("K", KEEP + more, STEP[state][role]))
        out.append(("R", REROLE + more, STEP[state][WANTED[state]]))
    return out


class Tables:
    """Normalised vectors, transitions by symbol and by block, and traces of blocks as they are needed."""

    def __init__(self) -> None:
        end = _inserted([0 if s in ACCEPTS else 1 << 20 for s in range(4)])
        self.vectors = [tuple(x - min(end) for x in end)]
        known = {self.vectors[0]: 0}
        self.step: list[list[tuple[int, int]]] = []
        for vector in self.vectors:  # grows until no new vector comes up
            row = []
            for symbol in range(SYMBOLS):
                costs = _inserted([min(c + vector[t] for _, c, t in _edits(symbol, s)) for s in range(4)])
                less = min(costs)
                new = tuple(x - less for x in costs)
                if new not in known:
                    known[new] = len(self.vectors)
                    self.vectors.append(new)
                row.append((known[new], less))
            self.step.append(row)
        self.blocks = [[self._through(v, code) for code in range(SYMBOLS**BLOCK)] for v in range(len(self.vectors))]
        self.traces: dict[tuple[int, int, int], tuple[str, int]] = {}

    def _through(self, v: int, code: int) -> tuple[int, int]:
        grown = 0
        for _ in range(BLOCK):
            code, symbol = divmod(code, SYMBOLS)
            v, more = self.step[v][symbol]
            grown += more
        return v, grown

    def _row(self, v: int, symbol: int, state: int) -> tuple[str, int]:
        """The least letters that are best for one row, with vector ``v`` behind it."""
        before, grown = self.step[v][symbol]
        best, behind, letters = [x + grown for x in self.vectors[before]], self.vectors[v], ""
        while True:
            to = STEP[state][WANTED[state]]
            choices = [(a, t) for a, c, t in _edits(symbol, state) if c + behind[t] == best[state]]
            if INSERT + best[to] == best[state]:
                choices.append(("I", to))
            letter, state = min(choices)
            letters += letter
            if letter != "I":
                return letters, state

    def block(self, v: int, code: int, state: int) -> tuple[str, int]:
        """Letters and last state of a block with vector ``v`` behind it, which is expanded backward first."""
        found = self.traces.get((v, code, state))
        if found is None:
            rest, steps, letters, at = code, [], "", state
            for _ in range(BLOCK):
                rest, symbol = divmod(rest, SYMBOLS)
                steps.append((v, symbol))
                v = self.step[v][symbol][0]
            for vector, symbol in reversed(steps):
                more, at = self._row(vector, symbol, at)
                letters += more
            found = self.traces[steps[0][0], code, state] = letters, at
        return found

    def repair(self, symbols: np.ndarray) -> tuple[int, str]:
        """Cost and letters of the best edits; of equal cost the letters that are least."""
        odd = len(symbols) % BLOCK
        codes = (symbols[odd:].reshape(-1, BLOCK).astype(np.int64) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))).tolist()
        behind, v, cost, blocks = bytearray(len(codes)), 0, 0, self.blocks
        for i in range(len(codes) - 1, -1, -1):
            behind[i] = v
            v, more = blocks[v][codes[i]]
            cost += more
        ahead = []
        for symbol in symbols[:odd][::-1].tolist():
            ahead.append((v, symbol))
            v, more = self.step[v][symbol]
            cost += more
        cost += self.vectors[v][0]
        state, out = 0, []
        for vector, symbol in reversed(ahead):
            letters, state = self._row(vector, symbol, state)
            out.append(letters)
        for i, code in enumerate(codes):
            letters, state = self.block(behind[i], code, state)
            out.append(letters)
        return cost, "".join(out) + {0: "", 1: "II", 2: "I", 3: ""}[state]


@lru_cache(1)
def tables() -> Tables:
    made = Tables()
    if len(made.vectors) > 255:
        raise ValueError("vector numbers take a byte")
    return made


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text (nulls: one space) of the rows after damage."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("op"))
    cut = F.when(F.col("op") == 1, "").when(F.col("op") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.where("op <> 0").select("conv_id", "turn", F.when(F.col("op") == 4, "user").otherwise(F.col("role")).alias("role"), cut.alias("text"), "op")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("op") == 3, 2).otherwise(1)))).drop("op", "copy")


def symbol_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies ``c`` and the symbol of the first copy; further copies are duplicates or blank.

    ``blank`` and ``late`` (role and text stood in an earlier turn) are told by aggregates, so a crowded conversation is no window.
    """
    rows = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    one = rows.groupBy("conv_id", "turn", "role", "digest", "text").agg(F.count(F.lit(1)).alias("c"))
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))).alias("first"))
    same = [one[k].eqNullSafe(first[k]) for k in ("conv_id", "role", "digest")]
    one = one.join(first, same[0] & same[1] & same[2]).select(one["conv_id"], one["turn"], one["role"], one["text"], "c", (~F.col("first.turn").eqNullSafe(one["turn"])).alias("late"))
    end = F.right(F.rtrim(F.col("text"), F.lit(WORD_SPACE)), F.lit(1))
    one = one.withColumns({"blank": end == "", "cut": ~end.isin(".", "!", "?")})
    place = F.instr(F.lit("sua"), F.substr("role", F.lit(1), F.lit(1)))
    place = F.when((F.col("role") == "") | (place == 0), 4).otherwise(place)
    return one.withColumn("symbol", F.when(F.col("blank") | F.col("late"), GONE).otherwise(place + F.when(F.col("cut"), 4).otherwise(0)).cast("short"))


class _Conversation:
    """What the streamed pass knows of one conversation: counts and symbols first, then edits and the digest of the repaired rows."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.symbols, self.copies = conv_id, bytearray(), []
        self.turns, self.least, self.most, self.last_turn = 0, None, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial, self.audit, self.at, self.state, self.digest, self.begun = None, None, 0, 0, hashlib.sha256(), False

    def add(self, turn, initial: str, c: int, symbol: int, blank: bool, late: bool) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.last_turn or self.most is None
            self.most = self.last_turn = turn
        self.blank += c if blank else 0
        self.duplicate += 0 if blank else c if late else c - 1
        self.truncated += symbol > 4
        self.illegal += (c - 1) + (self.initial is not None and self.initial + initial not in ("su", "ua", "au"))
        self.initial = initial
        self.symbols.append(symbol)
        if c > 1:
            self.symbols += bytes(c - 1)  # GONE

    def decide(self) -> None:
        self.cost, self.audit = tables().repair(np.array(list(memoryview(self.symbols)), np.uint8) if len(self.symbols) < BLOCK else np.frombuffer(bytes(self.symbols), np.uint8))
        self.symbols = bytearray()

    def _put(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.begun else "").encode() + f"{role}:{text}".encode("utf-8", "replace"))
        self.begun = True

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            wanted = WANTED[self.state]
            self._put(FULL[wanted], "")
            self.state, self.at = STEP[self.state][wanted], self.at + 1

    def write(self, role: str, text: str, c: int) -> None:
        """The edits of a row and its copies; only the first copy can stay."""
        if self.audit is None:
            self.decide()
        for _ in range(c):
            self._inserts()
            letter = self.audit[self.at]
            self.at += 1
            if letter != "D":
                wanted = role[:1] if letter == "K" else WANTED[self.state]
                self._put(role if letter == "K" else FULL[wanted], text)
                self.state = STEP[self.state][wanted]

    def row(self) -> tuple:
        if self.audit is None:
            self.decide()
        self._inserts()
        gaps = 0 if self.most is None else min((1 << 63) - 1, self.most - self.least + 1 - self.turns)
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit, self.digest.hexdigest())


def _streamed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row a conversation; its rows come in three runs: one that names it, its rows without texts, its rows with texts."""
    now, out, weight = None, [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text", "c", "symbol", "blank", "late")]
        for conv_id, kind, turn, role, text, c, symbol, blank, late in zip(*cols, strict=True):
            if kind == 0:
                if now is not None:
                    out.append(now.row())
                    weight += len(now.audit) + 200
                    if weight > 1 << 20:
                        yield flush()
                        out, weight = [], 0
                now = _Conversation(conv_id)
            elif kind == 1:
                now.add(turn, role, c, symbol, blank, late)
            else:
                now.write(role, text, c)
    if now is not None:
        out.append(now.row())
    yield flush()
    give_back()


def repair(conversations: DataFrame, after: DataFrame) -> DataFrame:
    """Counts, cost, edits and the repaired rows' digest of every conv_id of ``conversations``, whose rows are now those of ``after``."""
    rows = symbol_rows(after).select("conv_id", "turn", "role", "text", "c", "symbol", "blank", "late")
    nothing = [F.lit(None).cast(kind).alias(c) for c, kind in rows.dtypes[1:]]
    dealt = rows.unionAll(conversations.select("conv_id").distinct().select("conv_id", *nothing)).repartition("conv_id")
    # behind the shuffle each row comes twice, for the two runs; both are in the order of turn, role and text
    runs = F.when(F.col("c").isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(1), F.lit(2)))
    dealt = dealt.select("conv_id", F.explode(runs).alias("kind"), *rows.columns[1:]).sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "text")
    # the first run needs no texts, and of roles the initial
    read = dealt.withColumns({"text": F.when(F.col("kind") == 2, F.col("text")), "role": F.when(F.col("kind") == 2, F.col("role")).otherwise(F.substr("role", F.lit(1), F.lit(1)))})
    columns = AUDIT_COLUMNS.format(id=dict(conversations.dtypes)["conv_id"])
    schema = pa.schema([("conv_id", to_arrow_type(conversations.schema["conv_id"].dataType)), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return read.mapInArrow(lambda batches: _streamed(batches, schema), columns)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every damaged conversation."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(conversations, damaged(conversations))
