"""Random mass-matched decoys as a table function with an explicit seed.

A decoy ends in K or R (five chances in eleven each, else in any residue), gets random residues in front until its mass
reaches the upper bound, and then up to ``rounds`` single replacements that bring the mass as near to the target as possible.
It counts if its mass lies within the bounds, its length is 6 to 50 and it misses 3 cleavages at most.  Attempts are
bounded by number, not time, and the seed decides everything, so a retried task makes the same rows.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ionloom.constants import WATER, mass_int
from ionloom.operators.ptm import UNMODIFIED, StaticModifications
from ionloom.session import dealt

#: Precursors of one task, whose decoys take some seconds.
ROWS_A_TASK = 10_000
#: Failed decoys in a row after which the table function gives up.
FAILURES = 3
_MISSED = re.compile("(?<=[KR])(?!(P|$))")


@dataclass(frozen=True)
class DecoyRules:
    shortest: int = 6
    longest: int = 50
    missed_cleavages: int = 3
    rounds: int = 100
    attempts: int = 200


def acceptable(sequence: str, mass: int, lo: int, hi: int, rules: DecoyRules) -> bool:
    return lo <= mass <= hi and rules.shortest <= len(sequence) <= rules.longest and len(_MISSED.findall(sequence)) <= rules.missed_cleavages


def decoy(target: int, lo: int, hi: int, rng: random.Random, rules: DecoyRules = DecoyRules(), mods: StaticModifications = UNMODIFIED, needs: str = "", first: str = "", last: str = "") -> str | None:
    """One decoy, or None if no attempt succeeds; its mass includes the static modifications.

    ``needs`` are residues that it must have somewhere, ``first`` and ``last`` those of its ends: places for variable modifications, whose mass the
    caller takes off the target.
    """
    parts, names, others = _residues(mods)
    ends, fixed = mass_int(WATER) + mods.n_bond + mods.c_bond, len(needs) + len(first)
    bits, count, kinds = rng.getrandbits, len(names), len(names).bit_length()

    def below(n: int, k: int) -> int:  # what randrange and choice draw, without their checks
        r = bits(k)
        while r >= n:
            r = bits(k)
        return r

    for _ in range(rules.attempts):
        slot = below(11, 4)
        seq = [*first, *needs, last or (names[below(count, kinds)] if slot == 0 else "K" if slot <= 5 else "R")]
        mass = ends + sum(parts[a] for a in seq)
        while mass < hi:
            new = names[below(count, kinds)]
            seq.insert(fixed, new)
            mass += parts[new]
        free = len(seq) - 1 - fixed
        width = max(free, 0).bit_length()
        for _ in range(rules.rounds):
            if lo <= mass <= hi:
                whole = seq
                if needs:
                    body = seq[len(first) : -1]
                    rng.shuffle(body)
                    whole = [*first, *body, seq[-1]]
                if acceptable("".join(whole), mass, lo, hi, rules):
                    return "".join(whole)
            if free < 1:
                break
            at = fixed + below(free, width)
            old = parts[seq[at]]
            masses, named = others[seq[at]]
            need = target - mass + old
            i = bisect_left(masses, need)
            if i == len(masses) or i and (need - masses[i - 1], named[i - 1]) < (masses[i] - need, named[i]):
                i -= 1
            mass += masses[i] - old
            seq[at] = named[i]
    return None


@lru_cache(maxsize=16)
def _residues(mods: StaticModifications) -> tuple[dict[str, int], list[str], dict[str, tuple[list[int], list[str]]]]:
    """Masses, names in order, and for each residue the rising masses of the others with the first name of each mass."""
    parts = mods.masses()
    names, others = sorted(parts), {}
    for a in names:
        by_mass = {}
        for b in names:
            if b != a:
                by_mass.setdefault(parts[b], b)
        masses = sorted(by_mass)
        others[a] = masses, [by_mass[m] for m in masses]
    return parts, names, others


def register(spark: SparkSession, mods: StaticModifications = UNMODIFIED) -> None:
    """The table function ``decoys(seed, target, lo, hi, n[, needs, first, last])`` for SQL: rows (nr, sequence).

    It gives up after ``FAILURES`` failures in a row, as most such masses have no decoy; who needs all asks again with another seed.
    """

    class Decoys:
        def eval(self, seed: int, target: int, lo: int, hi: int, n: int, needs: str = "", first: str = "", last: str = "") -> Iterator[tuple[int, str]]:
            rng, failed = random.Random(seed), 0
            for nr in range(n or 0):
                got = decoy(target, lo, hi, rng, mods=mods, needs=needs, first=first, last=last)
                failed = failed + 1 if got is None else 0
                if failed == FAILURES:
                    return
                if got is not None:
                    yield nr, got

    spark.udtf.register("decoys", F.udtf(Decoys, returnType="nr int, sequence string"))


def generate(precursors, key: str, per_precursor: int, seed: int = 0, mods: StaticModifications = UNMODIFIED):
    """key, nr and sequence of decoys for every precursor with integer mass, lo and hi."""
    spark = precursors.sparkSession
    register(spark, mods)
    rows = precursors.select(key, F.xxhash64(F.col(key).cast("string"), F.lit(seed)).alias("seed"), "mass_int", "lo", "hi")
    rows = dealt(rows, ROWS_A_TASK, key)
    return spark.sql(f"SELECT {key}, nr, sequence FROM {{rows}}, LATERAL decoys(seed, mass_int, lo, hi, {int(per_precursor)})", rows=rows)
