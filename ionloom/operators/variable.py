"""Variable modifications: shifted mass windows, and placements that are written out for hits only.

A peptide may carry up to ``most`` variable modifications.  Which ones is a multiset, and there are few of them; so a window is looked up once for every
multiset, moved by its mass, and the library stays as it is.  Where the modifications sit is expanded for the pairs that the windows
let through, as column expressions.  A residue or bond carries one modification at most, and a residue with a static one carries no variable one.

A form is a sequence with its marks: ``AM[v15994915]K``, and ``[v42010565]-AMK`` or ``AMK-[v-984016]`` for the terminal bonds.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionloom.constants import SCALE
from ionloom.operators.ptm import UNMODIFIED, StaticModifications

#: More multisets than this are refused: every window is looked up once for each.
MOST_SETS = 2000
POSITIONS = ("Anywhere", "Terminus_N", "Terminus_C", "Bond_N", "Bond_C")
#: One residue of a form with all its marks.
TOKEN = r"(?s)(?:\[v-?[0-9]+\]-)?[^\[\]-](?:\[v-?[0-9]+\])?(?:-\[v-?[0-9]+\])?"


@dataclass(frozen=True)
class VariableModification:
    """An integer mass delta of a residue (anywhere or at a terminus), or of a terminal bond (no residue)."""

    residue: str
    delta: int
    position: str = "Anywhere"


def variable_modifications(ptms: DataFrame) -> tuple[VariableModification, ...]:
    """The variable rows of a modification table, in a fixed order; repeated ones count once."""
    rows = ptms.where("mod_type = 'Variable'").select(F.coalesce("amino_acid", F.lit("")).alias("residue"), F.round(F.col("mass_delta") * SCALE).cast("long").alias("delta"), "position").collect()
    if odd := [r for r in rows if r.position not in POSITIONS or (len(r.residue) != 1) != r.position.startswith("Bond")]:
        raise ValueError(f"not a residue anywhere or at a terminus, and not a bond: {odd[0]}")
    return tuple(sorted({VariableModification("" if r.position.startswith("Bond") else r.residue, r.delta, r.position) for r in rows}, key=lambda v: (POSITIONS.index(v.position), v.residue, v.delta)))


def multisets(variable: tuple[VariableModification, ...], most: int) -> list[tuple[int, ...]]:
    """Numbers of up to ``most`` modifications in ascending order, the empty one first; a terminus or bond has one place."""
    single = {i for i, v in enumerate(variable) if v.position != "Anywhere"}
    out = []
    for size in range(most + 1):
        for units in combinations_with_replacement(range(len(variable)), size):
            if all(n == 1 for i, n in Counter(units).items() if i in single):
                out.append(units)
                if len(out) > MOST_SETS:
                    raise ValueError(f"over {MOST_SETS} combinations of variable modifications: give fewer of them or a lower maximum")
    return out


def _sets(variable: tuple[VariableModification, ...], most: int) -> Column:
    """The multisets as an array of (units, delta) structs, held in the plan."""
    rows = [F.struct(F.array(*map(F.lit, u)).cast("array<int>").alias("units"), F.lit(sum(variable[i].delta for i in u)).cast("long").alias("delta")) for u in multisets(variable, most)]
    return F.array(*rows)


def shifted_windows(windows: DataFrame, variable: tuple[VariableModification, ...], most: int) -> DataFrame:
    """Every window (mass_int, lo, hi and other columns) once for each multiset, moved down by its ``delta``, with its ``units``."""
    rows = windows.withColumn("s", F.explode(_sets(variable, most)))
    moved = {c: F.col(c) - F.col("s.delta") for c in ("mass_int", "lo", "hi")}
    return rows.withColumns({**moved, "units": F.col("s.units"), "delta": F.col("s.delta")}).drop("s").where("hi > 0")


def sites(sequence: Column, v: VariableModification, mods: StaticModifications = UNMODIFIED) -> Column:
    """Places of a modification: 1 to the length for residues, 0 and one more for the bonds."""
    n, none = F.length(sequence), F.array().cast("array<int>")
    if v.position == "Bond_N":
        return F.array(F.lit(0))
    if v.position == "Bond_C":
        return F.array(n + 1)
    if mods.delta(v.residue):
        return none
    if v.position == "Terminus_N":
        return F.when(F.substr(sequence, F.lit(1), F.lit(1)) == v.residue, F.array(F.lit(1))).otherwise(none)
    if v.position == "Terminus_C":
        return F.when(F.right(sequence, F.lit(1)) == v.residue, F.array(n)).otherwise(none)
    return F.when(n > 0, F.filter(F.sequence(F.lit(1), n), lambda i: F.substr(sequence, i, F.lit(1)) == v.residue)).otherwise(none)


def with_placements(hits: DataFrame, sequence: str, variable: tuple[VariableModification, ...], most: int, mods: StaticModifications = UNMODIFIED) -> DataFrame:
    """``placements``: all ways to seat the hit's ``units``, each as an array of places; empty where they don't fit."""
    rows = hits.withColumn("sites", F.array(*(sites(F.col(sequence), v, mods) for v in variable)) if variable else F.array().cast("array<array<int>>"))
    rows = rows.withColumn("placements", F.array(F.array().cast("array<int>")))
    for k in range(most):
        rows = rows.withColumn("placements", F.when(F.size("units") > k, _seated(k)).otherwise(F.col("placements")))
    return rows.drop("sites")


def _seated(k: int) -> Column:
    """The placements with unit number ``k`` on each free site; equal units go to ascending sites, so that no placement comes twice."""
    unit, before = F.get("units", F.lit(k)), F.get("units", F.lit(k - 1))

    def grown(p: Column) -> Column:
        free = F.filter(F.get("sites", unit), lambda s: ~F.array_contains(p, s) & (~before.eqNullSafe(unit) | (s > F.get(p, F.lit(k - 1)))))
        return F.transform(free, lambda s: F.array_append(p, s))

    return F.flatten(F.transform("placements", grown))


def may_fit(hits: DataFrame, sequence: str, variable: tuple[VariableModification, ...]) -> DataFrame:
    """The hits whose sequence has each residue that their units need, a cheap test before places are written out."""
    for i, v in enumerate(variable):
        if v.residue:
            has = {"Terminus_N": F.startswith, "Terminus_C": F.endswith}.get(v.position, F.contains)(F.col(sequence), F.lit(v.residue))
            hits = hits.where(~F.array_contains("units", i) | has)
    return hits


def form_of(sequence: Column, units: Column, places: Column, variable: tuple[VariableModification, ...]) -> Column:
    """The sequence with a mark behind each modified residue."""
    if not variable:
        return sequence
    deltas = F.array(*(F.lit(v.delta).cast("long") for v in variable))

    def mark(i: Column) -> Column:
        unit = F.get(units, F.array_position(places, i).cast("int") - 1)
        return F.concat(F.lit("[v"), F.get(deltas, unit).cast("string"), F.lit("]"))

    n = F.length(sequence)
    body = F.concat_ws("", F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substr(sequence, i, F.lit(1)), F.coalesce(mark(i), F.lit("")))))
    ends = F.coalesce(F.concat(mark(F.lit(0)), F.lit("-")), F.lit("")), F.coalesce(F.concat(F.lit("-"), mark(n + 1)), F.lit(""))
    return F.when((F.size(places) > 0) & (n > 0), F.concat(ends[0], body, ends[1])).otherwise(sequence)


def forms(hits: DataFrame, sequence: str, variable: tuple[VariableModification, ...], most: int, mods: StaticModifications = UNMODIFIED) -> DataFrame:
    """``form`` of every placement of the hit's ``units``; hits without a place for them go."""
    rows = with_placements(may_fit(hits, sequence, variable), sequence, variable, most, mods).withColumn("places", F.explode("placements"))
    return rows.withColumn("form", form_of(F.col(sequence), F.col("units"), F.col("places"), variable)).drop("placements", "places")


def one_form(hits: DataFrame, sequence: str, variable: tuple[VariableModification, ...], most: int, pick: Column, mods: StaticModifications = UNMODIFIED) -> DataFrame:
    """``form`` of one placement, chosen by the number ``pick``; hits without a place for their units go."""
    rows = with_placements(may_fit(hits, sequence, variable), sequence, variable, most, mods).where(F.size("placements") > 0)
    places = F.get("placements", F.pmod(pick, F.size("placements")).cast("int"))
    return rows.withColumn("form", form_of(F.col(sequence), F.col("units"), places, variable)).drop("placements")


def plain(form: Column) -> Column:
    """The sequence without its marks."""
    return F.regexp_replace(form, r"\[[^\]]*\]|-", "")


def tokens(form: Column) -> Column:
    """Residues of a form, each with its marks."""
    return F.regexp_extract_all(form, F.lit(TOKEN), F.lit(0))


def token_delta(token: Column) -> Column:
    """Sum of the marks of one residue."""
    marks = F.regexp_extract_all(token, F.lit(r"\[v(-?[0-9]+)\]"), F.lit(1))
    return F.aggregate(marks, F.lit(0).cast("long"), lambda a, m: a + m.cast("long"))
