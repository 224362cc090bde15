"""Column functions for names, paths and FASTA entries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ionloom.constants import DECOY_NAME, DECOY_PREFIX, FASTA_WIDTH, TARGET_NAME, TARGET_PREFIX


def sanitize_word(c: Column) -> Column:
    """Every character that is no Unicode word character becomes ``_``."""
    return F.regexp_replace(c, "(?U)\\W", "_")


def sanitize_path(c: Column) -> Column:
    """White space is trimmed; runs of white space, slashes and NULs become one ``_``."""
    return F.regexp_replace(F.regexp_replace(c, "^\\s+|\\s+$", ""), "[\\s/\\x00]+", "_")


def url_decoded(c: Column) -> Column:
    """Percent escapes decoded; a plus sign stays one."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def fasta_entry(sequence: Column, index: Column, target: bool) -> Column:
    """Header and the sequence in lines of 60 residues, with a closing newline."""
    prefix, name = (TARGET_PREFIX, TARGET_NAME) if target else (DECOY_PREFIX, DECOY_NAME)
    ident = F.concat(F.lit(name), index.cast("string"))
    lines = F.regexp_replace(sequence, f"(.{{{FASTA_WIDTH}}})(?=.)", "$1\n")
    return F.concat(F.lit(f">{prefix}|"), ident, F.lit("|"), ident, F.lit("\n"), lines, F.lit("\n"))


def precursor_path(uuid: Column, run: Column, spectrum: Column, mz: Column, charge: Column, ext: str) -> Column:
    """search/run/spectrum/{mz}_{charge}.ext with sanitised parts."""
    leaf = F.concat(mz.cast("string"), F.lit("_"), charge.cast("string"), F.lit(f".{ext}"))
    return F.concat_ws("/", *(sanitize_path(c.cast("string")) for c in (uuid, run, spectrum)), leaf)


def parse_precursor(path: Column) -> tuple[Column, Column]:
    """m/z and charge of a file name {mz}_{charge}.x.y; -1 and 0 where they can't be read."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), "(\\.[^.]*){2}$", "")
    mz = F.substring_index(stem, "_", 1)
    charge = F.when(F.instr(stem, "_") > 0, F.substring(stem, F.length(mz) + 2, 1_000_000))
    return F.coalesce(mz.try_cast("double"), F.lit(-1.0)), F.coalesce(charge.try_cast("int"), F.lit(0))
