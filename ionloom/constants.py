"""Physical constants, residue masses and names of the peptide search."""

from __future__ import annotations

#: Proton and water masses in dalton (CODATA 2018; sum of monoisotopic atom masses).
PROTON = 1.007276466621
WATER = 18.010564684
AMMONIA = 17.026549101
# Residues whose fragments lose water or ammonia.
WATER_LOSS, AMMONIA_LOSS = "DEST", "KNQR"
#: Integer masses are dalton times SCALE, rounded.
SCALE = 1_000_000

# Monoisotopic residue masses in dalton (IUPAC atom masses).
RESIDUES = {
    "A": 71.037113805,
    "C": 103.009184505,
    "D": 115.026943065,
    "E": 129.042593135,
    "F": 147.068413945,
    "G": 57.021463735,
    "H": 137.058911875,
    "I": 113.084064015,
    "K": 128.094963050,
    "L": 113.084064015,
    "M": 131.040484645,
    "N": 114.042927470,
    "P": 97.052763875,
    "Q": 128.058577540,
    "R": 156.101111050,
    "S": 87.032028435,
    "T": 101.047678505,
    "V": 99.068413945,
    "W": 186.079312980,
    "Y": 163.063328575,
}

#: Prefixes of protein names in published tables.
TARGET_PREFIX, DECOY_PREFIX = "mdb", "moy"
TARGET_NAME, DECOY_NAME = "T", "D"
FASTA_WIDTH = 60

FEATURES = ("xcorr", "ions_matched_ratio", "mass_error")
NEIGHBOURS = 1000
EXTENT = 3

PSM_SCHEMA = (
    "scan_id string, peptide string, charge short, precursor_mz double, precursor_da double, experimental_mass double, xcorr double, "
    "ions_total long, ions_matched long, theoretical_mass double, second_theoretical_mass double"
)
SPECTRUM_SCHEMA = "uuid string, ms_run string, spectrum_id string, ms_level int, mz array<double>, intensity array<double>, precursors array<struct<mz:double,charge:smallint>>"


def mass_int(dalton: float) -> int:
    return round(dalton * SCALE)
