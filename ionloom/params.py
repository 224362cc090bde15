"""Search parameters, read from and written to TOML."""

from __future__ import annotations

import tomllib
from dataclasses import asdict, dataclass, field, fields


@dataclass(frozen=True)
class XcorrParams:
    bin_size: float = 0.02
    bin_offset: float = 0.0
    use_flanking_peaks: bool = True
    minimum_intensity: float = 0.0
    max_fragment_charge: int = 3
    ions: tuple[str, ...] = ("B", "Y")
    use_neutral_loss_ions: bool = False
    #: bins of background on either side, and windows of the normalisation
    background: int = 75
    windows: int = 10


@dataclass(frozen=True)
class SearchParams:
    max_charge: int = 6
    lower_mass_tolerance_ppm: int = 10
    upper_mass_tolerance_ppm: int = 10
    max_variable_modifications: int = 3
    decoys_per_peptide: int = 0
    score_threshold: float = float("-inf")
    keep_fasta_files: bool = False
    xcorr: XcorrParams = field(default_factory=XcorrParams)

    @staticmethod
    def from_toml(text: str) -> SearchParams:
        """The ``search_parameters`` section; unknown keys are errors, missing ones take their defaults."""
        raw = dict(tomllib.loads(text).get("search_parameters", {}))
        x = raw.pop("xcorr", {})
        known = {f.name for f in fields(XcorrParams)}
        if bad := set(x) - known:
            raise ValueError(f"unknown xcorr parameters: {sorted(bad)}")
        x = {k: tuple(v) if isinstance(v, list) else v for k, v in x.items()}
        return SearchParams(**raw, xcorr=XcorrParams(**x))

    def to_toml(self) -> str:
        def value(v) -> str:
            if isinstance(v, bool):
                return str(v).lower()
            if isinstance(v, str):
                return f'"{v}"'
            if isinstance(v, (list, tuple)):
                return "[" + ", ".join(map(value, v)) + "]"
            return repr(v)

        d = asdict(self)
        x = d.pop("xcorr")
        lines = ["[search_parameters]", *(f"{k} = {value(v)}" for k, v in d.items()), "", "[search_parameters.xcorr]", *(f"{k} = {value(v)}" for k, v in x.items())]
        return "\n".join(lines) + "\n"
