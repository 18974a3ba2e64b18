"""Options of a run: defaults, then a TOML file, then what the caller gives (survey id SRC-23)."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, fields, replace
from pathlib import Path

# Choices of the enumerated options (fixed values).
CHOICES = {
    "cand_mode": ("any_ipg", "best_ipg", "best_id", "one_id", "same_id"),
    "win_mode": ("win_nts", "win_genes"),
    "min_win_type": ("total", "upstream", "downstream", "both"),
    "tree_mode": ("taxonomy", "neighborhood", "neighborhood_phylo", "aai_tree", "ani_tree", "use_input_tree"),
    "aai_mode": ("wgrr", "aai", "hyper"),
    "aai_subset_mode": ("target_prot", "target_region", "window"),
    "tree_method": ("nj", "bionj", "unj", "upgma"),
}


@dataclass(frozen=True)
class Settings:
    cand_mode: str = "best_id"
    win_mode: str = "win_nts"
    window: int = 20_000
    min_win: int = 0
    min_win_type: str = "total"
    tree_mode: str = "taxonomy"
    tree_method: str = "nj"
    aai_mode: str = "wgrr"
    aai_subset_mode: str = "window"
    max_df_frac: float = 0.2
    min_shared: int = 2
    max_evalue: float = 1e-5
    min_pident: float = 30.0

    def __post_init__(self) -> None:
        for name, allowed in CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {', '.join(allowed)}")


def load(path: str | None = None, **given: object) -> Settings:
    """Unknown keys of the file are ignored, tables of it are flattened; values of None don't override."""
    known = {f.name for f in fields(Settings)}
    found: dict[str, object] = {}
    if path:
        for k, v in tomllib.loads(Path(path).read_text(encoding="utf-8")).items():
            found |= v if isinstance(v, dict) else {k: v}
    found |= {k: v for k, v in given.items() if v is not None}
    return replace(Settings(), **{k.replace("-", "_"): v for k, v in found.items() if k.replace("-", "_") in known})
