"""Settings: defaults, user overrides and storage roots."""

from __future__ import annotations

import copy
import json
import os
from dataclasses import dataclass, field
from typing import Any

# Default settings.
DEFAULTS: dict[str, Any] = {
    "paths": {
        "simulations": {},
        "input_files": {},
        "analysis_cache_dir": None,
        "lake_dir": None,
        "gwtc_catalog_csv": None,
    },
    "hdf5": {
        "file_selection": {
            "wait_age_hour": 24,
            "sample_every_nb_time": 1.0,
            "exclude_bad_dirname": True,
        },
        "scan": {"incremental_from_cache_tail": True, "checkpoint_every_files": 100},
    },
    "particle_lake": {
        "enabled": False,
        "scan": {
            "sample_every_nb_time": None,
            "checkpoint_every_files": 25,
            "skip_unreadable_files": True,
        },
    },
    "compact_object_history": {"enabled": True},
    "snapshot_summary": {"enabled": True},
    "current_lagrangian": {"enabled": True},
    "galactic_orbit": {"enabled": True, "time_color_max_myr": 500.0},
    "galactic_energy_angular_momentum": {"enabled": True, "percentile_limits": [0.1, 99.9]},
    "binary_stellar_type_extraction": {},
    "selected_lagr_percent": ["<RC", "10%", "30%", "50%", "70%", "90%", "95%"],
}
# Sections a user file may override.
MERGED = (
    "paths",
    "hdf5",
    "particle_lake",
    "compact_object_history",
    "snapshot_summary",
    "current_lagrangian",
    "galactic_orbit",
    "galactic_energy_angular_momentum",
    "binary_stellar_type_extraction",
)

def _merge(base: dict, extra: dict) -> dict:
    for key, value in extra.items():
        if isinstance(value, dict) and isinstance(base.get(key), dict):
            _merge(base[key], value)
        else:
            base[key] = value
    return base


def _parse(path: str) -> dict[str, Any]:
    with open(path) as handle:
        text = handle.read()
    if path.endswith(".json"):
        return json.loads(text) or {}
    import yaml  # only needed for YAML files

    return yaml.safe_load(text) or {}


@dataclass
class Config:
    values: dict[str, Any] = field(default_factory=lambda: copy.deepcopy(DEFAULTS))

    @property
    def simulations(self) -> dict[str, str]:
        return self.values["paths"]["simulations"]

    def input_file(self, simulation_id: str) -> str:
        """Namelist file of a simulation."""
        try:
            return self.values["paths"]["input_files"][simulation_id]
        except KeyError:
            raise ValueError(f"paths.input_files has no entry for {simulation_id!r}") from None

    @property
    def cache_root(self) -> str:
        root = self.values["paths"]["analysis_cache_dir"]
        if not root:
            raise ValueError("paths.analysis_cache_dir is not set")
        return root

    @property
    def lake_root(self) -> str:
        return self.values["paths"]["lake_dir"] or self.cache_root

    def scan_options(self, lake: bool = False, force: bool = False) -> dict[str, Any]:
        """Arguments of ScanOptions: shared settings, then those of the lake build."""
        options = {**self.values["hdf5"]["file_selection"], **self.values["hdf5"]["scan"]}
        if lake:
            options.update(self.values["particle_lake"]["scan"])
        known = {
            "wait_age_hour",
            "sample_every_nb_time",
            "exclude_bad_dirname",
            "incremental_from_cache_tail",
            "checkpoint_every_files",
            "skip_unreadable_files",
        }
        return {**{k: v for k, v in options.items() if k in known}, "force": force}


def load_config(path: str | None = None) -> Config:
    """Defaults merged with a YAML or JSON file.

    Without a path, $STARFOLD_CONFIG or ./starfold.yaml is used when present.
    """
    config = Config()
    path = path or os.environ.get("STARFOLD_CONFIG")
    if path is None and os.path.exists("starfold.yaml"):
        path = "starfold.yaml"
    if path is None:
        return config
    user = _parse(path)
    for section in MERGED:
        if isinstance(user.get(section), dict):
            _merge(config.values[section], user[section])
    if "selected_lagr_percent" in user:
        config.values["selected_lagr_percent"] = list(user["selected_lagr_percent"])
    return config
