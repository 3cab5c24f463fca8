"""Run configuration: defaults, and a YAML or JSON file, which an environment variable may name.

Other entries of a settings file are left alone: ``subsample_frac`` and ``first_vars`` steer nothing.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from pathlib import Path

from staywise import values

SETTINGS_VARIABLE = "STAYWISE_SETTINGS"
_REMOTE = ("://", "dbfs:/")


@dataclass(frozen=True)
class Settings:
    """What a run needs to know. Paths may be local or of any file system Spark can read."""

    path_hr: str = "data/raw/hr.csv"
    path_evaluation: str = "data/raw/evaluation.csv"
    path_survey: str = "data/raw/survey.csv"
    sql_file: str = "reports/merge.sql"
    key: str = values.KEY
    target: str = values.TARGET
    numeric: tuple[str, ...] = values.NUMERIC_COLUMNS
    categorical: tuple[str, ...] = values.CATEGORICAL_COLUMNS
    satisfaction: tuple[str, ...] = values.SATISFACTION_COLUMNS
    random_state: int = values.RANDOM_STATE
    fit_fraction: float = 1.0  # seeded part of the (oversampled) rows that the classifier is fitted on
    database: str | None = None

    @property
    def raw_paths(self) -> dict[str, str]:
        return {"sirh": self.path_hr, "evaluation": self.path_evaluation, "sond": self.path_survey}


# Names in a settings file, by section, and the fields they set.
FILE_KEYS = {
    "random_state": "random_state",
    "col_id": "key",
    "target": "target",
    "fit_fraction": "fit_fraction",
    "num_cols": "numeric",
    "cat_cols": "categorical",
    "sat_cols": "satisfaction",
    "paths.sirh": "path_hr",
    "paths.evaluation": "path_evaluation",
    "paths.sondage": "path_survey",
    "paths.sql_file": "sql_file",
    "database.schema": "database",
}
_LISTS = ("numeric", "categorical", "satisfaction")
_PATHS = ("path_hr", "path_evaluation", "path_survey", "sql_file")


def load_settings(path: str | os.PathLike | None = None) -> Settings:
    """Settings from ``path``, else from the file named in the environment, else the defaults.

    Relative paths are relative to the file. A scalar where a list belongs is refused.
    """
    chosen = path or os.environ.get(SETTINGS_VARIABLE)
    found: dict[str, object] = {}
    if chosen:
        file = Path(chosen)
        if not file.exists():
            raise FileNotFoundError(f"settings file not found: {file}")
        found = _read(file)
    return replace(Settings(), **found)


def _read(file: Path) -> dict[str, object]:
    text = file.read_text(encoding="utf-8")
    if file.suffix == ".json":
        content = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading YAML settings needs PyYAML; use JSON instead") from error
        content = yaml.safe_load(text) or {}
    if not isinstance(content, Mapping):
        raise ValueError(f"{file} must hold a mapping")
    known = {f.name: f for f in fields(Settings)}
    found: dict[str, object] = {}
    for name, setting in FILE_KEYS.items():
        section, _, leaf = name.rpartition(".")
        block = content.get(section) or {} if section else content
        if block.get(leaf) is None:
            continue
        value = block[leaf]
        if setting in _LISTS:
            if isinstance(value, str):
                raise TypeError(f"{name} must be a list, not a single text")
            value = tuple(v for v in value if v)
        elif setting in _PATHS:
            value = str(value).strip().strip("\"'")
            if not any(mark in value for mark in _REMOTE):
                value = str((file.parent / value).resolve())
        elif known[setting].type in ("int", "float"):
            value = int(value) if known[setting].type == "int" else float(value)
        found[setting] = value
    return found
