"""Gold contracts: what a dataset looks like and which rows it may hold."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql.types import StructType

from stratalake.operators.quality import CheckConfig

_FOLDER = Path(__file__).parent
_CHECK_FIELDS = ("check", "columns", "column", "value", "min", "max")


@dataclass(frozen=True)
class Contract:
    dataset: str
    version: int
    partition_key: list[str]
    schema: dict[str, str]
    quality_checks: list[CheckConfig]
    quarantine_on_failure: bool = True
    hard_failure_threshold: float = 0.05

    @property
    def struct_type(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in self.schema.items()))


def parse_contract(raw: dict[str, Any]) -> Contract:
    """Contract from a parsed YAML document; the two gate settings are optional."""
    checks = [
        CheckConfig(**{f: entry[f] for f in _CHECK_FIELDS if f in entry})
        for entry in raw.get("quality_checks", [])
    ]
    optional = {f: raw[f] for f in ("quarantine_on_failure", "hard_failure_threshold") if f in raw}
    return Contract(
        raw["dataset"], raw["version"], raw["partition_key"], raw["schema"], checks, **optional
    )


def load_contract(name: str, folder: str | Path = _FOLDER) -> Contract:
    """Contract by dataset name; ``folder`` may hold a user's own YAML files."""
    file = Path(folder) / f"{name}.yaml"
    if not file.is_file():
        raise FileNotFoundError(f"no contract {name!r} in {folder}")
    return parse_contract(yaml.safe_load(file.read_text()))
