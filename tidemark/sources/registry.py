"""The schema registry: which header layout renames to which canonical columns, read from YAML."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import yaml


class UnknownSchema(LookupError):
    """A header hash that the registry does not hold; guessing is not an option."""


@dataclass(frozen=True)
class Registry:
    """``layouts``: header hash -> {source column: canonical column}; ``corrupt``: files refused by name."""

    layouts: dict[str, dict[str, str]]
    corrupt: frozenset[str]

    def rename_map(self, header_hash: str | None) -> dict[str, str]:
        if header_hash not in self.layouts:
            raise UnknownSchema(f"no layout for header {header_hash}")
        return self.layouts[header_hash]

    def canonical_columns(self) -> list[str]:
        """All canonical columns, in order of first mention."""
        return list(dict.fromkeys(c for names in self.layouts.values() for c in names.values()))


def load_registry(path: str | Path) -> Registry:
    """Reads ``esquemas: {hash: {columnas: {...}}}`` and ``snapshots_conocidos_corruptos``."""
    raw = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    layouts = {h: dict(s["columnas"]) for h, s in (raw.get("esquemas") or {}).items()}
    for h, names in layouts.items():
        if len(set(names.values())) != len(names):
            raise ValueError(f"layout {h} maps two columns to one")
    return Registry(layouts, frozenset(c["archivo_bronze"] for c in raw.get("snapshots_conocidos_corruptos") or []))
