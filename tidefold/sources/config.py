"""Configuration from JSON files; nothing is evaluated."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class ReplayConfig:
    """What a replay needs: where to, how parallel, which slots."""

    connection_string: str
    nb_threads: int = 4
    debug: bool = False
    keep_data: bool = False
    keep_schema: bool = False
    db_options: dict[str, dict[str, str]] = field(default_factory=dict)

    @property
    def slots(self) -> dict[str, str]:
        """The only slot accepted for each restricted database."""
        return {db: o["source_slotname"] for db, o in self.db_options.items() if o.get("source_slotname")}


@dataclass(frozen=True)
class BackupConfig:
    """What a base backup leaves out."""

    ignored_objects: tuple[str, ...] = ()
    ignored_schemas: tuple[str, ...] = ()


def _load(path: str | None, places: tuple[str, ...]) -> dict:
    for p in (path,) if path else places:
        if p and os.path.exists(p):
            with open(p, encoding="utf-8") as f:
                return json.load(f)
    if path:
        raise FileNotFoundError(path)
    return {}


def replay_config(path: str) -> ReplayConfig:
    found = _load(path, ())
    if "connection_string" not in found:
        raise ValueError("connection_string is missing")
    return ReplayConfig(**found)


def backup_config(path: str | None = None, name: str = "basebackup.json") -> BackupConfig:
    """The file given, or the first found in the working folder, the user's and the system's configuration."""
    found = _load(path, (name, os.path.expanduser(f"~/.config/{name}"), f"/etc/{name}"))
    return BackupConfig(tuple(found.get("ignored_objects", ())), tuple(found.get("ignored_schemas", ())))
