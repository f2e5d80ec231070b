"""State documents of runs: tolerant to read, replaced as a whole when written."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field, fields
from datetime import UTC, datetime

from marginalia.sources.manifest import write_json


def now() -> str:
    return datetime.now(UTC).isoformat()


def _read(kind: type, path: str):
    try:
        with open(path, encoding="utf-8") as f:
            document = json.load(f)
        return kind(**{k: document[k] for k in {x.name for x in fields(kind)} & document.keys()})
    except (OSError, ValueError, TypeError, AttributeError):
        return None


@dataclass
class RunState:
    last_sync_date: str | None = None
    completed_shards: list[int] = field(default_factory=list)
    manifest_shard_count: int = 0
    filter: dict = field(default_factory=dict)
    started_at: str | None = None
    finished_at: str | None = None

    @classmethod
    def load(cls, folder: str) -> RunState:
        """The state of a folder; a missing or broken document is a fresh state."""
        return _read(cls, os.path.join(folder, ".state.json")) or cls()

    def save(self, folder: str) -> None:
        write_json(os.path.join(folder, ".state.json"), asdict(self))


@dataclass
class LayoutState:
    source_manifest_hash: str = ""
    zstd_level: int = 0
    row_group_size: int = 0
    num_shards: int = 0
    completed_at: str = ""
    tables: list[str] = field(default_factory=list)
    completed_tables: list[str] = field(default_factory=list)

    @classmethod
    def load(cls, folder: str) -> LayoutState | None:
        return _read(cls, os.path.join(folder, ".hive_state.json"))

    def save(self, folder: str) -> None:
        write_json(os.path.join(folder, ".hive_state.json"), asdict(self))

    def same_input(self, other: LayoutState) -> bool:
        return all(getattr(self, n) == getattr(other, n) for n in ("source_manifest_hash", "zstd_level", "row_group_size", "num_shards"))


def append_log(folder: str, entry: dict) -> None:
    """One line of the sync log."""
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, ".sync_log.jsonl"), "a", encoding="utf-8") as f:
        f.write(json.dumps({"timestamp": now(), **entry}) + "\n")
