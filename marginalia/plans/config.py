"""Settings: a TOML file with unknown keys refused, command-line values before it, defaults last."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, field, fields, is_dataclass

from marginalia.functions.text import parse_memory
from marginalia.operators.filters import WorkFilter

LOCAL_FILE, HOME_FILE = "etl.toml", os.path.join("~", "marginalia", "etl.toml")


@dataclass
class HiveConfig:
    enable: bool | None = None
    clean_raw: bool | None = None
    zstd_level: int | None = None
    row_group_size: int | None = None
    num_shards: int | None = None
    threads: int | None = None
    memory_limit: str | None = None

    def is_enabled(self) -> bool:
        """As told, else on if any setting but clean_raw is given."""
        own = (self.zstd_level, self.row_group_size, self.num_shards, self.threads, self.memory_limit)
        return self.enable if self.enable is not None else any(x is not None for x in own)


@dataclass
class EmbedConfig:
    enable: bool | None = None
    backend: str | None = None
    batch_size: int | None = None
    max_rows: int | None = None
    endpoint: str | None = None
    model: str | None = None
    model_dir: str | None = None
    models_dir: str | None = None
    device: str | None = None
    pooling: str | None = None
    prompt: str | None = None
    max_length: int | None = None
    output: str | None = None

    def is_enabled(self) -> bool:
        return self.enable if self.enable is not None else self.backend is not None or self.model is not None


@dataclass
class UploadConfig:
    bucket: str | None = None
    endpoint: str | None = None
    region: str | None = None
    access_key: str | None = None
    secret_key: str | None = None
    prefix: str | None = None
    force: bool | None = None
    concurrency: int | None = None

    def credentials(self) -> dict[str, str | None]:
        """Bucket access from the file, else from the environment; the region is "auto" unless told."""
        env = os.environ.get
        return {
            "bucket": self.bucket or env("S3_BUCKET"),
            "endpoint": self.endpoint or env("S3_ENDPOINT"),
            "region": self.region or env("AWS_REGION") or "auto",
            "access_key": self.access_key or env("AWS_ACCESS_KEY_ID"),
            "secret_key": self.secret_key or env("AWS_SECRET_ACCESS_KEY"),
        }


@dataclass
class Config:
    output: str | None = None
    zstd_level: int | None = None
    concurrency: int | None = None
    max_retries: int | None = None
    read_timeout: int | None = None
    outer_retries: int | None = None
    retry_delay: int | None = None
    filter: WorkFilter = field(default_factory=WorkFilter)
    hive: HiveConfig = field(default_factory=HiveConfig)
    upload: UploadConfig = field(default_factory=UploadConfig)
    embed: EmbedConfig = field(default_factory=EmbedConfig)


# The defaults of a run.
DEFAULTS = dict(concurrency=8, read_timeout=30, max_retries=3, outer_retries=3, retry_delay=30, zstd_level=3, hive_zstd_level=8, row_group_size=500_000, num_shards=4, embed_batch_size=64)


def _fill(kind: type, values: dict, where: str):
    known = {f.name: f for f in fields(kind)}
    if unknown := set(values) - set(known):
        raise ValueError(f"unknown keys in {where}: {', '.join(sorted(unknown))}")
    made = kind()
    for name, value in values.items():
        now = getattr(made, name)
        setattr(made, name, _fill(type(now), value, f"[{name}]") if is_dataclass(now) else value)
    return made


def load(path: str | None = None) -> Config:
    """Settings of the file named, else of ./etl.toml or the home folder's, else none. A named file that is missing is an error."""
    for candidate in [path] if path else [LOCAL_FILE, os.path.expanduser(HOME_FILE)]:
        if path or os.path.exists(candidate):
            with open(candidate, "rb") as f:
                return _fill(Config, tomllib.load(f), candidate)
    return Config()


def setting(name: str, told: object, given: object) -> object:
    """The command line's value, else the file's, else the default."""
    return told if told is not None else given if given is not None else DEFAULTS[name]


def default_threads() -> int:
    return max(2, (os.cpu_count() or 2) * 3 // 4)


def memory_limit(text: str | None) -> int:
    """Bytes as told, else 65 % of the machine's memory."""
    return parse_memory(text) if text else int(os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") * 0.65)
