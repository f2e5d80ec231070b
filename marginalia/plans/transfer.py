"""Pushing and pulling of outputs by difference of listings, over an object-store interface with a local-folder backend."""

from __future__ import annotations

import os
import shutil
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from marginalia.operators.sync import transfers
from marginalia.schemas import TABLES


class Store(Protocol):
    def listing(self, prefix: str) -> list[tuple[str, int]]: ...

    def put(self, key: str, path: str) -> None: ...

    def get(self, key: str, path: str) -> None: ...


class FolderStore:
    """An object store in a folder; a fetched file appears whole or not at all."""

    def __init__(self, root: str) -> None:
        self.root = root

    def listing(self, prefix: str) -> list[tuple[str, int]]:
        base = os.path.join(self.root, prefix)
        files = [os.path.join(d, f) for d, _, names in os.walk(base) for f in names]
        return [(os.path.relpath(f, self.root), os.path.getsize(f)) for f in sorted(files)]

    def put(self, key: str, path: str) -> None:
        self._copy(path, os.path.join(self.root, key))

    def get(self, key: str, path: str) -> None:
        self._copy(os.path.join(self.root, key), path)

    @staticmethod
    def _copy(source: str, target: str) -> None:
        os.makedirs(os.path.dirname(target), exist_ok=True)
        shutil.copyfile(source, f"{target}.tmp")
        os.replace(f"{target}.tmp", target)


def make_key(prefix: str, relative: str) -> str:
    return f"{prefix.rstrip('/')}/{relative}" if prefix.rstrip("/") else relative


def local_listing(output: str, sub: str) -> list[tuple[str, int]]:
    """State documents at the root of `sub` and every parquet file of its tables."""
    base = os.path.join(output, sub)
    if not os.path.isdir(base):
        return []
    roots = [os.path.join(base, n) for n in sorted(os.listdir(base)) if (n.startswith(".") or n.endswith(".jsonl")) and os.path.isfile(os.path.join(base, n))]
    deep = [os.path.join(d, f) for t in TABLES for d, _, names in os.walk(os.path.join(base, t)) for f in sorted(names) if f.endswith(".parquet")]
    return [(os.path.relpath(f, output), os.path.getsize(f)) for f in roots + deep]


@dataclass
class TransferSummary:
    files_transferred: int = 0
    bytes_transferred: int = 0
    files_skipped: int = 0
    files_failed: int = 0
    failed_keys: list[str] = field(default_factory=list)


def _frame(spark: SparkSession, listing: list[tuple[str, int]]) -> DataFrame:
    return spark.createDataFrame(listing, "relative string, size long")


def sync(spark: SparkSession, output: str, store: Store, prefix: str = "", pull: bool = False, subs: tuple[str, ...] = ("raw", "hive"), force: bool = False, dry_run: bool = False, concurrency: int = 8) -> TransferSummary:
    """Transfer what differs; failures of single files are collected, not raised."""
    local = [x for sub in subs for x in local_listing(output, sub)]
    strip = len(make_key(prefix, ""))
    remote = [(k[strip:], n) for sub in subs for k, n in store.listing(make_key(prefix, sub))]
    source, target = (remote, local) if pull else (local, remote)
    todo = [(r["relative"], r["size"]) for r in transfers(_frame(spark, source), _frame(spark, target), force).orderBy("relative").collect()]
    done = TransferSummary(files_skipped=len(source) - len(todo))
    if dry_run:
        return done

    def move(item: tuple[str, int]) -> Exception | None:
        try:
            (store.get if pull else store.put)(make_key(prefix, item[0]), os.path.join(output, item[0]))
            return None
        except OSError as error:
            return error

    with ThreadPoolExecutor(concurrency) as pool:
        for (relative, size), error in zip(todo, pool.map(move, todo), strict=True):
            if error is None:
                done.files_transferred, done.bytes_transferred = done.files_transferred + 1, done.bytes_transferred + size
            else:
                done.files_failed += 1
                done.failed_keys.append(relative)
    return done
