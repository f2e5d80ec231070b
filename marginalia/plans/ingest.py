"""Shards of JSON lines to the twelve raw tables, in one pass over the input."""

from __future__ import annotations

import contextlib
import glob
import json
import os
import shutil
import time
from collections.abc import Callable

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.operators.filters import WorkFilter
from marginalia.operators.records import build_tables
from marginalia.schemas import SHARDS, TABLES
from marginalia.sources import works as source
from marginalia.sources.manifest import write_json
from marginalia.sources.tables import cut


def backoff(attempt: int) -> int:
    """Seconds before the next attempt."""
    return 2**attempt


def retryable(error: Exception) -> bool:
    """Whether another attempt may help: not for refused requests, a full disk or bad values."""
    code = getattr(error, "code", None) or getattr(getattr(error, "response", None), "status_code", None)
    return not (code in (400, 403, 410) or isinstance(error, (ValueError, TypeError)) or getattr(error, "errno", None) == 28)


def with_retries(work: Callable[[], object], attempts: int, sleep: Callable[[float], None] = time.sleep) -> object:
    """The result of `work`, tried again with growing pauses; the last error otherwise. Interruption is final."""
    for attempt in range(attempts + 1):
        try:
            return work()
        except Exception as error:
            if attempt == attempts or not retryable(error):
                raise
            sleep(backoff(attempt))
    raise AssertionError


def writer(df: DataFrame, zstd_level: int, row_group_size: int):
    """A parquet writer with zstd and a cap on the rows of a row group."""
    w = df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", zstd_level)
    return w.option("parquet.block.row.count.limit", row_group_size)


#: Folder with one document for each shard whose tables were all written.
MARKERS = "_complete"


def ingest(spark: SparkSession, shards: DataFrame, raw: str, work_filter: WorkFilter | None = None, strict: bool = True, zstd_level: int = 3, row_group_size: int = 500_000, paths: list[str] | None = None) -> DataFrame:
    """Write the tables of `shards` under `raw`, each partitioned by shard, and return the counters per shard.

    The input is parsed once: the kept records go to the shared checkpoint folder and all tables are projections of
    them. Partitions of other shards stay as they are; writing a shard again replaces it. A shard counts as complete
    only by its marker, which is removed before the first table is written and put back after the last. `paths` are the
    files to read where they are not the shards' addresses.
    """
    if paths is None:
        paths = [r["url"] for r in shards.select("url").collect()]  # one per file
    keep = (work_filter or WorkFilter()).condition(F.col("w"))
    parsed = source.with_shards(source.parse_works(source.scan_lines(spark, paths), strict, keep_failures=True), shards)
    parsed = cut(parsed.select("w", "url", "shard_updated_date", "oa_shard_idx"))
    kept = parsed.where(F.col("w").isNotNull() & keep)
    numbers = [r["shard_idx"] for r in shards.select("shard_idx").collect()]
    delete_shards(raw, numbers)
    for name, table in build_tables(kept, keep_shard=True).items():
        out = writer(table, zstd_level, row_group_size).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy("oa_shard_idx").parquet(os.path.join(raw, name))
    for n in numbers:
        write_json(os.path.join(raw, MARKERS, f"{n}.json"), {"files": {t: len(_files(raw, t, n)) for t in TABLES}})
    return source.ingest_metrics(parsed, keep, "oa_shard_idx")


def ingest_isolated(spark: SparkSession, shards: DataFrame, raw: str, passes: int = 0, pause: Callable[[int], None] = lambda _: None, **options) -> tuple[list[dict], list[int]]:
    """`ingest` of shards whose failures must not touch each other: counters of the good ones, numbers of the failed.

    A batch that fails is halved until the bad shards stand alone; they are tried again in `passes` further passes, with
    `pause` before each. A full disk and interruption end the run.
    """
    counters: list[dict] = []

    def attempt(numbers: list[int]) -> list[int]:
        try:
            found = ingest(spark, shards.where(F.col("shard_idx").isin(numbers)), raw, **options).collect()
            counters.extend(r.asDict() for r in found)
            return []
        except Exception as error:
            delete_shards(raw, numbers)
            if getattr(error, "errno", None) == 28:
                raise
            if len(numbers) == 1:
                return numbers
            half = len(numbers) // 2
            return attempt(numbers[:half]) + attempt(numbers[half:])

    left = sorted(r["shard_idx"] for r in shards.select("shard_idx").collect())  # one row per shard file
    left = attempt(left) if left else left
    for n in range(passes):
        if not left:
            break
        pause(n)
        left = attempt(left)
    return counters, left


def _files(raw: str, name: str, number: int) -> list[str]:
    return glob.glob(os.path.join(raw, name, f"oa_shard_idx={number}", "*.parquet"))


def delete_shards(raw: str, numbers: list[int]) -> int:
    """Remove the partitions of shards from every table, and their markers first; how many folders there were."""
    for n in numbers:
        with contextlib.suppress(FileNotFoundError):
            os.remove(os.path.join(raw, MARKERS, f"{n}.json"))
    folders = [f for n in numbers for t in TABLES if os.path.isdir(f := os.path.join(raw, t, f"oa_shard_idx={n}"))]
    for folder in folders:
        shutil.rmtree(folder)
    return len(folders)


def clean_temporary(folder: str) -> int:
    """Remove what interrupted writers left: *.tmp files and _temporary folders; how many."""
    left = [p for pattern in ("*.tmp", "_temporary") for p in glob.glob(os.path.join(folder, "**", pattern), recursive=True)]
    for path in left:
        shutil.rmtree(path) if os.path.isdir(path) else os.remove(path)
    return len(left)


def valid_footer(path: str) -> bool:
    try:
        pq.read_metadata(path)
        return True
    except (OSError, ValueError):
        return False


def completed_shards(spark: SparkSession, raw: str) -> DataFrame:
    """(shard_idx) of shards that were written whole: their marker is there, and of every table the files it names.

    Every file must have a readable footer. A table that the shard has no rows for has no file.
    """
    done = []
    for path in sorted(glob.glob(os.path.join(raw, MARKERS, "*.json"))):
        try:
            number = int(os.path.basename(path).removesuffix(".json"))
            with open(path, encoding="utf-8") as f:
                expected = json.load(f)["files"]
            files = {t: _files(raw, t, number) for t in TABLES}
            whole = all(len(files[t]) == expected.get(t) for t in TABLES)
        except (OSError, ValueError, KeyError, TypeError, AttributeError):
            continue
        if whole and all(valid_footer(f) for t in TABLES for f in files[t]):
            done.append((number,))
    return spark.createDataFrame(done, "shard_idx int")


def schema_mismatches(spark: SparkSession, raw: str) -> list[tuple[str, list[str], list[str]]]:
    """(table, expected, found) of tables whose columns differ in name or order; missing and unreadable ones are passed over."""
    found = []
    for name, schema in TABLES.items():
        files = sorted(glob.glob(os.path.join(raw, name, "**", "*.parquet"), recursive=True))
        try:
            columns = pq.read_schema(files[0]).names if files else None
        except (OSError, ValueError):
            columns = None
        expected = [c for c in schema.fieldNames() if not (name == "works" and c == "oa_shard_idx")]
        if columns is not None and columns != expected:
            found.append((name, expected, columns))
    return found


def empty_shards(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SHARDS)
