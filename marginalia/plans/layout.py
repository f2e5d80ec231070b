"""Raw tables to tables partitioned by publication year and bucket of the work id.

One shuffle per table to (pub_year, shard) replaces any two-pass scheme; a partition with very many rows is split over
tasks by a salt, which also bounds its files.
"""

from __future__ import annotations

import hashlib
import os
import shutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.operators.partitions import partition_map, place_children, place_fact
from marginalia.plans.ingest import writer
from marginalia.plans.state import LayoutState, now
from marginalia.schemas import CHILDREN, FACT, TABLES

#: Rows of a (year, bucket) that one task writes.
ROWS_PER_TASK = 4_000_000


def file_hash(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def spread(placed: DataFrame) -> DataFrame:
    """Rows by (pub_year, shard), the large ones over several tasks."""
    sizes = placed.groupBy("pub_year", "shard").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_TASK).cast("int").alias("_tasks")).where("_tasks > 1")
    # under rows / ROWS_PER_TASK rows: as many as there are large partitions; the salt is the row's own, so that a
    # repeated task sends each row where it went before
    salted = placed.join(sizes, ["pub_year", "shard"], "left").withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns]), F.coalesce("_tasks", F.lit(1))))
    return salted.repartition("pub_year", "shard", "_salt").drop("_tasks", "_salt")


def write_placed(placed: DataFrame, path: str, zstd_level: int = 8, row_group_size: int = 500_000) -> None:
    """Stage a table and put it in place of the old one."""
    staging, old = f"{path}.staging", f"{path}.old"
    for leftover in (staging, old):
        shutil.rmtree(leftover, ignore_errors=True)
    writer(spread(placed), zstd_level, row_group_size).mode("overwrite").partitionBy("pub_year", "shard").parquet(staging)
    if os.path.isdir(path):
        os.rename(path, old)
    os.rename(staging, path)
    shutil.rmtree(old, ignore_errors=True)


def read_raw(spark: SparkSession, raw: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(raw, name))


def build_layout(spark: SparkSession, raw: str, hive: str, manifest: str, zstd_level: int = 8, row_group_size: int = 500_000, num_shards: int = 4, force: bool = False, dry_run: bool = False) -> list[str]:
    """Write every raw table's layout under `hive`; the names of the tables written.

    Nothing is written where the last complete run had the same listing and settings; an interrupted run goes on with
    the tables it had not finished. Of a repeated work the last row, by file and place in it, tells its children's year.
    """
    present = [t for t in TABLES if os.path.isdir(os.path.join(raw, t))]
    state = LayoutState(file_hash(manifest), zstd_level, row_group_size, num_shards, tables=present)
    last = LayoutState.load(hive)
    if last and state.same_input(last) and not force:
        if last.completed_at:
            return []
        state.completed_tables = [t for t in last.completed_tables if os.path.isdir(os.path.join(hive, t))]
    todo = [t for t in present if t not in state.completed_tables]
    if dry_run:
        return todo
    works = read_raw(spark, raw, FACT)
    mapped = partition_map(works, [F.col("_metadata.file_path"), F.col("_metadata.row_index")], num_shards)
    for name in [t for t in [FACT, *CHILDREN] if t in todo]:
        table = read_raw(spark, raw, name)
        placed = place_fact(table, num_shards) if name == FACT else place_children(table, mapped)
        write_placed(placed, os.path.join(hive, name), zstd_level, row_group_size)
        state.completed_tables.append(name)
        state.save(hive)
    state.completed_at = now()
    state.save(hive)
    return todo
