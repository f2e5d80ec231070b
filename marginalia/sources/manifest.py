"""The listing of shards: fetching, snapshots, stable numbers, and the difference between two listings."""

from __future__ import annotations

import json
import os
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.functions.text import partition_date, to_https
from marginalia.schemas import SHARDS, I, L, S, struct

_REMOTE = struct(entries=T.ArrayType(struct(url=S, meta=struct(content_length=L, record_count=L))))
_SNAPSHOT = struct(saved_at=S, entries=T.ArrayType(struct(url=S, shard_idx=I, content_length=L, record_count=L, updated_date=S)))
SNAPSHOT_NAME = ".manifest.json"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Shards of a listing as published, numbered in its order, with https addresses and the date of their address."""
    entries = spark.read.option("multiLine", True).schema(_REMOTE).json(path).select(F.posexplode("entries").alias("shard_idx", "e"))
    url = to_https(F.col("e.url"))
    shards = entries.select("shard_idx", url.alias("url"), F.col("e.meta.content_length").alias("content_length"), F.col("e.meta.record_count").alias("record_count"), partition_date(url).alias("updated_date"))
    if shards.isEmpty():
        raise ValueError(f"empty manifest: {path}")
    return shards


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The listing kept by the last run; None where there is none or it cannot be read."""
    try:
        with open(path, encoding="utf-8") as f:
            entries = json.load(f)["entries"]
    except (OSError, ValueError, KeyError, TypeError):
        return None
    return spark.createDataFrame([tuple(e.get(n) for n in SHARDS.fieldNames()) for e in entries], SHARDS)


def save_snapshot(shards: DataFrame, path: str, failed: DataFrame | None = None) -> None:
    """Keep a listing for the next run, without the shards that failed, so that they appear as changed again."""
    kept = shards if failed is None else shards.join(failed.select("url"), "url", "left_anti")
    # one row per shard file; listings are read and written whole by design
    entries = [r.asDict() for r in kept.orderBy("shard_idx").select(*SHARDS.fieldNames()).collect()]
    write_json(path, {"saved_at": datetime.now(UTC).isoformat(), "entries": entries})


def write_json(path: str, document: dict) -> None:
    """A JSON document, replaced as a whole."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(f"{path}.tmp", "w", encoding="utf-8") as f:
        json.dump(document, f, indent=2)
    os.replace(f"{path}.tmp", path)


def stabilise(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """`new` with the numbers that `old` gave its addresses; addresses it lacks are numbered on from its highest, in order.

    The highest number of an empty or missing listing is 0, so numbering then starts at 1 for a given empty listing;
    without any listing the numbers of `new` stand.
    """
    if old is None:
        return new
    known = old.groupBy("url").agg(F.max("shard_idx").alias("_old"))
    top = old.agg(F.coalesce(F.max("shard_idx"), F.lit(0)).alias("_top"))
    joined = new.join(known, "url", "left").join(F.broadcast(top))  # one row
    # the order of the listing needs one sequence; a listing has one row per file
    nth = F.row_number().over(Window.partitionBy(F.col("_old").isNull()).orderBy("shard_idx", "url"))
    return joined.withColumn("shard_idx", F.coalesce("_old", (F.col("_top") + nth)).cast("int")).select(*new.columns)


def diff(old: DataFrame | None, new: DataFrame, complete: DataFrame) -> DataFrame:
    """(url, shard_idx, change) of the addresses of both listings.

    `changed`: new, or another content_length (null is 0) or record_count; `removed`: in `old` only; `unchanged_ok` or
    `unchanged_missing`: equal, and its shard_idx is or is not among `complete`. Without `old` everything is changed.
    """
    if old is None:
        return new.select("url", "shard_idx", F.lit("changed").alias("change"))
    print_of = lambda d: F.struct(F.coalesce(F.col(f"{d}.content_length"), F.lit(0)), F.col(f"{d}.record_count"))
    done = complete.select(F.col("shard_idx").alias("_done")).distinct()
    both = old.alias("o").join(new.alias("n"), F.col("o.url") == F.col("n.url"), "full_outer").join(done, F.col("n.shard_idx") == F.col("_done"), "left")
    change = F.when(F.col("n.url").isNull(), "removed").when(F.col("o.url").isNull() | ~print_of("o").eqNullSafe(print_of("n")), "changed").when(F.col("_done").isNotNull(), "unchanged_ok").otherwise("unchanged_missing")
    return both.select(F.coalesce("n.url", "o.url").alias("url"), F.coalesce("n.shard_idx", "o.shard_idx").alias("shard_idx"), change.alias("change"))


def plan_changes(old: DataFrame | None, new: DataFrame, complete: DataFrame) -> DataFrame:
    """Stable numbers first, then the difference; in the other order a re-sorted listing would mislabel files."""
    return diff(old, stabilise(new, old), complete)


def gather(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """The shards of these numbers (shard_idx), such as the set to try again after a run in which they failed."""
    return shards.join(numbers.select("shard_idx").distinct(), "shard_idx", "left_semi").select(*shards.columns)


def summary(shards: DataFrame, *by: str) -> DataFrame:
    """One row, or one for each value of the columns `by`: n_shards, record_count, content_length (nulls ignored), first_date, last_date, n_dates."""
    return shards.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_shards"), F.sum("record_count").alias("record_count"), F.sum("content_length").alias("content_length"),
        F.min("updated_date").alias("first_date"), F.max("updated_date").alias("last_date"), F.count_distinct("updated_date").alias("n_dates"),
    )


def run_summary(outcomes: DataFrame) -> DataFrame:
    """One row of (shard_idx, ok, rows, scanned): completed, failed, rows_written, scanned, failed_shards in order."""
    return outcomes.agg(
        F.count_if("ok").alias("completed"), F.count_if(~F.col("ok")).alias("failed"), F.sum(F.when(F.col("ok"), F.col("rows")).otherwise(0)).alias("rows_written"),
        F.sum("scanned").alias("scanned"), F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col("shard_idx")))).alias("failed_shards"),
    )
