"""Incremental ingest as a stream: new files of a folder are parsed once; the checkpoint is the record of what was read."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marginalia.operators.filters import WorkFilter
from marginalia.operators.records import build_tables
from marginalia.plans.ingest import writer
from marginalia.sources.works import parse_works, with_shards
from marginalia.sources.tables import cut


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(line, url) of the text files that appear in a folder."""
    return spark.readStream.format("text").load(folder).select(F.col("value").alias("line"), F.input_file_name().alias("url"))


def ingest_new(spark: SparkSession, folder: str, raw: str, checkpoint: str, work_filter: WorkFilter | None = None, strict: bool = True) -> StreamingQuery:
    """Write the tables of all files not read before, then stop. A batch that is replayed replaces its own output."""
    keep = (work_filter or WorkFilter()).condition(F.col("w"))

    def batch(lines: DataFrame, number: int) -> None:
        kept = cut(with_shards(parse_works(lines, strict).where(keep)).select("w", "shard_updated_date", "oa_shard_idx"))
        for name, table in build_tables(kept).items():
            writer(table, 3, 500_000).mode("overwrite").parquet(os.path.join(raw, name, f"batch={number}"))

    return stream_lines(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
