"""Which files to transfer, from two listings of (relative, size)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the state documents, which are always transferred.
STATE_FILES = (".manifest.json", ".state.json", ".sync_log.jsonl", ".hive_state.json")


def is_state(relative: Column) -> Column:
    found = F.lit(False)
    for name in STATE_FILES:
        found = found | relative.endswith(name)
    return found


def transfers(source: DataFrame, target: DataFrame, force: bool = False) -> DataFrame:
    """Files of `source` that `target` lacks or holds in another size, and state documents; all of them if forced.

    Pushing has the local listing as source, pulling the remote one.
    """
    if force:
        return source
    held = target.groupBy("relative").agg(F.max("size").alias("_size"))
    return source.join(held, "relative", "left").where(is_state(F.col("relative")) | F.col("_size").isNull() | (F.col("_size") != F.col("size"))).select(*source.columns)
