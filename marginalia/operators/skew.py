"""Per-key results where a few keys hold most rows: value-frequency compression.

Rows are first counted by (key, value), with map-side combine, so a hot key is spread over its values and arrives as
at most one row per value and task. Distinct counts, modes and percentiles then come from the weighted values. For
percentiles, the weighted values are ranged by key and value over tasks of about equal size, so that a key with very
many distinct values spreads over several, and no window holds more than a task's share of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.sources.tables import cut


def value_frequencies(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, n): how often each value stands with each key. Null keys and null values are counted as such."""
    return rows.select(F.col(key).alias("key"), F.col(value).alias("value")).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


def key_profile(frequencies: DataFrame) -> DataFrame:
    """(key, n_rows, n_distinct, mode_value, mode_rows) of value frequencies.

    Null values count in n_rows only. Of equally frequent values the smallest is the mode; a key with null values only
    has a null mode and no mode_rows. The null key has its row.
    """
    present = F.col("value").isNotNull()
    return frequencies.groupBy("key").agg(
        F.sum("n").alias("n_rows"),
        F.count("value").alias("n_distinct"),
        F.min_by(F.when(present, F.col("value")), F.when(present, F.struct(-F.col("n"), F.col("value")))).alias("mode_value"),
        F.max(F.when(present, F.col("n"))).alias("mode_rows"),
    )


def weighted_percentiles(frequencies: DataFrame, fractions: list[float]) -> DataFrame:
    """(key, fraction, percentile): the smallest value whose cumulated share reaches the fraction, exact.

    Null values are left out; a key without values has no row. Values must be ordered by their type.
    """
    weighted = frequencies.where(F.col("value").isNotNull()).select("key", "value", "n")
    tasks = int(frequencies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once: the bounds of the ranges come from a sample and must be the same in all that follows
    ranged = cut(weighted.repartitionByRange(tasks, "key", "value").withColumn("range", F.spark_partition_id()))
    by_range = ranged.groupBy("key", "range").agg(F.sum("n").alias("in_range"))
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_range.select(F.col("key").alias("_k"), F.col("range").alias("_r"), F.coalesce(F.sum("in_range").over(before), F.lit(0)).alias("offset"), F.sum("in_range").over(Window.partitionBy("key")).alias("total"))
    inside = Window.partitionBy("key", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.join(offsets, F.col("key").eqNullSafe(F.col("_k")) & (F.col("range") == F.col("_r"))).withColumn("upto", F.col("offset") + F.sum("n").over(inside))
    asked = placed.withColumn("fraction", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
    # the value that holds the rank ceil(fraction * total), at least 1
    rank = F.greatest(F.ceil(F.col("fraction") * F.col("total")), F.lit(1))
    return asked.where((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)).select("key", "fraction", F.col("value").alias("percentile"))


def hot_keys(profile: DataFrame, share: float) -> DataFrame:
    """Non-null keys of a profile that hold at least `share` of all rows, those of the null key included in the whole."""
    whole = profile.agg(F.sum("n_rows").alias("_whole"))
    # one row
    return profile.join(F.broadcast(whole)).where(F.col("key").isNotNull() & (F.col("n_rows") >= share * F.col("_whole"))).drop("_whole")
