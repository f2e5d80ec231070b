"""Layout by publication year and bucket of the id: the partition map, and the join of children to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.text import shard_bucket, work_number


def partition_map(works: DataFrame, order: list[Column], shards: int) -> DataFrame:
    """(work_num, pub_year, shard): the year of every work number, of repeated works the last one in `order`.

    Null ids are left out; ids without a number share the number 0; null years are 0.
    """
    numbered = works.where(F.col("work_id").isNotNull()).select(work_number(F.col("work_id")).alias("work_num"), F.coalesce("publication_year", F.lit(0)).alias("year"), F.struct(*order).alias("at"))
    last = numbered.groupBy("work_num").agg(F.max_by("year", "at").alias("pub_year"))
    return last.withColumn("shard", shard_bucket(F.col("work_num"), shards))


def place_fact(works: DataFrame, shards: int) -> DataFrame:
    """Works with their own year and bucket; null years are 0, null ids are in bucket 0. Repeated works stay in each of their years."""
    number = F.when(F.col("work_id").isNotNull(), work_number(F.col("work_id")))
    return works.withColumn("pub_year", F.coalesce("publication_year", F.lit(0))).withColumn("shard", shard_bucket(number, shards))


def place_children(children: DataFrame, mapped: DataFrame) -> DataFrame:
    """Children with the year and bucket of their work; those whose work is unknown, and null ids, are left out.

    Whether the map is broadcast is left to its measured size; a shuffled join splits works with very many children.
    """
    keyed = children.where(F.col("work_id").isNotNull()).withColumn("work_num", work_number(F.col("work_id")))
    return keyed.join(mapped, "work_num").drop("work_num")


def unmatched(children: DataFrame, mapped: DataFrame) -> DataFrame:
    """One row: matched and unmatched child rows, null ids among the unmatched."""
    number = F.when(F.col("work_id").isNotNull(), work_number(F.col("work_id")))
    joined = children.select(number.alias("work_num")).join(mapped.select("work_num", F.lit(1).alias("hit")), "work_num", "left")
    return joined.agg(F.count("hit").alias("matched"), F.count_if(F.col("hit").isNull()).alias("unmatched"))


def years(mapped: DataFrame) -> DataFrame:
    return mapped.select("pub_year").distinct().orderBy("pub_year")


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A parquet table as the given schema; an empty one where the folder is missing or holds no file."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
