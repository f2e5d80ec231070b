"""Pooling and scaling of vectors, and the split of works into carried and newly encoded ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the least norm and the least count that are divided by.
LEAST = 1e-9


def l2_normalise(vector: Column) -> Column:
    """A vector of length one, as floats; a norm below LEAST counts as LEAST."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.transform(F.array(norm), lambda n: F.transform(vector, lambda x: (x / F.greatest(n, F.lit(LEAST))).cast("float")))[0]


def mean_pool(tokens: DataFrame, key: str, vector: str, mask: str | None = None) -> DataFrame:
    """(key, pooled): the mean of each dimension over the tokens of a key whose mask is above 0; zeros where none is."""
    weight = F.lit(1.0) if mask is None else F.when(F.col(mask) > 0, 1.0).otherwise(0.0)
    flat = tokens.select(key, weight.alias("w"), F.posexplode(vector).alias("i", "x"))
    means = flat.groupBy(key, "i").agg((F.sum(F.col("x").cast("double") * F.col("w")) / F.greatest(F.sum("w"), F.lit(LEAST))).alias("m"))
    return means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("pooled"))


def first_pool(tokens: DataFrame, key: str, vector: str, order: str) -> DataFrame:
    """(key, pooled): the vector of the first token."""
    return tokens.groupBy(key).agg(F.min_by(vector, order).alias("pooled"))


def last_pool(tokens: DataFrame, key: str, vector: str, order: str, mask: str | None = None) -> DataFrame:
    """(key, pooled): the vector of the last token whose mask is above 0, assuming padding on the right; the first token where none is."""
    kept = F.lit(True) if mask is None else F.col(mask) > 0
    return tokens.groupBy(key).agg(F.max_by(vector, F.struct(kept, F.when(kept, F.col(order)).otherwise(-F.col(order)))).alias("pooled"))


def existing_vectors(vectors: DataFrame) -> DataFrame | None:
    """(work_id, content_hash, embedding) of an earlier output, one per work and hash; None where it lacks a column, which forces a full run."""
    if not {"work_id", "content_hash", "embedding"} <= set(vectors.columns):
        return None
    known = vectors.where(F.col("work_id").isNotNull() & F.col("content_hash").isNotNull())
    # a work may have vectors of several versions: the one of its present hash is the one to carry
    return known.groupBy("work_id", "content_hash").agg(F.max("embedding").alias("embedding"))


def split_carried(works: DataFrame, existing: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(carried, to_encode) of works (work_id, text, content_hash): a vector is carried if it is of the same, non-empty hash.

    Works whose text is empty are in neither; a null work_id is ''.
    """
    works = works.where(F.col("text") != "").withColumn("work_id", F.coalesce("work_id", F.lit("")))
    if existing is None:
        return works.withColumn("embedding", F.lit(None).cast("array<float>")).where(F.lit(False)), works
    known = existing.select(F.col("work_id").alias("_id"), F.col("content_hash").alias("_hash"), "embedding")
    joined = works.join(known, (F.col("work_id") == F.col("_id")) & (F.col("content_hash") == F.col("_hash")) & (F.col("content_hash") != ""), "left")
    return joined.where(F.col("_id").isNotNull()).drop("_id", "_hash"), joined.where(F.col("_id").isNull()).drop("_id", "_hash", "embedding")
