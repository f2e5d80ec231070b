"""References to records that do not exist.

Parent keys are integers (the number of a record id). They are sorted and compressed into contiguous runs
[run_start, run_end]; a reference is as-of matched to the run that starts at or before it and dangles when it lies
beyond that run's end. Ids that are no integers form a space of their own, so that the same rule serves them.

At scale: keys are cut into cells of CELL numbers, so runs, and the as-of match, are computed by windows that hold at
most CELL keys and CELL distinct targets each, however many references name one target; runs are split at cell
borders. References are reduced to distinct targets (with map-side combine) before the match, and meet the dangling
targets again in a join in which the HOT most referenced targets, dangling or not, a fixed number, travel by broadcast:
rows of hot targets that exist are left out before the shuffle, those of hot targets that dangle are spread over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.ids import id_number, id_space

#: Width of a cell of key numbers: the most keys that one window group can hold.
CELL = 1 << 16
#: Number of most referenced targets that are broadcast with their verdict; every other one holds under 1/HOT of the rows.
HOT = 1000


def _cells(df: DataFrame, id_column: str) -> DataFrame:
    number = F.coalesce(id_number(F.col(id_column)), F.lit(0).cast("long"))
    return df.withColumns({"space": id_space(F.col(id_column)), "number": number}).withColumn("cell", F.floor(F.col("number") / CELL))


def contiguous_runs(parents: DataFrame, id_column: str = "parent_id") -> DataFrame:
    """Runs (space, cell, run_start, run_end) of the distinct canonical ids in `id_column`.

    Null ids are no keys; repeated ids count once; an empty table gives no run; other columns are ignored.
    """
    keys = _cells(parents.select(id_column).where(F.col(id_column).isNotNull()), id_column).select("space", "cell", "number").distinct()
    ordered = Window.partitionBy("space", "cell").orderBy("number")
    return (
        keys.withColumn("island", F.col("number") - F.row_number().over(ordered))
        .groupBy("space", "cell", "island")
        .agg(F.min("number").alias("run_start"), F.max("number").alias("run_end"))
        .drop("island")
    )


def dangling_targets(targets: DataFrame, runs: DataFrame) -> DataFrame:
    """Of distinct (target_id, n_refs), those that no run covers."""
    asked = _cells(targets, "target_id").select("space", "cell", F.col("number").alias("at"), "target_id", "n_refs", F.lit(None).cast("long").alias("run_end"))
    known = runs.select("space", "cell", F.col("run_start").alias("at"), F.lit(None).cast("string").alias("target_id"), F.lit(None).cast("long").alias("n_refs"), "run_end")
    # the run that starts at the same number comes before the target
    preceding = Window.partitionBy("space", "cell").orderBy("at", F.col("run_end").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    matched = known.unionByName(asked).withColumn("reach", F.last("run_end", ignorenulls=True).over(preceding))
    return matched.where(F.col("target_id").isNotNull() & (F.col("reach").isNull() | (F.col("at") > F.col("reach")))).select("target_id", "n_refs")


def dangling_references(references: DataFrame, parents: DataFrame) -> DataFrame:
    """Rows of `references` whose target_id is no parent_id of `parents`.

    `references`: target_id (canonical, as of functions.ids.canonical_id) and any other columns. `parents`: parent_id
    (canonical), the keys that exist. Null targets refer to nothing and give no row. Repeated references are all
    returned. Empty parents make every reference dangle.
    """
    # the row travels as one value, so that none of its names can clash with those used here
    rows = references.where(F.col("target_id").isNotNull()).select("target_id", F.struct(*[F.col(f"`{c}`") for c in references.columns]).alias("row"))
    targets = rows.groupBy("target_id").agg(F.count(F.lit(1)).alias("n_refs"))
    lost = dangling_targets(targets, contiguous_runs(parents))
    most = targets.orderBy(F.desc("n_refs"), "target_id").limit(HOT)
    hot = most.join(lost.select("target_id", F.lit(True).alias("dead")), "target_id", "left").select(F.col("target_id").alias("hot"), F.coalesce("dead", F.lit(False)).alias("dead"))
    # a row of a hot target is decided already; where it dangles, a key of its own spreads it over the shuffle
    spread = F.concat(F.lit("\u0000"), F.xxhash64("row").cast("string"))
    keyed = rows.join(F.broadcast(hot), F.col("target_id") == F.col("hot"), "left").where(F.col("hot").isNull() | F.col("dead")).select("row", "hot", F.when(F.col("hot").isNotNull(), spread).otherwise(F.col("target_id")).alias("key"))
    found = keyed.join(lost.select(F.col("target_id").alias("lost")), F.col("key") == F.col("lost"), "left")
    return found.where(F.col("hot").isNotNull() | F.col("lost").isNotNull()).select("row.*")
