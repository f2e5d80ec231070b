"""Only new or changed records: what the next run has to process.

The ledger of what runs wrote is anti-joined, as pairs of key and version, with the current version of every record.
`reread_horizon` gives the start of the oldest run that was still open when the last good run began; a source whose
records carry their time of arrival may be read from there on. Records that arrive late keep an old date, so callers
that cannot trust the date pass no horizon and have the anti-join decide for every record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def instant(text: Column) -> Column:
    """A date text of mixed precision as a timestamp; null where it is none. A day counts as its first moment."""
    return F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), "[zZ]$", "").try_cast("timestamp_ntz")


def good_runs(run_log: DataFrame) -> DataFrame:
    """run_ids of the runs that ended well; any other state, null included, is no good end."""
    return run_log.where(F.col("run_state") == "success").select("run_id").where(F.col("run_id").isNotNull()).distinct()


def reread_horizon(run_log: DataFrame) -> DataFrame:
    """One row: last_good_run, horizon (null where no run was good).

    The horizon is the start of the oldest run that had begun, and not ended well, when the last good run began, or
    that run's own start.
    """
    good = run_log.where(F.col("run_state") == "success").agg(F.max("run_id").alias("last_good_run"))
    last = run_log.join(good, F.col("run_id") == F.col("last_good_run")).agg(F.max("last_good_run").alias("last_good_run"), F.max("started_at").alias("last_start"))
    still_open = F.col("started_at").isNotNull() & (F.col("started_at") <= F.col("last_start")) & (F.col("finished_at").isNull() | (F.col("finished_at") > F.col("last_start")))
    # one row on the right
    return run_log.join(F.broadcast(last), still_open, "right").groupBy("last_good_run").agg(F.least(F.min("started_at"), F.max("last_start")).alias("horizon"))


def current_versions(records: DataFrame, key: str, version: str, order: list[Column]) -> DataFrame:
    """The version of the last row of each key: (key, version). Nulls of `order` come first; the version breaks ties."""
    last = F.max_by(F.struct(F.col(version).alias("v")), F.struct(*order, F.col(version)))
    return records.where(F.col(key).isNotNull()).groupBy(key).agg(last.alias("_last")).select(key, F.col("_last.v").alias(version))


def unprocessed(records: DataFrame, ledger: DataFrame, key: str, version: list[str]) -> DataFrame:
    """Rows of `records` whose pair of key and version is not in `ledger`.

    A null version equals nothing, so its record is unprocessed. Null keys are dropped. Repeated rows of the ledger
    change nothing; an empty ledger leaves every record.
    """
    pairs = ledger.select(key, *version).distinct()
    return records.where(F.col(key).isNotNull()).join(pairs, [key, *version], "left_anti")
