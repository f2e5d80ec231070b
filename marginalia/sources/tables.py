"""Access to parquet tables and to the folder that checkpoints go to."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table `name` of a folder with one parquet file (or directory of files) per table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def footer_counts(files: DataFrame) -> DataFrame:
    """(n_rows, n_files) of a parquet table: the rows are counted without reading a column, the files from the listing.

    Files without rows count; an empty table has one row of zeros.
    """
    return files.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_files", F.lit(len(files.inputFiles())).cast("long"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, which a cluster sets.

    Where it is unset a temporary one, in local mode only: elsewhere a folder of one machine would lose tables.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="marginalia-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df`: it is written to the shared folder, once, and read from there.

    A parquet table takes a fraction of the space of an RDD checkpoint, and its size is known to later joins. The
    tables of an application are removed when it ends.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    folder = f"{shared_folder(spark)}/marginalia-{context.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_remove, context, folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_FOLDERS: set[str] = set()


def _remove(context: SparkContext, folder: str) -> None:
    with contextlib.suppress(Exception):  # the application may have ended before
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def bounded_sample(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """At most `rows` rows of `df`, those of the smallest hash of the columns `by`; all of a smaller table.

    Rows are first thinned by the hash to about twice the number, so that no task sends more than its share.
    """
    n = df.count()
    key = F.xxhash64(*by)
    if n > 2 * rows:
        df = df.where(F.pmod(key, F.lit(1 << 48)) < int((1 << 48) * 2 * rows / n))  # fine enough for any number of rows
    return df.orderBy(key, *by).limit(rows)
