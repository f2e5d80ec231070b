"""JSON-lines shards of work records: scan, lenient and strict parsing, counters."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.functions.text import partition_date
from marginalia.schemas import WORK

#: Lists that may be null, and lists whose elements may be; any other list must be a list of non-nulls.
NULLABLE_LISTS, NULLABLE_ELEMENTS = frozenset({"issn"}), frozenset({"institution_ids"})
_CORRUPT = "_corrupt"


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(line, url) of text files, gzip by their name, one task for each gzip file; all members of a file are read."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.input_file_name().alias("url"))


def not_blank(line: Column) -> Column:
    return F.coalesce(line.rlike(r"(?U)\S"), F.lit(False))


def _valid(value: object, kind: T.DataType, name: str = "") -> bool:
    if isinstance(kind, T.VariantType):
        return True
    if value is None:
        return not isinstance(kind, T.ArrayType) or name in NULLABLE_LISTS
    if isinstance(kind, T.StringType):
        return isinstance(value, str) or name == "mag"
    if isinstance(kind, T.BooleanType):
        return isinstance(value, bool)
    if isinstance(kind, T.IntegerType):
        return isinstance(value, int) and not isinstance(value, bool) and -(1 << 31) <= value < 1 << 31
    if isinstance(kind, T.DoubleType):
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    if isinstance(kind, T.MapType):
        return isinstance(value, dict) and all(isinstance(x, list) and all(isinstance(p, int) and not isinstance(p, bool) and 0 <= p < 1 << 32 for p in x) for k, x in value.items() if k != _CORRUPT)
    if isinstance(kind, T.ArrayType):
        return isinstance(value, list) and all((x is None and name in NULLABLE_ELEMENTS) or (x is not None and _valid(x, kind.elementType)) for x in value)
    names = {f.name for f in kind.fields}
    if not isinstance(value, dict) or value.get(_CORRUPT, set()) & names or {"funder", "funder_id"} <= value.keys() & names:
        return False
    return all(_valid(value[f.name], f.dataType, f.name) for f in kind.fields if f.name in value)


def _pairs(pairs: list[tuple[str, object]]) -> dict:
    found = dict(pairs)
    if len(found) < len(pairs):
        names = [n for n, _ in pairs]
        found[_CORRUPT] = {n for n in names if names.count(n) > 1}
    return found


def _constant(name: str) -> None:
    raise ValueError(name)


def is_strict(line: str | None) -> bool:
    """Whether a line is one JSON object whose declared fields all have their declared type.

    A wrong type, an explicit null or null element for a list, a repeated declared field, both names of the funder
    field, negative positions, NaN, and text after the object make it false; unknown fields do not.
    """
    try:
        return _valid(json.loads(line or "", object_pairs_hook=_pairs, parse_constant=_constant), WORK)
    except (ValueError, RecursionError):
        return False


def _with_verdict(lines: DataFrame) -> DataFrame:
    """`lines` with `_strict`, the verdict of `is_strict` on each line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            verdict = pa.array([is_strict(x.as_py()) for x in b.column("line")], pa.bool_())
            yield pa.RecordBatch.from_arrays([*b.columns, verdict], names=[*b.schema.names, "_strict"])

    return lines.mapInArrow(run, T.StructType([*lines.schema.fields, T.StructField("_strict", T.BooleanType())]))


def parse_works(lines: DataFrame, strict: bool = False, keep_failures: bool = False) -> DataFrame:
    """`lines` with the parsed record `w`; blank lines are dropped, and lines that fail, unless they are kept with a null `w`.

    Lenient parsing takes what Spark's JSON reader takes; `strict` also applies `is_strict` to the line.
    """
    schema = T.StructType([*WORK.fields, T.StructField(_CORRUPT, T.StringType())])
    lines = lines.where(not_blank(F.col("line")))
    verdict = F.lit(True)
    if strict:
        lines, verdict = _with_verdict(lines), F.col("_strict")
    parsed = lines.withColumn("w", F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}))
    good = verdict & F.col("w").isNotNull() & F.col(f"w.{_CORRUPT}").isNull()
    plain = F.when(good, F.struct(*[F.col(f"w.{f.name}").alias(f.name) for f in WORK.fields]))
    parsed = parsed.withColumn("w", plain).drop("_strict")
    return parsed if keep_failures else parsed.where(F.col("w").isNotNull())


def with_shards(lines: DataFrame, shards: DataFrame | None = None) -> DataFrame:
    """`lines` with shard_updated_date, of their address, and oa_shard_idx, of the listing (null where it is not listed)."""
    dated = lines.withColumn("shard_updated_date", partition_date(F.col("url")))
    if shards is None:
        return dated.withColumn("oa_shard_idx", F.lit(None).cast("int"))
    listed = shards.groupBy(F.col("url").alias("_url")).agg(F.min("shard_idx").cast("int").alias("oa_shard_idx"))
    return dated.join(listed, F.col("url") == F.col("_url"), "left").drop("_url")


def null_institution(w: Column) -> Column:
    """Whether any affiliation of a record holds a null institution id."""
    of = F.exists(w["authorships"], lambda a: F.coalesce(F.exists(a["affiliations"], lambda x: F.coalesce(F.exists(x["institution_ids"], lambda i: i.isNull()), F.lit(False))), F.lit(False)))
    return F.coalesce(of, F.lit(False))


def ingest_metrics(parsed: DataFrame, kept: Column, by: str = "url") -> DataFrame:
    """Per shard: scanned, written, parse_failures, null_institutions, match_percent, failure_percent of `keep_failures` rows."""
    ok = F.col("w").isNotNull()
    counts = parsed.groupBy(by).agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(ok & kept).alias("written"), F.count_if(~ok).alias("parse_failures"), F.count_if(ok & null_institution(F.col("w"))).alias("null_institutions"),
    )
    percent = lambda c: F.round(100.0 * F.col(c) / F.col("scanned"), 4)
    return counts.withColumn("match_percent", percent("written")).withColumn("failure_percent", percent("parse_failures"))


def observed(parsed: DataFrame, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """`keep_failures` rows with counters that are filled by whatever action reads them, without another scan."""
    seen = Observation(name)
    return parsed.observe(seen, F.count(F.lit(1)).alias("scanned"), F.count_if(F.col("w").isNull()).alias("parse_failures")), seen
