"""Text and identifier functions of the ingest, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Addresses that identifiers are delivered under.
SITE = "https://openalex.org/"
BUCKET, BUCKET_HTTPS = "s3://openalex/", "https://openalex.s3.amazonaws.com/"
PMID_PREFIX = "https://pubmed.ncbi.nlm.nih.gov/"
PMCID_PREFIX = "https://www.ncbi.nlm.nih.gov/pmc/articles/"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def trim_blanks(c: Column) -> Column:
    """Without white space of any script at both ends; `trim` takes off plain spaces only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalize_doi(c: Column) -> Column:
    """A DOI without its address, in ASCII lower case; null where nothing is left."""
    return F.translate(F.nullif(trim_blanks(F.regexp_replace(c, r"^https?://(dx\.)?doi\.org/", "")), F.lit("")), _UPPER, _LOWER)


def strip_tags(c: Column) -> Column:
    """Without anything between < and the next >, or the end; entities and lone > stay."""
    return F.regexp_replace(c, "<[^>]*>?", "")


def _after(c: Column, prefix: str) -> Column:
    return F.when(c.startswith(prefix), F.nullif(F.regexp_replace(F.substr(c, F.lit(len(prefix) + 1)), "/+$", ""), F.lit("")))


def extract_pmid(c: Column) -> Column:
    return _after(c, PMID_PREFIX)


def extract_pmcid(c: Column) -> Column:
    return _after(c, PMCID_PREFIX)


def strip_site(c: Column, site: str = SITE) -> Column:
    """An id without the address of its site, if it has it."""
    return F.regexp_replace(c, "^" + re.sub(r"([.\\+*?\[^\]$(){}=!<>|:\-#/])", r"\\\1", site), "")


def work_number(c: Column) -> Column:
    """The number after the first character; 0 for null, for anything but an optional sign and digits, and beyond 64 bits."""
    return F.coalesce(F.when(c.rlike(r"(?s)^.[+-]?[0-9]+$"), F.substr(c, F.lit(2)).try_cast("long")), F.lit(0).cast("long"))


def shard_bucket(number: Column, shards: int) -> Column:
    """abs(number) mod shards without overflow; null is bucket 0."""
    return F.coalesce(F.abs(number % F.lit(shards)), F.lit(0)).cast("int")


def embed_text(title: Column, abstract: Column) -> Column:
    """Title and abstract, trimmed, one per line; empty where both are blank."""
    part = lambda c: F.nullif(trim_blanks(c), F.lit(""))
    return F.concat_ws("\n", part(title), part(abstract))


def to_https(url: Column) -> Column:
    return F.replace(url, F.lit(BUCKET), F.lit(BUCKET_HTTPS))


def partition_date(url: Column) -> Column:
    """The value of the first updated_date= of an address, up to the next slash; null unless ten bytes with two dashes."""
    found = F.regexp_extract(url, "updated_date=([^/]*)", 1)
    return F.when((F.octet_length(found) == 10) & (F.length(found) - F.length(F.replace(found, F.lit("-"))) == 2), found)


def content_type(name: Column) -> Column:
    return F.when(name.endswith(".parquet"), "application/vnd.apache.parquet").otherwise("application/json")


def content_hash(title: Column, abstract: Column) -> Column:
    """SHA-256, in hex, of title, one NUL and abstract, nulls taken as empty."""
    text = lambda c: F.coalesce(c, F.lit(""))
    return F.sha2(F.concat(text(title), F.lit("\u0000"), text(abstract)), 256)


def decode_inverted_index(index: Column) -> Column:
    """The text of a map of word to positions: words in their places, single spaces between places, gaps left empty.

    Of words at one place the last in word order is taken. A map without positions, and an empty one, give an empty text.
    """
    at = F.array_sort(F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(F.coalesce(e.value, F.array()), lambda p: F.struct(p.alias("p"), e.key.alias("w"))))))

    def let(value: Column, body) -> Column:  # a lambda variable is computed once, an expression in a lambda for each item
        return F.transform(F.array(value), body)[0]

    def spaced(words: Column) -> Column:  # the gap before a word is as many spaces as places were skipped
        return F.transform(words, lambda x, i: F.concat(F.repeat(F.lit(" "), (x["p"] - F.when(i == 0, F.lit(0)).otherwise(F.get(words, i - 1)["p"])).cast("int")), x["w"]))

    def last(words: Column) -> Column:
        return F.filter(words, lambda x, i: F.coalesce(F.get(words, i + 1)["p"] != x["p"], F.lit(True)))

    return F.when(index.isNotNull(), F.array_join(let(let(at, last), spaced), ""))


def empty_to_null(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def number_as_int(variant: Column) -> Column:
    """A delivered number as 32-bit integer: whole numbers wrap around, fractions are cut towards zero and saturate; anything else is null."""
    kind = F.schema_of_variant(variant)
    as_long = F.try_variant_get(variant, "$", "decimal(38,0)")
    wrapped = (F.pmod(as_long + F.lit(2147483648), F.lit(4294967296)) - F.lit(2147483648)).cast("int")
    cut = F.try_variant_get(variant, "$", "double")
    fraction = F.when(cut >= 2147483647.0, F.lit(2147483647)).when(cut <= -2147483648.0, F.lit(-2147483648)).otherwise(cut.try_cast("int"))
    return F.when(kind == "BIGINT", wrapped).when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), fraction)


#: SQL bodies of the functions that queries in SQL may call, of one argument s.
_SQL = {
    "normalize_doi": rf"translate(nullif(regexp_replace(regexp_replace(s, r'^https?://(dx\.)?doi\.org/', ''), r'(?U)^\s+|\s+$', ''), ''), '{_UPPER}', '{_LOWER}')",
    "strip_tags": "regexp_replace(s, '<[^>]*>?', '')",
    "strip_site": f"if(startswith(s, '{SITE}'), substr(s, {len(SITE) + 1}), s)",
    "extract_pmid": f"if(startswith(s, '{PMID_PREFIX}'), nullif(rtrim('/', substr(s, {len(PMID_PREFIX) + 1})), ''), NULL)",
    "extract_pmcid": f"if(startswith(s, '{PMCID_PREFIX}'), nullif(rtrim('/', substr(s, {len(PMCID_PREFIX) + 1})), ''), NULL)",
    "work_number": "coalesce(if(s rlike '^.[+-]?[0-9]+$', try_cast(substr(s, 2) AS BIGINT), NULL), 0L)",
}


def register(spark: SparkSession) -> None:
    """Temporary SQL functions normalize_doi, strip_tags, strip_site, extract_pmid, extract_pmcid and work_number."""
    for name, body in _SQL.items():
        kind = "BIGINT" if name == "work_number" else "STRING"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS {kind} RETURN {body}")


def format_bytes(n: int) -> str:
    """Whole gigabytes from one on, else megabytes."""
    return f"{n >> 30} GB" if n >= 1 << 30 else f"{n >> 20} MB"


def format_number(n: int) -> str:
    return f"{n:,}"


def format_elapsed(seconds: float) -> str:
    return f"{int(seconds) // 60}m{int(seconds) % 60:02d}s" if seconds >= 60 else f"{seconds:.1f}s"


def parse_memory(text: str) -> int:
    """Bytes of "32GB", "512MB", "64KB" or a plain number; ValueError otherwise."""
    m = re.fullmatch(r"\s*(\d+)\s*(GB|MB|KB)?\s*", text.upper())
    if not m:
        raise ValueError(f"not an amount of memory: {text!r}")
    return int(m.group(1)) << {"GB": 30, "MB": 20, "KB": 10, None: 0}[m.group(2)]


def redact_url(message: str) -> str:
    """An error message without the address it names."""
    return re.sub(r" for url \([^)]*\)", "", message)
