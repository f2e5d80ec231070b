"""One parsed record to the rows of the twelve tables: flattening of the fact, and generators of its children.

Each table is one narrow projection or `inline` of the parsed record; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalia.functions import hashing, text
from marginalia.schemas import TABLES



class _Record:
    """The parsed record; a column is made when it is asked for, as that needs a session."""

    def __getitem__(self, name: str) -> Column:
        return F.col("w")[name]


W = _Record()


def _topic(t: Column) -> list[Column]:
    levels = [t[level][part].alias(f"{level}_{part}") for level in ("subfield", "field", "domain") for part in ("id", "display_name")]
    return [t["id"].alias("id"), t["display_name"].alias("display_name"), t["score"].alias("score"), *levels]


def _location(x: Column) -> list[Column]:
    own = [x[n].alias(n) for n in ("is_oa", "landing_page_url", "pdf_url", "license", "version")]
    return own + [x["source"][n].alias(f"source_{n}") for n in ("id", "display_name", "issn_l", "issn", "host_organization", "type")]


def _apc(x: Column) -> list[Column]:
    return [text.number_as_int(x["value"]).alias("value"), x["currency"].alias("currency"), text.number_as_int(x["value_usd"]).alias("value_usd"), x["provenance"].alias("provenance")]


def works(parsed: DataFrame, hash_algorithm: str = "blake3", site: str = text.SITE) -> DataFrame:
    """The fact table: one row per record, 82 columns.

    The content hash covers the title as delivered and the abstract without tags; the title column has its tags taken
    off afterwards. An abstract that is empty without tags is null, a title stays empty. Empty lists of ids become null.
    """
    digest = {"blake3": hashing.blake3_hash, "sha256": text.content_hash}[hash_algorithm]
    based = parsed.withColumn("_abstract", F.nullif(text.strip_tags(text.decode_inverted_index(W["abstract_inverted_index"])), F.lit("")))
    based = based.withColumn("_hash", digest(W["title"], F.col("_abstract")))
    same = lambda *names: [W[n].alias(n) for n in names]
    inside = lambda prefix, columns: [c.alias(f"{prefix}_{n}") for c, n in columns]
    apc_names, location_names = ("value", "currency", "value_usd", "provenance"), [n for n in TABLES["work_locations"].fieldNames() if n != "work_id"]
    topic_names = ["id", "display_name", "score", *[f"{a}_{b}" for a in ("subfield", "field", "domain") for b in ("id", "display_name")]]
    return based.select(
        text.strip_site(W["id"], site).alias("work_id"), W["doi"].alias("doi"), text.normalize_doi(W["doi"]).alias("doi_norm"), text.strip_tags(W["title"]).alias("title"), F.col("_abstract").alias("abstract_text"), F.col("_hash").alias("content_hash"),
        *same("publication_date", "publication_year", "created_date", "updated_date", "language"), W["type"].alias("work_type"),
        *same("cited_by_count", "referenced_works_count", "countries_distinct_count", "institutions_distinct_count", "locations_count", "fwci", "is_retracted", "is_paratext"),
        *[W["open_access"][n].alias(n) for n in ("is_oa", "oa_status", "oa_url", "any_repository_has_fulltext")],
        W["citation_normalized_percentile"]["value"].alias("citation_normalized_percentile"), W["citation_normalized_percentile"]["is_in_top_1_percent"].alias("is_in_top_1_pct"), W["citation_normalized_percentile"]["is_in_top_10_percent"].alias("is_in_top_10_pct"),
        W["cited_by_percentile_year"]["min"].alias("cited_by_percentile_min"), W["cited_by_percentile_year"]["max"].alias("cited_by_percentile_max"),
        F.coalesce(W["has_content"]["pdf"], W["has_fulltext"]).alias("has_content_pdf"), W["has_content"]["grobid_xml"].alias("has_content_grobid_xml"),
        *[W["biblio"][n].alias(f"biblio_{n}") for n in ("volume", "issue", "first_page", "last_page")],
        *[c for name in ("apc_list", "apc_paid") for c in inside(name, zip(_apc(W[name]), apc_names, strict=True))],
        *inside("primary_topic", zip(_topic(W["primary_topic"]), topic_names, strict=True)),
        *[c for name in ("primary_location", "best_oa_location") for c in inside(name, zip(_location(W[name]), location_names, strict=True))],
        text.extract_pmid(W["ids"]["pmid"]).alias("ids_pmid"), text.extract_pmcid(W["ids"]["pmcid"]).alias("ids_pmcid"),
        *[text.empty_to_null(W[n]).alias(n) for n in ("corresponding_author_ids", "corresponding_institution_ids", "indexed_in", "related_works")],
        "shard_updated_date", F.col("oa_shard_idx").cast("int").alias("oa_shard_idx"),
    )


def works_keys(parsed: DataFrame) -> DataFrame:
    keys = [text.strip_site(W["id"]).alias("work_id"), text.normalize_doi(W["doi"]).alias("doi_norm"), text.extract_pmid(W["ids"]["pmid"]).alias("pmid"), text.extract_pmcid(W["ids"]["pmcid"]).alias("pmcid")]
    return parsed.select(*keys, *(["oa_shard_idx"] if "oa_shard_idx" in parsed.columns else []))


def _each(parsed: DataFrame, items: Column, columns: Callable[[Column], list[Column]]) -> DataFrame:
    """A row per item of a list, in order, with the work's bare id, '' where it has none; empty lists give no row."""
    owner = F.coalesce(text.strip_site(W["id"]), F.lit("")).alias("work_id")
    shard = ["oa_shard_idx"] if "oa_shard_idx" in parsed.columns else []
    return parsed.select(owner, *shard, F.explode(items).alias("x")).select("work_id", *columns(F.col("x")), *shard)


def _fields(*names: str, **renamed: str) -> Callable[[Column], list[Column]]:
    return lambda x: [x[n].alias(n) for n in names] + [x[n].alias(to) for to, n in renamed.items()]


def citations(parsed: DataFrame) -> DataFrame:
    return _each(parsed, W["referenced_works"], lambda x: [text.strip_site(x).alias("referenced_work_id")])


def work_authorships(parsed: DataFrame) -> DataFrame:
    """Authorships with their institutions as parallel lists: missing parts are '', so the lists stay aligned; empty sources give null lists."""

    def columns(a: Column) -> list[Column]:
        spots, texts = a["institutions"], a["affiliations"]
        filled = lambda n: F.transform(spots, lambda i: F.coalesce(i[n], F.lit("")))
        lists = [filled(n) for n in ("id", "display_name", "ror", "country_code", "type")]
        names = ("institution_ids", "institution_display_names", "institution_rors", "institution_country_codes", "institution_types")
        return [
            a["author_position"].alias("author_position"), a["author"]["id"].alias("author_id"), a["author"]["display_name"].alias("author_display_name"), a["author"]["orcid"].alias("author_orcid"),
            a["raw_author_name"].alias("raw_author_name"), a["is_corresponding"].alias("is_corresponding"), text.empty_to_null(a["countries"]).alias("countries"), text.empty_to_null(a["raw_affiliation_strings"]).alias("raw_affiliation_strings"),
            *[F.when(F.size(spots) > 0, c).alias(n) for c, n in zip(lists, names, strict=True)],
            F.when(F.size(spots) > 0, F.transform(spots, lambda i: F.coalesce(i["lineage"], F.array()))).alias("institution_lineages"),
            F.when(F.size(texts) > 0, F.transform(texts, lambda x: F.coalesce(x["raw_affiliation_string"], F.lit("")))).alias("affiliation_raw_strings"),
            F.when(F.size(texts) > 0, F.transform(texts, lambda x: F.coalesce(F.array_compact(x["institution_ids"]), F.array()))).alias("affiliation_institution_ids"),
        ]

    return _each(parsed, W["authorships"], columns)


def work_mesh(parsed: DataFrame) -> DataFrame:
    """Distinct pairs of descriptor and qualifier of a work, the first of equals; nulls are equal."""
    mesh = W["mesh"]
    same = lambda x, y: y["descriptor_ui"].eqNullSafe(x["descriptor_ui"]) & y["qualifier_ui"].eqNullSafe(x["qualifier_ui"])
    first = F.filter(mesh, lambda x, i: ~F.exists(F.slice(mesh, F.lit(1), i), lambda y: same(x, y)))
    return _each(parsed, first, _fields("descriptor_ui", "descriptor_name", "qualifier_ui", "qualifier_name", "is_major_topic"))


def work_awards(parsed: DataFrame) -> DataFrame:
    return _each(parsed, W["awards"], lambda x: [*_fields("id", "display_name", "funder_award_id")(x), F.coalesce(x["funder_id"], x["funder"]).alias("funder_id"), x["funder_display_name"].alias("funder_display_name")])


def work_topics(parsed: DataFrame) -> DataFrame:
    return _each(parsed, W["topics"], lambda x: [_topic(x)[0].alias("topic_id"), *_topic(x)[1:]])


def work_keywords(parsed: DataFrame) -> DataFrame:
    return _each(parsed, W["keywords"], lambda x: [x["id"].alias("keyword_id"), text.strip_tags(x["display_name"]).alias("display_name"), x["score"].alias("score")])


#: Table to builder; a new table is one more entry.
BUILDERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "works": works,
    "works_keys": works_keys,
    "citations": citations,
    "work_authorships": work_authorships,
    "work_topics": work_topics,
    "work_keywords": work_keywords,
    "work_mesh": work_mesh,
    "work_locations": lambda p: _each(p, W["locations"], _location),
    "work_funders": lambda p: _each(p, W["funders"], lambda x: [x["id"].alias("funder_id"), *_fields("display_name", "ror")(x)]),
    "work_awards": work_awards,
    "work_sdgs": lambda p: _each(p, W["sustainable_development_goals"], lambda x: [x["id"].alias("sdg_id"), *_fields("display_name", "score")(x)]),
    "work_counts_by_year": lambda p: _each(p, W["counts_by_year"], _fields("year", "cited_by_count")),
}


def coerce(table: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `table`, taken by their place, under the names and types of `schema`; values that fit no type are null.

    A table with another number of columns is an error.
    """
    if len(table.columns) != len(schema.fields):
        raise ValueError(f"{len(table.columns)} columns, {len(schema.fields)} expected")
    return table.toDF(*[f"_{i}" for i in range(len(schema.fields))]).select(*[F.col(f"_{i}").try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def build_tables(parsed: DataFrame, keep_shard: bool = False) -> dict[str, DataFrame]:
    """All tables of parsed records (w, shard_updated_date, oa_shard_idx), as lazy projections of one input.

    With `keep_shard` the children have their oa_shard_idx as a last column.
    """

    def schema(name: str) -> T.StructType:
        extra = [T.StructField("oa_shard_idx", T.IntegerType())] if keep_shard and name != "works" else []
        return T.StructType([*TABLES[name].fields, *extra])

    return {name: build(parsed).to(schema(name)) for name, build in BUILDERS.items()}
