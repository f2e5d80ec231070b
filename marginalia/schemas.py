"""Input record and the twelve output tables: one fact table, its keys, and ten children of it."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
SS = T.ArrayType(S)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# ---- the delivered record ----

NAMED = struct(id=S, display_name=S)
TOPIC = struct(id=S, display_name=S, score=D, subfield=NAMED, field=NAMED, domain=NAMED)
SOURCE = struct(id=S, display_name=S, issn_l=S, issn=SS, host_organization=S, type=S)
LOCATION = struct(is_oa=B, landing_page_url=S, pdf_url=S, license=S, version=S, source=SOURCE)
INSTITUTION = struct(id=S, display_name=S, ror=S, country_code=S, type=S, lineage=SS)
AFFILIATION = struct(raw_affiliation_string=S, institution_ids=SS)
AUTHORSHIP = struct(
    author_position=S, author=struct(id=S, display_name=S, orcid=S), institutions=T.ArrayType(INSTITUTION), is_corresponding=B, raw_author_name=S, countries=SS,
    raw_affiliation_strings=SS, affiliations=T.ArrayType(AFFILIATION),
)
#: Numbers of charges come as integer, fraction, null or text, so their JSON text is kept.
APC = struct(value=T.VariantType(), currency=S, value_usd=T.VariantType(), provenance=S)
SCORED = struct(id=S, display_name=S, score=D)
MESH = struct(descriptor_ui=S, descriptor_name=S, qualifier_ui=S, qualifier_name=S, is_major_topic=B)
FUNDER = struct(id=S, display_name=S, ror=S)
AWARD = struct(id=S, display_name=S, funder_award_id=S, funder_id=S, funder=S, funder_display_name=S)
WORK = struct(
    id=S, doi=S, title=S, display_name=S, publication_date=S, publication_year=I, created_date=S, updated_date=S, language=S, type=S, cited_by_count=I, referenced_works_count=I,
    countries_distinct_count=I, institutions_distinct_count=I, locations_count=I, fwci=D, is_retracted=B, is_paratext=B,
    open_access=struct(is_oa=B, oa_status=S, oa_url=S, any_repository_has_fulltext=B), citation_normalized_percentile=struct(value=D, is_in_top_1_percent=B, is_in_top_10_percent=B),
    cited_by_percentile_year=struct(min=D, max=D), has_fulltext=B, has_content=struct(pdf=B, grobid_xml=B), biblio=struct(volume=S, issue=S, first_page=S, last_page=S),
    apc_list=APC, apc_paid=APC, primary_topic=TOPIC, topics=T.ArrayType(TOPIC), primary_location=LOCATION, best_oa_location=LOCATION, locations=T.ArrayType(LOCATION),
    authorships=T.ArrayType(AUTHORSHIP), corresponding_author_ids=SS, corresponding_institution_ids=SS, ids=struct(mag=S, pmid=S, pmcid=S), keywords=T.ArrayType(SCORED), mesh=T.ArrayType(MESH),
    sustainable_development_goals=T.ArrayType(SCORED), funders=T.ArrayType(FUNDER), awards=T.ArrayType(AWARD), counts_by_year=T.ArrayType(struct(year=I, cited_by_count=I)),
    referenced_works=SS, related_works=SS, indexed_in=SS, abstract_inverted_index=T.MapType(S, T.ArrayType(I)),
)

# ---- the tables ----

_TOPIC_COLUMNS = dict(subfield_id=S, subfield_display_name=S, field_id=S, field_display_name=S, domain_id=S, domain_display_name=S)
_LOCATION_COLUMNS = dict(is_oa=B, landing_page_url=S, pdf_url=S, license=S, version=S, source_id=S, source_display_name=S, source_issn_l=S, source_issn=SS, source_host_organization=S, source_type=S)
_APC_COLUMNS = dict(value=I, currency=S, value_usd=I, provenance=S)


def _prefixed(prefix: str, columns: dict[str, T.DataType]) -> dict[str, T.DataType]:
    return {f"{prefix}_{n}": t for n, t in columns.items()}


WORKS = struct(
    work_id=S, doi=S, doi_norm=S, title=S, abstract_text=S, content_hash=S, publication_date=S, publication_year=I, created_date=S, updated_date=S, language=S, work_type=S,
    cited_by_count=I, referenced_works_count=I, countries_distinct_count=I, institutions_distinct_count=I, locations_count=I, fwci=D, is_retracted=B, is_paratext=B,
    is_oa=B, oa_status=S, oa_url=S, any_repository_has_fulltext=B, citation_normalized_percentile=D, is_in_top_1_pct=B, is_in_top_10_pct=B, cited_by_percentile_min=D, cited_by_percentile_max=D,
    has_content_pdf=B, has_content_grobid_xml=B, biblio_volume=S, biblio_issue=S, biblio_first_page=S, biblio_last_page=S,
    **_prefixed("apc_list", _APC_COLUMNS), **_prefixed("apc_paid", _APC_COLUMNS), **_prefixed("primary_topic", dict(id=S, display_name=S, score=D, **_TOPIC_COLUMNS)),
    **_prefixed("primary_location", _LOCATION_COLUMNS), **_prefixed("best_oa_location", _LOCATION_COLUMNS),
    ids_pmid=S, ids_pmcid=S, corresponding_author_ids=SS, corresponding_institution_ids=SS, indexed_in=SS, related_works=SS, shard_updated_date=S, oa_shard_idx=I,
)

TABLES: dict[str, T.StructType] = {
    "works": WORKS,
    "works_keys": struct(work_id=S, doi_norm=S, pmid=S, pmcid=S),
    "citations": struct(work_id=S, referenced_work_id=S),
    "work_authorships": struct(
        work_id=S, author_position=S, author_id=S, author_display_name=S, author_orcid=S, raw_author_name=S, is_corresponding=B, countries=SS, raw_affiliation_strings=SS, institution_ids=SS,
        institution_display_names=SS, institution_rors=SS, institution_country_codes=SS, institution_types=SS, institution_lineages=T.ArrayType(SS), affiliation_raw_strings=SS, affiliation_institution_ids=T.ArrayType(SS),
    ),
    "work_topics": struct(work_id=S, topic_id=S, display_name=S, score=D, **_TOPIC_COLUMNS),
    "work_keywords": struct(work_id=S, keyword_id=S, display_name=S, score=D),
    "work_mesh": struct(work_id=S, descriptor_ui=S, descriptor_name=S, qualifier_ui=S, qualifier_name=S, is_major_topic=B),
    "work_locations": struct(work_id=S, **_LOCATION_COLUMNS),
    "work_funders": struct(work_id=S, funder_id=S, display_name=S, ror=S),
    "work_awards": struct(work_id=S, id=S, display_name=S, funder_award_id=S, funder_id=S, funder_display_name=S),
    "work_sdgs": struct(work_id=S, sdg_id=S, display_name=S, score=D),
    "work_counts_by_year": struct(work_id=S, year=I, cited_by_count=I),
}
FACT = "works"
CHILDREN = [t for t in TABLES if t != FACT]

SHARDS = struct(shard_idx=I, url=S, content_length=L, record_count=L, updated_date=S)
