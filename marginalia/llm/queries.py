"""Queries of the problems on texts, names and vectors: each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.ids import canonical_id
from marginalia.llm import markup, names, neighbours, packing, subjects, tokens
from marginalia.sources.tables import table


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Author ids of one person, and unmatched authorships with the registered institutions they name."""
    rows, registered = table(spark, d, "work_authorships"), table(spark, d, "institutions_ref")
    person = canonical_id(F.col("author_id")).alias("person")
    texts = rows.where(F.col("institution_ids").isNull()).select("authorship_id", "author_id", F.explode("raw_affiliation_strings").alias("text")).where(F.col("text") != "")
    named = names.cut(names.link_organisations(texts, registered))
    delivered = rows.select(person, F.array("author_display_name", "raw_author_name").alias("spellings"), F.transform("institution_ids", canonical_id).alias("places"), F.col("author_orcid").alias("orcid"))
    # a place that a string names counts like a listed one
    told = named.select(person, F.array().cast("array<string>").alias("spellings"), F.array("institution_id").alias("places"), F.lit(None).cast("string").alias("orcid"))
    people = names.entity_pairs(names.resolve_people(delivered.unionByName(told))).select(F.lit("person").alias("entity_kind"), "key_1", "key_2")
    organisations = named.select(F.lit("org").alias("entity_kind"), F.col("authorship_id").cast("string").alias("key_1"), F.col("institution_id").alias("key_2")).distinct()
    return people.unionByName(organisations)


def _fields(spark: SparkSession, d: str) -> DataFrame:
    fields = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("text")) for c in ("title", "abstract_text")])).alias("f")
    return table(spark, d, "works").select(canonical_id(F.col("work_id")).alias("work_id"), fields).select("work_id", "f.field_name", "f.text").where(F.col("work_id").isNotNull())


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Titles and abstracts that hold markup in any row of the work."""
    return markup.clean_texts(_fields(spark, d)).where(F.size("markup") > 0).select("work_id", "field_name").distinct()


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    """The clean text of every title and abstract that holds markup, distinct, with the families of markup found."""
    return markup.clean_texts(_fields(spark, d)).where(F.size("markup") > 0).select("work_id", "field_name", "clean_text", F.array_join("markup", " ").alias("markup")).distinct()


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of works of which one is among the five most similar to the other."""
    rows = table(spark, d, "work_vectors").select(canonical_id(F.col("work_id")).alias("work_id"), "embedding")
    found = neighbours.nearest(neighbours.unit_vectors(rows, "work_id", "embedding"), 5)
    return found.select(F.least("id", "other").alias("work_id_1"), F.greatest("id", "other").alias("work_id_2")).distinct()


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """The token ids of every document."""
    return tokens.encode_texts(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    """Every document, or its pieces, in a container of each kind."""
    sized = tokens.count_tokens(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "n_tokens")
    return packing.pack(sized, table(spark, d, "container_sizes"))


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and share of unused space by kind."""
    held = p9_containers(spark, d).where(F.col("container_id").isNotNull()).groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("n")).groupBy("container_kind").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n").alias("n_tokens"))
    kinds = table(spark, d, "container_sizes").select("container_kind", "capacity_tokens").distinct()
    return held.join(kinds, "container_kind").select("container_kind", "n_containers", "n_tokens", F.round(1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6).alias("unused_share"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """The subjects of every document."""
    works = table(spark, d, "works").select("work_id", F.concat_ws(". ", "title", "abstract_text").alias("text"), F.col("primary_topic_field_id").alias("field_id"), F.col("primary_topic_field_display_name").alias("field_name"))
    return subjects.subjects_of(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "subject_areas"), table(spark, d, "subject_labels"), works)


QUERIES = {f.__name__: f for f in (p5_found, p6_found, p6_clean, p7_found, p8_ids, p9_containers, p9_fill, p10_found)}
ORACLE: dict[str, str] = {}
