"""Queries of the general problems: each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.ids import canonical_id
from marginalia.operators import changes, dangling, flatten, skew
from marginalia.sources.tables import table

#: A key is hot from this share of all rows on.
HOT_SHARE = 0.05
FRACTIONS = [0.5, 0.9]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """References of works and work_topics to works or institutions that do not exist, by table and month of delivery."""
    works, topics, institutions, removed = (table(spark, d, t) for t in ("works", "work_topics", "institutions_ref", "removed_works"))
    month = F.coalesce(F.substring("shard_updated_date", 1, 7), F.lit("none")).alias("shard_month")

    def listed(column: str) -> DataFrame:
        refs = works.select(F.lit(f"works.{column}").alias("ref_field"), month, canonical_id(F.col("work_id")).alias("work_id"), F.explode(column).alias("target"))
        return refs.select("ref_field", "shard_month", "work_id", canonical_id(F.col("target")).alias("target_id")).where(F.col("work_id").isNotNull())

    own = canonical_id(F.col("work_id"))
    named = topics.select(F.lit("work_topics.work_id").alias("ref_field"), month, own.alias("work_id"), own.alias("target_id")).where(F.col("work_id").isNotNull())
    gone = removed.select(canonical_id(F.col("work_id")).alias("parent_id")).where(F.col("parent_id").isNotNull()).distinct()
    there = works.select(canonical_id(F.col("work_id")).alias("parent_id")).distinct().join(gone, "parent_id", "left_anti")
    institution = canonical_id(F.col("institution_id")).alias("parent_id")
    ended = F.coalesce(F.trim("removed_date"), F.lit("")) != ""
    # one space for every kind of record: the letter of the id tells works from institutions
    kept = institutions.groupBy(institution).agg(F.max(ended).alias("gone")).where(~F.col("gone")).select("parent_id")
    parents = there.unionByName(kept).where(F.col("parent_id").isNotNull())
    references = listed("related_works").unionByName(listed("corresponding_institution_ids")).unionByName(named)
    # repeated rows are merged before anything moves twice
    return dangling.dangling_references(references.where(F.col("target_id").isNotNull()).distinct(), parents)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Institutions, lineages and affiliations of authorships as flat rows that keep their places."""
    paths = ["authorships[].institutions[].id", "authorships[].institutions[].lineage[]", "authorships[].affiliations[].institution_ids[]"]
    flat = flatten.flatten_json(table(spark, d, "raw_records"), "raw_id", "json_line", paths)
    kind = F.when(F.col("place") == "authorships[].institutions[]", "institution").when(F.col("place").endswith("lineage[]"), "lineage").otherwise("affiliation")
    from_json = flat.select(
        F.lit("raw_records").alias("source_table"), "record_key", F.col("ordinals")[0].alias("authorship_idx"), kind.alias("link_kind"), F.col("ordinals")[1].alias("item_idx"),
        F.coalesce(F.get("ordinals", F.lit(2)), F.lit(-1)).alias("sub_idx"), F.coalesce(F.col("leaves")["id"], F.col("leaves")["value"]).alias("child_id"),
    )
    authorships = table(spark, d, "work_authorships")

    def lists(link: str, column: str) -> DataFrame:
        flat = flatten.flatten_lists(authorships, F.col("authorship_id"), F.col(column))
        return flat.select(F.lit("work_authorships").alias("source_table"), "record_key", F.lit(-1).alias("authorship_idx"), F.lit(link).alias("link_kind"), "item_idx", "sub_idx", F.col("value").alias("child_id"))

    listed = lists("lineage", "institution_lineages").unionByName(lists("affiliation", "affiliation_institution_ids"))
    return from_json.unionByName(listed).where(F.col("child_id") != "").distinct()


def _frequencies(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    works = table(spark, d, "works").select(F.col("publication_year").cast("string").alias("year"), F.col("cited_by_count").cast("double").alias("cited"))
    topics = table(spark, d, "work_topics").select(canonical_id(F.col("topic_id")).alias("topic"), "score")
    return {"works.publication_year": skew.value_frequencies(works, "year", "cited"), "work_topics.topic_id": skew.value_frequencies(topics, "topic", "score")}


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Publication years and topics that hold at least 5 % of all rows of their table."""
    found = [skew.hot_keys(skew.key_profile(f), HOT_SHARE).select(F.lit(name).alias("field_name"), F.col("key").alias("hot_key")) for name, f in _frequencies(spark, d).items()]
    return found[0].unionByName(found[1])


def p3_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows, exact distinct values, mode and exact percentiles of citations per year and of scores per topic."""
    found = []
    for name, f in _frequencies(spark, d).items():
        percentiles = skew.weighted_percentiles(f, FRACTIONS).groupBy("key").agg(*[F.max(F.when(F.col("fraction") == x, F.col("percentile"))).alias(f"p{int(100 * x)}") for x in FRACTIONS])
        joined = skew.key_profile(f).alias("a").join(percentiles.alias("b"), F.col("a.key").eqNullSafe(F.col("b.key")), "left")
        found.append(joined.select(F.lit(name).alias("field_name"), F.col("a.key").alias("key"), "n_rows", "n_distinct", "mode_value", "mode_rows", *[f"p{int(100 * x)}" for x in FRACTIONS]))
    return found[0].unionByName(found[1])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Works and shards that the next run must process."""
    works, written, runs, listing = (table(spark, d, t) for t in ("works", "processed_works", "run_log", "manifest_entries"))
    good = changes.good_runs(runs)
    # keys are compared in canonical form; a later delivery, then the hash, breaks ties of the date
    delivered = works.select(canonical_id(F.col("work_id")).alias("item_key"), "content_hash", changes.instant(F.col("updated_date")).alias("at"), "shard_updated_date")
    current = changes.current_versions(delivered, "item_key", "content_hash", [F.col("at"), F.col("shard_updated_date")])
    ledger = written.join(good, "run_id", "left_semi").select(canonical_id(F.col("work_id")).alias("item_key"), "content_hash", "processed_at", "run_id")
    last = changes.current_versions(ledger, "item_key", "content_hash", [F.col("processed_at"), F.col("run_id")])
    works_due = changes.unprocessed(current, last, "item_key", ["content_hash"])

    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("record_count", "content_length")]
    keyed = listing.where(F.coalesce(F.trim("url"), F.lit("")) != "").select("run_id", F.col("url").alias("item_key"), *counts)
    planned = keyed.join(listing.agg(F.max("run_id").alias("run_id")), "run_id", "left_semi")
    known = keyed.join(good.agg(F.max("run_id").alias("run_id")), "run_id", "left_semi")
    shards_due = changes.unprocessed(planned, known, "item_key", ["record_count", "content_length"])
    due = works_due.select(F.lit("work").alias("item_kind"), "item_key").unionByName(shards_due.select(F.lit("shard").alias("item_kind"), "item_key"))
    return due.distinct()


def p4_horizon(spark: SparkSession, d: str) -> DataFrame:
    """The last good run and the time from which its successor has to reread."""
    return changes.reread_horizon(table(spark, d, "run_log")).select("last_good_run", F.col("horizon").cast("string").alias("horizon"))


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p3_found, p3_profile, p4_found, p4_horizon)}

_ID = r"'^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/\s]+/(?:[^/\s]+/)*)?([A-Za-z])0*([0-9]+)/*\s*$'"


def _id(c: str) -> str:
    return f"nullif(coalesce(nullif(upper(regexp_extract({c}, {_ID}, 1)) || regexp_extract({c}, {_ID}, 2), ''), trim({c})), '')"


_MONTH = "coalesce(substr(shard_updated_date, 1, 7), 'none') AS shard_month"
_P3 = "SELECT 'works.publication_year' AS field_name, CAST(publication_year AS VARCHAR) AS key, CAST(cited_by_count AS DOUBLE) AS value FROM works UNION ALL SELECT 'work_topics.topic_id', {topic}, score FROM work_topics".format(topic=_id("topic_id"))

ORACLE = {
    "p1_found": f"""
WITH r AS (
  SELECT 'works.related_works' AS ref_field, {_MONTH}, {_id('work_id')} AS work_id, {_id('t')} AS target_id
  FROM (SELECT work_id, shard_updated_date, unnest(related_works) AS t FROM works)
  UNION ALL SELECT 'works.corresponding_institution_ids', {_MONTH}, {_id('work_id')}, {_id('t')}
  FROM (SELECT work_id, shard_updated_date, unnest(corresponding_institution_ids) AS t FROM works)
  UNION ALL SELECT 'work_topics.work_id', {_MONTH}, {_id('work_id')}, {_id('work_id')} FROM work_topics),
w AS (SELECT {_id('work_id')} AS id FROM works), g AS (SELECT {_id('work_id')} AS id FROM removed_works),
i AS (SELECT {_id('institution_id')} AS id FROM institutions_ref WHERE coalesce(removed_date, '') = '')
SELECT DISTINCT * FROM r WHERE work_id IS NOT NULL AND target_id IS NOT NULL AND CASE WHEN ref_field = 'works.corresponding_institution_ids'
  THEN target_id NOT IN (SELECT id FROM i WHERE id IS NOT NULL)
  ELSE target_id NOT IN (SELECT id FROM w WHERE id IS NOT NULL) OR target_id IN (SELECT id FROM g WHERE id IS NOT NULL) END""",
    "p3_found": f"""
WITH v AS ({_P3}) SELECT field_name, key AS hot_key FROM (SELECT field_name, key, count(*) AS n FROM v GROUP BY ALL)
JOIN (SELECT field_name, count(*) AS whole FROM v GROUP BY ALL) USING (field_name) WHERE key IS NOT NULL AND n >= 0.05 * whole""",
    "p3_profile": f"""
WITH v AS ({_P3}), f AS (SELECT field_name, key, value, count(*) AS n FROM v GROUP BY ALL),
a AS (SELECT field_name, key, CAST(sum(n) AS BIGINT) AS n_rows, count(value) AS n_distinct FROM f GROUP BY ALL),
m AS (SELECT field_name, key, value AS mode_value, n AS mode_rows FROM f WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY field_name, key ORDER BY n DESC, value) = 1),
q AS (SELECT field_name, key, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.9) AS p90 FROM v WHERE value IS NOT NULL GROUP BY ALL)
SELECT a.*, m.mode_value, m.mode_rows, q.p50, q.p90 FROM a
LEFT JOIN m ON m.field_name = a.field_name AND m.key IS NOT DISTINCT FROM a.key LEFT JOIN q ON q.field_name = a.field_name AND q.key IS NOT DISTINCT FROM a.key""",
    "p4_found": f"""
WITH good AS (SELECT DISTINCT run_id FROM run_log WHERE run_state = 'success'),
c AS (SELECT {_id('work_id')} AS k, content_hash AS h FROM works WHERE {_id('work_id')} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k
  ORDER BY CAST(replace(updated_date, 'Z', '') AS TIMESTAMP) DESC NULLS LAST, shard_updated_date DESC NULLS LAST, content_hash DESC NULLS LAST) = 1),
l AS (SELECT {_id('work_id')} AS k, content_hash AS h FROM processed_works WHERE run_id IN (FROM good) QUALIFY row_number() OVER (PARTITION BY k ORDER BY processed_at DESC NULLS LAST, run_id DESC) = 1),
s AS (SELECT run_id, url, coalesce(record_count, 0) AS rc, coalesce(content_length, 0) AS cl FROM manifest_entries WHERE trim(url) <> '')
SELECT 'work' AS item_kind, k AS item_key FROM c LEFT JOIN l USING (k) WHERE c.h IS NULL OR l.h IS NULL OR c.h <> l.h
UNION SELECT 'shard', url FROM s WHERE run_id = (SELECT max(run_id) FROM manifest_entries) AND NOT EXISTS (
  SELECT 1 FROM s AS o WHERE o.run_id = (SELECT max(run_id) FROM good) AND o.url = s.url AND o.rc = s.rc AND o.cl = s.cl)""",
    "p4_horizon": """
WITH g AS (SELECT max(run_id) AS last_good_run FROM run_log WHERE run_state = 'success'),
l AS (SELECT last_good_run, (SELECT max(started_at) FROM run_log WHERE run_id = last_good_run) AS last_start FROM g)
SELECT last_good_run, CAST(least(last_start, (SELECT min(started_at) FROM run_log WHERE started_at <= last_start AND (finished_at IS NULL OR finished_at > last_start))) AS VARCHAR) AS horizon FROM l""",
    "p2_found": """
WITH j AS (SELECT raw_id, CAST(json_line AS JSON) AS o FROM (SELECT raw_id, trim(json_line) AS json_line FROM raw_records) WHERE CASE WHEN json_valid(json_line) THEN json_type(json_line) = 'OBJECT' AND NOT regexp_matches(json_line, '[:,\\[]\\s*-?(NaN|Infinity)') ELSE FALSE END),
a AS (SELECT raw_id, unnest(x) AS a, generate_subscripts(x, 1) - 1 AS ai FROM (SELECT raw_id, CASE json_type(o->'authorships') WHEN 'ARRAY' THEN CAST(o->'authorships' AS JSON[]) WHEN 'OBJECT' THEN [o->'authorships'] END AS x FROM j)),
i AS (SELECT raw_id, ai, unnest(x) AS i, generate_subscripts(x, 1) - 1 AS ii FROM (SELECT raw_id, ai, CASE json_type(a->'institutions') WHEN 'ARRAY' THEN CAST(a->'institutions' AS JSON[]) WHEN 'OBJECT' THEN [a->'institutions'] END AS x FROM a)),
f AS (SELECT raw_id, ai, unnest(x) AS f, generate_subscripts(x, 1) - 1 AS fi FROM (SELECT raw_id, ai, CASE json_type(a->'affiliations') WHEN 'ARRAY' THEN CAST(a->'affiliations' AS JSON[]) WHEN 'OBJECT' THEN [a->'affiliations'] END AS x FROM a)),
l AS (SELECT raw_id, ai, ii, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS s FROM (SELECT raw_id, ai, ii, CASE json_type(i->'lineage') WHEN 'ARRAY' THEN CAST(i->'lineage' AS JSON[]) WHEN 'VARCHAR' THEN [i->'lineage'] END AS x FROM i)),
t AS (SELECT raw_id, ai, fi, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS s FROM (SELECT raw_id, ai, fi, CASE json_type(f->'institution_ids') WHEN 'ARRAY' THEN CAST(f->'institution_ids' AS JSON[]) WHEN 'VARCHAR' THEN [f->'institution_ids'] END AS x FROM f)),
n AS (SELECT authorship_id, unnest(institution_lineages) AS x, generate_subscripts(institution_lineages, 1) - 1 AS ii FROM work_authorships),
m AS (SELECT authorship_id, unnest(affiliation_institution_ids) AS x, generate_subscripts(affiliation_institution_ids, 1) - 1 AS ii FROM work_authorships),
u AS (
  SELECT 'raw_records' AS source_table, raw_id AS record_key, ai AS authorship_idx, 'institution' AS link_kind, ii AS item_idx, -1 AS sub_idx, i->>'id' AS child_id FROM i
  UNION ALL SELECT 'raw_records', raw_id, ai, 'lineage', ii, s, v->>'$' FROM l
  UNION ALL SELECT 'raw_records', raw_id, ai, 'affiliation', fi, s, v->>'$' FROM t
  UNION ALL SELECT 'work_authorships', authorship_id, -1, 'lineage', ii, generate_subscripts(x, 1) - 1, unnest(x) FROM n
  UNION ALL SELECT 'work_authorships', authorship_id, -1, 'affiliation', ii, generate_subscripts(x, 1) - 1, unnest(x) FROM m)
SELECT DISTINCT source_table, record_key, CAST(authorship_idx AS INTEGER) AS authorship_idx, link_kind, CAST(item_idx AS INTEGER) AS item_idx, CAST(sub_idx AS INTEGER) AS sub_idx, child_id FROM u WHERE child_id <> ''""",
}
