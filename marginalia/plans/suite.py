"""Queries of the ingest and layout operators over the driver's tables, with their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import hashing, text
from marginalia.operators import filters, partitions, records, sync, vectors
from marginalia.plans import layout
from marginalia.sources import manifest
from marginalia.sources import works as source
from marginalia.sources.tables import cut, footer_counts, shared_folder, table

SHARDS = 4
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


_SPACE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_TRIM = lambda c: f"regexp_replace({c}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"
_NUM = lambda c: f"coalesce(CASE WHEN regexp_full_match({c}, '.[+-]?[0-9]+') THEN TRY_CAST(substr({c}, 2) AS BIGINT) END, 0)"


# ---- text ----


@query("""SELECT work_id, md5(regexp_replace(title, '<[^>]*>?', '', 'g')) AS title_md5, md5(regexp_replace(abstract_text, '<[^>]*>?', '', 'g')) AS abstract_md5,
CAST(length(regexp_replace(abstract_text, '<[^>]*>?', '', 'g')) AS BIGINT) AS abstract_chars FROM works""")
def tag_strip(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "works")
    abstract = text.strip_tags(F.col("abstract_text"))
    return w.select("work_id", F.md5(text.strip_tags(F.col("title"))).alias("title_md5"), F.md5(abstract).alias("abstract_md5"), F.length(abstract).cast("long").alias("abstract_chars"))


_DOI = """CASE o_orderkey % 8 WHEN 0 THEN 'https://doi.org/10.5/AB' || k WHEN 1 THEN 'http://doi.org/10.5/Ab' || k WHEN 2 THEN 'https://dx.doi.org/10.5/' || k || ' ' WHEN 3 THEN 'http://dx.doi.org/10.5/' || k
WHEN 4 THEN '  10.5/' || k || 'Z' WHEN 5 THEN ' https://doi.org/10.5/' || k WHEN 6 THEN 'https://doi.org/' ELSE '   ' END"""


@query(f"""SELECT o_orderkey, translate(nullif({_TRIM("regexp_replace(doi, '^https?://(dx\\.)?doi\\.org/', '')")}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS doi_norm
FROM (SELECT o_orderkey, {_DOI} AS doi FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS k FROM orders))""")
def doi_normalise(spark: SparkSession, d: str) -> DataFrame:
    given = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("k")).withColumn("doi", F.expr(_DOI))
    return given.select("o_orderkey", text.normalize_doi(F.col("doi")).alias("doi_norm"))


_LINK = "CASE c_custkey % 5 WHEN 0 THEN '{p}' || c_custkey WHEN 1 THEN '{p}' || c_custkey || '//' WHEN 2 THEN '{p}' WHEN 3 THEN 'https://other.example/' || c_custkey ELSE NULL END"


def _extract(prefix: str) -> str:
    link = _LINK.format(p=prefix)
    return f"SELECT c_custkey, CASE WHEN starts_with(link, '{prefix}') THEN nullif(rtrim(substr(link, {len(prefix) + 1}), '/'), '') END AS found FROM (SELECT c_custkey, {link} AS link FROM customer)"


@query(_extract(text.PMID_PREFIX))
def pmid_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").withColumn("link", F.expr(_LINK.format(p=text.PMID_PREFIX))).select("c_custkey", text.extract_pmid(F.col("link")).alias("found"))


@query(_extract(text.PMCID_PREFIX))
def pmcid_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").withColumn("link", F.expr(_LINK.format(p=text.PMCID_PREFIX))).select("c_custkey", text.extract_pmcid(F.col("link")).alias("found"))


@query(f"SELECT c_custkey, CASE WHEN starts_with(link, '{text.SITE}') THEN substr(link, {len(text.SITE) + 1}) ELSE link END AS bare FROM (SELECT c_custkey, {_LINK.format(p=text.SITE)} AS link FROM customer)")
def site_strip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").withColumn("link", F.expr(_LINK.format(p=text.SITE))).select("c_custkey", text.strip_site(F.col("link")).alias("bare"))


@query(f"SELECT o_orderkey, replace('{text.BUCKET}data/part_' || o_orderkey || '?copy={text.BUCKET}x', '{text.BUCKET}', '{text.BUCKET_HTTPS}') AS url FROM orders")
def url_rewrite(spark: SparkSession, d: str) -> DataFrame:
    url = F.concat(F.lit(f"{text.BUCKET}data/part_"), F.col("o_orderkey").cast("string"), F.lit(f"?copy={text.BUCKET}x"))
    return table(spark, d, "orders").select("o_orderkey", text.to_https(url).alias("url"))


@query("""SELECT run_id, url, CASE WHEN strlen(f) = 10 AND length(f) - length(replace(f, '-', '')) = 2 THEN f END AS partition_date
FROM (SELECT run_id, url, regexp_extract(url, 'updated_date=([^/]*)', 1) AS f FROM manifest_entries)""")
def url_partition_date(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest_entries").select("run_id", "url", text.partition_date(F.col("url")).alias("partition_date"))


@query(f"SELECT shard, count(*) AS n_rows, count(DISTINCT num) AS n_works FROM (SELECT {_NUM('work_id')} AS num, CAST(abs(CASE WHEN work_id IS NOT NULL THEN {_NUM('work_id')} ELSE 0 END % {SHARDS}) AS INTEGER) AS shard FROM works) GROUP BY shard")
def work_id_bucket(spark: SparkSession, d: str) -> DataFrame:
    num = text.work_number(F.col("work_id"))
    return table(spark, d, "works").select(num.alias("num"), text.shard_bucket(num, SHARDS).alias("shard")).groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("num").alias("n_works"))


@query("SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS n_chars FROM documents WHERE text IS NOT NULL")
def inverted_index_decode(spark: SparkSession, d: str) -> DataFrame:
    """Encode every text as word to positions, decode it again."""
    words = table(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", F.posexplode(F.split("text", " ", -1)).alias("at", "word"))
    entries = words.groupBy("doc_id", "word").agg(F.sort_array(F.collect_list("at")).alias("at")).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "at"))).alias("index"))
    plain = entries.select("doc_id", text.decode_inverted_index(F.col("index")).alias("text"))
    return plain.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


@query("SELECT work_id, sha256(coalesce(title, '') || chr(0) || coalesce(abstract_text, '')) AS computed, content_hash IS NOT DISTINCT FROM sha256(coalesce(title, '') || chr(0) || coalesce(abstract_text, '')) AS agrees FROM works")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    computed = text.content_hash(F.col("title"), F.col("abstract_text"))
    return table(spark, d, "works").select("work_id", computed.alias("computed"), F.col("content_hash").eqNullSafe(computed).alias("agrees"))


@query()
def blake3_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "works").select("work_id", hashing.blake3_hash(F.col("title"), F.col("abstract_text")).alias("content_hash"))


@query(f"SELECT work_id, md5(t) AS text_md5 FROM (SELECT work_id, concat_ws(chr(10), nullif({_TRIM('title')}, ''), nullif({_TRIM('abstract_text')}, '')) AS t FROM works) WHERE t <> ''")
def embed_text(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "works").select("work_id", text.embed_text(F.col("title"), F.col("abstract_text")).alias("text"))
    return filters.embeddable(texts).select("work_id", F.md5("text").alias("text_md5"))


# ---- records ----


@query("SELECT k, count(*) AS n FROM (SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY k")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.from_json("props", "k int").alias("p")).groupBy(F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


def _parsed(spark: SparkSession, d: str, **options) -> DataFrame:
    lines = table(spark, d, "raw_records").select(F.col("json_line").alias("line"), F.col("oa_shard_idx").cast("string").alias("url"), "oa_shard_idx")
    return source.parse_works(lines, **options).withColumn("shard_updated_date", F.lit(None).cast("string"))


@query()
def raw_works(spark: SparkSession, d: str) -> DataFrame:
    """The fact table of the delivered records, strictly parsed."""
    return records.build_tables(_parsed(spark, d, strict=True))["works"]


@query()
def raw_authorships(spark: SparkSession, d: str) -> DataFrame:
    return records.build_tables(_parsed(spark, d, strict=True))["work_authorships"]


@query()
def raw_table_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each of the twelve tables of the delivered records, parsed as Spark's reader does."""
    counts = [t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, t in records.build_tables(cut(_parsed(spark, d))).items()]
    whole = counts[0]
    for c in counts[1:]:
        whole = whole.unionByName(c)
    return whole


@query()
def raw_ingest_metrics(spark: SparkSession, d: str) -> DataFrame:
    return source.ingest_metrics(_parsed(spark, d, strict=True, keep_failures=True), filters.WorkFilter(languages=["en"]).condition(F.col("w")))


@query("""SELECT event_type, count(*) AS scanned, count(*) FILTER (value > 50) AS written, CAST(round(100.0 * count(*) FILTER (value > 50) / count(*), 4) AS DOUBLE) AS match_percent FROM events GROUP BY event_type""")
def ingest_metrics(spark: SparkSession, d: str) -> DataFrame:
    agg = table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("scanned"), F.count_if(F.col("value") > 50).alias("written"))
    return agg.withColumn("match_percent", F.round(100.0 * F.col("written").cast("double") / F.col("scanned"), 4))


@query("SELECT language, work_type, count(*) AS n FROM works WHERE language IN ('en', 'de') AND work_type IN ('article', 'review') GROUP BY ALL")
def filter_language_type(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "works").withColumn("w", F.struct("language", F.col("work_type").alias("type")))
    kept = w.where(filters.WorkFilter(languages=["en", "de"], work_types=["article", "review"]).condition(F.col("w")))
    return kept.groupBy("language", "work_type").agg(F.count(F.lit(1)).alias("n"))


_TOPICS = ["T80926", "T81909"]


@query("""SELECT work_id, count(*) AS n_topics FROM work_topics GROUP BY work_id
HAVING bool_or(coalesce(domain_display_name = 'Health Sciences', FALSE) OR coalesce(regexp_replace(topic_id, '^https://corpus\\.example/', '') IN ('T80926', 'T81909'), FALSE))""")
def filter_topic_exists(spark: SparkSession, d: str) -> DataFrame:
    """Works any of whose topics is of a domain or a topic asked for: the filter decides each topic as a record of its own."""
    t = table(spark, d, "work_topics")
    # the filter strips its own site's address
    topic = F.struct(F.regexp_replace("topic_id", r"^https://corpus\.example/", text.SITE).alias("id"), F.struct(F.col("domain_display_name").alias("display_name")).alias("domain"))
    record = F.struct(F.lit(None).cast("struct<id:string,domain:struct<display_name:string>>").alias("primary_topic"), F.array(topic).alias("topics"))
    hit = filters.WorkFilter(domains=["Health Sciences"], topics=_TOPICS).condition(F.col("w"))
    return t.select("work_id", record.alias("w")).select("work_id", hit.alias("hit")).groupBy("work_id").agg(F.count(F.lit(1)).alias("n_topics"), F.bool_or("hit").alias("hit")).where("hit").drop("hit")


@query("SELECT run_id, url, shard_idx FROM manifest_entries WHERE updated_date >= '2025-06-01'")
def since_filter(spark: SparkSession, d: str) -> DataFrame:
    return filters.since(table(spark, d, "manifest_entries"), "2025-06-01").select("run_id", "url", "shard_idx")


@query("SELECT coalesce(work_id, '') AS work_id, regexp_replace(t, '^https://corpus\\.example/', '') AS related_work_id FROM (SELECT work_id, unnest(related_works) AS t FROM works)")
def explode_children(spark: SparkSession, d: str) -> DataFrame:
    site = lambda c: F.regexp_replace(c, r"^https://corpus\.example/", text.SITE)
    record = F.struct(F.col("work_id").alias("id"), F.transform("related_works", site).alias("referenced_works"))
    return records.citations(table(spark, d, "works").select(record.alias("w"))).select("work_id", F.col("referenced_work_id").alias("related_work_id"))


_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


@query(f"""SELECT l_orderkey, l_returnflag, l_linestatus, l_linenumber, l_partkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus ORDER BY {', '.join(_LINE_ORDER)}) = 1""")
def mesh_dedup_first(spark: SparkSession, d: str) -> DataFrame:
    """First line of each pair of flags within an order: the lines of an order are the mesh headings of a record."""
    heading = lambda x: F.struct(x["l_returnflag"].alias("descriptor_ui"), x["l_partkey"].alias("descriptor_name"), x["l_linestatus"].alias("qualifier_ui"), x["l_linenumber"].alias("qualifier_name"), F.lit(None).cast("boolean").alias("is_major_topic"))
    lines = table(spark, d, "lineitem").select("l_orderkey", F.struct(*_LINE_ORDER, "l_returnflag", "l_linestatus").alias("l"))
    orders = lines.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list("l")), heading).alias("mesh"))
    mesh = records.work_mesh(orders.select(F.struct(F.col("l_orderkey").cast("string").alias("id"), "mesh").alias("w")))
    return mesh.select(F.col("work_id").cast("long").alias("l_orderkey"), F.col("descriptor_ui").alias("l_returnflag"), F.col("qualifier_ui").alias("l_linestatus"), F.col("qualifier_name").alias("l_linenumber"), F.col("descriptor_name").alias("l_partkey"))


@query("""SELECT authorship_id, CASE WHEN len(institution_ids) > 0 THEN array_to_string(list_transform(institution_ids, lambda x: coalesce(x, '')), '|') END AS ids,
CASE WHEN len(institution_country_codes) > 0 THEN array_to_string(list_transform(institution_country_codes, lambda x: coalesce(x, '')), '|') END AS codes,
CASE WHEN len(countries) > 0 THEN array_to_string(countries, '|') END AS countries FROM work_authorships""")
def struct_of_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Parallel lists with '' for what is missing, null where empty."""
    a = table(spark, d, "work_authorships")
    filled = lambda c: F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda x: F.coalesce(x, F.lit(""))), "|"))
    return a.select("authorship_id", filled("institution_ids").alias("ids"), filled("institution_country_codes").alias("codes"), F.array_join(text.empty_to_null(F.col("countries")), "|").alias("countries"))


@query("SELECT c_custkey, n_name AS nation_name, r_name AS region_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def flatten_struct(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    nested = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.struct(F.struct("n_name", F.struct("r_name").alias("region")).alias("nation")).alias("home"))
    return nested.select("c_custkey", F.col("home.nation.n_name").alias("nation_name"), F.col("home.nation.region.r_name").alias("region_name"))


@query("SELECT work_id, CASE WHEN len(related_works) > 0 THEN CAST(len(related_works) AS INTEGER) END AS n_listed, CASE WHEN len(related_works) > 0 THEN CAST(len(list_filter(related_works, lambda x: x IS NOT NULL)) AS INTEGER) END AS n_present FROM works")
def empty_list_to_null(spark: SparkSession, d: str) -> DataFrame:
    listed = text.empty_to_null(F.col("related_works"))
    size = lambda c: F.when(c.isNotNull(), F.size(c))
    return table(spark, d, "works").select("work_id", size(listed).alias("n_listed"), size(F.array_compact(listed)).alias("n_present"))


# ---- layout ----

_MAP = f"""m AS (SELECT num AS work_num, arg_max(y, (coalesce(u, ''), y)) AS pub_year FROM (SELECT {_NUM('work_id')} AS num, coalesce(publication_year, 0) AS y, updated_date AS u FROM works WHERE work_id IS NOT NULL) GROUP BY num)"""


def _map(spark: SparkSession, d: str) -> DataFrame:
    return partitions.partition_map(table(spark, d, "works"), [F.coalesce("updated_date", F.lit("")), F.coalesce("publication_year", F.lit(0))], SHARDS)


@query(f"WITH {_MAP} SELECT work_num, pub_year, CAST(abs(work_num % {SHARDS}) AS INTEGER) AS shard FROM m")
def partition_map_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return _map(spark, d)


@query(f"""WITH {_MAP} SELECT pub_year, CAST(abs(work_num % {SHARDS}) AS INTEGER) AS shard, count(*) AS n_rows, count(DISTINCT topic_id) AS n_topics
FROM work_topics JOIN m ON {_NUM('work_topics.work_id')} = work_num WHERE work_topics.work_id IS NOT NULL GROUP BY ALL""")
def child_year_join(spark: SparkSession, d: str) -> DataFrame:
    placed = partitions.place_children(table(spark, d, "work_topics"), _map(spark, d))
    # distinct topics by two aggregations with partial combine, not one set per partition
    return placed.groupBy("pub_year", "shard", "topic_id").agg(F.count(F.lit(1)).alias("n")).groupBy("pub_year", "shard").agg(F.sum("n").alias("n_rows"), F.count("topic_id").alias("n_topics"))


@query(f"WITH {_MAP} SELECT count(*) FILTER (work_num IS NOT NULL) AS matched, count(*) FILTER (work_num IS NULL) AS unmatched FROM work_topics t LEFT JOIN m ON CASE WHEN t.work_id IS NOT NULL THEN {_NUM('t.work_id')} END = work_num")
def unmatched_count(spark: SparkSession, d: str) -> DataFrame:
    return partitions.unmatched(table(spark, d, "work_topics"), _map(spark, d))


@query(f"WITH {_MAP} SELECT DISTINCT pub_year FROM m ORDER BY pub_year")
def distinct_years(spark: SparkSession, d: str) -> DataFrame:
    return partitions.years(_map(spark, d))


@query(f"SELECT coalesce(publication_year, 0) AS pub_year, CAST(abs(CASE WHEN work_id IS NOT NULL THEN {_NUM('work_id')} ELSE 0 END % {SHARDS}) AS INTEGER) AS shard, count(*) AS n_rows FROM works GROUP BY ALL")
def hive_layout_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Write the fact table's layout to the shared folder and count what is read back."""
    folder = os.path.join(shared_folder(spark).removeprefix("file:"), f"layout-{os.urandom(8).hex()}")
    layout.write_placed(partitions.place_fact(table(spark, d, "works"), SHARDS), os.path.join(folder, "works"))
    return spark.read.parquet(os.path.join(folder, "works")).groupBy("pub_year", "shard").agg(F.count(F.lit(1)).alias("n_rows"))


# ---- listings ----

_LISTING = "SELECT url, min(shard_idx) AS shard_idx, max(content_length) AS content_length, max(record_count) AS record_count FROM manifest_entries WHERE run_id = {run} AND url IS NOT NULL GROUP BY url"


def _listing(spark: SparkSession, d: str, run: int) -> DataFrame:
    rows = table(spark, d, "manifest_entries").where((F.col("run_id") == run) & F.col("url").isNotNull())
    return rows.groupBy("url").agg(F.min("shard_idx").alias("shard_idx"), F.max("content_length").alias("content_length"), F.max("record_count").alias("record_count"), F.max("updated_date").alias("updated_date"))


def _complete(shards: DataFrame) -> DataFrame:
    return shards.where("shard_idx % 3 <> 0").select("shard_idx")


@query(f"""WITH o AS ({_LISTING.format(run=4)}), n AS ({_LISTING.format(run=7)})
SELECT coalesce(n.url, o.url) AS url, coalesce(n.shard_idx, o.shard_idx) AS shard_idx, CASE WHEN n.url IS NULL THEN 'removed'
WHEN o.url IS NULL OR coalesce(o.content_length, 0) <> coalesce(n.content_length, 0) OR o.record_count IS DISTINCT FROM n.record_count THEN 'changed' WHEN n.shard_idx % 3 <> 0 THEN 'unchanged_ok' ELSE 'unchanged_missing' END AS change FROM o FULL JOIN n ON o.url = n.url""")
def manifest_diff(spark: SparkSession, d: str) -> DataFrame:
    new = _listing(spark, d, 7)
    return manifest.diff(_listing(spark, d, 4), new, _complete(new))


@query(f"""WITH o AS ({_LISTING.format(run=4)}), n AS ({_LISTING.format(run=7)})
SELECT n.url, CAST(coalesce(o.shard_idx, (SELECT max(shard_idx) FROM o) + row_number() OVER (PARTITION BY o.url IS NULL ORDER BY n.shard_idx, n.url)) AS INTEGER) AS shard_idx FROM n LEFT JOIN o ON o.url = n.url""")
def stabilise_indices(spark: SparkSession, d: str) -> DataFrame:
    return manifest.stabilise(_listing(spark, d, 7), _listing(spark, d, 4)).select("url", "shard_idx")


@query(f"WITH n AS ({_LISTING.format(run=7)}) SELECT url, shard_idx FROM n WHERE shard_idx % 3 = 0")
def completed_anti(spark: SparkSession, d: str) -> DataFrame:
    new = _listing(spark, d, 7)
    return filters.pending(new, _complete(new)).select("url", "shard_idx")


@query(f"WITH n AS ({_LISTING.format(run=7)}) SELECT url, shard_idx FROM n WHERE shard_idx % 3 <> 0")
def failed_semi(spark: SparkSession, d: str) -> DataFrame:
    new = _listing(spark, d, 7)
    return manifest.gather(new, _complete(new)).select("url", "shard_idx")


def _sync(source_run: int, target_run: int) -> str:
    return f"""WITH s AS ({_LISTING.format(run=source_run)}), t AS ({_LISTING.format(run=target_run)})
SELECT s.url AS relative, coalesce(s.content_length, 0) AS size FROM s LEFT JOIN t ON s.url = t.url WHERE t.url IS NULL OR coalesce(s.content_length, 0) <> coalesce(t.content_length, 0) OR s.url LIKE '%.manifest.json'"""


def _files(listing: DataFrame) -> DataFrame:
    return listing.select(F.col("url").alias("relative"), F.coalesce("content_length", F.lit(0)).alias("size"))


@query(_sync(7, 4))
def sync_diff_push(spark: SparkSession, d: str) -> DataFrame:
    return sync.transfers(_files(_listing(spark, d, 7)), _files(_listing(spark, d, 4)))


@query(_sync(4, 7))
def sync_diff_pull(spark: SparkSession, d: str) -> DataFrame:
    return sync.transfers(_files(_listing(spark, d, 4)), _files(_listing(spark, d, 7)))


@query("""SELECT run_id, count(*) AS n_shards, CAST(sum(record_count) AS BIGINT) AS record_count, CAST(sum(content_length) AS BIGINT) AS content_length, min(updated_date) AS first_date, max(updated_date) AS last_date, count(DISTINCT updated_date) AS n_dates FROM manifest_entries GROUP BY run_id""")
def manifest_summary(spark: SparkSession, d: str) -> DataFrame:
    return manifest.summary(table(spark, d, "manifest_entries"), "run_id")


@query("""SELECT count(*) FILTER (ok) AS completed, count(*) FILTER (NOT ok) AS failed, CAST(coalesce(sum(rows) FILTER (ok), 0) AS BIGINT) AS rows_written, CAST(sum(rows) AS BIGINT) AS scanned,
array_to_string(list(shard_idx ORDER BY shard_idx) FILTER (NOT ok), ',') AS failed_shards FROM (SELECT r.run_id AS shard_idx, coalesce(any_value(run_state) = 'success', FALSE) AS ok, count(p.run_id) AS rows FROM run_log r LEFT JOIN processed_works p ON p.run_id = r.run_id GROUP BY r.run_id)""")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    written = table(spark, d, "processed_works").groupBy("run_id").agg(F.count(F.lit(1)).alias("rows"))
    runs = table(spark, d, "run_log").join(written, "run_id", "left").select(F.col("run_id").alias("shard_idx"), F.coalesce(F.col("run_state") == "success", F.lit(False)).alias("ok"), F.coalesce("rows", F.lit(0)).alias("rows"))
    return manifest.run_summary(runs.withColumn("scanned", F.col("rows"))).withColumn("failed_shards", F.array_join("failed_shards", ","))


@query("SELECT url, shard_idx FROM manifest_entries WHERE run_id = 7 ORDER BY shard_idx, url LIMIT 10")
def limit_topn(spark: SparkSession, d: str) -> DataFrame:
    """The first shards of a listing, in its order: the limit is the feature."""
    shards = table(spark, d, "manifest_entries").where("run_id = 7")
    return filters.pending(shards, shards.limit(0), most=10).select("url", "shard_idx")


@query("SELECT DISTINCT work_id FROM works WHERE work_id IS NOT NULL AND work_id NOT IN (SELECT work_id FROM processed_works WHERE work_id IS NOT NULL)")
def set_except(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "works").select("work_id").where(F.col("work_id").isNotNull()).distinct().join(table(spark, d, "processed_works").select("work_id"), "work_id", "left_anti")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST(o_totalprice AS INTEGER) AS price, CAST(o_custkey AS DOUBLE) AS cust FROM (SELECT o_orderkey, trunc(o_totalprice) AS o_totalprice, o_custkey FROM orders)")
def coerce_schema(spark: SparkSession, d: str) -> DataFrame:
    """Columns by position to the types of another table's schema."""
    given = table(spark, d, "orders").select("o_orderkey", F.expr("cast(o_totalprice as bigint)").alias("o_totalprice"), "o_custkey")
    return records.coerce(given, spark.createDataFrame([], "key string, price int, cust double").schema)


_NUMBERS = "CASE p_partkey % 5 WHEN 0 THEN CAST(p_partkey AS VARCHAR(30)) WHEN 1 THEN CAST(p_partkey * 100000007 AS VARCHAR(30)) WHEN 2 THEN CAST(p_partkey AS VARCHAR(30)) || '.75' WHEN 3 THEN '\"' || CAST(p_partkey AS VARCHAR(30)) || '\"' ELSE 'null' END"


@query("""SELECT p_partkey, CAST(CASE p_partkey % 5 WHEN 0 THEN p_partkey WHEN 1 THEN ((p_partkey * 100000007 + 2147483648) % 4294967296) - 2147483648 WHEN 2 THEN p_partkey END AS INTEGER) AS number FROM part""")
def number_as_i32(spark: SparkSession, d: str) -> DataFrame:
    given = table(spark, d, "part").select("p_partkey", F.expr(_NUMBERS).alias("j"))
    return given.select("p_partkey", text.number_as_int(F.parse_json("j")).alias("number"))


# ---- vectors ----


@query("""SELECT DISTINCT w.work_id, CASE WHEN v.work_id IS NULL THEN 'encode' ELSE 'carried' END AS fate FROM works w LEFT JOIN (SELECT DISTINCT work_id, content_hash FROM work_vectors WHERE work_id IS NOT NULL AND content_hash IS NOT NULL) v
ON v.work_id = w.work_id AND v.content_hash = w.content_hash AND w.content_hash <> '' WHERE w.work_id IS NOT NULL AND (coalesce(trim(w.title), '') <> '' OR coalesce(trim(w.abstract_text), '') <> '')""")
def incremental_embed_split(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "works").where(F.col("work_id").isNotNull()).select("work_id", text.embed_text(F.col("title"), F.col("abstract_text")).alias("text"), "content_hash")
    carried, fresh = vectors.split_carried(w, vectors.existing_vectors(table(spark, d, "work_vectors")))
    return carried.select("work_id", F.lit("carried").alias("fate")).unionByName(fresh.select("work_id", F.lit("encode").alias("fate"))).distinct()


@query("SELECT label, count(*) AS n, round(sum(CAST(embedding[1] AS DOUBLE)), 4) + 0.0 AS first_sum FROM embeddings GROUP BY label")
def embed_union(spark: SparkSession, d: str) -> DataFrame:
    """Two branches of vectors in one output again."""
    e = table(spark, d, "embeddings")
    whole = e.where("vec_id % 3 = 0").unionByName(e.where("vec_id % 3 <> 0"))
    return whole.groupBy("label").agg(F.count(F.lit(1)).alias("n"), (F.round(F.sum(F.col("embedding")[0].cast("double")), 4) + 0.0).alias("first_sum"))


@query("SELECT label, CAST(i AS INTEGER) AS dim, round(avg(x), 4) + 0.0 AS pooled FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings) GROUP BY label, i")
def mean_pool(spark: SparkSession, d: str) -> DataFrame:
    pooled = vectors.mean_pool(table(spark, d, "embeddings"), "label", "embedding")
    return pooled.select("label", F.posexplode("pooled").alias("dim", "x")).select("label", "dim", (F.round("x", 4) + 0.0).alias("pooled"))


@query("SELECT label, arg_min(embedding, vec_id)[1] AS first_value FROM embeddings GROUP BY label")
def cls_pool(spark: SparkSession, d: str) -> DataFrame:
    return vectors.first_pool(table(spark, d, "embeddings"), "label", "embedding", "vec_id").select("label", F.col("pooled")[0].alias("first_value"))


@query("SELECT label, (arg_max(embedding, vec_id) FILTER (vec_id % 2 = 0))[1] AS first_value FROM embeddings GROUP BY label")
def last_token_pool(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings").withColumn("mask", (F.col("vec_id") % 2 == 0).cast("int"))
    return vectors.last_pool(rows, "label", "embedding", "vec_id", "mask").select("label", F.col("pooled")[0].alias("first_value"))


@query("SELECT vec_id, round(CAST(embedding[1] AS DOUBLE) / greatest(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 1e-9), 4) + 0.0 AS first_value FROM embeddings")
def l2_normalise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", (F.round(vectors.l2_normalise(F.col("embedding"))[0].cast("double"), 4) + 0.0).alias("first_value"))


@query("SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files FROM work_authorships")
def row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows and files of a table, from its footers; the test tables have one file each."""
    return footer_counts(table(spark, d, "work_authorships"))
