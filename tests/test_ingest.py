"""Scalar functions, strict parsing, tables, filters, layout, listings, embedding, transfer, settings and the command line."""

import glob
import gzip
import json
import os
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marginalia import schemas
from marginalia.functions import hashing, text
from marginalia.operators import partitions, records, sync, vectors
from marginalia.operators.filters import WorkFilter, pending, since
from marginalia.plans import cli, embed, ingest, layout, transfer
from marginalia.plans import config as settings
from marginalia.plans.state import LayoutState, RunState, append_log
from marginalia.sources import manifest
from marginalia.sources import works as source
from marginalia.streaming.ingest import ingest_new

SITE = text.SITE


def check(spark, make, cases):
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, s string")
    got = {r["i"]: r["got"] for r in rows.select("i", make(F.col("s")).alias("got")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_doi(spark):
    check(spark, text.normalize_doi, [("10.1/AbÄ", "10.1/abÄ"), ("https://doi.org/10.1/X ", "10.1/x"), ("http://dx.doi.org/10.1", "10.1"), ("https://doi.org/", None), ("  ", None), (" 10.2 ", "10.2"), ("HTTPS://doi.org/1", "https://doi.org/1"), (" https://doi.org/1", "https://doi.org/1"), (None, None)])


def test_tags(spark):
    check(spark, text.strip_tags, [("a <b>c</b>", "a c"), ("<br/>x", "x"), ("open <tag", "open "), ("a > b", "a > b"), ("<a\nb>c", "c"), ("", ""), ("&lt;", "&lt;"), (None, None)])


def test_ids_and_numbers(spark):
    check(spark, text.extract_pmid, [(text.PMID_PREFIX + "12/", "12"), (text.PMID_PREFIX, None), ("https://x/1", None), (None, None)])
    check(spark, text.extract_pmcid, [(text.PMCID_PREFIX + "PMC7//", "PMC7"), ("PMC7", None)])
    check(spark, text.strip_site, [(SITE + "W1", "W1"), ("x" + SITE, "x" + SITE), (None, None)])
    check(spark, text.work_number, [("W12", 12), ("W", 0), ("", 0), ("W 5", 0), ("W+5", 5), ("W-5", -5), ("W" + "9" * 20, 0), (None, 0), ("é7", 7)])
    check(spark, lambda c: text.shard_bucket(text.work_number(c), 4), [("W-5", 1), ("W6", 2), ("W-9223372036854775808", 0)])
    check(spark, text.partition_date, [("a/updated_date=2024-01-02/p", "2024-01-02"), ("a/updated_date=2024-01-02", "2024-01-02"), ("updated_date=20240102aa/", None), ("none", None), ("updated_date=x/updated_date=2024-01-02/", None)])


def test_sql_functions(spark):
    text.register(spark)
    r = spark.sql(f"SELECT normalize_doi(' https://doi.org/1/A') a, normalize_doi('http://doi.org/1/A') b, work_number('W9') c, strip_site('{SITE}W1') d, extract_pmid('{text.PMID_PREFIX}5/') e, strip_tags('a<b') f").first()
    assert tuple(r) == ("https://doi.org/1/a", "1/a", 9, "W1", "5", "a")


def test_inverted_index(spark):
    cases = [({"the": [0, 2], "cat": [1]}, "the cat the"), ({"a": [0], "b": [3]}, "a   b"), ({}, ""), ({"a": []}, ""), ({"b": [0], "a": [0]}, "b"), (None, None), ({"x": [2]}, "  x")]
    rows = spark.createDataFrame([(i, m) for i, (m, _) in enumerate(cases)], "i int, m map<string,array<int>>")
    assert {r["i"]: r["t"] for r in rows.select("i", text.decode_inverted_index(F.col("m")).alias("t")).collect()} == {i: w for i, (_, w) in enumerate(cases)}


def test_number_as_int(spark):
    check(spark, lambda c: text.number_as_int(F.parse_json(c)), [("2500", 2500), ("2500.0", 2500), ('"x"', None), ("3000000000", -1294967296), ("1e20", 2147483647), ("-2.9", -2), ("null", None), ("true", None), (None, None)])


def test_blake3_against_jvm(spark):
    assert hashing.blake3([b""]) == ["af1349b9f5f9a1a6a0404dea36dcc9499bcb25c9adc112b7cc9a93cae41f3262"]
    rnd = random.Random(0)
    messages = [bytes(rnd.randrange(256) for _ in range(n)) for n in (0, 1, 63, 64, 65, 1023, 1024, 1025, 2048, 2049, 3072, 3073, 5000, 8192, 9000)]
    jvm = spark.sparkContext._jvm.org.apache.commons.codec.digest.Blake3
    assert hashing.blake3(messages) == [bytes(b % 256 for b in jvm.hash(bytearray(m))).hex() for m in messages]


RICH = {
    "id": SITE + "W42", "doi": "https://doi.org/10.1/ABC", "title": "A <i>rich</i> work", "publication_year": 2020, "type": "article", "language": "en", "fwci": 1.5, "has_fulltext": True, "open_access": {"is_oa": True, "oa_status": "gold"},
    "citation_normalized_percentile": {"value": 0.5, "is_in_top_1_percent": False}, "apc_list": {"value": 2500.0, "currency": "USD"}, "apc_paid": {"value": None}, "ids": {"mag": 123, "pmid": text.PMID_PREFIX + "9"},
    "primary_topic": {"id": SITE + "T1", "score": 1, "domain": {"id": "d", "display_name": "Physical Sciences"}}, "topics": [{"id": SITE + "T2", "display_name": "t", "field": {"id": "f"}}],
    "primary_location": {"is_oa": True, "source": {"id": "s", "issn": None}}, "locations": [{"source": {"issn": []}}, {}], "corresponding_author_ids": [], "related_works": ["r"],
    "authorships": [{"author": {"id": "A1"}, "institutions": [{"id": "I1", "lineage": ["I1", "I0"]}, {"display_name": "two"}], "countries": [], "affiliations": [{"raw_affiliation_string": "x", "institution_ids": [None, "I1"]}]}, {}],
    "keywords": [{"id": "k", "display_name": "<b>K</b>", "score": 0.1}], "mesh": [{"descriptor_ui": "D1"}, {"descriptor_ui": "D1", "descriptor_name": "again"}, {"descriptor_ui": "D1", "qualifier_ui": "Q"}],
    "sustainable_development_goals": [{"id": "g"}], "funders": [{"id": "F"}], "awards": [{"id": "w", "funder": "F9"}], "counts_by_year": [{"year": 2020, "cited_by_count": 1}, {"year": 2021, "cited_by_count": 2}],
    "referenced_works": [SITE + "W1", "W2"], "abstract_inverted_index": {"The": [0], "<p>end</p>": [2]},
}


def parse(spark, *documents, **options):
    lines = spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d), "s3://b/updated_date=2024-05-06/x.gz") for d in documents], "line string, url string")
    return source.with_shards(source.parse_works(lines, **options))


@pytest.mark.parametrize("strict", [False, True])
def test_rich_record(spark, strict):
    tables = records.build_tables(parse(spark, RICH, {}, strict=strict))
    assert {n: t.columns for n, t in tables.items()} == {n: s.fieldNames() for n, s in schemas.TABLES.items()}
    assert {n: t.count() for n, t in tables.items()} == {"works": 2, "works_keys": 2, "citations": 2, "work_authorships": 2, "work_topics": 1, "work_keywords": 1, "work_mesh": 2, "work_locations": 2, "work_funders": 1, "work_awards": 1, "work_sdgs": 1, "work_counts_by_year": 2}
    w = tables["works"].where("work_id = 'W42'").first()
    assert (w["title"], w["abstract_text"], w["doi_norm"], w["apc_list_value"], w["apc_paid_value"], w["has_content_pdf"], w["ids_pmid"]) == ("A rich work", "The  end", "10.1/abc", 2500, None, True, "9")
    assert w["content_hash"] == hashing.blake3([b"A <i>rich</i> work\0The  end"])[0]
    assert w["corresponding_author_ids"] is None and w["related_works"] == ["r"] and w["shard_updated_date"] == "2024-05-06"
    empty = tables["works"].where("work_id is null").first()
    assert empty["content_hash"] == hashing.blake3([b"\0"])[0] and empty["title"] is None
    a = tables["work_authorships"].where("author_id = 'A1'").first()
    assert (a["institution_ids"], a["institution_display_names"], a["institution_lineages"], a["affiliation_institution_ids"], a["countries"]) == (["I1", ""], ["", "two"], [["I1", "I0"], []], [["I1"]], None)
    assert tables["work_keywords"].first()["display_name"] == "K" and tables["work_awards"].first()["funder_id"] == "F9"
    assert {r["descriptor_name"] for r in tables["work_mesh"].collect()} == {None}
    assert {r["referenced_work_id"] for r in tables["citations"].collect()} == {"W1", "W2"}


@pytest.mark.parametrize(
    "line,good",
    [('{"title":5}', False), ('{"topics":null}', False), ('{"topics":[null]}', False), ('{"publication_year":2020.0}', False), ('{"publication_year":3000000000}', False), ('{"fwci":NaN}', False), ('{"id":"a"} x', False), ("[]", False), ('{"is_oa":1,"x":{}}', True),
     ('{"awards":[{"funder":"a","funder_id":"b"}]}', False), ('{"id":"a","id":"b"}', False), ('{"x":1,"x":2}', True), ('{"abstract_inverted_index":{"a":[-1]}}', False), ('{"abstract_inverted_index":null}', True), ('{"ids":{"mag":5}}', True),
     ('{"authorships":[{"affiliations":[{"institution_ids":[null]}]}]}', True), ('{"primary_location":{"source":{"issn":null}}}', True), ('{"referenced_works":["a",null]}', False), ("", False), (None, False)],
)
def test_strict(line, good):
    assert source.is_strict(line) is good


def test_metrics_and_failures(spark):
    bad = parse(spark, RICH, "{broken", "  ", '{"title":5}', strict=True, keep_failures=True)
    r = source.ingest_metrics(bad, WorkFilter(languages=["en"]).condition(F.col("w"))).first()
    assert (r["scanned"], r["written"], r["parse_failures"], r["null_institutions"], r["failure_percent"]) == (3, 1, 2, 1, 66.6667)
    seen, counters = source.observed(bad)
    seen.write.format("noop").mode("overwrite").save()
    assert counters.get == {"scanned": 3, "parse_failures": 2}


@pytest.mark.parametrize(
    "f,kept",
    [(WorkFilter(), 3), (WorkFilter(languages=["en"]), 1), (WorkFilter(languages=["EN"]), 0), (WorkFilter(work_types=["article"]), 1), (WorkFilter(require_abstract=True), 1), (WorkFilter(domains=["Physical Sciences"]), 1), (WorkFilter(topics=["T2"]), 1), (WorkFilter(topics=["T3"]), 1), (WorkFilter(domains=["None"], topics=["T1"]), 1), (WorkFilter(domains=["None"]), 0)],
)
def test_filters(spark, f, kept):
    assert parse(spark, RICH, {"topics": [{"id": SITE + "T3"}]}, {}).where(f.condition(F.col("w"))).count() == kept


def test_filter_merge():
    assert WorkFilter(["a"], require_abstract=True).merged(WorkFilter(["b"], languages=["en"])) == WorkFilter(["b"], languages=["en"], require_abstract=True)


def test_partition_map(spark):
    works = spark.createDataFrame([("W1", 2000, 1), ("W1", 2001, 2), ("W2", None, 1), (None, 1999, 1), ("odd", 1990, 1)], "work_id string, publication_year int, at int")
    mapped = partitions.partition_map(works, [F.col("at")], 4)
    assert {tuple(r) for r in mapped.collect()} == {(1, 2001, 1), (2, 0, 2), (0, 1990, 0)}
    children = spark.createDataFrame([("W1", "a"), ("W1", "b"), ("W9", "c"), (None, "d"), ("", "e")], "work_id string, x string")
    assert {(r["x"], r["pub_year"]) for r in partitions.place_children(children, mapped).collect()} == {("a", 2001), ("b", 2001), ("e", 1990)}
    assert tuple(partitions.unmatched(children, mapped).first()) == (3, 2)
    assert {(r["work_id"], r["pub_year"], r["shard"]) for r in partitions.place_fact(works, 4).collect()} == {("W1", 2000, 1), ("W1", 2001, 1), ("W2", 0, 2), (None, 1999, 0), ("odd", 1990, 0)}


def shards(spark, *rows):
    return spark.createDataFrame([(i, u, n, n, "2024-01-01") for i, u, n in rows], schemas.SHARDS)


def test_manifest(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"entries": [{"url": text.BUCKET + "data/updated_date=2024-01-02/a.gz", "meta": {"content_length": 5, "record_count": 2}}]}))
    r = manifest.read_manifest(spark, str(path)).first()
    assert (r["shard_idx"], r["url"], r["updated_date"]) == (0, text.BUCKET_HTTPS + "data/updated_date=2024-01-02/a.gz", "2024-01-02")
    path.write_text('{"entries":[]}')
    with pytest.raises(ValueError):
        manifest.read_manifest(spark, str(path))
    snapshot = str(tmp_path / "s.json")
    assert manifest.read_snapshot(spark, snapshot) is None
    manifest.save_snapshot(shards(spark, (0, "a", 1), (1, "b", 2)), snapshot, shards(spark, (1, "b", 2)))
    assert [r["url"] for r in manifest.read_snapshot(spark, snapshot).collect()] == ["a"]


def test_manifest_diff(spark):
    old, new = shards(spark, (0, "same", 1), (1, "gone", 1), (2, "other", 1), (3, "lost", 1)), shards(spark, (0, "other", 2), (1, "same", 1), (2, "new", 1), (3, "lost", 1))
    done = spark.createDataFrame([(0,)], "shard_idx int")
    got = {r["url"]: (r["shard_idx"], r["change"]) for r in manifest.plan_changes(old, new, done).collect()}
    assert got == {"same": (0, "unchanged_ok"), "other": (2, "changed"), "new": (4, "changed"), "gone": (1, "removed"), "lost": (3, "unchanged_missing")}
    assert {r["change"] for r in manifest.diff(None, new, done).collect()} == {"changed"}
    assert sorted(r["shard_idx"] for r in manifest.stabilise(new, old.limit(0)).collect()) == [1, 2, 3, 4]
    assert manifest.stabilise(new, None) is new
    assert [r["url"] for r in pending(new, done, most=2).orderBy("shard_idx").collect()] == ["same", "new"]
    assert since(new, "2025").count() == 0


def test_run_summary(spark):
    r = manifest.run_summary(spark.createDataFrame([(2, False, 5, 7), (1, True, 3, 4), (0, False, 0, 0)], "shard_idx int, ok boolean, rows long, scanned long")).first()
    assert tuple(r) == (1, 2, 3, 11, [0, 2])


def test_sync(spark):
    local = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("raw/.state.json", 4)], "relative string, size long")
    remote = spark.createDataFrame([("a", 1), ("b", 9), ("raw/.state.json", 4)], "relative string, size long")
    assert {r["relative"] for r in sync.transfers(local, remote).collect()} == {"b", "c", "raw/.state.json"}
    assert sync.transfers(local, remote, force=True).count() == 4


def test_pooling(spark):
    tokens = spark.createDataFrame([(1, 0, [1.0, 2.0], 1), (1, 1, [3.0, 4.0], 1), (1, 2, [9.0, 9.0], 0), (2, 0, [5.0, 6.0], 0)], "k int, at int, v array<float>, m int")
    pooled = lambda df: {r["k"]: r["pooled"] for r in df.collect()}
    assert pooled(vectors.mean_pool(tokens, "k", "v", "m")) == {1: [2.0, 3.0], 2: [0.0, 0.0]}
    assert pooled(vectors.first_pool(tokens, "k", "v", "at")) == {1: [1.0, 2.0], 2: [5.0, 6.0]}
    assert pooled(vectors.last_pool(tokens, "k", "v", "at", "m")) == {1: [3.0, 4.0], 2: [5.0, 6.0]}
    unit = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>").select(vectors.l2_normalise(F.col("v")).alias("u"))
    assert [[round(x, 6) for x in r["u"]] for r in unit.collect()] == [[0.6, 0.8], [0.0, 0.0]]
    hidden, mask = np.arange(12, dtype=np.float32).reshape(2, 3, 2), np.array([[1, 1, 0], [0, 0, 0]])
    assert embed.pool(hidden, mask, "mean").tolist() == [[1, 2], [0, 0]]
    assert embed.pool(hidden, mask, "last").tolist() == [[2, 3], [6, 7]] and embed.pool(hidden, mask, "cls").tolist() == [[0, 1], [6, 7]]
    ids, m = embed.pad_batch([[1, 2, 3, 99], [1, 99]], 3)
    assert ids.tolist() == [[1, 2, 99], [1, 99, 0]] and m.tolist() == [[1, 1, 1], [1, 1, 0]]


def test_http_embedder():
    calls = []

    def post(url, body):
        calls.append(json.loads(body))
        if len(calls) == 1:
            raise OSError("try again")
        return json.dumps({"data": [{"embedding": [1.0, 2.0]} for _ in calls[-1]["input"]]}).encode()

    e = embed.HttpEmbedder("http://x", "m", 2, post, lambda s: None)
    assert e.encode(["a", "b", "c"], 2).shape == (3, 2) and len(calls) == 3
    e.dim = 3
    with pytest.raises(ValueError):
        e.encode(["a"])


def test_probe_model(tmp_path):
    with pytest.raises(FileNotFoundError):
        embed.probe_model(str(tmp_path))
    (tmp_path / "onnx").mkdir()
    (tmp_path / "onnx/model.onnx").write_bytes(b"")
    (tmp_path / "1_Pooling").mkdir()
    (tmp_path / "1_Pooling/config.json").write_text('{"pooling_mode_lasttoken": true, "pooling_mode_mean_tokens": true}')
    (tmp_path / "config_sentence_transformers.json").write_text('{"prompts": {"a": "first", "b": "second"}}')
    found = embed.probe_model(str(tmp_path))
    assert (found["pooling"], found["prompt"], found["max_length"]) == ("last", "first", None)


def test_incremental_embedding(spark):
    works = spark.createDataFrame([("W1", "t", "a", "h1"), ("W2", " ", None, "h2"), ("W3", "x", None, "h3"), (None, "y", None, "h4"), ("W5", "z", None, "")], "work_id string, title string, abstract_text string, content_hash string")
    old = spark.createDataFrame([("W1", [1.0] * 4, "h1"), ("W3", [1.0] * 4, "stale"), ("W9", [1.0] * 4, "h9"), ("W5", [1.0] * 4, "")], "work_id string, embedding array<float>, content_hash string")
    got = {r["work_id"]: r["embedding"] for r in embed.embed_works(works, old, lambda: embed.HashEmbedder(4)).collect()}
    assert set(got) == {"W1", "W3", "", "W5"} and got["W1"] == [1.0] * 4 and got["W3"] != [1.0] * 4 and got["W5"] != [1.0] * 4
    assert vectors.existing_vectors(old.drop("content_hash")) is None
    assert embed.embed_works(works, None, lambda: embed.HashEmbedder(4), max_rows=2).count() == 2
    assert embed.embed_works(works.limit(0), old, lambda: embed.HashEmbedder(4)).count() == 0


def test_config(tmp_path, monkeypatch):
    path = tmp_path / "c.toml"
    path.write_text('output = "o"\n[hive]\nnum_shards = 2\n[filter]\nlanguages = ["en"]\n[embed]\nmodel = "m"\n')
    c = settings.load(str(path))
    assert (c.output, c.hive.is_enabled(), c.embed.is_enabled(), c.filter.languages) == ("o", True, True, ["en"])
    assert not settings.HiveConfig(clean_raw=True).is_enabled() and not settings.HiveConfig(enable=False, threads=3).is_enabled()
    path.write_text("[hive]\nnope = 1\n")
    with pytest.raises(ValueError):
        settings.load(str(path))
    with pytest.raises(FileNotFoundError):
        settings.load(str(tmp_path / "missing.toml"))
    monkeypatch.chdir(tmp_path)
    assert settings.load() == settings.Config()
    assert settings.setting("zstd_level", None, None) == 3 and settings.setting("zstd_level", 9, 4) == 9
    assert settings.memory_limit("2GB") == 2 << 30 and settings.default_threads() >= 2
    with pytest.raises(ValueError):
        settings.memory_limit("lots")


def test_formats_and_retries():
    assert (text.format_bytes(5 << 30), text.format_bytes(5 << 20), text.format_number(1234567), text.format_elapsed(125), text.format_elapsed(1.25)) == ("5 GB", "5 MB", "1,234,567", "2m05s", "1.2s")
    assert text.redact_url("bad for url (http://secret)") == "bad"
    slept, calls = [], []

    def work():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("net")
        return "done"

    assert ingest.with_retries(work, 3, slept.append) == "done" and slept == [1, 2]
    with pytest.raises(ValueError):
        ingest.with_retries(lambda: (_ for _ in ()).throw(ValueError("no")), 3, slept.append)


def test_states(tmp_path):
    folder = str(tmp_path)
    assert RunState.load(folder) == RunState()
    RunState(completed_shards=[1]).save(folder)
    assert RunState.load(folder).completed_shards == [1]
    (tmp_path / ".hive_state.json").write_text('{"source_manifest_hash": "x"}')
    assert LayoutState.load(folder).completed_tables == []
    (tmp_path / ".state.json").write_text("broken")
    assert RunState.load(folder) == RunState()
    append_log(folder, {"failed": 0})
    assert "timestamp" in json.loads((tmp_path / ".sync_log.jsonl").read_text())


def write_shards(folder, *shards):
    entries = []
    for i, documents in enumerate(shards):
        path = folder / f"updated_date=2024-01-0{i + 1}" / "part.gz"
        path.parent.mkdir(parents=True, exist_ok=True)
        with gzip.open(path, "wt") as f:
            f.write("\n".join(json.dumps(d) for d in documents) + "\n")
        entries.append({"url": f"file://{path}", "meta": {"content_length": path.stat().st_size, "record_count": len(documents)}})
    (folder / "manifest.json").write_text(json.dumps({"entries": entries}))
    return str(folder / "manifest.json")


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.chdir(tmp_path)
    listing = write_shards(tmp_path / "in", [RICH, {"id": SITE + "W7", "publication_year": 1999, "topics": [{"id": "T"}]}], [{"id": SITE + "W8"}])
    out = str(tmp_path / "out")
    assert cli.main(["run", "--manifest", listing, "-o", out, "--dry-run"], spark) == 0
    assert cli.main(["run", "--manifest", listing, "-o", out, "--hive"], spark) == 0
    raw = spark.read.parquet(f"{out}/raw/works")
    assert {r["work_id"] for r in raw.collect()} == {"W42", "W7", "W8"} and raw.count() == 3
    assert ingest.schema_mismatches(spark, f"{out}/raw") == []
    hive = spark.read.parquet(f"{out}/hive/works")
    assert {(r["work_id"], r["pub_year"]) for r in hive.collect()} == {("W42", 2020), ("W7", 1999), ("W8", 0)}
    assert {(r["work_id"], r["pub_year"]) for r in spark.read.parquet(f"{out}/hive/work_topics").collect()} == {("W42", 2020), ("W7", 1999)}
    # nothing to do again; then one shard has changed
    assert layout.build_layout(spark, f"{out}/raw", f"{out}/hive", f"{out}/.manifest.json", num_shards=4) == []
    write_shards(tmp_path / "in", [RICH], [{"id": SITE + "W8"}])
    assert cli.main(["run", "--manifest", listing, "-o", out], spark) == 0
    assert {r["work_id"] for r in spark.read.parquet(f"{out}/raw/works").collect()} == {"W42", "W8"}
    assert cli.main(["embed", "-o", out, "--backend", "hash"], spark) == 0
    assert cli.main(["embed", "-o", out, "--backend", "hash"], spark) == 0
    assert {r["work_id"] for r in spark.read.parquet(f"{out}/embeddings").collect()} == {"W42"}
    assert cli.main(["push", "-o", out, "--store", str(tmp_path / "store"), "--prefix", "p/"], spark) == 0
    again = transfer.sync(spark, out, transfer.FolderStore(str(tmp_path / "store")), "p/")
    assert again.files_failed == 0 and again.files_transferred <= 4 and again.files_skipped > 0
    assert cli.main(["pull", "-o", str(tmp_path / "copy"), "--store", str(tmp_path / "store"), "--prefix", "p"], spark) == 0
    assert spark.read.parquet(f"{tmp_path}/copy/raw/works").count() == 2
    assert cli.main(["status", "--manifest", listing, "-o", out], spark) == 0
    (tmp_path / "out/raw/works/x.tmp").write_text("")
    assert cli.main(["clean", "-o", out]) == 0
    assert "1 temporary" in capsys.readouterr().out


def test_row_groups(spark, tmp_path):
    ingest.writer(spark.range(1000).coalesce(1), 3, 100).parquet(str(tmp_path / "t"))
    path = next(str(p) for p in (tmp_path / "t").glob("*.parquet"))
    assert pq.ParquetFile(path).metadata.num_row_groups == 10 and ingest.valid_footer(path) and not ingest.valid_footer(__file__)


def test_stream(spark, tmp_path):
    folder = tmp_path / "new"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(RICH) + "\n{bad\n")
    args = (spark, str(folder), str(tmp_path / "raw"), str(tmp_path / "cp"))
    ingest_new(*args).awaitTermination()
    (folder / "b.json").write_text(json.dumps({"id": SITE + "W8"}) + "\n")
    ingest_new(*args).awaitTermination()
    ingest_new(*args).awaitTermination()
    assert sorted(r["work_id"] for r in spark.read.parquet(str(tmp_path / "raw" / "works")).collect()) == ["W42", "W8"]
    assert os.path.isdir(tmp_path / "raw" / "citations")


def test_missing_table(spark, tmp_path):
    assert partitions.read_or_empty(spark, str(tmp_path / "none"), schemas.TABLES["citations"]).count() == 0


def test_failures_stay_with_their_shard(spark, tmp_path):
    listing = write_shards(tmp_path / "in", [{"id": SITE + "W1"}], [{"id": SITE + "W2"}], [{"id": SITE + "W3"}])
    shards = manifest.read_manifest(spark, listing)
    bad = json.loads((tmp_path / "in/manifest.json").read_text())["entries"][1]["url"].removeprefix("file://")
    with open(bad, "rb") as f:
        whole = f.read()
    with open(bad, "wb") as f:
        f.write(whole[:20] + b"no gzip" + whole[20:])
    raw, pauses = str(tmp_path / "raw"), []

    def mend(n):
        pauses.append(n)
        if n == 1:
            with open(bad, "wb") as f:
                f.write(whole)

    counters, failed = ingest.ingest_isolated(spark, shards, raw)
    assert failed == [1] and sorted(c["oa_shard_idx"] for c in counters) == [0, 2]
    assert {r["shard_idx"] for r in ingest.completed_shards(spark, raw).collect()} == {0, 2}
    assert {r["work_id"] for r in spark.read.parquet(f"{raw}/works").collect()} == {"W1", "W3"}
    counters, failed = ingest.ingest_isolated(spark, manifest.gather(shards, spark.createDataFrame([(1,)], "shard_idx int")), raw, passes=3, pause=mend)
    assert failed == [] and pauses == [0, 1] and {r["shard_idx"] for r in ingest.completed_shards(spark, raw).collect()} == {0, 1, 2}


def test_broken_writes_are_not_complete(spark, tmp_path, monkeypatch):
    listing = write_shards(tmp_path / "in", [RICH], [{"id": SITE + "W2"}])
    shards, raw = manifest.read_manifest(spark, listing), str(tmp_path / "raw")
    done = lambda: {r["shard_idx"] for r in ingest.completed_shards(spark, raw).collect()}
    ingest.ingest(spark, shards, raw)
    assert done() == {0, 1}
    real = ingest.build_tables

    def broken(*args, **kwargs):  # the run ends between two tables
        tables = real(*args, **kwargs)
        return {"works": tables["works"], "works_keys": tables["works_keys"].select(F.raise_error(F.lit("end")).alias("x"), "*")}

    monkeypatch.setattr(ingest, "build_tables", broken)
    with pytest.raises(Exception):  # noqa: B017
        ingest.ingest(spark, shards.where("shard_idx = 0"), raw)
    assert os.path.isdir(f"{raw}/works/oa_shard_idx=0") and done() == {1}
    monkeypatch.undo()
    ingest.ingest(spark, shards.where("shard_idx = 0"), raw)
    assert done() == {0, 1}
    path = glob.glob(f"{raw}/works/oa_shard_idx=1/*.parquet")[0]
    with open(path, "wb") as f:
        f.write(b"PAR1")
    assert done() == {0}
    os.remove(glob.glob(f"{raw}/citations/oa_shard_idx=0/*.parquet")[0])
    assert done() == set()


def test_coerce_and_summary(spark):
    wanted = spark.createDataFrame([], "a string, b int").schema
    assert [tuple(r) for r in records.coerce(spark.createDataFrame([(1, "2"), (None, "x")], "x int, y string"), wanted).collect()] == [("1", 2), (None, None)]
    with pytest.raises(ValueError):
        records.coerce(spark.createDataFrame([(1,)], "x int"), wanted)
