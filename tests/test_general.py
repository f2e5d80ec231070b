"""Dangling references, nested records, skewed keys, changed records: edge cases against brute force."""

import json
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginalia.functions.ids import canonical_id
from marginalia.operators import changes, dangling, flatten, skew


def test_ids(spark):
    cases = {"W7": "W7", " https://corpus.example/w007/": "W7", "http://corpus.example/I12": "I12", "": None, "  ": None, None: None, "thing ": "thing", "W": "W", "w0": "W0", "W99999999999999999999999": "W99999999999999999999999"}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "raw string, want string")
    assert all(r["got"] == r["want"] for r in rows.withColumn("got", canonical_id(F.col("raw"))).collect())


def test_dangling_against_sets(spark):
    rnd = random.Random(3)
    parents = [f"W{n}" for n in rnd.sample(range(200_000), 900)] + ["odd", "I5", "W99999999999999999999999"]
    targets = [f"W{rnd.randrange(200_000)}" for _ in range(2000)] + parents[:500] + ["odd", "other", "I5", "I6", "A5", None, "W99999999999999999999999", "W99999999999999999999998"] + ["W3"] * 400 + ["W200001"] * 700
    refs = spark.createDataFrame([(i, t) for i, t in enumerate(targets)], "row int, target_id string")
    got = dangling.dangling_references(refs, spark.createDataFrame([(p,) for p in parents + parents[:5] + [None]], "parent_id string"))
    assert sorted(r["row"] for r in got.collect()) == [i for i, t in enumerate(targets) if t is not None and t not in set(parents)]


def test_dangling_empty(spark):
    none = spark.createDataFrame([], "parent_id string")
    refs = spark.createDataFrame([("W1", 5, "a", 7), (None, 6, "b", 8)], "target_id string, number int, key string, n_refs int")  # columns named like inner ones
    assert [tuple(r) for r in dangling.dangling_references(refs, none).collect()] == [("W1", 5, "a", 7)]
    assert dangling.dangling_references(refs.limit(0), none).count() == 0


def test_hot_targets(spark, monkeypatch):
    """A target with most rows, dangling or not, next to others; only the hottest two are broadcast."""
    monkeypatch.setattr(dangling, "HOT", 2)
    rows = [("W1", i) for i in range(300)] + [("W2", i) for i in range(200)] + [("W3", 1), ("W4", 1), ("W5", 1), ("W5", 1), (None, 1)]
    references = spark.createDataFrame(rows, "target_id string, n int")
    parents = spark.createDataFrame([("W1",), ("W3",)], "parent_id string")
    got = sorted(tuple(r) for r in dangling.dangling_references(references, parents).collect())
    assert got == sorted(r for r in rows if r[0] in ("W2", "W4", "W5"))


def test_runs_cross_cells(spark):
    keys = spark.createDataFrame([(f"W{n}",) for n in range(dangling.CELL - 3, dangling.CELL + 3)], "parent_id string")
    runs = {(r["run_start"], r["run_end"]) for r in dangling.contiguous_runs(keys).collect()}
    assert runs == {(dangling.CELL - 3, dangling.CELL - 1), (dangling.CELL, dangling.CELL + 2)}


LINES = [
    '{"a":[{"b":[{"id":"x"},null,{"id":""}]},{"b":{"id":"y"}}]}', ' {"a":{"b":[{"id":5}]}} ', '{"a":null}', '{"a":[]}', "", None, "null", "[1]", '{"a":1} {}', '{"a":1}]', '{"a":[{"b":[{"id":NaN}]}]}', '{"a":[{"b":[{"id":"u"}]}],"a":[{"b":[{"id":"v"}]}]}',
    '{"a":[{"b":"text"},3,{"b":[{"id":["z"]}]},{"b":[{"id":true}]}]}', '{"a":[{"b":[{"id":"\\ud800q"}]}],"n":' + "9" * 5000 + "}",
]


def test_flatten_places(spark):
    rows = spark.createDataFrame([(i, x, "k") for i, x in enumerate(LINES)], "id long, line string, place string")
    flat = flatten.flatten_json(rows, "id", "line", ["a[].b[].id"])
    got = {(r["record_key"], tuple(r["ordinals"]), r["leaves"]["id"]) for r in flat.collect()}
    assert got == {(0, (0, 0), "x"), (0, (0, 2), ""), (0, (1, 0), "y"), (1, (0, 0), "5"), (11, (0, 0), "v"), (12, (3, 0), "true"), (13, (0, 0), "�q")}
    table = flatten.flat_table(flat, "a[].b[]", ["a_idx", "b_idx"], {"child": "id"})
    assert table.columns == ["record_key", "a_idx", "b_idx", "child"] and table.count() == len(got)
    assert flatten.flatten_json(rows.limit(0), "id", "line", ["a[].b[].id"]).count() == 0


def test_flatten_deep():
    deep = '{"a":[{"b":[{"id":"x"}]}],"n":' + "[" * 200_000 + "]" * 200_000 + "}"
    assert flatten.parse_object(deep)["a"] == [{"b": [{"id": "x"}]}]
    assert flatten.parse_object(deep[:-1]) is None
    assert flatten.parse_object(deep + "x}") is None


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=4), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=12))
@settings(max_examples=150, deadline=None)
def test_iterative_parser_agrees(value):
    text = json.dumps({"v": value})
    assert flatten._deep(text) == flatten._DECODER.decode(text)


def test_lists(spark):
    rows = spark.createDataFrame([(1, [["a", None], None, [""]]), (2, None), (3, [])], "k long, x array<array<string>>")
    got = {tuple(r) for r in flatten.flatten_lists(rows, F.col("k"), F.col("x")).collect()}
    assert got == {(1, 0, 0, "a"), (1, 0, 1, None), (1, 2, 0, "")}


def test_skew_against_brute_force(spark):
    rnd = random.Random(1)
    rows = [("hot", rnd.randrange(500)) for _ in range(3000)] + [(f"k{i % 7}", rnd.choice([None, 1, 2, 2, 3])) for i in range(500)] + [(None, 4), ("nulls", None)]
    f = skew.value_frequencies(spark.createDataFrame(rows, "k string, v int"), "k", "v").persist()
    by = defaultdict(list)
    for k, v in rows:
        by[k].append(v)
    for r in skew.key_profile(f).collect():
        present = Counter(v for v in by[r["key"]] if v is not None)
        top = min(present, key=lambda v: (-present[v], v)) if present else None
        assert (r["n_rows"], r["n_distinct"], r["mode_value"], r["mode_rows"]) == (len(by[r["key"]]), len(present), top, present.get(top))
    got = {(r["key"], r["fraction"]): r["percentile"] for r in skew.weighted_percentiles(f, [0.0, 0.5, 0.9, 1.0]).collect()}
    for k, vs in by.items():
        s = sorted(v for v in vs if v is not None)
        for q in (0.0, 0.5, 0.9, 1.0):
            assert got.get((k, q)) == (s[max(1, -(-int(q * 1000) * len(s) // 1000)) - 1] if s else None)
    assert {r["key"] for r in skew.hot_keys(skew.key_profile(f), 0.05).collect()} == {"hot"}
    assert skew.weighted_percentiles(f.limit(0), [0.5]).count() == 0


def test_changes(spark):
    records = spark.createDataFrame([("a", "1", "2024-01-02"), ("a", "2", "2024-01-02T10:00:00Z"), ("a", "9", None), ("b", None, "2024-01-01"), ("c", "5", "2024"), (None, "7", "2024-01-01"), ("d", "4", "x"), ("d", "4", "x")], "k string, v string, at string")
    last = changes.current_versions(records.withColumn("t", changes.instant(F.col("at"))), "k", "v", [F.col("t")])
    assert {tuple(r) for r in last.collect()} == {("a", "2"), ("b", None), ("c", "5"), ("d", "4")}
    ledger = spark.createDataFrame([("a", "2"), ("a", "2"), ("b", None), ("c", "4")], "k string, v string")
    assert {r["k"] for r in changes.unprocessed(last, ledger, "k", ["v"]).collect()} == {"b", "c", "d"}
    assert changes.unprocessed(last, ledger.limit(0), "k", ["v"]).count() == 4


@pytest.mark.parametrize("runs,want", [([(1, "success", 1, 3), (2, "failed", 2, 9), (3, "success", 5, 6)], (3, "2024-01-02")), ([(1, "failed", 1, 2)], (None, None)), ([(1, "success", 4, 5), (2, None, 1, None)], (1, "2024-01-01"))])
def test_horizon(spark, runs, want):
    day = lambda d: None if d is None else f"2024-01-{d:02d}"
    log = spark.createDataFrame([(i, s, day(a), day(b)) for i, s, a, b in runs], "run_id int, run_state string, started_at string, finished_at string")
    r = changes.reread_horizon(log).first()
    assert (r["last_good_run"], r["horizon"]) == want
