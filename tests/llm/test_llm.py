"""Operators on texts, names and vectors: brute force, exact round trips, held-out accuracy, edge cases."""

import json
import os
import random
import re
import string

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginalia.llm import markup, names, neighbours, packing, subjects, tokens

DATA = "/root/testdata/sf0.001"
VOCABULARY = os.path.join(tokens.VOCABULARIES, "byte_bpe_50k.tiktoken")


# ---- names ----


@pytest.mark.parametrize(
    "text,want",
    [("Cedric Zeragas", ("zeragas", "cedric", "")), ("Zeragas, C.", ("zeragas", "c", "")), ("Zeragas CB", ("zeragas", "c", "b")), ("Maedae, J.-L.K.", ("maedae", "j", "k")), ("Dr. Victoria de la Zenwo, PhD", ("zenwo", "victoria", "")), ("MEI SKIAGELR", ("skiagelr", "mei", "")),
     ("Xenia  O'Zodor ", ("ozodor", "xenia", "")), ("ZoÃ« Maehis", ("maehis", "zoe", "")), ("Kate M. Kaegel", ("kaegel", "katherine", "m")), ("Wano Tariq", ("wano", "tariq", "")), ("Łucja Bit-Rot", ("bitrot", "lucja", "")), ("  ", None), ("--", None), ("Plato", ("plato", "", ""))],
)
def test_parse_name(text, want):
    assert names.parse_name(text, frozenset({"tariq"})) == want


@given(st.text("abc", min_size=1, max_size=5), st.text("abc", min_size=1, max_size=5))
@settings(max_examples=300, deadline=None)
def test_edited_against_distance(a, b):
    def distance(a, b):
        d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
        for i in range(len(a)):
            for j in range(len(b)):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
                if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a) - 1, len(b) - 1]

    assert names.edited(a, b) == (distance(a, b) <= 1)


def test_one_edit_and_neighbours(spark):
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(4, 6))) for _ in range(60)})
    table = spark.createDataFrame([(w,) for w in words], "word string")
    got = {tuple(r) for r in names.neighbours(table, table, 4).collect()}
    assert got == {(a, b) for a in words for b in words if a != b and names.edited(a, b)}
    assert sorted(tuple(r) for r in names.neighbours_within(table, 4).collect()) == sorted(got)


def records(spark, rows):
    return spark.createDataFrame([(p, s, pl, o) for p, s, pl, o in rows], "person string, spellings array<string>, places array<string>, orcid string")


def test_people(spark):
    rows = [
        ("A1", ["Cedric Zeragas", "C. Zeragas"], ["I1"], None), ("A2", ["Zeragas, Cedric"], ["I1", "I2"], None), ("A3", ["Cedric Zerragas"], ["I2"], None),  # a chain over places, a typo
        ("A4", ["Cedric Zeragas"], ["I9"], None),  # another place: another person
        ("A5", ["Carla Zeragas"], ["I1"], None),  # another given name at the same place
        ("B1", ["Ann B. Lurbron"], ["I3"], None), ("B2", ["Ann C. Lurbron"], ["I3"], None),  # middle initials contradict
        ("C1", ["Mei Tolan"], ["I4"], "o1"), ("C2", ["Mei Tolan"], ["I4"], "o2"), ("C3", ["M T"], ["I5"], "o1"),  # ORCIDs contradict, and join
        ("D1", ["J. Kaptin"], ["I6"], None), ("D2", ["John Kaptin"], ["I6"], None), ("D3", ["Jane Kaptin"], ["I6"], None),  # initials that fit two people
        ("E1", ["Kate Oberlin"], ["I7"], None), ("E2", ["Katherine Oberlin"], ["I7"], None), ("E2", ["Katherine Oberlin", None, ""], None, ""), (None, ["x y"], ["I1"], None), ("F1", None, ["I1"], None), ("F2", ["--"], ["I1"], None),
    ]
    got = {tuple(r) for r in names.entity_pairs(names.resolve_people(records(spark, rows))).collect()}
    assert got == {("A1", "A2"), ("A1", "A3"), ("A2", "A3"), ("C1", "C3"), ("E1", "E2")}
    assert names.resolve_people(records(spark, rows).limit(0)).count() == 0


def test_merged_profiles_match_again(spark):
    # only the union of both spellings and places of A1 and A2 reaches A3
    rows = [("A1", ["Rosa Velmark"], ["I1"], "o"), ("A2", ["Rosa Tornquist"], ["I2"], "o"), ("A3", ["Rosa Velmark"], ["I2"], None)]
    got = {tuple(r) for r in names.entity_pairs(names.resolve_people(records(spark, rows))).collect()}
    assert got == {("A1", "A2"), ("A1", "A3"), ("A2", "A3")}


def test_merged_givens_decide_again(spark):
    # S. fits two given names until these are one person; T. keeps a third candidate that is another person
    rows = [("A1", ["Soren Velmark"], ["I1"], None), ("A2", ["Soeren Velmark"], ["I1"], None), ("A3", ["S. Velmark"], ["I1"], None)]
    rows += [("B1", ["Taren Oberlin"], ["I2"], None), ("B2", ["Tauren Oberlin"], ["I2"], None), ("B3", ["T. Oberlin"], ["I2", "I3"], None), ("B4", ["Tilda Oberlin"], ["I3"], None)]
    got = {tuple(r) for r in names.entity_pairs(names.resolve_people(records(spark, rows))).collect()}
    assert got == {("A1", "A2"), ("A1", "A3"), ("A2", "A3"), ("B1", "B2")}


@pytest.mark.parametrize(
    "rows,pairs",
    [
        ([("A", ["Ann Lurbron"], ["I1"], "o1"), ("B", ["Ann Lurbron"], ["I1"], "o2"), ("X", ["Ann Lurbron"], ["I1"], None)], {("A", "X")}),
        ([("A", ["Ann B. Lurbron"], ["I1"], None), ("B", ["Ann Lurbron"], ["I1"], None), ("C", ["Ann C. Lurbron"], ["I1"], None)], {("A", "B")}),
        ([("A", ["Ann B. Lurbron"], ["I1"], None), ("B", ["Ann Lurbron"], ["I1", "I2"], None), ("C", ["Ann C. Lurbron"], ["I1", "I2"], None)], {("B", "C")}),
    ],
)
def test_contradictions_hold_for_whole_profiles(spark, rows, pairs):
    assert {tuple(r) for r in names.entity_pairs(names.resolve_people(records(spark, rows))).collect()} == pairs


def test_candidates_without_given_name(spark):
    rows = [("A1", ["J. Velmark"], ["I1"], None), ("A2", ["J. Velmark"], ["I1"], None), ("A3", ["John Velmark"], ["I1"], None)]  # all one
    rows += [("B1", ["J. Oberlin"], ["I2"], None), ("B2", ["J. Oberlin"], ["I2"], None), ("B3", ["John Oberlin"], ["I2"], None), ("B4", ["Jane Oberlin"], ["I2"], None)]  # twins that fit two people
    rows += [("C1", ["T. Kaptin"], ["I3", "I4"], None), ("C2", ["T. Kaptin"], ["I3", "I5"], None), ("C3", ["Tilda Kaptin"], ["I4"], None), ("C4", ["Thomas Kaptin"], ["I5"], None)]  # twins with a name each
    got = {tuple(r) for r in names.entity_pairs(names.resolve_people(records(spark, rows))).collect()}
    assert got == {("A1", "A2"), ("A1", "A3"), ("A2", "A3"), ("B1", "B2"), ("C1", "C3"), ("C2", "C4")}


def test_organisations(spark):
    registry = spark.createDataFrame(
        [("I1", "University of Gizia", None, "Gizia", "IN"), ("I2", "Klinikum Gizia", "GIKL", "Gizia", "IN"), ("I3", "Technische Hochschule Glurenx", None, "Glurenx", "CH"), ("I4", "Kredu Centre for Plasma Research", None, "Kredu", "NL"), ("I5", "Universidad de Dezelt", None, "Dezelt", "MX"), ("I6", "Universität Dejelt", None, "Dejelt", "CH"), (None, "University of Nowhere", None, "Nowhere", "US")],
        "institution_id string, display_name string, acronym string, city string, country_code string",
    )
    cases = {
        "Université de Gizia": {"I1"}, "Dept. of Law, UNIVERSITY OF GIZIA (IN)": {"I1"}, "Univeristy of Gizzia": {"I1"}, "Gizia, University, Institut für Software": {"I1"}, "Gizia General Hospital": {"I2"}, "GIKL, Gizia": {"I2"}, "Glurenx Inst. Tech.; University of Gizia": {"I1", "I3"},
        "Kreduer Zentrum für Plasma-Forschung": {"I4"}, "Kredu Centre for Crop Research": set(), "Universidad de Deelt, Mexico": {"I5"}, "Universidad de Deelt": set(), "Gizia Municipal Library": set(), "5 Dezelt Street, University of Gizia": {"I1"}, "": set(), "University of Jellor. mail: a@gizia.example": set(),
    }
    mentions = spark.createDataFrame([(i, t) for i, t in enumerate([*cases, None, *cases])], "mention_id int, text string")
    got: dict[int, set] = {}
    for r in names.link_organisations(mentions, registry).collect():
        got.setdefault(r["mention_id"], set()).add(r["institution_id"])
    assert {t: got.get(i, set()) for i, t in enumerate(cases)} == cases
    assert names.link_organisations(mentions, registry.limit(0)).count() == 0


def test_few_jobs(spark):
    # each job has a plan in the driver's memory
    def jobs(run):
        before = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
        got = {tuple(r) for r in run().collect()}
        return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() - before, got

    registry = spark.createDataFrame([("I1", "University of Gizia", None, "Gizia", "IN"), ("I2", "Klinikum Dezelt", None, "Dezelt", "MX")], "institution_id string, display_name string, acronym string, city string, country_code string")
    # Gizziia is one edit from Gizzia, which the first string teaches
    texts = [(1, "University of Gizzia"), (2, "Gizziia University"), (3, "Hospital, Dezelt"), (4, "Gizzia Law School; Univ. Gizziia"), (5, "Nowhere")]
    n, got = jobs(lambda: names.link_organisations(spark.createDataFrame(texts, "mention_id int, text string"), registry))
    assert got == {(1, "I1"), (2, "I1"), (3, "I2"), (4, "I1")}
    assert n <= 110
    rows = [("A1", ["Rosa Velmark"], ["I1"], "o"), ("A2", ["Rosa Tornquist"], ["I2"], "o"), ("A3", ["Rosa Velmark"], ["I2"], None), ("A4", ["R. Velmark"], ["I2"], None)]
    n, got = jobs(lambda: names.resolve_people(records(spark, rows)))
    assert got == {("A2", "A1"), ("A3", "A1"), ("A4", "A1")}
    assert n <= 140


# ---- markup ----

MARKED = [
    "a <i>b</i>", "x <SUB>2</SUB>", "end br/> here", "tells</sup us", "< br / >", "<jats:p>t</jats:p>", "&amp;lt;i&amp;gt;", "&#946; cell", "&#8211 dash", "amp;#946; x", "\\u003ci\\u003e", "%3Cem%3Ea%3C/em%3E", "$x_{1}^2$", "\\textbf{a}", "10^{-3}", "stayed\\'{e}", "\\[ E = k T \\]", "taking\\,\\mu m", "et~\\% term",
    "**We** thank", "~~old~~", "`code`", "[on](https://a.example/1)", "[on][5] x", "![figure](img/a.png)", "## Head\n\ntext", "Head\n====\n\nx", "- a\n- b\n", "1. a\n2. b", "| a | b |\n|---|---|", "[[Place|x]] y", "[[clinic]]", "{{cite|A|1}}", "''cell'' x", "== H ==\ntext", "{| class\n|}", "<!-- n -->",
]
PLAIN = [
    "p < 0.07, n > 151", "7 < x < 49", "ratio a/b >> 1 in 2", "x <- 6 and a == b", "aged <6 or >211", "C:\\runs\\set8", "*.csv matched 2 of *.csv", "rates * weights", "note * below; 3% ~ 110", "$40 million to $56 million", "Fees of $15 (AT&B)", "max_depth = 3", "[sic] by 5", "[in brief]", "[[5, 0], [0, 350]]", "{{7, 1}, {225}}",
    "C# and item #7 of #sample6", "x~y means", "3' 183\"", "R&D; and Q&A;", "stable [5].", "A * B designs", "– a < b case", "If i < j and k > 5", "(n < 30)", "& beyond", "", None, " ", "5 - 306 units", "a" * 100_000,
]


@pytest.mark.parametrize("text", MARKED)
def test_marked(text):
    assert markup.markup_kinds(text)


@pytest.mark.parametrize("text", PLAIN)
def test_plain(text):
    assert not markup.markup_kinds(text) and markup.clean_text(text) == text


@pytest.mark.parametrize(
    "text,want",
    [("<h2>A</h2><p>b <b>c</b></p><ul><li>d</li><li>e</li></ul>", "## A\n\nb c\n\n- d\n- e"), ("see <pre>x = 1\ny</pre>", "see\n```\nx = 1\ny\n```"), ("E <mml:math><mml:mi>k</mml:mi><mml:mo>=</mml:mo><mml:mn>2</mml:mn></mml:math> x", "E $k=2$ x"), ("\\textbf{a} \\cite{b}c", "a c"), ("[[A|b]] ''c''", "b c"),
     ("**a** [b](https://x.example)", "a b"), ("a &amp;lt;i&amp;gt;b&amp;lt;/i&amp;gt; < 3", "a b < 3"), ("\\begin{align*}u &= v\\end{align*}", "$$u &= v$$"), ("A\n===\n\nb", "# A\n\nb"), ("== H ==\nx", "## H\nx"), ("na\\\"{i}ve", "naïve"), ("p < 3 <i>x</i>", "p < 3 x")],
)
def test_clean(text, want):
    assert markup.clean_text(text) == want


def test_signs_stand_in_all_that_patterns_find(spark):
    # texts for the alternatives of the patterns, without a line break or bracket where they need none
    texts = [*MARKED, "# Introduction", "## Results of X", " #\ta", "jats:p Text", "mml:mi x", "JATS:title A", "a /i> b", "<!DOCTYPE a", "<?xml a", "a ]]> b", "a --> b", "lt; b", "#946; x", "\\x3c", "&beta b", "``a''", "$$a", "$a$", "a][1]", "[1]: http", "[^1]", "<https://a.example>", "__a__", "~~~", "| a |", "> a", "[[a", "{{a|", "|}", "'''a'''", "== a ==", "__TOC__", "[https://a.example b]"]
    assert [t for t in texts if not markup.markup_kinds(t)] == []
    assert [r["t"] for r in spark.createDataFrame([(t,) for t in texts], "t string").where(~F.col("t").rlike(markup.SIGNS)).collect()] == []


@pytest.mark.parametrize(
    "text,want",
    [("if a<b then b>c <i>x</i>", "if a<b then b>c x"), ("use <code>f(x)</code> now", "use `f(x)` now"), ("<pre>\\section{A} [[b|c]]</pre>", "```\n\\section{A} [[b|c]]\n```"), ("`**a**` **b**", "`**a**` b"),
     ("\\textbf{\\emph{\\textit{\\textsc{\\underline{x}}}}}", "x"), ("&amp;amp;amp;amp;amp;amp;lt;i&amp;amp;gt;x", "x"), ("{{" + "a" * 500 + "}} end", "end"), ("a &rArr; b", "a ⇒ b"), ("\ue0001\ue001 <i>x</i>", "\ufffd1\ufffd x"),
     ("<ul><li><a href='x'>Home</a></li></ul><p>A long paragraph of text, the content.</p>", "A long paragraph of text, the content."), ("<p>See <a href='x'>paper</a> now</p>", "See paper now")],
)
def test_nothing_is_lost_or_left(text, want):
    assert markup.markup_kinds(text) and markup.clean_text(text) == want


def test_signs_are_in_every_marked_text():
    rnd, signs = random.Random(3), re.compile(markup.SIGNS)
    for _ in range(4_000):
        text = "".join(rnd.choice(["a", "b ", "1", ". ", ",", "(", ")", "-", "!", "amp", "lt", "jats", "br", "'", '"', "+", "@", "?", "<", "&", "$", "*", "\n", ";", ":", "/", "#", "[", "]"]) for _ in range(rnd.randint(1, 12)))
        found = [name for name, patterns in markup.PATTERNS.items() if any(re.search(p, text) for p in patterns)]
        assert markup.markup_kinds(text) == found and (signs.search(text) or not found)


def test_density_leaves_menus_out():
    menu = "<div>" + "".join(f'<p><a href="/{i}">Link {i}</a></p>' for i in range(30)) + "</div>"
    body = "<div>" + "".join(f"<p>{'A long sentence of the article itself, with many words. ' * 5}</p>" for _ in range(6)) + "</div>"
    clean = markup.clean_text(f"<html><body>{menu}{body}{menu}</body></html>")
    assert "article itself" in clean and "Link 3" not in clean


def test_clean_texts(spark):
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*MARKED, *PLAIN])], "id int, text string, chars string")
    out = {r["id"]: r for r in markup.clean_texts(rows).collect()}
    assert len(out) == len(MARKED) + len(PLAIN) and all(bool(out[i]["markup"]) == (i < len(MARKED)) for i in out)
    assert markup.clean_texts(rows.limit(0)).count() == 0


@given(st.text(max_size=80))
@settings(max_examples=200, deadline=None)
def test_clean_never_fails(text):
    assert isinstance(markup.clean_text(text), str)


def test_deep_and_hostile():
    assert markup.clean_text("<div>" * 5000 + "x" + "</div>" * 5000).strip() == "x"
    for text in ("<" * 50_000, "$" * 50_000, "*" * 50_000, "[[" * 30_000, "{{" * 30_000, "\\" * 50_000, "_" * 50_000, "`" * 50_000, "<a " * 20_000):
        markup.clean_text(text)


# ---- vectors ----


def test_recall(spark, monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((40, 16))
    x = centres[rng.integers(40, size=3000)] + 0.5 * rng.standard_normal((3000, 16))
    x[0], x[1], x[2] = x[3], 0, x[3] * 7
    rows = [(f"v{i:04d}", [float(c) for c in v]) for i, v in enumerate(x)] + [("v0005", [float(c) for c in x[5]]), (None, [1.0] * 16), ("null", None), ("nan", [float("nan")] * 16), ("empty", [])]
    monkeypatch.setattr(neighbours, "CELL_ROWS", 200)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 150)
    monkeypatch.setattr(neighbours, "BATCH", 500)
    table = spark.createDataFrame(rows, "id string, v array<float>")
    got: dict[str, set] = {}
    for r in neighbours.nearest(neighbours.unit_vectors(table, "id", "v"), 5).collect():
        got.setdefault(r["id"], set()).add(r["other"])
    u = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    s[:, 1] = -2
    truth = {f"v{i:04d}": {f"v{j:04d}" for j in np.argsort(-s[i], kind="stable")[:5]} for i in range(3000) if i != 1}
    assert set(got) == set(truth) and all(len(v) == 5 and k not in v for k, v in got.items())
    assert sum(len(got[k] & truth[k]) for k in truth) / (5 * len(truth)) > 0.95


def test_few_vectors(spark):
    table = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [0.0, 1.0])], "id string, vector array<float>")
    assert {(r["id"], r["other"]) for r in neighbours.nearest(neighbours.unit_vectors(table, "id", "vector"), 5).collect()} == {(a, b) for a in "abc" for b in "abc" if a != b}
    assert neighbours.nearest(neighbours.unit_vectors(table.limit(0), "id", "vector"), 5).count() == 0


def test_copies_of_a_vector(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 20)
    rng = np.random.default_rng(4)
    x = rng.integers(-3, 4, size=(60, 8)).astype(float)
    x[np.abs(x).sum(1) == 0] = 1
    x = np.concatenate([x, np.repeat(x[:1], 30, axis=0), np.repeat(x[1:2], 3, axis=0)])
    table = spark.createDataFrame([(f"v{i:02d}", [float(c) for c in v]) for i, v in enumerate(x)], "id string, v array<float>")
    got: dict[str, list] = {}
    for r in neighbours.nearest(neighbours.unit_vectors(table, "id", "v"), 5).collect():
        got.setdefault(r["id"], []).append(r["other"])
    copies = [f"v{i:02d}" for i in [0, *range(60, 90)]]
    assert all(sorted(got[c]) == [d for d in copies if d != c][:5] for c in copies)
    assert all({"v01", "v90", "v91", "v92"} - {c} < set(got[c]) and len(got[c]) == 5 for c in ("v01", "v90", "v92"))
    assert all(len(set(v)) == 5 and k not in v for k, v in got.items())


def test_collisions_against_counting():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((333, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lines, least = neighbours._lines(24), 30
    h, radius = x[:50] @ lines, np.linspace(0.3, 1.6, 50)
    got = set(zip(*(a.tolist() for a in neighbours.Block(x).collisions(h, radius, least)), strict=True))
    apart = np.abs(h[:, None, :] - (x @ lines)[None, :, :])
    half = (neighbours.WIDTH / 2 * radius)[:, None, None]
    sure, far = (apart <= half).sum(2) >= least, (apart <= half + 0.3).sum(2) < least  # windows are rounded outward to marks
    assert {(int(a), int(b)) for a, b in zip(*np.nonzero(sure), strict=True)} <= got
    assert not any(far[a, b] for a, b in got)


# ---- tokens ----


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(tokens.VOCABULARIES, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_encoding(spark, reference):
    rnd = random.Random(1)
    odd = ["<|endoftext|> a", "a" * 100_000, "é" * 30_000 + " x", "   " * 5000 + "z", " ".join(["word"] * 40_000), "".join(rnd.choice("abc de\n1é漢") for _ in range(100_000)), "", " ", "\xa0", "\r\n\t x", "don't 'S", None]
    texts = [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()] + odd
    table = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r["doc_id"]: list(r["ids"]) for r in tokens.encode_texts(table).collect()}
    assert got == {i: reference(t) if t else [] for i, t in enumerate(texts)}
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(table).collect()}
    assert counts == {i: len(x) for i, x in got.items()}


@given(st.text(string.ascii_lowercase[:5] + "éß漢0!", min_size=1, max_size=120))
@settings(max_examples=400, deadline=None)
def test_tree_concatenation(text):
    small = tokens.Encoder(VOCABULARY, piece=3)
    assert small.merge_bytes(text.encode()) == small._merge(text.encode())


# ---- containers ----


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_packing(spark, seed):
    rnd = random.Random(seed)
    sizes = [rnd.choice([0, 1, 5, rnd.randrange(1, 40), rnd.randrange(20, 130), 300]) for _ in range(700)] + [None, 100, 101, 200]
    items = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n_tokens long")
    kinds = spark.createDataFrame([("s", 100), ("l", 1000), ("l", 1000), (None, 5), ("bad", 0)], "container_kind string, capacity_tokens int")
    rows = packing.pack(items, kinds).collect()
    for kind, capacity in (("s", 100), ("l", 1000)):
        own = [r for r in rows if r["container_kind"] == kind]
        fill: dict[str, int] = {}
        pieces: dict[int, list] = {}
        for r in own:
            if r["container_id"] is not None:
                fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["n_tokens"]
            pieces.setdefault(r["doc_id"], []).append((r["piece_start"], r["n_tokens"], r["piece_idx"]))
        assert max(fill.values()) <= capacity and set(pieces) == set(range(len(sizes)))
        for doc, parts in pieces.items():
            parts.sort()
            assert sum(p[1] for p in parts) == (sizes[doc] or 0) and [p[2] for p in parts] == list(range(len(parts))) and all(p[0] == i * capacity for i, p in enumerate(parts))
            assert len(parts) == max(1, -(-(sizes[doc] or 0) // capacity))
        # no worse than best fit decreasing by more than 3 % and one container
        free: list[int] = []
        for s in sorted((p[1] for parts in pieces.values() for p in parts if p[1]), reverse=True):
            fits = [i for i, f in enumerate(free) if f >= s]
            if fits:
                free[min(fits, key=lambda i: free[i])] -= s
            else:
                free.append(capacity - s)
        assert len(fill) <= 1.03 * len(free) + 1
    assert {r["container_kind"] for r in rows} == {"s", "l"}
    assert packing.pack(items.limit(0), kinds).count() == 0 and packing.pack(items, kinds.limit(0)).count() == 0


def test_plans():
    rnd = random.Random(4)
    counts = {s: rnd.randrange(1, 50) for s in rnd.sample(range(10, 100), 20)}
    found = packing.configurations(counts, 100)
    assert all(sum(s * n for s, n in use.items()) <= 100 for use, _ in found)
    assert {s: sum(use.get(s, 0) * t for use, t in found) for s in counts} == counts
    plan, fresh = packing.place_small({3: 10, 7: 4}, {10: 2, 4: 1}, 20)
    assert sum(hi - lo for _, lo, hi, *_ in plan) == 14 and fresh == 2


# ---- subjects ----


def test_subjects_held_out(spark):
    d = DATA.replace("0.001", "0.01")
    read = lambda t: spark.read.parquet(f"{d}/{t}.parquet")
    works = read("works").select("work_id", F.concat_ws(". ", "title", "abstract_text").alias("text"), F.col("primary_topic_field_id").alias("field_id"), F.col("primary_topic_field_display_name").alias("field_name"))
    labels = read("subject_labels")
    seen, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    found = {(r["doc_id"], r["subject_id"]) for r in subjects.subjects_of(read("documents"), read("subject_areas"), seen, works).collect()}
    truth = {(r["doc_id"], r["subject_id"]) for r in held.collect()}
    said = {x for x in found if x[0] in {i for i, _ in truth}}
    assert len(said & truth) / len(truth) > 0.85 and len(said & truth) / len(said) > 0.85
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "  "), (4, "123 ???")], "doc_id long, text string")
    assert subjects.subjects_of(odd, read("subject_areas"), seen.limit(0), works).count() == 0
    assert subjects.subjects_of(read("documents"), read("subject_areas"), seen, works.limit(0)).count() == 0


def test_decide_and_calibrate():
    scores = np.array([[2.0, -1], [1.5, -1], [-1, 0.7], [-2, -2]])
    assert subjects.decide(scores, (0.0, 0.2, 0.5)) == {0} and subjects.decide(scores, (0.0, 0.2, 0.3)) == {0, 1}
    assert subjects.decide(np.zeros((0, 2)), subjects.DEFAULT) == set() and subjects.calibrate([]) == subjects.DEFAULT
    assert subjects.decide(scores, subjects.calibrate([(scores, {0, 1})] * 3)) == {0, 1}


def test_queries_are_registered():
    from marginalia.llm import queries

    assert json.dumps(sorted(queries.QUERIES)) and {"p5_found", "p6_found", "p7_found", "p8_ids", "p9_containers", "p10_found"} <= set(queries.QUERIES)
