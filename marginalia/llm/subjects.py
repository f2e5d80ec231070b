"""Subject areas of documents: one-versus-rest linear classifiers on hashed word n-grams.

Weak labels come from catalogued works: the address path of a work's field (or the field's name) says which subject
its title and abstract treat. Every sentence of them is one training row of hashed words and word pairs; a logistic
regression per subject learns to tell its sentences from the rest, and sentences that stand with all subjects, such as
thanks or passing mentions, end up below zero for each.

A document's sentences are scored; a subject's share is the part of the scored sentences above the threshold in which
it comes first. The thresholds (score, least share, least share of a single sentence) are calibrated on documents that
readers labelled, for the highest F1; some labels may be wrong.

The classifier is fitted on at most WORKS works and calibrated on at most LABELLED documents, both by hash; scoring
covers every document and its whole text, in Arrow batches with the weights (a fixed size) broadcast.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.names import fold_accents
from marginalia.sources.tables import bounded_sample

#: Bounds of the fitted samples, hashed features, passes of the fit.
WORKS, LABELLED, FEATURES, PASSES = 8_000, 20_000, 1 << 17, 25
#: Thresholds tried: score of a sentence, share of a subject, share of a subject that one sentence speaks for.
SCORES, SHARES, SINGLES = (-0.5, 0.0, 0.5), (0.1, 0.15, 0.2, 0.25, 0.3), (0.3, 0.34, 0.4, 0.5)
DEFAULT = (0.0, 0.2, 0.34)
_ENDS = re.compile(r"(?<=[.!?;:])\s+|\n+")
_WORD = re.compile(r"[^\W\d_]+")
_MARKS = re.compile("[̀-ͯ]+")


@lru_cache(200_000)
def _hash(word: str) -> int:
    return zlib.crc32(word.encode())


def sentence_features(text: str) -> list[np.ndarray]:
    """Hashed words and word pairs of every sentence of at least two words."""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", fold_accents(text)))
    found = []
    for sentence in _ENDS.split(text.lower()):
        words = np.array([_hash(w) for w in _WORD.findall(sentence)], np.int64)
        if len(words) > 1:
            found.append(np.concatenate([words, words[:-1] * 31 + words[1:] * 17 + 7]) % FEATURES)
    return found


def _scores(sentences: list[np.ndarray], weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    if not sentences:
        return np.zeros((0, len(bias)), np.float32)
    lengths = np.array([len(s) for s in sentences])
    sums = np.add.reduceat(weights[np.concatenate(sentences)], np.r_[0, np.cumsum(lengths)[:-1]], axis=0)
    return sums / np.sqrt(lengths)[:, None] + bias


def fit(texts: list[str], labels: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (FEATURES x n) and bias of one logistic regression per subject, each sentence of a text labelled alike."""
    weights, bias = np.zeros((FEATURES, n), np.float32), np.full(n, -2.0, np.float32)
    rows, truth = [], []
    for text, label in zip(texts, labels, strict=True):
        own = sentence_features(text)
        rows += own
        truth += [label] * len(own)
    if not rows:
        return weights, bias
    lengths = np.array([len(r) for r in rows])
    starts, row = np.r_[0, np.cumsum(lengths)[:-1]], np.repeat(np.arange(len(rows)), lengths)
    used, at = np.unique(np.concatenate(rows), return_inverse=True)
    value = (1 / np.sqrt(lengths)).astype(np.float32)[row]
    w, squares = np.zeros((len(used), n), np.float32), np.full((len(used), n), 1e-6, np.float32)
    target = np.zeros((len(rows), n), np.float32)
    target[np.arange(len(rows)), truth] = 1
    for _ in range(PASSES):
        z = np.stack([np.add.reduceat(w[at, k] * value, starts) for k in range(n)], axis=1) + bias
        error = 1 / (1 + np.exp(-z)) - target
        for k in range(n):
            slope = np.bincount(at, error[row, k] * value, len(used)) + 1e-3 * w[:, k]
            squares[:, k] += slope * slope
            w[:, k] -= slope / np.sqrt(squares[:, k])
        bias -= 0.5 * error.mean(0)
    weights[used] = w
    return weights, bias


def decide(scores: np.ndarray, thresholds: tuple[float, float, float]) -> set[int]:
    """The subjects of a document from the scores of its sentences."""
    score, share, single = thresholds
    if not len(scores):
        return set()
    counts = np.bincount(scores.argmax(1)[scores.max(1) > score], minlength=scores.shape[1])
    total = counts.sum()
    return {int(k) for k in np.flatnonzero(counts) if counts[k] >= share * total and (counts[k] > 1 or counts[k] >= single * total)}


def calibrate(labelled: list[tuple[np.ndarray, set[int]]]) -> tuple[float, float, float]:
    """The thresholds of the highest F1 over labelled documents; the first of equal ones, a default without labels."""
    best, found = -1.0, DEFAULT
    if not labelled:
        return found
    for thresholds in ((a, b, c) for a in SCORES for b in SHARES for c in SINGLES):
        hit = said = there = 0
        for scores, truth in labelled:
            guess = decide(scores, thresholds)
            hit, said, there = hit + len(guess & truth), said + len(guess), there + len(truth)
        f1 = 2 * hit / max(1, said + there)
        if f1 > best:
            best, found = f1, thresholds
    return found


def subjects_of(documents: DataFrame, areas: DataFrame, labels: DataFrame, works: DataFrame) -> DataFrame:
    """(doc_id, subject_id): one row for each subject that a document is about.

    `documents`: doc_id, text; `areas`: subject_id, subject_name, a short list; `labels`: doc_id, subject_id; `works`:
    work_id, text, field_id (an address) and field_name. Null, empty and blank texts, texts without words and texts
    that no subject claims have no row; repeated documents give repeated rows. Without works of known field there is
    nothing to learn from and no row.
    """
    spark = documents.sparkSession
    names = {r["subject_name"].strip().lower(): int(r["subject_id"]) for r in areas.where(F.col("subject_id").isNotNull() & F.col("subject_name").isNotNull()).select("subject_id", "subject_name").distinct().collect()}  # the list of areas, a few rows
    ids = sorted(set(names.values()))
    place = {s: i for i, s in enumerate(ids)}
    known = works.where(F.length("text") > 2).select("work_id", "text", F.regexp_extract("field_id", r"([^/]+/[^/]+)/*$", 1).alias("path"), F.lower(F.trim("field_name")).alias("name"))
    taken = bounded_sample(known.where((F.col("name") != "") | (F.col("path") != "")), WORKS, "work_id", "text").toArrow().to_pylist()
    # the address path of a field stands for the name it carries most often
    votes: dict[str, dict[str, int]] = {}
    for r in taken:
        if r["path"] and r["name"] in names:
            votes.setdefault(r["path"], {})[r["name"]] = votes.get(r["path"], {}).get(r["name"], 0) + 1
    by_path = {p: max(sorted(v), key=v.get) for p, v in votes.items()}
    named = [(r["text"], by_path.get(r["path"] or "", r["name"])) for r in taken]
    weak = [(t, place[names[n]]) for t, n in named if n in names]
    schema = "doc_id long, subject_id int"
    if not weak:
        return spark.createDataFrame([], schema)
    weights, bias = fit([t for t, _ in weak], [k for _, k in weak], len(ids))
    marked = labels.where(F.col("subject_id").isNotNull()).groupBy("doc_id").agg(F.collect_set("subject_id").alias("subjects"))
    read = bounded_sample(marked, LABELLED, "doc_id").join(documents.where(F.length("text") > 0).select("doc_id", "text"), "doc_id").select("text", "subjects").toLocalIterator()
    scored = ((_scores(sentence_features(r["text"]), weights, bias), {place[s] for s in r["subjects"] if s in place}) for r in read)
    thresholds = calibrate(list(scored))
    model = spark.sparkContext.broadcast((weights, bias))  # FEATURES x subjects

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = model.value
        for whole in batches:
            docs, found = [], []
            for doc, text in zip(whole.column(0).to_pylist(), whole.column(1), strict=True):
                for k in sorted(decide(_scores(sentence_features(text.as_py()), w, b), thresholds)):
                    docs.append(doc)
                    found.append(ids[k])
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(found, pa.int32())], names=["doc_id", "subject_id"])

    return documents.where(F.length("text") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
