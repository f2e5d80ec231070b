"""Incremental embedding of works: vectors of unchanged text are carried over, the rest is encoded in Arrow batches."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import time
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions.text import embed_text
from marginalia.operators.vectors import LEAST, existing_vectors, split_carried
from marginalia.plans.ingest import with_retries, writer

OUTPUT = "work_id string, embedding array<float>, content_hash string"


class Embedder(Protocol):
    """Encodes texts to a matrix of one row each; made once in every Python worker."""

    dim: int

    def encode(self, texts: list[str], batch_size: int) -> np.ndarray: ...


class HashEmbedder:
    """Deterministic vectors of a text's words; stands in for a model in tests and dry runs."""

    def __init__(self, dim: int = 64) -> None:
        self.dim = dim

    def encode(self, texts: list[str], batch_size: int = 64) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for i, text in enumerate(texts):
            for word in text.split():
                digest = hashlib.sha256(word.encode()).digest()
                out[i, digest[0] % self.dim] += 1 - 2 * (digest[1] & 1)
        return normalise(out)


class HttpEmbedder:
    """An embeddings API that takes {model, input} and answers {data: [{embedding}]}."""

    def __init__(self, endpoint: str, model: str, dim: int, post: Callable[[str, bytes], bytes] | None = None, sleep: Callable[[float], None] = time.sleep) -> None:
        self.endpoint, self.model, self.dim = endpoint, model, dim
        self.post, self.sleep = post or self._post, sleep

    @staticmethod
    def _post(url: str, body: bytes) -> bytes:
        request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=60) as answer:
            return answer.read()

    def encode(self, texts: list[str], batch_size: int = 64) -> np.ndarray:
        rows: list[list[float]] = []
        for at in range(0, len(texts), batch_size):
            batch = texts[at : at + batch_size]
            body = json.dumps({"model": self.model, "input": batch}).encode()
            data = json.loads(with_retries(lambda b=body: self.post(self.endpoint, b), 3, self.sleep))["data"]
            if len(data) != len(batch) or any(len(d["embedding"]) != self.dim for d in data):
                raise ValueError(f"expected {len(batch)} vectors of {self.dim}")
            rows += [d["embedding"] for d in data]
        return np.array(rows, np.float32).reshape(-1, self.dim)


def normalise(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), LEAST)


def pool(hidden: np.ndarray, mask: np.ndarray, how: str) -> np.ndarray:
    """batch x tokens x dim to batch x dim: `mean` over the mask, `cls` (first token) or `last` (of a mask padded on the right)."""
    if how == "cls":
        return hidden[:, 0]
    if how == "last":
        return hidden[np.arange(len(hidden)), np.maximum((mask > 0).sum(1) - 1, 0)]
    weight = (mask > 0).astype(np.float32)
    return np.einsum("btd,bt->bd", hidden, weight) / np.maximum(weight.sum(1, keepdims=True), LEAST)


def pad_batch(ids: list[list[int]], most: int, pad: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Token ids cut to the longest allowed, with the final special token kept, and their mask."""
    cut = [x if len(x) <= most else [*x[: most - 1], x[-1]] for x in ids]
    width = max((len(x) for x in cut), default=0)
    out, mask = np.full((len(cut), width), pad, np.int64), np.zeros((len(cut), width), np.int64)
    for i, x in enumerate(cut):
        out[i, : len(x)], mask[i, : len(x)] = x, 1
    return out, mask


def probe_model(folder: str) -> dict:
    """The files and settings of a model folder: model path, pooling (cls, last or mean), longest input, first prompt."""

    def read(name: str) -> dict:
        try:
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                return json.load(f)
        except (OSError, ValueError):
            return {}

    model = next((p for p in (os.path.join(folder, "model.onnx"), os.path.join(folder, "onnx", "model.onnx")) if os.path.exists(p)), None)
    if model is None:
        raise FileNotFoundError(f"no model.onnx in {folder}")
    pooling, prompts = read("1_Pooling/config.json"), read("config_sentence_transformers.json").get("prompts") or {}
    how = "cls" if pooling.get("pooling_mode_cls_token") else "last" if pooling.get("pooling_mode_lasttoken") else "mean"
    return {"model": model, "pooling": how, "max_length": read("config.json").get("max_position_embeddings"), "prompt": next(iter(prompts.values()), None)}


class OnnxEmbedder:
    """A local model: tokenised, run and pooled in the worker."""

    def __init__(self, folder: str, dim: int, pooling: str | None = None, prompt: str | None = None, max_length: int = 512, providers: tuple[str, ...] = ("CPUExecutionProvider",)) -> None:
        import onnxruntime
        from tokenizers import Tokenizer

        found = probe_model(folder)
        self.dim, self.pooling, self.prompt = dim, pooling or found["pooling"], prompt if prompt is not None else found["prompt"] or ""
        self.most = min(max_length, found["max_length"] or max_length)
        self.tokenizer = Tokenizer.from_file(os.path.join(folder, "tokenizer.json"))
        self.session = onnxruntime.InferenceSession(found["model"], providers=list(providers))
        self.inputs = {i.name for i in self.session.get_inputs()}

    def encode(self, texts: list[str], batch_size: int = 64) -> np.ndarray:
        out = [np.zeros((0, self.dim), np.float32)]
        for at in range(0, len(texts), batch_size):
            ids, mask = pad_batch([e.ids for e in self.tokenizer.encode_batch([self.prompt + t for t in texts[at : at + batch_size]])], self.most)
            feed = {"input_ids": ids, "attention_mask": mask, "token_type_ids": np.zeros_like(ids)}
            hidden = self.session.run(None, {k: v for k, v in feed.items() if k in self.inputs})[0]
            out.append(normalise(pool(hidden, mask, self.pooling)))
        return np.concatenate(out)


def encode_rows(rows: DataFrame, make: Callable[[], Embedder], batch_size: int = 64) -> DataFrame:
    """(work_id, embedding, content_hash) of (work_id, text, content_hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embedder = make()
        for b in batches:
            vectors = embedder.encode(b.column(1).to_pylist(), batch_size).astype(np.float32)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]), pa.array(vectors.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), flat, b.column(2)], names=["work_id", "embedding", "content_hash"])

    return rows.select("work_id", "text", "content_hash").mapInArrow(run, OUTPUT)


def embed_works(works: DataFrame, existing: DataFrame | None, make: Callable[[], Embedder], batch_size: int = 64, max_rows: int | None = None) -> DataFrame:
    """Vectors of all works (work_id, title, abstract_text, content_hash) with text; vectors of works that are gone are left out.

    `max_rows` takes the first works with text in order of their id, carried ones included.
    """
    texts = works.select("work_id", embed_text(F.col("title"), F.col("abstract_text")).alias("text"), "content_hash").where(F.col("text") != "")
    if max_rows is not None:
        texts = texts.orderBy("work_id", "content_hash").limit(max_rows)
    known = existing_vectors(existing) if existing is not None else None
    carried, fresh = split_carried(texts, known)
    return encode_rows(fresh, make, batch_size).unionByName(carried.select("work_id", "embedding", "content_hash"))


def run_embed(spark: SparkSession, hive: str, output: str, make: Callable[[], Embedder], force: bool = False, batch_size: int = 64, max_rows: int | None = None) -> None:
    """Stage the vectors of the works under `hive` and put them in place; the old output is the input of the carry-over."""
    works = spark.read.parquet(os.path.join(hive, "works")).select("work_id", "title", "abstract_text", "content_hash")
    staging, old = f"{output}.staging", f"{output}.old"
    if os.path.isdir(old) and not os.path.isdir(output):  # an earlier run ended between its two renames
        os.rename(old, output)
    existing = spark.read.parquet(output) if os.path.isdir(output) and not force else None
    shutil.rmtree(staging, ignore_errors=True)
    writer(embed_works(works, existing, make, batch_size, max_rows), 3, 500_000).mode("overwrite").parquet(staging)
    shutil.rmtree(old, ignore_errors=True)
    if os.path.isdir(output):
        os.rename(output, old)
    os.rename(staging, output)
    shutil.rmtree(old, ignore_errors=True)
