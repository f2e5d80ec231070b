"""Encoding of whole texts with a public byte-level BPE vocabulary.

A text is cut into pre-tokens by the vocabulary's pattern and each pre-token is merged by rank. Two exact cuts keep
long texts from being one sequential piece of work:

* between a non-blank and a blank a pre-token always ends, so a text with blanks falls into segments that are encoded
  independently and joined as they are;
* a pre-token that is longer than PIECE bytes is encoded by tree concatenation: both halves are encoded, then a window
  around their join is encoded again and grown until its first token is the left half's and its last token the right
  half's. Every pair of neighbours is then one that the encoding itself produces, so the result equals the encoding of
  the whole.

Halves and segments of long texts are encoded by threads of the task; the encoder releases the interpreter.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Folder of the public vocabularies; a parameter of every function.
VOCABULARIES = "/opt/tokenizers"
#: Fixed value: the pattern of the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of a pre-token from which tree concatenation sets in, characters of a text from which it is cut into segments, threads of a task.
PIECE, LONG, THREADS = 4_096, 65_536, 2
_BREAK = regex.compile(r"(?<=\S)(?=\s)")
_UNSPLIT = regex.compile(r"\S{%d}|\s{%d}" % (PIECE // 4, PIECE // 4))
_SPLIT = regex.compile(PATTERN)


class Encoder:
    """A byte-level vocabulary of ranks."""

    def __init__(self, path: str, piece: int = PIECE) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        self._plain = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._merge = self._plain._core_bpe.encode_single_piece
        self._bytes = {rank: token for token, rank in ranks.items()}
        self.piece = max(2, piece)

    def _join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both, from their encodings."""
        size = 4
        while True:
            i, j = min(size, len(left)), min(size, len(right))
            window = self._merge(b"".join(self._bytes[t] for t in (*left[len(left) - i :], *right[:j])))
            whole_left, whole_right = i == len(left), j == len(right)
            if (whole_left or window[0] == left[-i]) and (whole_right or window[-1] == right[j - 1]):
                return [*left[: len(left) - i], *window, *right[j:]]
            size *= 2

    def merge_bytes(self, data: bytes, pool: ThreadPoolExecutor | None = None) -> list[int]:
        """The tokens of one pre-token, by tree concatenation where it is long."""
        if len(data) <= self.piece:
            return self._merge(data)
        parts = [data[i : i + self.piece] for i in range(0, len(data), self.piece)]
        level = list(pool.map(self._merge, parts) if pool else map(self._merge, parts))
        while len(level) > 1:
            pairs = [(level[i], level[i + 1]) for i in range(0, len(level) - 1, 2)]
            joined = list(pool.map(lambda p: self._join(*p), pairs) if pool else (self._join(*p) for p in pairs))
            level = joined + level[len(level) - len(level) % 2 :]
        return level[0]

    def _segment(self, text: str) -> list[int]:
        if not _UNSPLIT.search(text):
            return self._plain.encode_ordinary(text)
        found: list[int] = []
        for m in _SPLIT.finditer(text):
            found += self.merge_bytes(m.group().encode())
        return found

    def encode(self, text: str | None, pool: ThreadPoolExecutor | None = None) -> list[int]:
        """The ids of a text without special tokens, whose strings count as plain text; none for null and empty texts."""
        if not text:
            return []
        if len(text) <= LONG:
            return self._segment(text)
        segments, at = [], 0
        while at < len(text):
            m = _BREAK.search(text, at + LONG) if at + LONG < len(text) else None
            end = m.start() if m else len(text)
            segments.append(text[at:end])
            at = end
        if len(segments) > 1:
            return [t for part in (pool.map(self._segment, segments) if pool else map(self._segment, segments)) for t in part]
        found: list[int] = []
        for m in _SPLIT.finditer(text):
            found += self.merge_bytes(m.group().encode(), pool)
        return found


@cache
def encoder(vocabulary: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> Encoder:
    """The encoder of a vocabulary file, loaded once in each Python worker."""
    return Encoder(os.path.join(folder, f"{vocabulary}.tiktoken"))


def _encoded(texts: DataFrame, text: str, outcome: str, vocabulary: str, folder: str) -> DataFrame:
    kept = [c for c in texts.columns if c != outcome]
    ids = outcome == "ids"
    schema = texts.select(*kept).schema.add(outcome, T.ArrayType(T.IntegerType()) if ids else T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary, folder)
        with ThreadPoolExecutor(THREADS) as pool:
            for batch in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
                column = batch.column(batch.schema.get_field_index(text))
                found = (np.array(e.encode(t.as_py(), pool), np.int32) for t in column)
                values = pa.array(list(found), pa.list_(pa.int32())) if ids else pa.array([len(x) for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept))] + [values], names=[*kept, outcome])

    return texts.select(*kept).mapInArrow(run, schema)


def encode_texts(texts: DataFrame, text: str = "text", vocabulary: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """`texts` with `ids`, the token ids of its text column; a column of that name is replaced. Null texts give an empty list."""
    return _encoded(texts, text, "ids", vocabulary, folder)


def count_tokens(texts: DataFrame, text: str = "text", vocabulary: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """`texts` with `n_tokens`, the number of ids of its text column; null and empty texts have none."""
    return _encoded(texts, text, "n_tokens", vocabulary, folder)
