"""Nested records to flat tables that keep parent-child links.

Each record is parsed in one pass into path-value-ordinal triples: the path names the leaf (`authorships[].id`), the
ordinals give the place in every list on the way, counted from 0, nulls included. Paths are grouped by their last
repeated ancestor and each group is pivoted into one table: (record key, ordinals, one value per leaf). Ordinals are
the parent link: a child row's ordinals start with those of its parent.

The triples of a record never leave the task that parsed it, so the pivot needs no shuffle, however many children a
record has. JSON text is parsed in Python, in Arrow batches: Spark's own parsers accept text after the first value
and drop whole records over a field of another type, and the result needs both the strictness and the tolerance.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "record_key long, place string, ordinals array<int>, leaves map<string,string>"
_ARROW = pa.schema([("record_key", pa.int64()), ("place", pa.string()), ("ordinals", pa.list_(pa.int32())), ("leaves", pa.map_(pa.string(), pa.string()))])
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")
_GAP = re.compile(r"[ \t\n\r]*")


class _Text(str):
    """A number, kept as it was written."""


def _refuse(name: str) -> None:
    raise ValueError(name)


_DECODER = json.JSONDecoder(parse_int=_Text, parse_float=_Text, parse_constant=_refuse)


def _deep(text: str) -> object:
    """The JSON value of `text`, parsed without recursion, for nesting beyond what the decoder takes."""
    top: list = []
    stack: list[tuple[object, str | None]] = [(top, None)]
    at, wants = _GAP.match(text, 0).end(), "value"
    while True:
        holder, name = stack[-1]
        if wants == "value":
            c = text[at : at + 1]
            closed = False
            if c == "{" or c == "[":
                new: object = {} if c == "{" else []
                at = _GAP.match(text, at + 1).end()
                closed = text[at : at + 1] == ("}" if c == "{" else "]")
                at += closed
            elif c == '"':
                new, at = json.decoder.scanstring(text, at + 1, True)
                closed = True
            elif (m := _NUMBER.match(text, at)) is not None:
                new, at, closed = _Text(m.group()), m.end(), True
            else:
                word = next((w for w in ("true", "false", "null") if text.startswith(w, at)), None)
                if word is None:
                    raise ValueError(at)
                new, at, closed = {"true": True, "false": False, "null": None}[word], at + len(word), True
            if isinstance(holder, dict):
                holder[name] = new
            else:
                holder.append(new)
            if closed:
                wants = "next"
            else:
                stack.append((new, None))
                wants = "name" if c == "{" else "value"
        elif wants == "name":
            if text[at : at + 1] != '"':
                raise ValueError(at)
            key, at = json.decoder.scanstring(text, at + 1, True)
            at = _GAP.match(text, at).end()
            if text[at : at + 1] != ":":
                raise ValueError(at)
            at = _GAP.match(text, at + 1).end()
            stack[-1] = (holder, key)
            wants = "value"
        else:
            at = _GAP.match(text, at).end()
            if len(stack) == 1:
                if at != len(text):
                    raise ValueError(at)
                return top[0]
            c = text[at : at + 1]
            if c == ("}" if isinstance(holder, dict) else "]"):
                stack.pop()
                at += 1
            elif c == ",":
                at = _GAP.match(text, at + 1).end()
                wants = "name" if isinstance(holder, dict) else "value"
            else:
                raise ValueError(at)


def parse_object(line: str | None) -> dict | None:
    """The object of a line that, blanks around it aside, is exactly one JSON object; else None.

    NaN and Infinity are no JSON. Of a repeated key the last value counts. Numbers are kept as text.
    """
    text = (line or "").strip()
    if not text.startswith("{") or not text.endswith("}"):
        return None
    try:
        found = _DECODER.decode(text)
    except RecursionError:
        try:
            found = _deep(text)
        except ValueError:
            return None
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def _tree(paths: list[str]) -> dict:
    """Paths as a tree of steps; a step is a field name or [] for the items of a list. A leaf holds (place, leaf name)."""
    root: dict = {}
    for path in paths:
        node = root
        for step in re.findall(r"\[\]|[^.\[\]]+", path):
            node = node.setdefault(step, {})
        place = path[: path.rfind("[]") + 2] if "[]" in path else ""
        node[None] = (place, path[len(place) :].lstrip(".") or "value")
    return root


def triples(value: object, node: dict, ordinals: tuple[int, ...] = ()) -> Iterator[tuple[tuple[str, str], tuple[int, ...], str]]:
    """((place, leaf), ordinals, value) of every scalar of `value` that a path of the tree names, in document order."""
    if None in node and not isinstance(value, (dict, list)) and value is not None:
        yield node[None], ordinals, str(value).lower() if isinstance(value, bool) else str(value)
    if "[]" in node and value is not None:
        for i, item in enumerate(value if isinstance(value, list) else [value]):  # a single item in place of a list
            yield from triples(item, node["[]"], (*ordinals, i))
    if isinstance(value, dict):
        for name, below in node.items():
            if name is not None and name != "[]" and name in value:
                yield from triples(value[name], below, ordinals)


def _clean(text: str) -> str:
    try:
        text.encode()
        return text
    except UnicodeEncodeError:  # a lone surrogate
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def flatten_json(records: DataFrame, key: str, json_column: str, paths: list[str]) -> DataFrame:
    """One row per object or item that holds a value of `paths`: record_key, place, ordinals, leaves (name to value).

    `place` is the repeated ancestor of the path; `ordinals` has one number per [] in it. Lines that are not exactly
    one JSON object, null and blank lines give no row; so do missing and null fields, and objects or lists where a
    scalar is named. A single item in place of a list is a list of one. Repeated lines give repeated rows.
    """
    tree = _tree(paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, ordinals, leaves = [], [], [], []
            for record_key, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = parse_object(line.as_py())
                groups: dict[tuple[str, tuple[int, ...]], dict[str, str]] = {}
                for (place, leaf), at, value in triples(found, tree) if found else ():
                    groups.setdefault((place, at), {})[leaf] = _clean(value)
                for (place, at), values in groups.items():
                    keys.append(record_key)
                    places.append(place)
                    ordinals.append(at)
                    leaves.append(list(values.items()))
                if len(keys) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((keys, places, ordinals, leaves), _ARROW.types, strict=True)], schema=_ARROW)
                    keys, places, ordinals, leaves = [], [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((keys, places, ordinals, leaves), _ARROW.types, strict=True)], schema=_ARROW)

    lines = records.select(F.col(key).cast("long").alias("record_key"), F.col(json_column).cast("string").alias("line"))
    return lines.mapInArrow(run, SCHEMA)


def flat_table(flat: DataFrame, place: str, ordinals: list[str], leaves: dict[str, str]) -> DataFrame:
    """The table of one place of `flatten_json`: record_key, the named ordinals, the named leaves (column to leaf)."""
    chosen = flat.where(F.col("place") == place)
    return chosen.select("record_key", *[F.col("ordinals")[i].alias(n) for i, n in enumerate(ordinals)], *[F.col("leaves")[leaf].alias(n) for n, leaf in leaves.items()])


def flatten_lists(rows: DataFrame, key: Column, lists: Column) -> DataFrame:
    """(record_key, item_idx, sub_idx, value) of a column of lists of lists; null and empty lists give no row, null items keep their place."""
    outer = rows.select(key.cast("long").alias("record_key"), F.posexplode(lists).alias("item_idx", "items"))
    return outer.select("record_key", "item_idx", F.posexplode("items").alias("sub_idx", "value"))
