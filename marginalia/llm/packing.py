"""Filling containers of fixed capacity with items, by linear grouping.

Items larger than the capacity are cut into full pieces and a rest; nothing else is split. Of the remaining items the
large ones are sorted by size and cut into groups of about equal cardinality; each is rounded up to the largest size of
its group, which leaves few sizes. Configurations of these sizes are chosen to fill the capacity as far as possible
(an exact subset-sum over the sizes still to be placed, with the largest one always in), and each is used as often as
its groups last. Actual documents then take the slots of their group, by rank, and small documents go, largest first,
to the container that they fit best, or to new ones.

All decisions are made on histograms: sizes and free spaces are at most the capacity, so the driver sees at most a few
thousand numbers, however many documents there are. Documents and containers only learn their rank within their class
(size, group or free space) and look up the interval of the plan that holds it; no class is gathered in one task.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.sources.tables import cut

#: Groups of large sizes; an item is large from this share of the capacity on; rows aimed at per ranking bucket.
GROUPS, LARGE, BUCKET_ROWS = 512, 1 / 8, 50_000


def group_sizes(histogram: dict[int, int], capacity: int) -> dict[int, int]:
    """Size to rounded size: the largest of its group, for sizes of at least the large share of the capacity."""
    large = sorted((s for s in histogram if s > capacity * LARGE), reverse=True)
    total, groups, seen, head = sum(histogram[s] for s in large), {}, 0, None
    step = max(1, -(-total // GROUPS))
    for s in large:
        if head is None or seen >= step:
            head, seen = s, 0
        groups[s] = head
        seen += histogram[s]
    return groups


def configurations(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(rounded size to number in a container, times used), until every item is placed."""
    left, found = dict(counts), []
    while left:
        sizes = sorted(left, reverse=True)
        first = sizes[0]
        reach, steps = 1 << first, []  # bit n: total n can be made, with one of the largest in it
        for s in sizes:
            for _ in range(min(left[s] - (s == first), (capacity - first) // s)):
                grown = reach | (reach << s) & ((1 << (capacity + 1)) - 1)
                if grown == reach:
                    break
                steps.append((s, reach))
                reach = grown
        at, use = reach.bit_length() - 1, {first: 1}
        for s, before in reversed(steps):
            if not before >> at & 1:
                use[s] = use.get(s, 0) + 1
                at -= s
        times = min(left[s] // n for s, n in use.items())
        found.append((use, times))
        for s, n in use.items():
            left[s] -= n * times
            if not left[s]:
                del left[s]
    return found


def place_small(sizes: dict[int, int], free: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Best fit, largest first: intervals (size, first rank, end rank, class, first container, per container), and new containers.

    `class` is the free space at the start of the containers, or -1 for new ones.
    """
    spaces: dict[int, list[tuple[int, int, int]]] = {r: [(r, 0, n)] for r, n in free.items() if r > 0}
    order, fresh, plan = sorted(spaces), 0, []

    def put(space: int, piece: tuple[int, int, int]) -> None:
        if space <= 0:
            return
        if space not in spaces:
            bisect.insort(order, space)
            spaces[space] = []
        spaces[space].append(piece)

    for s in sorted((s for s, n in sizes.items() if n), reverse=True):
        rank, left = 0, sizes[s]
        while left:
            at = bisect.bisect_left(order, s)
            if at == len(order):
                per = capacity // s
                need = -(-left // per)
                put(capacity, (-1, fresh, fresh + need))
                fresh += need
                continue
            space = order[at]
            kind, low, high = spaces[space].pop()
            if not spaces[space]:
                del spaces[space], order[at]
            per = space // s
            whole = min(high - low, left // per)
            if whole:
                plan.append((s, rank, rank + whole * per, kind, low, per))
                put(space - per * s, (kind, low, low + whole))
                rank, left, low = rank + whole * per, left - whole * per, low + whole
            if left and low < high:  # fewer items than one container takes
                plan.append((s, rank, rank + left, kind, low, left))
                put(space - left * s, (kind, low, low + 1))
                rank, left, low = rank + left, 0, low + 1
            if low < high:
                put(space, (kind, low, high))
    return plan, fresh


def _ranked(rows: DataFrame, keys: list[str], by: list[str], buckets: int) -> DataFrame:
    """`rows` with `rank` from 0 within `keys`; a class is ranked in buckets, so that no task holds it whole."""
    spread = cut(rows.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.lit(buckets))))
    sizes = spread.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = spread.withColumn("_at", F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*by)))
    return inside.join(offsets, [*keys, "_bucket"]).withColumn("rank", F.col("_before") + F.col("_at") - 1).drop("_before", "_at", "_bucket")


def _lookup(intervals: dict) -> dict:
    """Intervals of a plan as arrays by class, for binary search of ranks."""
    return {k: tuple(np.array(x, np.int64) for x in zip(*sorted(v), strict=True)) for k, v in intervals.items()}


def pack(items: DataFrame, containers: DataFrame) -> DataFrame:
    """(container_kind, container_id, doc_id, piece_idx, piece_start, n_tokens): every item in a container of each kind.

    `items`: doc_id long (unique), n_tokens long; `containers`: container_kind, capacity_tokens, a short list. Items of
    no or unknown size need no space: they come out once with a null container. Kinds with a null name or without a
    positive capacity are passed over, repeated kinds count once. container_id is `f<doc>-<piece>` for a container that
    one full piece fills, else `m<number>`. An empty table gives no row.
    """
    spark = items.sparkSession
    kinds = {r["container_kind"]: int(r["capacity_tokens"]) for r in containers.where((F.col("capacity_tokens") > 0) & F.col("container_kind").isNotNull()).groupBy("container_kind").agg(F.min("capacity_tokens").alias("capacity_tokens")).collect()}
    none = "container_kind string, container_id string, doc_id long, piece_idx int, piece_start long, n_tokens long"
    if not kinds:
        return spark.createDataFrame([], none)
    sized = cut(items.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("whole")))
    every = sized.withColumn("k", F.explode(F.array(*[F.struct(F.lit(k).alias("container_kind"), F.lit(c).cast("long").alias("capacity")) for k, c in sorted(kinds.items())])))
    every = every.select("k.container_kind", "k.capacity", "doc_id", "whole", F.floor(F.col("whole") / F.col("k.capacity")).alias("full"), (F.col("whole") % F.col("k.capacity")).alias("size"))
    pieces = every.where(F.col("full") > 0).select("container_kind", "capacity", "doc_id", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("piece_idx", "nth"))
    full = pieces.select("container_kind", F.concat(F.lit("f"), "doc_id", F.lit("-"), "piece_idx").alias("container_id"), "doc_id", "piece_idx", (F.col("nth") * F.col("capacity")).alias("piece_start"), F.col("capacity").alias("n_tokens"))
    empty = every.where(F.col("whole") == 0).select("container_kind", F.lit(None).cast("string").alias("container_id"), "doc_id", F.lit(0).alias("piece_idx"), F.lit(0).cast("long").alias("piece_start"), F.lit(0).cast("long").alias("n_tokens"))
    rest = every.where(F.col("size") > 0).select("container_kind", "doc_id", F.col("full").cast("int").alias("piece_idx"), (F.col("full") * F.col("capacity")).alias("piece_start"), "size")
    # at most the capacity's number of rows for each kind
    histograms: dict[str, dict[int, int]] = {k: {} for k in kinds}
    for r in rest.groupBy("container_kind", "size").agg(F.count(F.lit(1)).alias("n")).collect():
        histograms[r["container_kind"]][r["size"]] = r["n"]
    rounded = {k: group_sizes(h, kinds[k]) for k, h in histograms.items()}
    slots: dict[tuple[str, int], list[tuple]] = {}
    opened: dict[str, int] = {}
    for kind, groups in rounded.items():
        counts: dict[int, int] = {}
        for s, g in groups.items():
            counts[g] = counts.get(g, 0) + histograms[kind][s]
        used: dict[int, int] = dict.fromkeys(counts, 0)
        number = 0
        for use, times in configurations(counts, kinds[kind]):
            for g, per in use.items():
                slots.setdefault((kind, g), []).append((used[g], used[g] + per * times, number, per))
                used[g] += per * times
            number += times
        opened[kind] = number
    most = max([1, *(n for h in histograms.values() for n in h.values())])
    buckets = max(1, -(-most // BUCKET_ROWS))
    classes = spark.sparkContext.broadcast(rounded)

    def classify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            group = [classes.value[k].get(s, 0) for k, s in zip(f["container_kind"], f["size"], strict=True)]
            yield f.assign(rounded=np.array(group, np.int64), cls=np.where(np.array(group) > 0, -np.array(group), f["size"]))

    schema = "container_kind string, doc_id long, piece_idx int, piece_start long, size long"
    ranked = cut(_ranked(rest.mapInPandas(classify, f"{schema}, rounded long, cls long"), ["container_kind", "cls"], ["doc_id"], buckets))
    plan = spark.sparkContext.broadcast(_lookup(slots))

    def substitute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            number = np.zeros(len(f), np.int64)
            for key, at in f.groupby(["container_kind", "rounded"]).indices.items():
                low, _, first, per = plan.value[key]
                r = f["rank"].to_numpy()[at]
                i = np.searchsorted(low, r, "right") - 1
                number[at] = first[i] + (r - low[i]) // per[i]
            yield f.assign(number=number)[["container_kind", "doc_id", "piece_idx", "piece_start", "size", "number"]]

    large = cut(ranked.where("rounded > 0").mapInPandas(substitute, f"{schema}, number long"))
    capacity = F.element_at(F.create_map(*[x for k, c in sorted(kinds.items()) for x in (F.lit(k), F.lit(c).cast("long"))]), F.col("container_kind"))
    spaces = large.groupBy("container_kind", "number").agg(F.sum("size").alias("used")).select("container_kind", "number", (capacity - F.col("used")).alias("space")).where("space > 0")
    boxes = cut(_ranked(spaces, ["container_kind", "space"], ["number"], buckets))
    free: dict[str, dict[int, int]] = {k: {} for k in kinds}
    for r in boxes.groupBy("container_kind", "space").agg(F.count(F.lit(1)).alias("n")).collect():
        free[r["container_kind"]][r["space"]] = r["n"]
    intervals: dict[tuple[str, int], list[tuple]] = {}
    for kind, c in kinds.items():
        small = {s: n for s, n in histograms[kind].items() if s not in rounded[kind]}
        for size, low, high, space, first, per in place_small(small, free[kind], c)[0]:
            intervals.setdefault((kind, size), []).append((low, high, space, first, per))
    fits, base = spark.sparkContext.broadcast(_lookup(intervals)), dict(opened)

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            space, nth = np.zeros(len(f), np.int64), np.zeros(len(f), np.int64)
            for key, at in f.groupby(["container_kind", "size"]).indices.items():
                low, _, where, first, per = fits.value[key]
                r = f["rank"].to_numpy()[at]
                i = np.searchsorted(low, r, "right") - 1
                space[at], nth[at] = where[i], first[i] + (r - low[i]) // per[i]
            fresh = space < 0
            number = np.where(fresh, nth + f["container_kind"].map(base).to_numpy(np.int64), -1)
            yield f.assign(space=space, nth=nth, number=number)[["container_kind", "doc_id", "piece_idx", "piece_start", "size", "space", "nth", "number"]]

    fitted = ranked.where("rounded = 0").mapInPandas(fit, f"{schema}, space long, nth long, number long")
    new = fitted.where("space < 0").drop("space", "nth")
    held = fitted.where("space >= 0").drop("number").join(boxes.withColumnRenamed("rank", "nth"), ["container_kind", "space", "nth"]).select(*large.columns)
    mixed = large.unionByName(new).unionByName(held).select("container_kind", F.concat(F.lit("m"), F.col("number").cast("string")).alias("container_id"), "doc_id", "piece_idx", "piece_start", F.col("size").alias("n_tokens"))
    return full.unionByName(mixed).unionByName(empty)
