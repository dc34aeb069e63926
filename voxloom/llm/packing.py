"""Filling fixed-capacity containers with items, balanced by estimated attention cost."""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.clips import current_clips
from voxloom.storage import write_table


#: Longer durations count as this, some 285 000 years, so that microseconds fit int64.
LONGEST_S = 9e12
#: Items that are packed together.
GROUP_ITEMS = 10_000


def attention_cost(size: np.ndarray, linear: float = 1.0, quadratic: float = 1.0) -> np.ndarray:
    """Estimated cost of items by their share of a container: linear plus quadratic for attention within an item."""
    return linear * size + quadratic * size * size


def _fill(order: np.ndarray, sizes: np.ndarray, costs: np.ndarray, capacity: int, bins: int, small: int) -> tuple[np.ndarray, int]:
    """Assign items in descending ``order`` to ``bins`` containers, opening more when none has room.

    Containers wait in a heap by cost.  The cheapest with room gets the item; one without room is put aside until a
    smaller item comes.  Items up to ``small``, the last ones, close gaps instead: each goes where it leaves least
    room, as spreading them by cost would leave every container a little short.
    """
    place = np.empty(len(sizes), np.int64)
    heap = [(0.0, b, 0) for b in range(bins)]
    aside: list[tuple[int, float, int]] = []  # by free room, largest first
    split = int(np.searchsorted(-sizes[order], -small, "left"))
    for i in order[:split].tolist():
        size = int(sizes[i])
        while aside and -aside[0][0] >= size:
            room, cost, b = heapq.heappop(aside)
            heapq.heappush(heap, (cost, b, capacity + room))
        while heap and heap[0][2] + size > capacity:
            cost, b, used = heapq.heappop(heap)
            heapq.heappush(aside, (used - capacity, cost, b))
        cost, b, used = heapq.heappop(heap) if heap else (0.0, bins, 0)
        bins += b == bins
        place[i] = b
        heapq.heappush(heap, (cost + float(costs[i]), b, used + size))
    rooms = sorted([(capacity - used, b) for _, b, used in heap] + [(-room, b) for room, _, b in aside])
    for i in order[split:].tolist():
        size = int(sizes[i])
        at = bisect.bisect_left(rooms, (size, -1))
        room, b = rooms.pop(at) if at < len(rooms) else (capacity, bins)
        bins += b == bins
        place[i] = b
        if room > size:
            bisect.insort(rooms, (room - size, b))
    return place, bins


def pack_sizes(sizes: np.ndarray, capacity: int, tries: int = 6, small: float = 1 / 4) -> tuple[np.ndarray, int]:
    """Container of each item (sizes from 1 to ``capacity``) and the number of containers.

    Starts from the fewest containers that could hold all and keeps the attempt that ends with fewest; starting with
    more of them spreads the large items further.  ``small`` is the share of a container up to which items close gaps.
    """
    if not len(sizes):
        return np.empty(0, np.int64), 0
    order = np.argsort(-sizes, kind="stable")
    costs = attention_cost(sizes / capacity)
    least = -(-int(sizes.sum()) // capacity)
    best: tuple[np.ndarray, int] | None = None
    start = least
    for _ in range(tries):
        place, bins = _fill(order, sizes, costs, capacity, start, int(capacity * small))
        used, place = np.unique(place, return_inverse=True)  # a container that stayed empty isn't opened
        bins = len(used)
        if best is None or bins < best[1]:
            best = place, bins
        if bins <= start:
            break
        start = min(best[1] - 1, max(start + 1, (start + bins) // 2))
    return best


def _pack_groups(capacity: int):
    """Arrow mapper over partitions sorted by group: packs each group's items."""

    def emit(group: int, ids: list, sizes: np.ndarray) -> pa.RecordBatch:
        full, rest = sizes // capacity, sizes % capacity
        full[sizes == capacity], rest[sizes == capacity] = 0, capacity
        packed, filled = np.flatnonzero(rest), np.flatnonzero(full)
        place, bins = pack_sizes(rest[packed], capacity)
        own = bins + np.cumsum(full[filled]) - full[filled]
        row = np.concatenate([packed, filled])
        columns = [pa.array(ids).take(pa.array(row)), np.full(len(row), group), np.concatenate([place, own]), np.concatenate([np.ones(len(packed), np.int64), full[filled]]), np.concatenate([rest[packed], full[filled] * capacity]), full[row] > 0]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "pack_group", "container", "containers", "size", "divided"])

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, sizes = None, [], []
        for batch in batches:
            codes = batch["pack_group"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if codes[a] != group:
                    if ids:
                        yield emit(group, pa.chunked_array(ids).combine_chunks(), np.concatenate(sizes))
                    group, ids, sizes = int(codes[a]), [], []
                ids.append(batch["id"].slice(a, b - a))
                sizes.append(batch["size"].to_numpy()[a:b])
        if ids:
            yield emit(group, pa.chunked_array(ids).combine_chunks(), np.concatenate(sizes))

    return mapper


def pack_items(items: DataFrame, capacity: int, groups: int | None = None) -> DataFrame:
    """Containers for ``items`` (``id`` string, ``size`` whole units above 0, both not null).

    Returns ``(id, pack_group, container, containers, size, divided)``.  An item up to ``capacity`` lies whole in one
    container.  A larger one is divided: a row says which ``containers`` in number, from ``container`` on, it fills
    alone, another where its remainder, if any, is packed like any item.  Repeated ids are packed as they come; an
    empty table gives an empty one.

    Packing one list is sequential, so items are dealt by hash into groups of some ``GROUP_ITEMS``, whose size mix is
    that of the whole: each group packs alone within a fraction of a per cent of its least number of containers, and
    no group grows with the data.  The number of groups follows from the number of items alone, so the same items are
    packed alike on any cluster.
    """
    items = items.select("id", F.col("size").cast("long").alias("size"))
    if groups is None:
        items, _ = write_table(items, "items")
        groups = max(1, -(-items.count() // GROUP_ITEMS))
    dealt = items.withColumn("pack_group", F.pmod(F.xxhash64("id"), F.lit(groups)))
    return dealt.repartition("pack_group").sortWithinPartitions("pack_group", F.desc("size"), "id").mapInArrow(_pack_groups(capacity), "id string, pack_group long, container long, containers long, size long, divided boolean")


def clip_items(metadata: DataFrame) -> DataFrame:
    """Current clips as items in microseconds; null, NaN, infinite and non-positive durations can't be packed."""
    clips = current_clips(metadata, "duration").filter((F.col("duration") > 0) & (F.col("duration") < float("inf")))
    micros = F.ceil(F.round(F.least(F.col("duration"), F.lit(LONGEST_S)) * 1e6, 3))
    return clips.select(F.col("audio_file").alias("id"), F.greatest(F.lit(1), micros).alias("size"))


def pack_clips(metadata: DataFrame, seconds: int = 30) -> DataFrame:
    """``pack_items`` of the current clips into containers of ``seconds``."""
    return pack_items(clip_items(metadata), seconds * 1_000_000)


def oversized_clips(metadata: DataFrame, seconds: int = 30) -> DataFrame:
    """``audio_file`` of the clips that the packing had to divide."""
    return pack_clips(metadata, seconds).filter(F.col("divided")).groupBy(F.col("id").alias("audio_file")).agg(F.count("*").alias("rows")).select("audio_file")


def packing_report(metadata: DataFrame, seconds: int = 30, slack: float = 0.02) -> DataFrame:
    """One row on ``pack_clips``: clips packed, those whose parts don't sum up to them, containers filled beyond their
    capacity, and whether containers are within ``slack`` of the fewest that could hold all (and one more a group).
    """
    capacity = seconds * 1_000_000
    items = clip_items(metadata)
    rows, _ = write_table(pack_items(items, capacity), "packed")
    whole = F.col("divided") & (F.col("size") == F.col("containers") * capacity)
    parts = rows.groupBy("id").agg(F.sum("size").alias("packed"), F.count_if(~whole).alias("pieces"))
    torn = items.join(parts, "id", "left").agg(F.count("*").alias("clips"), F.count_if(F.coalesce((F.col("packed") != F.col("size")) | (F.col("pieces") > 1), F.lit(True))).alias("torn"), F.sum("size").alias("total"))
    held = rows.filter(~whole).groupBy("pack_group", "container").agg(F.sum("size").alias("used")).agg(F.count("*").alias("shared"), F.count_if(F.col("used") > capacity).alias("overfull"))
    alone = rows.agg(F.coalesce(F.sum(F.when(whole, F.col("containers"))), F.lit(0)).alias("alone"), F.count_distinct("pack_group").alias("groups"))
    one = lambda df: df.withColumn("one", F.lit(1))
    least = F.ceil(F.coalesce("total", F.lit(0)) / capacity)
    return one(torn).join(one(held), "one").join(one(alone), "one").select("clips", "torn", "overfull", (F.col("shared") + F.col("alone") <= least * (1 + slack) + F.col("groups")).alias("tight"))
