"""Continuous periods and gaps of overlapping time intervals, by run bitmaps per entity and time shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.columns import pick
from voxloom.functions.labels import label_key
from voxloom.storage import write_table

#: Milliseconds from this on don't fit the arithmetic on 64-bit numbers.
LARGEST_MS = 2**60


def turn_intervals(turns: DataFrame) -> DataFrame:
    """Valid turns as ``(video_id, speaker, start_ms, end_ms)``: both times, a label, and an end after the start in whole ms."""
    ms = lambda c: F.when(F.abs(F.col(c)) < LARGEST_MS / 1000, F.round(F.col(c) * 1000).cast("long"))  # noqa: E731 - false for NaN and infinity
    picked = pick(turns, "video_id", "speaker", "start", "end").select("video_id", label_key(F.col("speaker"), upper=True).alias("speaker"), ms("start").alias("start_ms"), ms("end").alias("end_ms"))
    return picked.filter(F.col("video_id").isNotNull() & F.col("speaker").isNotNull() & (F.col("end_ms") > F.col("start_ms")))


def run_union(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of half-open runs per owner: maximal runs, touching ones joined, ordered by owner and start.

    ``owner`` holds small codes.  Each owner's runs are moved to their own stretch of one number line,
    so that one running maximum serves all owners.
    """
    if not len(owner):
        return owner, start, end
    low = int(start.min())
    span = int(end.max()) - low + 2
    if (int(owner.max()) + 1) * span >= 2**62:  # too wide for one line: owner by owner
        parts = [run_union(np.zeros(m.sum(), np.int64), start[m], end[m]) + (k,) for k in np.unique(owner) for m in [owner == k]]
        return np.concatenate([np.full(len(p[1]), p[3]) for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    base = owner.astype(np.int64) * span - low
    s, e = start + base, end + base
    order = np.argsort(s, kind="stable")
    s, e, who = s[order], np.maximum.accumulate(e[order]), owner[order]
    first = np.ones(len(s), bool)
    first[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(first)
    who, shift = who[at], base[order][at]
    return who, s[at] - shift, e[np.append(at[1:] - 1, len(e) - 1)] - shift


#: Shards that one reducer unites at a time.
BLOCK = 64


def _widths(shard_ms: int, most_pieces: int) -> list[int]:
    """Shard widths by level: an interval longer than ``most_pieces`` shards belongs to the next, coarser level."""
    widths = [shard_ms]
    while widths[-1] * most_pieces < 4 * LARGEST_MS:
        widths.append(widths[-1] * most_pieces)
    return widths


def _codes(table: pa.Table, keys: list[str]) -> tuple[np.ndarray, list[pa.Array]]:
    """One number per row for its keys, and the keys' dictionaries, from which ``_names`` gives the keys back."""
    codes, names = np.zeros(len(table), np.int64), []
    for k in keys:
        column = table[k].combine_chunks().dictionary_encode()
        names.append(column.dictionary)
        codes = codes * max(1, len(column.dictionary)) + column.indices.to_numpy(zero_copy_only=False)
    return codes, names


def _names(codes: np.ndarray, names: list[pa.Array]) -> list[pa.Array]:
    out = []
    for column in reversed(names):
        out.append(column.take(pa.array(codes % max(1, len(column)))))
        codes = codes // max(1, len(column))
    return out[::-1]


def _shard_runs(keys: list[str], widths: list[int], most_pieces: int, hold: int):
    """Arrow mapper: cuts intervals at shard borders and unites each shard's runs before the shuffle."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        start, end = (table[c].to_numpy() for c in ("start_ms", "end_ms"))
        level = np.searchsorted([w * most_pieces for w in widths[:-1]], end - start, "left")
        width = np.array(widths)[level]
        first = start // width
        pieces = (end - 1) // width - first + 1
        row = np.repeat(np.arange(len(start)), pieces)
        shard = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        codes, names = _codes(table, keys)
        entity = codes[row] * len(widths) + level[row]
        order = np.lexsort((shard, entity))
        row, shard, entity = row[order], shard[order], entity[order]
        opens = np.ones(len(row), bool)
        opens[1:] = (entity[1:] != entity[:-1]) | (shard[1:] != shard[:-1])
        wide, base = width[row], shard * width[row]
        # one row per owner: its run bitmap as alternating offsets of set runs from the shard's start
        owner, s, e = run_union(np.cumsum(opens) - 1, np.maximum(start[row] - base, 0), np.minimum(end[row] - base, wide))
        at = np.flatnonzero(opens)
        cuts = np.searchsorted(owner, np.arange(len(at) + 1)).astype(np.int32) * 2
        runs = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.stack([s, e], 1).reshape(-1)))
        where = [pa.array((entity[at] % len(widths)).astype(np.int32)), pa.array(shard[at] // BLOCK), pa.array(shard[at])]
        return pa.RecordBatch.from_arrays([*_names(entity[at] // len(widths), names), *where, runs], names=[*keys, "level", "block", "shard", "runs"])

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= hold:
                yield flush(held)
                held, rows = [], 0
        if rows:
            yield flush(held)

    return mapper


def _unite_blocks(keys: list[str], widths: list[int], hold: int):
    """Arrow mapper over rows sorted by entity, level and block: unites their bitmaps, reads off set and clear runs.

    Runs inside a block are final: a ``period`` each, and a ``gap`` between two.  The first and the last of a block
    are of kind ``edge``, as they may go on in the blocks beside.  A block lies in memory as its united runs.
    """
    group = [*keys, "level", "block"]

    def borders(table: pa.Table) -> np.ndarray:
        opens = np.ones(len(table), bool)
        opens[1:] = False
        for k in group:
            column = table[k].combine_chunks()
            x = column.dictionary_encode().indices.to_numpy(zero_copy_only=False) if pa.types.is_string(column.type) else column.to_numpy()
            opens[1:] |= x[1:] != x[:-1]
        return opens

    def united(table: pa.Table, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lists = table["runs"].combine_chunks()
        flat, each = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy()) // 2
        row = np.repeat(np.arange(len(table)), each)
        base = table["shard"].to_numpy()[row] * np.array(widths)[table["level"].to_numpy()[row]]
        return np.flatnonzero(opens), *run_union((np.cumsum(opens) - 1)[row], flat[0::2] + base, flat[1::2] + base)

    def finished(table: pa.Table) -> pa.RecordBatch:
        at, owner, s, e = united(table, borders(table))
        same = owner[1:] == owner[:-1]
        edge = ~(np.append(False, same) & np.append(same, False))
        clear = np.flatnonzero(same)
        row = at[np.concatenate([owner, owner[clear]])]
        kind = pa.DictionaryArray.from_arrays(pa.array(np.concatenate([np.where(edge, 2, 0), np.ones(len(clear), int)]).astype(np.int32)), pa.array(["period", "gap", "edge"])).cast(pa.string())
        spans = [pa.array(np.concatenate([s, e[clear]])), pa.array(np.concatenate([e, s[clear + 1]]))]
        return pa.RecordBatch.from_arrays([*(table[g].combine_chunks().take(pa.array(row)) for g in group), kind, *spans], names=[*group, "kind", "s", "e"])

    def compact(table: pa.Table) -> pa.Table:
        """One row for the rows of one block, relative to the first one's shard."""
        _, _, s, e = united(table, np.arange(len(table)) == 0)
        first = table.slice(0, 1)
        base = first["shard"][0].as_py() * widths[first["level"][0].as_py()]
        runs = pa.ListArray.from_arrays(pa.array([0, 2 * len(s)], pa.int32()), pa.array(np.stack([s, e], 1).reshape(-1) - base))
        return first.set_column(first.schema.get_field_index("runs"), table.schema.field("runs"), pa.chunked_array([runs.cast(table.schema.field("runs").type)]))

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < hold:
                continue
            table = pa.Table.from_batches([b for b in held if b.num_rows])
            last = int(np.flatnonzero(borders(table))[-1])
            if last:
                yield finished(table.slice(0, last))
            held = compact(table.slice(last)).to_batches()
            rows = 1
        if rows:
            yield finished(pa.Table.from_batches([b for b in held if b.num_rows]))

    return mapper


def _joined_edges(edges: DataFrame, entity: list[str]) -> DataFrame:
    """Periods and gaps from the first and last runs of blocks: at most two small rows a block, ordered per entity."""
    w = Window.partitionBy(*entity).orderBy("s")
    prior, other = F.lag("e").over(w), F.lag("block").over(w) != F.col("block")
    marked = edges.withColumns({"opens": F.when(prior >= F.col("s"), 0).otherwise(1), "from_prior": F.when(other & (prior < F.col("s")), prior)})
    runs = marked.withColumn("island", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*entity, "island").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min("from_prior").alias("from_prior"))
    row = lambda kind, s, e: F.struct(F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"))
    both = F.filter(F.array(row("gap", F.col("from_prior"), F.col("s")), row("period", F.col("s"), F.col("e"))), lambda x: x["s"].isNotNull())
    return runs.select(*entity, F.explode(both).alias("x")).select(*entity, "x.*")


def _over_levels(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Periods and gaps of the entities whose runs lie on several levels."""
    w = Window.partitionBy(*keys).orderBy("s", "e")
    reach = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.filter("kind = 'period'").withColumn("opens", F.when(reach >= F.col("s"), 0).otherwise(1)).withColumn("from_prior", F.when(reach < F.col("s"), reach))
    return _joined_edges(marked.select(*keys, "s", "e", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("block")).groupBy(*keys, "block").agg(F.min("s").alias("s"), F.max("e").alias("e")), keys)


def periods_and_gaps(intervals: DataFrame, keys: list[str], shard_ms: int = 600_000, most_pieces: int = 4096, hold: int = 500_000) -> DataFrame:
    """Maximal covered stretches (``period``) and the clear ones between them (``gap``) per entity.

    ``intervals`` has the string ``keys``, ``start_ms`` and ``end_ms`` (int64, end after start, no nulls; see
    ``turn_intervals``); other columns are ignored.  Overlapping, nested, touching and repeated intervals join.
    An empty table gives an empty one; an entity with one period has no gap.

    Each map task turns its rows into run bitmaps (alternating offsets of set runs) per entity and time shard and
    unites them, so repeated rows of a hot entity shrink before the one shuffle of the bitmaps.  A reducer unites the
    bitmaps of an entity's block of shards and reads off its set runs and clear runs.  Only the first and last run of
    a block go on to be joined across blocks: two small rows a block, bounded by the recording's length and not by its
    rows.  Intervals longer than ``most_pieces`` shards are united on coarser levels of their own; the few entities
    that have any are then united over their levels.
    """
    widths = _widths(shard_ms, most_pieces)
    kinds = ", ".join(f"{k} string" for k in keys)
    block = [*keys, "level", "block"]
    mapped = intervals.select(*keys, "start_ms", "end_ms").mapInArrow(_shard_runs(keys, widths, most_pieces, hold), f"{kinds}, level int, block long, shard long, runs array<long>")
    united = mapped.repartition(*block).sortWithinPartitions(*block).mapInArrow(_unite_blocks(keys, widths, hold), f"{kinds}, level int, block long, kind string, s long, e long")
    runs, _ = write_table(united, "runs")
    entity = [*keys, "level"]
    inner, edges = runs.filter("kind <> 'edge'").select(*entity, "kind", "s", "e"), _joined_edges(runs.filter("kind = 'edge'").select(*block, "s", "e"), entity)
    out = inner.unionByName(edges)
    if not runs.filter("level > 0").isEmpty():
        long = runs.filter("level > 0").select(*keys).distinct()
        out = out.join(long, keys, "left_anti").drop("level").unionByName(_over_levels(out.join(long, keys, "left_semi"), keys))
    return out.select(*keys, "kind", F.col("s").alias("start_ms"), F.col("e").alias("end_ms"))


def speaking_periods(turns: DataFrame, **params: int) -> DataFrame:
    """``periods_and_gaps`` of the valid turns per ``video_id`` and ``speaker``.

    Rows without video, label or usable times, and rows not ending after their start in whole ms, are left out.
    """
    return periods_and_gaps(turn_intervals(turns), ["video_id", "speaker"], **params)


def clock(seconds: Column) -> Column:
    """Seconds as whole milliseconds."""
    return F.round(seconds * 1000).cast("long")
