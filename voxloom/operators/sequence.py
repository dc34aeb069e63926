"""Sequential operators: folds that depend on what was kept, batching and sharding, seeded splits, references.

Folds run per key on sorted Arrow batches, so a group streams through a task instead of being collected.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.operators.ranking import range_ranked


def fold_sorted(table: DataFrame, keys: list[str], order: list[str], make: Callable[[], Callable[[dict], object]], column: str, kind: str) -> DataFrame:
    """``table`` with ``column`` = the fold's answer for each row in ``order`` within ``keys``.

    ``make`` gives a fresh fold, a function of the row, for each group.  Rows are hash-partitioned by key and sorted;
    state is that of one group at a time.
    """
    arrow = pa.field("x", {"long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32()}[kind])

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: object = object()
        step: Callable[[dict], object] = make()
        for batch in batches:
            answers = []
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if key != last:
                    last, step = key, make()
                answers.append(step(row))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, arrow.type)], names=[*batch.schema.names, column])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    return table.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(mapper, f"{fields}, `{column}` {kind}")


def dedupe_by_time(words: DataFrame, epsilon: float = 0.06) -> DataFrame:
    """Words without repeats at the same time: dropped if the last kept one of the same form is within ``epsilon``.

    Words that normalize to nothing are dropped.  The fold matters: of 0, 0.05 and 0.10 the first and last stay.
    """
    named = words.withColumn("form_", T.normalize(F.col("text"))).filter(F.col("form_") != "")

    def make() -> Callable[[dict], bool]:
        kept = [None]

        def step(row: dict) -> bool:
            if row["start"] is None or kept[0] is not None and abs(row["start"] - kept[0]) <= epsilon:
                return row["start"] is None
            kept[0] = row["start"]
            return True

        return step

    return fold_sorted(named, ["video_id", "form_"], ["start", "end"], make, "keep_", "boolean").filter("keep_").drop("form_", "keep_")


class RollingTrack:
    """Fold over the words of a rolling track: a block of 2 to ``most`` words equal to the end of what is kept goes.

    Of several such blocks the longest goes; single repeated words stay.  ``take`` is fed with forms as they come and
    tells which to keep, as far as ``most`` words lie ahead, or all with ``final``.  The places of each form among the
    last kept ones are known, so only blocks that begin alike are compared.
    """

    def __init__(self, most: int = 40):
        self.most, self.kept, self.ahead, self.places = most, [], [], {}

    def _restated(self, at: int) -> int:
        """Length of the longest block at ``at`` that restates the end of the kept words; 0 without any."""
        end = len(self.kept)
        places = self.places.get(self.ahead[at], ())
        for start in places[bisect.bisect_left(places, end - self.most) :]:  # ascending, so the longest first
            span = end - start
            if span > 1 and self.ahead[at : at + span] == self.kept[start:]:
                return span
        return 0

    def take(self, forms: list[str], final: bool = False) -> list[bool]:
        self.ahead += forms
        told, at = [], 0
        while at < len(self.ahead) and (final or len(self.ahead) - at > self.most):
            if span := self._restated(at):
                told += [False] * span
                at += span
                continue
            form = self.ahead[at]
            self.places.setdefault(form, []).append(len(self.kept))
            self.kept.append(form)
            told.append(True)
            at += 1
        del self.ahead[:at]
        if len(self.kept) > 64 * self.most:  # only the last ones can be restated
            self.kept = self.kept[-self.most :]
            self.places = {}
            for i, form in enumerate(self.kept):
                self.places.setdefault(form, []).append(i)
        return told


def collapse_rolling(forms: list[str], most: int = 40) -> list[bool]:
    """Which words of a rolling track to keep (see ``RollingTrack``)."""
    return RollingTrack(most).take(forms, True)


def dedupe_rolling(words: DataFrame, most: int = 40) -> DataFrame:
    """Word tracks without restated blocks, per video in order of ``pos``.

    The fold needs no more than the last ``most`` kept words, and looks as far ahead; words stream through it.
    """
    named = words.withColumn("form_", T.normalize(F.col("text")))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields)

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        track, video, waiting = RollingTrack(most), None, []

        def told(flags: list[bool]) -> pa.Table:
            """The kept rows among the first that wait; the others go on waiting."""
            nonlocal waiting
            table = pa.Table.from_batches(waiting) if waiting else None
            waiting = table.slice(len(flags)).to_batches()
            return table.slice(0, len(flags)).filter(pa.array(flags, pa.bool_())).drop_columns("form_")

        for batch in batches:
            names = batch["video_id"].to_pylist()
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if names[a] != video:
                    if waiting:
                        yield from told(track.take([], True)).to_batches()
                    track, video, waiting = RollingTrack(most), names[a], []
                waiting.append(batch.slice(a, b - a))
                flags = track.take(batch["form_"].slice(a, b - a).to_pylist())
                if flags:
                    yield from told(flags).to_batches()
        if waiting:
            yield from told(track.take([], True)).to_batches()

    return named.repartition("video_id").sortWithinPartitions("video_id", "pos").mapInArrow(mapper, fields)


def dedupe_track(words: DataFrame, epsilon: float = 0.06, most: int = 40) -> DataFrame:
    """Caption words without repeats, by kind of track.

    ``words`` has ``kind`` and ``word_timed``.  Remarks go first.  Tracks with word times are de-duplicated by time;
    others by rolling blocks, except manual ones (``yt_manual``), which stay.
    """
    spoken = words.withColumn("text", T.strip_annotations(F.col("text"))).filter(F.col("text") != "")
    timed = F.coalesce(F.col("word_timed"), F.lit(False))
    rolling = ~timed & ~F.coalesce(F.col("kind") == "yt_manual", F.lit(False))
    return dedupe_by_time(spoken.filter(timed), epsilon).unionByName(dedupe_rolling(spoken.filter(rolling), most)).unionByName(spoken.filter(~timed & ~rolling))


def _packed(table: DataFrame, keys: list[str], order: list[str], size: str, column: str, cut: Callable[[np.ndarray, tuple], tuple[np.ndarray, tuple]]) -> DataFrame:
    """``table`` with the number of each row's pack from 0 per key, by ``cut`` of a key's sizes.

    ``cut(sizes, state)`` numbers a stretch of one key's rows and gives the state to go on with.  Rows stream in
    batches, and work within a stretch follows its packs, not its rows.
    """

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, ()
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            opens = np.zeros(n, bool)
            for k in keys:
                codes = batch[k].dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                opens[1:] |= codes[1:] != codes[:-1]
            first = [batch[k][0].as_py() for k in keys]
            opens[0] = first != last
            sizes = pc.fill_null(batch[size].cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
            numbers = np.empty(n, np.int64)
            cuts = [*np.unique(np.append(0, np.flatnonzero(opens))).tolist(), n]
            for a, b in zip(cuts, cuts[1:]):
                numbers[a:b], state = cut(sizes[a:b], () if opens[a] else state)
            last = [batch[k][n - 1].as_py() for k in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], names=[*batch.schema.names, column])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    return table.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(mapper, f"{fields}, `{column}` long")


def shards_after_reach(table: DataFrame, keys: list[str], order: list[str], size: str, target: float) -> DataFrame:
    """Greedy shards: a shard closes once its sum reaches ``target``. Adds ``shard`` from 0 per key; a null size is 0."""

    def cut(sizes: np.ndarray, state: tuple) -> tuple[np.ndarray, tuple]:
        shard, held = state or (0, 0.0)
        out, start, at, window = np.empty(len(sizes), np.int64), 0, 0, 64
        while at < len(sizes):
            sums = np.cumsum(np.append(held, sizes[at : at + window]))[1:]
            reached = np.flatnonzero(sums >= target)
            if not len(reached):
                held, at, window = float(sums[-1]), at + len(sums), 2 * window
                continue
            at += int(reached[0]) + 1
            out[start:at] = shard
            shard, held, start, window = shard + 1, 0.0, at, 64
        out[start:] = shard
        return out, (shard, held)

    return _packed(table, keys, order, size, "shard", cut)


def batches_before_exceed(table: DataFrame, keys: list[str], order: list[str], size: str, most: float, count: int) -> DataFrame:
    """Greedy batches: a batch closes before its sum would exceed ``most`` or it has ``count`` rows. Adds ``batch``.

    A null size is 0; a row larger than ``most`` is a batch of its own.
    """

    def cut(sizes: np.ndarray, state: tuple) -> tuple[np.ndarray, tuple]:
        batch, held, rows = state or (0, 0.0, 0)
        out = np.empty(len(sizes), np.int64)
        at = 0
        while at < len(sizes):
            ahead = sizes[at : at + count - rows]
            over = np.flatnonzero(held + np.cumsum(ahead) > most)
            fit = int(over[0]) if len(over) else len(ahead)
            if not fit and not rows:
                fit = 1
            out[at : at + fit] = batch
            held, rows, at = held + float(ahead[:fit].sum()), rows + fit, at + fit
            if at < len(sizes):
                batch, held, rows = batch + 1, 0.0, 0
        return out, (batch, held, rows)

    return _packed(table, keys, order, size, "batch", cut)


def fixed_batches(table: DataFrame, keys: list[str], order: list[Column], size: int, column: str = "batch") -> DataFrame:
    """Batches of ``size`` rows in order, from 0."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return table.withColumn(column, F.floor(number / size).cast("long"))


def seeded(seed: int, *columns: str) -> Column:
    """Order by a hash of the columns: the same rows come first whatever the partitioning."""
    return F.md5(F.concat_ws("\x01", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def train_validation(table: DataFrame, group: Column, key: str, fraction: float = 0.05, seed: int = 0) -> DataFrame:
    """Adds ``split``: a share of each group's rows, rounded half to even, is for validation, never all of them.

    Rows are ranked by a seeded hash, a group of any size being spread over tasks.
    """
    named = table.withColumns({"group_": group, "hash_": seeded(seed, key)})
    ranked = range_ranked(named, ["group_"], [F.col("hash_"), F.col(key)], "rank_", "size_")
    wanted = F.least(F.bround(F.col("size_") * F.lit(fraction)).cast("long"), F.col("size_") - 1)
    return ranked.withColumn("split", F.when(F.col("rank_") <= wanted, "validation").otherwise("train")).drop("group_", "hash_", "rank_", "size_")


def reference_pool(table: DataFrame, group: Column, order: list[Column], low: float = 3.0, high: float = 10.0, size: int = 12) -> DataFrame:
    """Each group's best rows of middle length by ``squim_mos`` (null and NaN as 0), or of any length if there is none.

    Returns ``(group, pool)``, the pool being an array of up to ``size`` structs of ``audio_file`` and ``duration``.
    """
    fits = F.col("duration").between(low, high)
    score = F.coalesce(F.nanvl("squim_mos", F.lit(0.0)), F.lit(0.0))
    named = table.withColumn("group", group).withColumn("fits_", F.coalesce(fits, F.lit(False)))
    best = named.withColumn("rank_", F.row_number().over(Window.partitionBy("group", "fits_").orderBy(score.desc(), *order))).filter(F.col("rank_") <= size)
    pools = best.groupBy("group", "fits_").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank_", "audio_file", "duration"))), lambda x: F.struct(x["audio_file"], x["duration"])).alias("pool"))
    return pools.groupBy("group").agg(F.max_by("pool", "fits_").alias("pool"))


def assign_references(table: DataFrame, group: Column, order: list[Column], **params) -> DataFrame:
    """Adds ``ref_audio`` and ``ref_duration``: another clip of the group's pool, the i-th row taking the i-th one around.

    A row whose pool has no other clip has none.
    """
    pools = reference_pool(table, group, order, **params)
    numbered = range_ranked(table.withColumn("group", group), ["group"], order, "i_").withColumn("i_", F.col("i_") - 1)
    others = F.filter("pool", lambda x: x["audio_file"] != F.col("audio_file"))
    joined = numbered.join(pools, "group", "left").withColumn("others_", others)
    ref = F.when(F.size("others_") > 0, F.get("others_", (F.col("i_") % F.size("others_")).cast("int")))
    return joined.withColumn("ref_", ref).withColumns({"ref_audio": F.col("ref_.audio_file"), "ref_duration": F.col("ref_.duration")}).drop("group", "i_", "pool", "others_", "ref_")
