"""Interval algebra and interval joins on timelines.

Tables hold half-open intervals ``(video_id, start, end)`` in seconds (or in any ordered number).  Joins have an
equality on ``video_id`` and on a time bucket, so a long recording spreads over tasks and no nested loop arises.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.storage import cut_lineage


def buckets(start: Column, end: Column, width: float) -> Column:
    """Numbers of the time buckets that ``[start, end]`` touches."""
    return F.sequence(F.floor(start / width), F.greatest(F.floor(start / width), F.floor(end / width)))


#: Time buckets that an interval may be expanded to; longer ones are joined by key.
MOST_BUCKETS = 1024


def overlap_join(left: DataFrame, right: DataFrame, width: float = 60.0, marked: bool = False, prefix: str = "r_", key: str = "video_id") -> DataFrame:
    """Pairs of intervals of one ``key`` that overlap by more than 0; right columns get ``prefix``.

    Both sides are expanded to the time buckets they touch and joined on key and bucket; a pair is taken in the
    first bucket that both touch, so it appears once.  A hot key spreads by time; ``width`` should be of the order of
    the longer intervals.  Empty and null intervals pair with nothing.  With ``marked``, each left row appears once
    more with nulls on the right, so that a grouping finds the unmatched ones as well.

    An interval of more than ``MOST_BUCKETS`` buckets, such as one with a bogus end, isn't expanded: it overlaps most of
    its key's intervals anyway, and is joined with them by key.
    """
    r = right.select(*[F.col(c).alias(prefix + c) for c in right.columns])
    r_start, r_end = F.col(f"{prefix}start"), F.col(f"{prefix}end")
    same = F.col(key) == F.col(prefix + key)
    met = (F.col("start") < r_end) & (F.col("end") > r_start)
    long_left, long_right = (e / width - s / width > MOST_BUCKETS for s, e in ((F.col("start"), F.col("end")), (r_start, r_end)))
    lb = left.filter(~long_left).withColumn("bucket", F.explode(buckets(F.col("start"), F.col("end"), width)))
    rb = r.filter(~long_right).withColumn("r_bucket", F.explode(buckets(r_start, r_end, width)))
    first = F.greatest(F.floor(F.col("start") / width), F.floor(r_start / width))
    pairs = lb.join(rb, same & (F.col("bucket") == F.col("r_bucket")) & met & (F.col("bucket") == first)).drop("bucket", "r_bucket")
    pairs = pairs.unionByName(left.filter(long_left).join(r, same & met)).unionByName(left.filter(~long_left).join(r.filter(long_right), same & met))
    return pairs.unionByName(left, allowMissingColumns=True) if marked else pairs


def overlap(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    """Length of the common part; negative if there is none."""
    return F.least(end, other_end) - F.greatest(start, other_start)


def islands(table: DataFrame, keys: list[str], max_gap: float = 0.0) -> DataFrame:
    """Merge intervals per ``keys`` whose gap to all before is at most ``max_gap``: ``(keys, start, end)``."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("start") - reach <= max_gap, 0).otherwise(1)
    marked = table.select(*keys, "start", "end", opens.alias("opens")).withColumn("island", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def subtract(regions: DataFrame, holes: DataFrame, width: float = 60.0) -> DataFrame:
    """``regions`` without the time of ``holes`` of the same video; empty pieces vanish, repeated regions stay.

    Holes are merged first; each region then takes the clear stretches between its holes.
    """
    kept = regions.filter(F.col("end") > F.col("start")).groupBy("video_id", "start", "end").agg(F.count("*").alias("times"))
    merged = islands(holes.filter(F.col("end") > F.col("start")), ["video_id"])
    pairs = overlap_join(kept, merged, width, marked=True)
    cut = F.when(F.col("r_start").isNotNull(), F.struct(F.greatest("start", "r_start").alias("s"), F.least("end", "r_end").alias("e")))
    grouped = pairs.groupBy("video_id", "start", "end", "times").agg(F.sort_array(F.collect_list(cut)).alias("cuts"))
    starts = F.concat(F.array(F.col("start")), F.transform("cuts", lambda c: c["e"]))
    ends = F.concat(F.transform("cuts", lambda c: c["s"]), F.array(F.col("end")))
    pieces = F.filter(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda p: p["e"] > p["s"])
    repeated = F.flatten(F.transform(F.sequence(F.lit(1), F.col("times").cast("int")), lambda _: pieces))
    return grouped.select("video_id", F.explode(repeated).alias("p")).select("video_id", F.col("p.s").alias("start"), F.col("p.e").alias("end"))


def clip_to(regions: DataFrame, start: Column, end: Column) -> DataFrame:
    """``regions`` clipped to a window; what lies outside vanishes."""
    clipped = regions.withColumn("start", F.greatest("start", start)).withColumn("end", F.least("end", end))
    return clipped.filter(F.col("end") > F.col("start"))


def overlapped_speech(turns: DataFrame, max_gap: float = 1e-3, decimals: int = 4, width: float = 60.0) -> DataFrame:
    """Stretches where turns of two or more different speakers are active, merged over gaps up to ``max_gap``.

    A sweep over the distinct boundaries, rounded to ``decimals``: a slice counts if more than one speaker is active
    at its middle.
    """
    at = lambda c: F.bround(F.col(c), decimals)
    points = turns.select("video_id", F.explode(F.array(at("start"), at("end"))).alias("start")).filter(F.col("start").isNotNull()).distinct()
    slices = points.withColumn("end", F.lead("start").over(Window.partitionBy("video_id").orderBy("start"))).filter(F.col("end").isNotNull())
    active = overlap_join(slices, turns.select("video_id", "start", "end", "speaker"), width)
    middle = (F.col("start") + F.col("end")) / 2
    busy = active.filter((F.col("r_start") <= middle) & (middle < F.col("r_end"))).groupBy("video_id", "start", "end").agg(F.count_distinct("r_speaker").alias("speakers")).filter("speakers > 1")
    return islands(busy, ["video_id"], max_gap)


def merge_same_speaker(pieces: DataFrame, max_gap: float = 0.3) -> DataFrame:
    """Join successive pieces of one speaker, in order of start over all speakers, with a gap of at most ``max_gap``.

    Pieces must be disjoint within a video.
    """
    w = Window.partitionBy("video_id").orderBy("start", "end", "speaker")
    goes_on = (F.col("speaker") == F.lag("speaker").over(w)) & (F.col("start") - F.lag("end").over(w) <= max_gap)
    marked = pieces.select("video_id", "start", "end", "speaker", F.when(goes_on, 0).otherwise(1).alias("opens"))
    runs = marked.withColumn("run", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("video_id", "run", "speaker").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def dominant_speaker(slices: DataFrame, turns: DataFrame, share: float = 0.5, width: float = 60.0) -> DataFrame:
    """The speaker of the single turn that covers most of each slice, if it covers at least ``share`` of it.

    Of equal overlaps the earlier turn wins, then the speaker that sorts first.  Slices without such a turn are left
    out.
    """
    pairs = overlap_join(slices.select("video_id", "start", "end"), turns.select("video_id", "start", "end", "speaker"), width)
    common = overlap(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end"))
    ranked = pairs.groupBy("video_id", "start", "end").agg(F.min(F.struct((-common).alias("o"), F.col("r_start").alias("s"), F.col("r_end").alias("e"), F.col("r_speaker").alias("speaker"))).alias("best"))
    return ranked.filter(-F.col("best.o") >= (F.col("end") - F.col("start")) * share).select("video_id", "start", "end", F.col("best.speaker").alias("speaker"))


def cut_at_turns(regions: DataFrame, turns: DataFrame, least: float = 1e-6, width: float = 60.0) -> DataFrame:
    """Regions cut at every turn boundary strictly inside them; slices up to ``least`` vanish."""
    kept = regions.select("video_id", "start", "end").filter(F.col("end") > F.col("start")).distinct()
    points = turns.select("video_id", F.explode(F.array("start", "end")).alias("start")).filter(F.col("start").isNotNull()).distinct().withColumn("end", F.col("start") + 1e-9)
    pairs = overlap_join(kept, points, width, marked=True)
    inner = F.when((F.col("r_start") > F.col("start")) & (F.col("r_start") < F.col("end")), F.col("r_start"))
    grouped = pairs.groupBy("video_id", "start", "end").agg(F.sort_array(F.collect_set(inner)).alias("cuts"))
    starts, ends = F.concat(F.array("start"), "cuts"), F.concat("cuts", F.array("end"))
    pieces = F.filter(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda p: p["e"] - p["s"] > least)
    return grouped.select("video_id", F.explode(pieces).alias("p")).select("video_id", F.col("p.s").alias("start"), F.col("p.e").alias("end"))


def assign_speakers(regions: DataFrame, turns: DataFrame, share: float = 0.5, only: str = "SPEAKER_00", width: float = 60.0) -> DataFrame:
    """Speech regions cut at turn boundaries and given their dominant speaker.

    Videos without any turn keep their regions whole under the speaker ``only``; unattributed slices vanish.
    """
    known = turns.select("video_id").distinct()
    with_turns = regions.join(known, "video_id", "left_semi")
    without = regions.join(known, "video_id", "left_anti").select("video_id", "start", "end", F.lit(only).alias("speaker"))
    return dominant_speaker(cut_at_turns(with_turns, turns, width=width), turns, share, width).unionByName(without)


def own_words(chunks: DataFrame, words: DataFrame, share: float = 0.5, jitter: float = 0.02, width: float = 60.0) -> DataFrame:
    """Words of each chunk: those of which it covers at least ``share``.

    ``chunks`` has ``video_id, chunk_index, start, end``; ``words`` has ``video_id, pos, text, start, end`` and maybe
    ``score``.  Returns per chunk ``text`` (in order of start), ``score`` (mean), ``aligned_words`` and
    ``boundary_clipped``: whether an owned word lies more than ``jitter`` outside.  A word shared by halves goes to
    both chunks; a chunk without words has the text ``''`` and no score.  A word of no length counts as 1e-6 long.
    """
    scored = words if "score" in words.columns else words.withColumn("score", F.lit(None).cast("double"))
    spans = scored.select("video_id", "pos", "text", "start", F.greatest(F.col("end"), F.col("start") + 1e-6).alias("end"), "score", F.col("end").alias("true_end"))
    pairs = overlap_join(chunks.select("video_id", "chunk_index", "start", "end"), spans, width)
    common = overlap(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end"))
    owned = pairs.filter(common >= share * F.greatest(F.col("r_end") - F.col("r_start"), F.lit(1e-6)) * (1 - 1e-12))
    clipped = (F.col("r_start") < F.col("start") - jitter) | (F.col("r_true_end") > F.col("end") + jitter)
    spoken = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r_start", "r_pos", "r_text"))), lambda w: w["r_text"]), " ")
    grouped = owned.groupBy("video_id", "chunk_index").agg(spoken.alias("text"), F.avg("r_score").alias("score"), F.count("*").alias("aligned_words"), F.bool_or(clipped).alias("boundary_clipped"))
    joined = chunks.select("video_id", "chunk_index", "start", "end").join(grouped, ["video_id", "chunk_index"], "left")
    return joined.select("video_id", "chunk_index", "start", "end", F.coalesce("text", F.lit("")).alias("text"), "score", F.coalesce("aligned_words", F.lit(0)).alias("aligned_words"), F.coalesce("boundary_clipped", F.lit(False)).alias("boundary_clipped"))


def plan_windows(words: DataFrame, seconds: float = 900.0) -> DataFrame:
    """Tumbling windows: ``(video_id, window, first_pos, end_pos)`` of those that hold words, positions half-open."""
    return words.filter(F.col("start").isNotNull()).groupBy("video_id", F.floor(F.col("start") / seconds).alias("window")).agg(F.min("pos").alias("first_pos"), (F.max("pos") + 1).alias("end_pos"))


def fill_ends(words: DataFrame) -> DataFrame:
    """Words of no or unknown length end where the next one starts, never ahead of their own start."""
    nxt = F.lead("start").over(Window.partitionBy("video_id").orderBy("pos"))
    end = F.when(F.col("end") > F.col("start"), F.col("end")).otherwise(F.greatest(F.col("start"), F.coalesce(nxt, F.col("start"))))
    return words.withColumn("end", end)


def pad_and_filter(chunks: DataFrame, pad: float = 0.2, shortest: float = 2.0, longest: float = 12.0, duration: str | None = None) -> DataFrame:
    """Pad both sides, clamp to the recording, then drop what is too short or longer than ``longest`` and both pads.

    Number the rest from 0 per video by start.  ``duration`` names a column; one of 0 or less, or null, doesn't clamp.
    """
    start, end = F.greatest(F.lit(0.0), F.col("start") - pad), F.col("end") + pad
    if duration:
        end = F.when(F.col(duration) > 0, F.least(F.col(duration), end)).otherwise(end)
    padded = chunks.withColumns({"start": start, "end": end})
    length = F.col("end") - F.col("start")
    kept = padded.filter((length >= shortest) & (length <= longest + 2 * pad))
    return kept.withColumn("chunk_index", F.row_number().over(Window.partitionBy("video_id").orderBy("start", "end")) - 1)


def split_span(start: float, end: float, speech: list[tuple[float, float]], longest: float = 12.0, least_pause: float = 0.25) -> list[tuple[float, float]]:
    """Cut a span at its deepest pause until all fit; without a pause into equal pieces.

    The deepest pause is the longest one (to 10 ms) strictly inside, of equal ones the most central.  ``speech`` is
    sorted by start.
    """
    todo, done = [(start, end)], []
    while todo:
        a, b = todo.pop()
        if b - a <= longest:
            done.append((a, b))
            continue
        inside = [(s, e) for s, e in speech if e > a and s < b]
        pauses = [(e, s) for (_, e), (s, _) in zip(inside, inside[1:]) if s - e >= least_pause and e > a and s < b]
        if pauses:
            low, high = max(pauses, key=lambda p: (round(p[1] - p[0], 2), -abs((p[0] + p[1]) / 2 - (a + b) / 2)))
            todo += [(high, b), (a, low)]
        else:
            n = max(1, math.ceil((b - a) / longest))
            done += [(a + i * (b - a) / n, a + (i + 1) * (b - a) / n) for i in range(n)]
    return done


def split_long(pieces: DataFrame, regions: DataFrame, longest: float = 12.0, least_pause: float = 0.25, width: float = 600.0) -> DataFrame:
    """``pieces`` (with ``speaker``) cut by ``split_span`` at the pauses between speech ``regions`` of their video.

    Only the regions that a piece overlaps travel to it; short pieces pass by without Python.
    """
    short = pieces.filter(F.col("end") - F.col("start") <= longest).select("video_id", "start", "end", "speaker")
    long = pieces.filter(F.col("end") - F.col("start") > longest).select("video_id", "start", "end", "speaker").distinct()
    pairs = overlap_join(long, regions.select("video_id", "start", "end"), width, marked=True)
    spans = pairs.groupBy("video_id", "start", "end", "speaker").agg(F.sort_array(F.collect_list(F.when(F.col("r_start").isNotNull(), F.struct(F.col("r_start").alias("s"), F.col("r_end").alias("e"))))).alias("speech"))

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = [(r["video_id"], a, b, r["speaker"]) for r in batch.to_pylist() for a, b in split_span(r["start"], r["end"], [(x["s"], x["e"]) for x in r["speech"]], longest, least_pause)]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.float64(), pa.string()))], names=["video_id", "start", "end", "speaker"])

    return short.unionByName(spans.mapInArrow(cut, "video_id string, start double, end double, speaker string"))


def build_chunks(regions: DataFrame, turns: DataFrame, durations: DataFrame | None = None, drop_overlap: bool = True, max_gap: float = 0.3, pad: float = 0.2, shortest: float = 2.0, longest: float = 12.0) -> DataFrame:
    """Chunks of one speaker each, from speech regions and turns: overlap out, speakers, merge, split, pad, number.

    Turns and speech are read several times over, so each is written once to shared storage in between.
    """
    turns = cut_lineage(turns.select("video_id", "start", "end", "speaker"), "turns")
    speech = cut_lineage(subtract(regions, overlapped_speech(turns)) if drop_overlap else regions.select("video_id", "start", "end"), "speech")
    merged = cut_lineage(merge_same_speaker(assign_speakers(speech, turns), max_gap), "merged")
    pieces = split_long(merged, speech, longest)
    if durations is None:
        return pad_and_filter(pieces, pad, shortest, longest)
    return pad_and_filter(pieces.join(durations.select("video_id", "duration"), "video_id", "left"), pad, shortest, longest, "duration").drop("duration")


def collapse_dominant(turns: DataFrame, share: float = 0.9) -> DataFrame:
    """Turns under one speaker where one of several has at least ``share`` of a video's speaking time."""
    of_speaker = turns.groupBy("video_id", "speaker").agg(F.sum(F.col("end") - F.col("start")).alias("seconds"))
    totals = of_speaker.groupBy("video_id").agg(F.sum("seconds").alias("total"), F.count("*").alias("n"), F.max(F.struct(F.col("seconds"), F.col("speaker"))).alias("top"))
    ruled = totals.filter((F.col("n") > 1) & (F.col("total") > 0) & (F.col("top.seconds") / F.col("total") >= share)).select("video_id", F.col("top.speaker").alias("ruler"))
    return turns.join(ruled, "video_id", "left").withColumn("speaker", F.coalesce("ruler", "speaker")).drop("ruler")


def namespaced(video_id: Column, speaker: Column) -> Column:
    """Speaker label that is unique over videos."""
    return F.concat(video_id, F.lit("_SPK"), speaker)


def label_runs(path: Column, scores: Column, blank: int) -> Column:
    """Runs of one label other than ``blank`` in an array of labels: array of (start, end, label, mean score)."""
    opens = F.transform(path, lambda x, i: F.when((i == 0) | (x != F.get(path, i - 1)), i))
    starts = F.filter(opens, lambda i: i.isNotNull())
    runs = F.transform(starts, lambda s, k: F.struct(s.alias("start"), F.coalesce(F.get(starts, k + 1), F.size(path)).alias("end"), F.get(path, s).alias("label")))
    spoken = F.filter(runs, lambda r: r["label"] != blank)
    mean = lambda r: F.aggregate(F.slice(scores, r["start"] + 1, r["end"] - r["start"]), F.lit(0.0), lambda a, x: a + x) / (r["end"] - r["start"])
    return F.transform(spoken, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["label"].alias("label"), mean(r).alias("score")))
