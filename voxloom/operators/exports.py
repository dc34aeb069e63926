"""From gated clips to a dataset: late transcripts, two-stage scores, flags, cut audio, summaries of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions import audio as A
from voxloom.functions import text as T
from voxloom.operators import tables
from voxloom.operators.intervals import overlap, overlap_join
from voxloom.operators.ranking import range_ranked

#: What a model reads of a second of audio, and the price of a million of that.
TOKENS_PER_SECOND, PRICE_PER_MILLION = 32, 1.0


def late_transcripts(rows: DataFrame, words: DataFrame, share: float = 0.5, width: float = 60.0) -> DataFrame:
    """Clips with the words that were recognized for their recordings later on.

    ``rows`` has ``audio_file``, ``video_id``, ``start`` and ``end``, ``words`` ``video_id``, ``pos``, ``text``,
    ``start``, ``end`` and ``score``.  A clip takes the words of which it covers at least ``share``, in order of
    ``pos``: ``text_cohere``, their number ``aligned_words`` and their mean score to five decimals ``asr_confidence``
    (null without words).  All clips of a recording with words become ``google_batch``, silent ones too; those of a
    recording without any stay as they are.  Clips without times get no words; a repeated clip gets its words each time.
    """
    spans = words.filter(F.col("text").isNotNull()).select("video_id", "pos", "text", "start", F.greatest("end", F.col("start") + 1e-6).alias("end"), "score")
    known = spans.select("video_id").distinct().withColumn("heard_", F.lit(True))
    clips = rows.select("audio_file", "video_id", "start", "end").distinct()
    pairs = overlap_join(clips, spans, width)
    common = overlap(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end"))
    owned = pairs.filter(common >= share * (F.col("r_end") - F.col("r_start")) * (1 - 1e-12))
    said = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r_pos", "r_text"))), lambda w: w["r_text"]), " ")
    found = owned.groupBy("audio_file", "video_id", "start", "end").agg(said.alias("said_"), F.round(F.avg("r_score"), 5).alias("mean_"), F.count("*").cast("int").alias("n_"))
    on = ["audio_file", "video_id", "start", "end"]
    joined = rows.join(known, "video_id", "left").join(found, on, "left")
    heard = F.col("heard_").isNotNull()
    pick = lambda c, new: F.when(heard, new).otherwise(F.col(c) if c in rows.columns else F.lit(None))
    new = {"text_cohere": F.coalesce("said_", F.lit("")), "text_source": F.lit("google_batch"), "asr_confidence": F.col("mean_"), "aligned_words": F.coalesce("n_", F.lit(0))}
    return joined.select(*[c for c in rows.columns if c not in new], *[pick(c, v).alias(c) for c, v in new.items()])


def reference_of_batches(clips: DataFrame, order: list[str], size: int = 8) -> DataFrame:
    """Adds ``batch``, ``reference`` and ``late``: per recording the clip that others are judged against.

    Clips are scored in batches of ``size``; the reference is the clip of the greatest ``squim_stoi`` in the first
    batch that has any, of equal ones the later.  Clips up to that batch were scored before it was known and are
    ``late``: they are scored again.  A recording without usable scores has no reference.
    """
    ranked = range_ranked(clips, ["video_id"], [F.col(c) for c in order], "place_").withColumn("batch", F.floor((F.col("place_") - 1) / size).cast("int")).drop("place_")
    usable = ranked.filter(F.col("squim_stoi").isNotNull() & ~F.isnan("squim_stoi"))
    best = usable.groupBy("video_id").agg(F.min(F.struct((F.col("batch")).alias("b"), (-F.col("squim_stoi")).alias("s"))).alias("first"))
    chosen = usable.join(best, "video_id").filter((F.col("batch") == F.col("first.b")) & (-F.col("squim_stoi") == F.col("first.s"))).groupBy("video_id").agg(F.max("audio_file").alias("reference"), F.first("first.b").alias("from_"))
    return ranked.join(chosen, "video_id", "left").withColumn("late", F.coalesce(F.col("batch") <= F.col("from_"), F.lit(False))).drop("from_")


def cut_audio(rows: DataFrame, samples: Column, rate: Column, target: int, gain_db: Column) -> DataFrame:
    """Clips with ``audio``: cut from the recording's samples by their times, gained and resampled.

    A clip that passed all gates but has no sample is rejected as ``audio:empty``; a rejected clip has no audio.
    """
    at = lambda c: F.least(F.greatest(F.bround(F.col(c) * rate).cast("int"), F.lit(0)), F.size(samples))
    first = at("start")
    cut = F.slice(samples, first + 1, F.greatest(at("end") - first, F.lit(0)))
    made = A.resample_udf(A.limited_gain(cut, gain_db), rate.cast("int"), F.lit(target))
    out = rows.withColumn("audio", F.when(F.col("reject_code").isNull(), made))
    empty = F.col("reject_code").isNull() & (F.coalesce(F.size("audio"), F.lit(0)) < 1)
    return out.withColumns({"reject_code": F.when(empty, "audio:empty").otherwise(F.col("reject_code")), "audio": F.when(~empty, F.col("audio"))})


def best_language(candidates: Column) -> Column:
    """The candidate (``language``, ``text``, ``confidence``) to take: of those with text the most confident one.

    An unknown confidence is less than any; of equal ones the first wins.  Without any text it is the first candidate,
    with an empty text.
    """
    ranked = F.transform(F.filter(candidates, lambda c: T.present(c["text"]) != ""), lambda c, i: F.struct(F.coalesce(c["confidence"], F.lit(-float("inf"))).alias("k"), (-i).alias("p"), c.alias("c")))
    first = F.get(candidates, F.lit(0))
    none = F.struct(first["language"].alias("language"), F.lit("").alias("text"), first["confidence"].alias("confidence"))
    return F.coalesce(F.array_max(ranked)["c"], none)


def flag_report(entries: DataFrame, group: list[str], label: str, confidence: str, order: str, lexicon: list[str], keep: list[str]) -> DataFrame:
    """Flagged clips for review with eight columns ``flag_*`` and their ``place``: surest first, then by label.

    Beside the judgement there are the clip's own label and confidence, the group's label and its tally of votes, and
    the words of ``lexicon`` in the text.  ``order`` settles ties.
    """
    consensus = tables.votes(entries, group, label, order)
    flagged = tables.flag_labels(entries, consensus, group, label, confidence, keep)
    said = consensus.select(*group, F.col("label").alias("flag_speaker_dialect"), F.col("tally").alias("flag_speaker_votes"))
    joined = flagged.join(said, group, "left")
    flags = joined.select(*entries.columns, F.col("flag_label").alias("flag_dialect"), F.round("flag_confidence", 3).alias("flag_confidence"), "flag_basis", F.col(label).alias("flag_clip_dialect"), F.round(F.coalesce(confidence, F.lit(0.0)), 3).alias("flag_clip_confidence"), "flag_speaker_dialect", "flag_speaker_votes", T.lexical_markers(F.lower(T.present(F.col("text"))), lexicon).alias("flag_lexical_markers"))
    return range_ranked(flags, [], [F.desc("flag_confidence"), F.col("flag_dialect"), F.col(order)], "place")


def marks_report(texts: DataFrame) -> DataFrame:
    """One row: rows, those with vowel marks, and the mean ratio of marks over these to four decimals."""
    ratio = T.marks_ratio(F.col("text"))
    marked = F.count_if(ratio > 0)
    return texts.agg(F.count("*").alias("rows"), marked.alias("marked"), F.round(F.coalesce(F.sum(F.when(ratio > 0, ratio)), F.lit(0.0)) / F.greatest(marked, F.lit(1)), 4).alias("mean_ratio"))


def run_summary(results: DataFrame) -> DataFrame:
    """One row on a run (``kept``, ``rejected``, ``seconds_kept``, ``error`` per recording), with its exit code.

    A run fails only if a recording failed and nothing was kept.
    """
    failed, kept = F.count_if(F.col("error").isNotNull()), F.coalesce(F.sum("kept"), F.lit(0))
    return results.agg(F.count("*").alias("videos"), kept.alias("kept"), F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"), (F.coalesce(F.sum("seconds_kept"), F.lit(0.0)) / 3600).alias("hours"), failed.alias("failed"), F.when((failed > 0) & (kept == 0), 1).otherwise(0).alias("exit_code"))


def video_results(kept: DataFrame, rejected: DataFrame, videos: DataFrame) -> DataFrame:
    """Per listed recording: kept and rejected clips, seconds kept to two decimals, rejections by reason, its error."""
    k = kept.groupBy("video_id").agg(F.count("*").alias("kept"), tables.total_seconds().alias("seconds_kept"))
    by_code = rejected.groupBy("video_id", "reject_code").agg(F.count("*").alias("n"))
    r = by_code.groupBy("video_id").agg(F.sum("n").alias("rejected"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("reject_code", "n")))).alias("reasons"))
    joined = videos.select("video_id", "video_url", "error").join(k, "video_id", "left").join(r, "video_id", "left")
    return joined.select("video_id", F.col("video_url").alias("url"), F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("rejected", F.lit(0)).alias("rejected"), F.round(F.coalesce("seconds_kept", F.lit(0.0)), 2).alias("seconds_kept"), F.coalesce("reasons", F.create_map().cast("map<string,bigint>")).alias("reasons"), "error")


def speaker_document(clips: DataFrame, linked: DataFrame) -> DataFrame:
    """Rows of the speakers' document: ``(part, key, seconds, value)``.

    Parts are seconds per speaker, seconds per recording, and the global speaker of each linked one.
    """
    part = lambda name, df, c: df.select(F.lit(name).alias("part"), F.col(c).alias("key"), "seconds", F.lit(None).cast("string").alias("value"))
    voices, videos = (tables.seconds_by(clips.filter(F.col(c).isNotNull()), c) for c in ("speaker", "video_id"))
    links = linked.select(F.lit("global_speakers").alias("part"), F.col("speaker").alias("key"), F.lit(None).cast("double").alias("seconds"), F.col("global_speaker").alias("value"))
    return part("per_speaker_seconds", voices, "speaker").unionByName(part("per_video_seconds", videos, "video_id")).unionByName(links)


def with_global_speakers(clips: DataFrame, linked: DataFrame, there: DataFrame | None = None) -> DataFrame:
    """Clips with the global speaker of their speaker and the path that follows from it.

    Clips of unlinked speakers go to one folder.  With ``there`` (``audio_file``), only clips whose file exists move.
    """
    named = clips.drop("global_speaker").join(linked.select("speaker", "global_speaker"), "speaker", "left")
    path = tables.regrouped_path(F.col("global_speaker"), F.col("audio_file"))
    if there is not None:
        named = named.join(there.select("audio_file").distinct().withColumn("there_", F.lit(True)), "audio_file", "left")
        path = F.when(F.col("there_"), path).otherwise(F.col("audio_file"))
    return named.withColumn("audio_file", path).drop("there_")


def replaced_texts(rows: DataFrame, files: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What a renewed transcription writes: new rows, orphans, differences, and a report of one row."""
    there, gone = tables.live(rows, files), tables.orphans(rows, files)
    updated = tables.overlay_text(there, cache)
    diffs = tables.text_diffs(there, cache)
    seconds = tables.total_seconds()
    report = updated.agg(F.count("*").alias("rows_after"), F.count_if(F.trim(T.present(F.col("text"))) == "").alias("empty_transcripts"), F.round(F.coalesce(seconds, F.lit(0.0)) / 3600, 3).alias("hours"))
    one = lambda df: df.withColumn("one_", F.lit(1))
    counts = one(report).join(one(gone.agg(F.count("*").alias("orphans_removed"))), "one_").join(one(diffs.agg(F.count("*").alias("transcripts_changed"))), "one_").join(one(cache.agg(F.count("*").alias("clips_transcribed"))), "one_")
    full = counts.select((F.col("rows_after") + F.col("orphans_removed")).alias("rows_before"), "rows_after", "orphans_removed", "clips_transcribed", "transcripts_changed", (F.col("rows_after") - F.col("transcripts_changed")).alias("transcripts_identical"), "empty_transcripts", "hours")
    return updated, gone, diffs, full


def token_estimate(seconds: Column) -> Column:
    """Millions of tokens of so many seconds of audio, which is their price as well at one a million."""
    return seconds * TOKENS_PER_SECOND / 1e6 * PRICE_PER_MILLION


def numbered_shards(table: DataFrame, key: str, shard: str) -> Column:
    """Name of a shard's file, ``train-k-of-n`` with five digits, in the folder of its ``key``; n counts the key's shards."""
    n = F.max(F.col(shard)).over(Window.partitionBy(key)) + 1
    return F.format_string("data/%s/train-%05d-of-%05d.parquet", F.col(key), F.col(shard).cast("int"), n.cast("int"))
