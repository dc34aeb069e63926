"""Tables of records and caches: last-wins views, overlays, work lists, votes, reports, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions import text as T

#: Sums are of decimal(20,6), which holds smaller numbers only.
LARGEST_SUMMAND = 1e14


def last_wins(log: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row per key of an append-only log, by ``order`` (nulls first); combined map-side, so hot keys are cheap."""
    rest = [c for c in log.columns if c not in key and c not in order]
    row = F.struct(*order, *rest)
    return log.groupBy(*key).agg(F.max(row).alias("row_")).select(*key, *[F.col(f"row_.{c}").alias(c) for c in [*order, *rest]]).select(*log.columns)


def first_seen(table: DataFrame, key: str, order: str) -> DataFrame:
    """Distinct keys with their first place: ``(key, order)``."""
    return table.groupBy(key).agg(F.min(order).alias(order))


def outstanding(rows: DataFrame, cache: DataFrame, key: str = "audio_file", limit: int | None = None, order: str | None = None) -> DataFrame:
    """Rows without a successful cache entry; at most ``limit`` of them in order if that is given."""
    todo = rows.join(cache.filter("status = 'ok'").select(key).distinct(), key, "left_anti")
    return todo.orderBy(order or key).limit(limit) if limit is not None else todo


def live(rows: DataFrame, files: DataFrame, key: str = "audio_file") -> DataFrame:
    """Rows whose file is listed."""
    return rows.join(files.select(key), key, "left_semi")


def orphans(rows: DataFrame, files: DataFrame, key: str = "audio_file") -> DataFrame:
    """Rows whose file isn't listed."""
    return rows.join(files.select(key), key, "left_anti")


def overlay_text(rows: DataFrame, cache: DataFrame, key: str = "audio_file") -> DataFrame:
    """Rows with the text of their successful cache entry and a ``gate_status``; others keep theirs (``not_sent``)."""
    entries = cache.select(key, F.col("text").alias("new_text_"), F.col("status").alias("status_"))
    joined = rows.join(entries, key, "left")
    ok = F.col("status_") == "ok"
    return joined.withColumns({"text": F.when(ok, F.coalesce("new_text_", F.lit(""))).otherwise(F.col("text")), "gate_status": F.coalesce("status_", F.lit("not_sent"))}).drop("new_text_", "status_")


def text_diffs(rows: DataFrame, cache: DataFrame, key: str = "audio_file") -> DataFrame:
    """``(key, before, after)`` where a successful entry changed the cleaned text."""
    entries = cache.filter("status = 'ok'").select(key, F.col("text").alias("after"))
    joined = rows.select(key, F.col("text").alias("before")).join(entries, key)
    return joined.filter(T.clean_for_output(F.col("before")) != T.clean_for_output(F.col("after")))


def overlay_marks(rows: DataFrame, verdicts: DataFrame, key: str = "audio_file", tag: str = "diacritized") -> DataFrame:
    """Rows with the marked text of accepted verdicts, ``tashkeel_ratio`` and ``tashkeel_source``."""
    joined = rows.join(verdicts.select(key, F.col("text").alias("marked_"), F.col("status").alias("status_")), key, "left")
    ok = F.coalesce(F.col("status_").startswith("ok"), F.lit(False)) & F.col("marked_").isNotNull()
    marked = joined.withColumns({"text": F.when(ok, F.col("marked_")).otherwise(F.col("text")), "text_source": F.when(ok & ~F.col("text_source").endswith("+" + tag), F.concat("text_source", F.lit("+" + tag))).otherwise(F.col("text_source"))})
    return marked.withColumns({"tashkeel_ratio": T.marks_ratio(F.col("text")), "tashkeel_source": F.when(ok, tag)}).drop("marked_", "status_")


def pick_text(mode: str) -> Column:
    """The text of a mode (``cohere``, ``youtube`` or canonical); blank counts as missing and falls back to ``text``."""
    given = {"cohere": F.col("text_cohere"), "youtube": F.col("text_yt")}.get(mode, F.col("text"))
    return F.coalesce(F.when(F.trim(given) != "", given), F.col("text"), F.lit(""))


def status_counts(rows: DataFrame, cache: DataFrame, key: str = "audio_file") -> DataFrame:
    """``(status, rows)`` of the rows' entries, ``not_sent`` without one."""
    return rows.select(key).join(cache.select(key, "status"), key, "left").groupBy(F.coalesce("status", F.lit("not_sent")).alias("status")).agg(F.count("*").alias("rows"))


def votes(entries: DataFrame, group: list[str], label: str, order: str, unclear: str = "unclear") -> DataFrame:
    """Consensus per group over labels other than ``unclear`` and null: ``(group, label, votes, total, share)``.

    Of equally frequent labels the one seen first wins.
    """
    counted = entries.filter(F.col(label).isNotNull() & (F.col(label) != unclear)).groupBy(*group, label).agg(F.count("*").alias("votes"), F.min(order).alias("seen"))
    best = counted.groupBy(*group).agg(F.min(F.struct((-F.col("votes")).alias("v"), "seen", F.col(label).alias("label"))).alias("b"), F.sum("votes").alias("total"), F.map_from_entries(F.sort_array(F.collect_list(F.struct(label, "votes")))).alias("tally"))
    return best.select(*group, F.col("b.label").alias("label"), (-F.col("b.v")).alias("votes"), "total", (-F.col("b.v") / F.col("total")).alias("share"), "tally")


def flag_labels(entries: DataFrame, consensus: DataFrame, group: list[str], label: str, confidence: str, keep: list[str], least_group: int = 3, least_share: float = 0.67, least_confidence: float = 0.6) -> DataFrame:
    """Entries whose judged label isn't in ``keep`` and is sure enough.

    A group of enough votes with a clear majority speaks for its entries, otherwise each entry for itself.
    """
    joined = entries.filter(F.col(label).isNotNull()).join(consensus.select(*group, F.col("label").alias("group_label"), "total", "share"), group, "left")
    use = F.coalesce((F.col("total") >= least_group) & (F.col("share") >= least_share), F.lit(False))
    judged = joined.withColumns({"flag_label": F.when(use, F.col("group_label")).otherwise(F.col(label)), "flag_confidence": F.when(use, F.col("share")).otherwise(F.coalesce(confidence, F.lit(0.0))), "flag_basis": F.when(use, "speaker_consensus").otherwise("clip")})
    return judged.filter(~F.col("flag_label").isin(*keep) & (F.col("flag_confidence") >= least_confidence)).drop("group_label", "total", "share")


def _summable(column: str) -> Column:
    """The value as a decimal that sums exactly; null for null, NaN, infinite and what the decimal can't hold."""
    return F.when(F.abs(F.col(column)) < LARGEST_SUMMAND, F.col(column)).cast("decimal(20,6)")


def total_seconds() -> Column:
    """Sum of ``duration``; a null, NaN or infinite one is 0."""
    return F.sum(F.coalesce(_summable("duration"), F.lit(0).cast("decimal(20,6)"))).cast("double")


def seconds_by(table: DataFrame, *keys: str) -> DataFrame:
    """Seconds and clips per key; a null, NaN or infinite duration is 0."""
    return table.groupBy(*keys).agg(total_seconds().alias("seconds"), F.count("*").alias("clips"))


def with_share(counts: DataFrame, value: str) -> DataFrame:
    """Adds ``share``: of the total, which is 0 for an empty table."""
    names = counts.columns
    one = lambda df: df.withColumn("one_", F.lit(1))
    total = one(counts.agg(F.sum(value).alias("total_")))  # one row
    return one(counts).join(F.broadcast(total), "one_").select(*names, (F.col(value) / F.greatest("total_", F.lit(1))).alias("share"))


def speaker_summary(clips: DataFrame, key: str = "speaker", samples: int = 5) -> DataFrame:
    """Per voice: seconds, hours, clips, episodes, mean score (null, NaN and infinite skipped), first sample files.

    Samples come from a top-k of their own, which Spark limits per task ahead of its shuffle; null voices have none.
    """
    score = _summable("squim_mos")
    at = F.row_number().over(Window.partitionBy(key).orderBy("audio_file"))
    first = clips.select(key, "audio_file", at.alias("at_")).filter(F.col("at_") <= samples).groupBy(key).agg(F.sort_array(F.collect_list("audio_file")).alias("samples"))
    grouped = clips.groupBy(key).agg(
        total_seconds().alias("seconds"),
        F.count("*").alias("clips"),
        F.count_distinct("video_id").alias("episodes"),
        (F.sum(score).cast("double") / F.count(score)).alias("mean_mos"),
    )
    return grouped.join(first, key, "left").withColumn("hours", F.col("seconds") / 3600)


def known_seconds() -> Column:
    """``duration`` where it is a finite number above 0, else null."""
    return F.when((F.col("duration") > 0) & (F.col("duration") < float("inf")), F.col("duration"))


def export_stats(clips: DataFrame) -> DataFrame:
    """One row on an export: clips, seconds, shortest, longest and mean duration, voices, recordings.

    Durations that are null, NaN, infinite or not above 0 count as clips but not among the lengths.
    """
    known = clips.withColumn("duration", known_seconds())
    n = F.count("duration")
    return known.agg(F.count("*").alias("clips"), total_seconds().alias("seconds"), F.min("duration").alias("shortest"), F.max("duration").alias("longest"), (total_seconds() / F.nullif(n, F.lit(0))).alias("mean"), F.count_distinct("speaker").alias("voices"), F.count_distinct("video_id").alias("recordings"))


def top_with_rest(table: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The first ``n`` rows by value, and one of the others' sum under the key ``(rest)`` if there are any."""
    first = table.select(key, value).orderBy(F.desc(value), key).limit(n)
    numbered = first.withColumn("place", F.row_number().over(Window.orderBy(F.desc(value), key)))  # of n rows
    rest = table.select(key, value).join(first.select(key), key, "left_anti").agg(F.sum(F.col(value).cast("decimal(30,6)")).cast("double").alias(value))
    return numbered.unionByName(rest.filter(F.col(value).isNotNull()).select(F.lit("(rest)").alias(key), value, F.lit(n + 1).alias("place")))


def billable_seconds(duration: Column, step: float = 15.0) -> Column:
    """Seconds billed for a request: whole steps, at least one; a duration that is no finite number is 0."""
    known = F.when(F.abs(duration) < LARGEST_SUMMAND, duration).otherwise(0.0)
    return F.greatest(F.lit(step), F.ceil(known / step) * step)


def estimated_cost(seconds: Column, per_minute: float) -> Column:
    """Cost of audio at a rate per minute."""
    return seconds / 60 * per_minute


def delete_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``table`` without the rows of the listed keys."""
    return table.join(keys.select(key), key, "left_anti")


def regrouped_path(global_speaker: Column, path: Column) -> Column:
    """Path of a clip in the folder of its global speaker, ``_unassigned`` without one."""
    return F.concat(F.coalesce(global_speaker, F.lit("_unassigned")), F.lit("/"), F.substring_index(path, "/", -1))


def manifest_rows(table: DataFrame, prefix: str, text: Column) -> DataFrame:
    """JSON lines of an export; keys without a value are left out."""
    ref = lambda c: F.when(F.col("ref_audio").isNotNull(), c)
    entry = F.struct(F.concat(F.lit(prefix), "audio_file").alias("audio"), text.alias("text"), "duration", ref(F.concat(F.lit(prefix), "ref_audio")).alias("ref_audio"), ref(F.col("ref_duration")).alias("ref_duration"), "speaker", "video_id")
    return table.select("audio_file", F.to_json(entry, {"ignoreNullFields": "true"}).alias("value"))


def drop_short_refs(table: DataFrame, shortest: float) -> DataFrame:
    """Rows of at least ``max(shortest - 0.25, 1)`` seconds, references to dropped ones nulled."""
    least = max(shortest - 0.25, 1.0)
    kept = table.filter(F.col("duration") >= least)
    there = kept.select(F.col("audio_file").alias("ref_audio"), F.lit(True).alias("there_")).distinct()
    joined = kept.join(there, "ref_audio", "left")
    gone = F.col("there_").isNull()
    return joined.withColumns({"ref_duration": F.when(~gone, F.col("ref_duration")), "ref_audio": F.when(~gone, F.col("ref_audio"))}).drop("there_").select(*table.columns)


def record(chunks: DataFrame, videos: DataFrame, sample_rate: int = 24_000, deferred: bool = False) -> DataFrame:
    """Rows of the dataset from chunks and their videos: paths, three decimals of times, language of the text."""
    third = lambda c: F.round(F.col(c), 3)
    v = videos.select("video_id", "video_url", "title", "channel", "upload_date")
    lang = F.coalesce(F.nullif("asr_language", F.lit("")), F.lit("ar"))
    name = F.format_string("%s/%s_%04d.wav", F.coalesce("speaker", F.lit("_unassigned")), "video_id", "chunk_index")
    joined = chunks.join(v, "video_id", "left")
    columns = {"audio_file": name, "start": third("start"), "end": third("end"), "duration": F.round(F.col("end") - F.col("start"), 3), "global_speaker": F.lit(None).cast("string"), "text_source": F.lit("pending") if deferred else F.col("text_source"), "sample_rate": F.lit(sample_rate), "language": lang}
    return joined.withColumns(columns)


def merge_rejections(old: DataFrame, new: DataFrame) -> DataFrame:
    """Earlier rejections other than of texts, and the new ones; a renewed pass replaces what it judged."""
    return old.filter(~F.coalesce(F.col("reject_code").startswith("text:"), F.lit(False))).unionByName(new, allowMissingColumns=True)


def slice_rows(table: DataFrame, ordinal: str, skip: int, stop: int | None = None) -> DataFrame:
    """Rows from place ``skip`` up to, not including, place ``stop`` in order of ``ordinal``, which counts from 0."""
    kept = table.filter(F.col(ordinal) >= skip)
    return kept.filter(F.col(ordinal) < stop) if stop is not None else kept


def totals(kept: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: videos, kept and rejected clips, hours; a null, NaN or infinite duration is 0."""
    tagged = kept.select("video_id", "duration", F.lit(1).alias("k")).unionByName(rejected.select(F.lit(None).cast("string").alias("video_id"), F.lit(None).cast("double").alias("duration"), F.lit(0).alias("k")))
    return tagged.agg(F.count_distinct("video_id").alias("videos"), F.coalesce(F.sum("k"), F.lit(0)).alias("kept"), F.coalesce(F.sum(1 - F.col("k")), F.lit(0)).alias("rejected"), (F.coalesce(total_seconds(), F.lit(0.0)) / 3600).alias("hours"))
