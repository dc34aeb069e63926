"""Catalog of the core queries; each takes a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import inference
from voxloom.config import Config, Limits
from voxloom.functions import sources as U
from voxloom.functions import text as T
from voxloom.functions import vectors as V
from voxloom.functions.audio import signal_stats_udf, wav_bytes_udf, wav_samples_udf, wav_seconds_udf
from voxloom.functions.labels import label_key
from voxloom.operators import coverage, exports, gates, intervals, sequence, speakers, tables
from voxloom.plans.sql import oracle_sql
from voxloom.sources import readers, writers
from voxloom.storage import scratch
from voxloom.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
CONFIG = Config()
HOSTS = CONFIG.sources.hosts, CONFIG.sources.short_hosts
__all__ = ["oracle_sql", "queries"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def millis(spark: SparkSession, folder: str) -> DataFrame:
    """Valid turns as intervals in whole milliseconds, each once: sums and cuts are exact in any engine."""
    return coverage.turn_intervals(table(spark, folder, "turns")).select("video_id", F.col("start_ms").alias("start"), F.col("end_ms").alias("end"), "speaker").distinct()


def chunk_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks as intervals in whole milliseconds."""
    return table(spark, folder, "chunks").select("video_id", "chunk_index", coverage.clock(F.col("start")).alias("start"), coverage.clock(F.col("end")).alias("end"))


def stream_words(spark: SparkSession, folder: str) -> DataFrame:
    """Caption words, one per video and position, times in whole milliseconds."""
    w = table(spark, folder, "sub_words").groupBy("video_id", "pos").agg(F.min("text").alias("text"), F.min("start").alias("start"), F.max("end").alias("end"), F.min("kind").alias("kind"))
    return w.select("video_id", "pos", "text", coverage.clock(F.col("start")).alias("start"), coverage.clock(F.coalesce(F.nanvl("end", "start"), F.col("start"))).alias("end"), "kind")


def disjoint(spark: SparkSession, folder: str) -> DataFrame:
    """Speaking periods per speaker as pieces."""
    return coverage.speaking_periods(table(spark, folder, "turns")).filter("kind = 'period'").select("video_id", F.col("start_ms").alias("start"), F.col("end_ms").alias("end"), "speaker")


def embedded(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as clips of a recording."""
    return table(spark, folder, "embeddings").select("vec_id", (F.col("vec_id") % 5).alias("recording"), "label", "embedding")


def unique_clips(spark: SparkSession, folder: str) -> DataFrame:
    """Last emitted row of each clip."""
    m = table(spark, folder, "metadata").drop("asr_confidence_alt")
    return tables.last_wins(m.filter("audio_file IS NOT NULL"), ["audio_file"], ["emitted_at"])


def _gate_reasons(s: SparkSession, d: str) -> DataFrame:
    return gates.text_gates(table(s, d, "chunks")).select("video_id", "chunk_index", "reject_code")


def _resolve(s: SparkSession, d: str) -> DataFrame:
    raw = table(s, d, "chunks").drop("reject_code", "reject_value")
    return gates.resolve_text(raw).select("video_id", "chunk_index", "text", "text_source", "cer_yt_vs_cohere", "reject_code")


def _error_rates(s: SparkSession, d: str) -> DataFrame:
    pairs = table(s, d, "chunks").select("video_id", "chunk_index", T.normalize(F.col("text_yt")).alias("a"), T.normalize(F.col("text_cohere")).alias("b"))
    return pairs.select("video_id", "chunk_index", T.cer_of_normal(F.col("a"), F.col("b")).alias("cer"), T.wer_of_normal(F.col("a"), F.col("b")).alias("wer"), T.cer_within(F.col("a"), F.col("b"), 0.35).alias("agrees"))


def _dominant(s: SparkSession, d: str) -> DataFrame:
    return intervals.dominant_speaker(chunk_spans(s, d), millis(s, d), width=60_000)


def _own_words(s: SparkSession, d: str) -> DataFrame:
    return intervals.own_words(chunk_spans(s, d), stream_words(s, d), jitter=20, width=60_000).drop("score", "start", "end")


def _build(s: SparkSession, d: str) -> DataFrame:
    seconds = lambda df, *more: df.select("video_id", (F.col("start") / 1000).alias("start"), (F.col("end") / 1000).alias("end"), *more)
    turns = seconds(millis(s, d), "speaker")
    return intervals.build_chunks(intervals.islands(turns, ["video_id"], 0.2), turns)


def _votes(s: SparkSession, d: str) -> DataFrame:
    clips = table(s, d, "metadata").withColumn("dialect", F.coalesce("asr_language", F.lit("unclear")))
    return tables.votes(clips, ["video_id", "speaker"], "dialect", "audio_file")


def _flags(s: SparkSession, d: str) -> DataFrame:
    clips = unique_clips(s, d).withColumn("dialect", F.coalesce("asr_language", F.lit("unclear"))).withColumn("sure", F.nanvl("asr_confidence", F.lit(0.0)))
    return tables.flag_labels(clips, tables.votes(clips, ["video_id", "speaker"], "dialect", "audio_file"), ["video_id", "speaker"], "dialect", "sure", ["ar", "unclear"]).select("audio_file", "flag_label", "flag_confidence", "flag_basis")


def _link(s: SparkSession, d: str) -> DataFrame:
    voices = speakers.robust_centroids(embedded(s, d), ["label", "recording"], "embedding", ["vec_id"])
    counts = embedded(s, d).groupBy("label", "recording").agg(F.count("*").cast("double").alias("seconds"))
    named = voices.join(counts, ["label", "recording"]).select(F.concat_ws("_", F.lit("v"), "recording", "label").alias("speaker"), "centroid", "seconds")
    return speakers.drop_thin(speakers.link_speakers(named, 0.35), named, 10.0)


def _purity(s: SparkSession, d: str) -> DataFrame:
    return speakers.purity(embedded(s, d), ["label"], "embedding", ["vec_id"]).select("vec_id", "off_speaker", F.round("speaker_distance", 6).alias("distance"))


def _centroids(s: SparkSession, d: str) -> DataFrame:
    c = speakers.mean_vectors(embedded(s, d), ["label"], "embedding")
    return c.select("label", F.posexplode("centroid").alias("dimension", "x")).withColumn("x", F.round("x", 6))


def _records(s: SparkSession, d: str) -> DataFrame:
    out = tables.record(table(s, d, "chunks").withColumn("text_source", F.coalesce("text_source", F.lit("none"))), table(s, d, "videos"))
    return out.select(*[F.col(c) for c in out.columns])


def _manifest(s: SparkSession, d: str) -> DataFrame:
    clips = unique_clips(s, d).withColumn("voice", F.coalesce(label_key(F.col("speaker")), "video_id"))
    refs = tables.drop_short_refs(sequence.assign_references(clips, F.col("voice"), [F.col("audio_file")]), 2.0)
    lines = tables.manifest_rows(refs, "audio/", T.clean_text(tables.pick_text("cohere")))
    kind = "struct<audio:string,text:string,duration:double,ref_audio:string,ref_duration:double,speaker:string,video_id:string>"
    return lines.select(F.from_json("value", kind).alias("line")).select("line.*")


def _references(s: SparkSession, d: str) -> DataFrame:
    clips = unique_clips(s, d).withColumn("voice", F.coalesce(label_key(F.col("speaker")), "video_id"))
    return sequence.assign_references(clips, F.col("voice"), [F.col("audio_file")]).select("audio_file", "ref_audio", "ref_duration")


def _train_validation(s: SparkSession, d: str) -> DataFrame:
    clips = unique_clips(s, d).withColumn("voice", F.coalesce(label_key(F.col("speaker")), "video_id"))
    return sequence.train_validation(clips, F.col("voice"), "audio_file", 0.1).select("audio_file", "split")


def _cues(s: SparkSession, d: str) -> DataFrame:
    stamp = lambda c: F.format_string("%02d:%02d:%02d.%03d", F.floor(c / 3_600_000), F.floor(c / 60_000) % 60, F.floor(c / 1000) % 60, c % 1000)
    spans = table(s, d, "chunks").select("video_id", "chunk_index", "text", coverage.clock(F.col("start")).alias("a"), coverage.clock(F.col("end")).alias("b"))
    content = F.concat(F.lit("WEBVTT\n\n"), stamp(F.col("a")), F.lit(" --> "), stamp(F.col("b")), F.lit("\n"), F.col("text"), F.lit("\n\n"))
    words = readers.caption_cues(spans.select(F.concat_ws("#", "video_id", "chunk_index").alias("video_id"), content.alias("content")))
    return words.groupBy("video_id").agg(F.count("*").alias("words"), F.max("pos").alias("last_pos"), coverage.clock(F.min("start")).alias("start_ms"), F.max("text").alias("last_text"))


def _events(s: SparkSession, d: str) -> DataFrame:
    spans = table(s, d, "chunks").select("video_id", "chunk_index", "text", coverage.clock(F.col("start")).alias("a"), coverage.clock(F.col("end")).alias("b"))
    seg = F.array(F.struct(F.col("text").alias("utf8"), F.lit(0).cast("long").alias("tOffsetMs")))
    event = F.array(F.struct(F.col("a").alias("tStartMs"), (F.col("b") - F.col("a")).alias("dDurationMs"), seg.alias("segs")))
    words = readers.caption_events(spans.select(F.concat_ws("#", "video_id", "chunk_index").alias("video_id"), F.to_json(F.struct(event.alias("events"))).alias("content")))
    return words.groupBy("video_id").agg(F.count("*").alias("words"), F.max("pos").alias("last_pos"), coverage.clock(F.min("start")).alias("start_ms"), coverage.clock(F.max("end")).alias("end_ms"))


def _predictions(s: SparkSession, d: str) -> DataFrame:
    clips = unique_clips(s, d).select("audio_file", F.coalesce("text", F.lit("")).alias("text"), "text_source", "boundary_clipped", "asr_language")
    uri = F.concat(F.lit("store://bucket/"), U.path_code(F.col("audio_file"), "batch"))
    answer = F.when(F.col("boundary_clipped"), "[{\"i\":5,\"text\":\"x\"}]").when(F.col("text_source") == "google", "no json").otherwise(F.to_json(F.array(F.struct(F.lit(1).alias("i"), F.col("text").alias("text")))))
    request = F.struct(F.array(F.struct(F.array(F.struct(F.struct(uri.alias("fileUri")).alias("fileData"))).alias("parts"))).alias("contents"))
    response = F.struct(F.array(F.struct(F.struct(F.array(F.struct(answer.alias("text"))).alias("parts")).alias("content"))).alias("candidates"))
    lines = clips.select(F.to_json(F.struct(request.alias("request"), F.when(F.col("asr_language") == "fr", "quota").otherwise("").alias("status"), response.alias("response"))).alias("value"))
    return gates.batch_entries(readers.prediction_batches(lines, "batch")).select("audio_file", "status")


def _state(s: SparkSession, d: str) -> DataFrame:
    states = unique_clips(s, d).groupBy("video_id").agg(F.count("*").alias("kept"), F.lit(0).cast("long").alias("rejected"), tables.total_seconds().alias("seconds_kept"), F.lit(True).alias("complete"))
    found = table(s, d, "videos").select(F.col("video_id").alias("source_id"))
    return readers.run_state(states, found)


def _outstanding(s: SparkSession, d: str) -> DataFrame:
    cache = table(s, d, "metadata").select("audio_file", F.when(F.col("squim_mos") >= 3, "ok").otherwise("low").alias("status"))
    return tables.outstanding(unique_clips(s, d).select("audio_file", "video_id"), cache)


def _diffs(s: SparkSession, d: str) -> DataFrame:
    clips = unique_clips(s, d)
    return tables.text_diffs(clips, clips.select("audio_file", F.col("text_cohere").alias("text"), F.when(F.col("text_cohere") != "", "ok").otherwise("empty").alias("status")))


def _overlay(s: SparkSession, d: str) -> DataFrame:
    clips = unique_clips(s, d)
    cache = clips.filter("text_source <> 'google'").select("audio_file", F.col("text_cohere").alias("text"), F.when(F.col("text_cohere") != "", "ok").otherwise("empty").alias("status"))
    return tables.overlay_text(clips, cache).groupBy("gate_status").agg(F.count("*").alias("rows"), F.count_if(F.col("text") == "").alias("empty"))


def _diacritized(s: SparkSession, d: str) -> DataFrame:
    clips = table(s, d, "chunks").select("video_id", "chunk_index", F.coalesce("text", F.lit("")).alias("text"), "text_cohere")
    return clips.select("video_id", "chunk_index", gates.diacritized_status(F.col("text"), F.col("text_cohere"), F.lit(None).cast("string"))["status"].alias("status"))


def _recognized(s: SparkSession, d: str) -> DataFrame:
    clips = table(s, d, "chunks").select("video_id", "chunk_index", "text", (F.col("end") - F.col("start")).alias("duration"))
    return inference.recognize(clips, "cohere").groupBy("result.status").agg(F.count("*").alias("rows"), F.count_if(F.col("result.value") == F.col("text")).alias("same"))


def _stand_ins(s: SparkSession, d: str) -> DataFrame:
    clips = unique_clips(s, d).select("audio_file", "video_id", "speaker", "duration")
    scored = clips.select("*", inference.stand_in_embedding("audio_file", "duration").alias("v"), inference.stand_in_scores("audio_file").alias("m"))
    return scored.select("audio_file", V.is_zero(F.col("v")).alias("too_short"), F.round(V.norm(F.col("v")), 6).alias("length"), "m.squim_mos")


def _stream(s: SparkSession, d: str, build: Callable[[DataFrame], DataFrame], name: str, key: str) -> DataFrame:
    """Closed windows of the whole events table, read as one batch and ended: append mode, so state goes with the watermark."""
    events = streams.increments(s, f"{d}/events.parquet*", table(s, d, "events").schema, None).select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    out = streams.collected(build(streams.ended(s, events, "ts")), name).filter(F.col(key).isNotNull())
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in out.dtypes if kind == "timestamp"})


def heard_words(s: SparkSession, d: str) -> DataFrame:
    """Caption words as recognized ones, with a score of eighths by their place."""
    return stream_words(s, d).withColumn("score", F.col("pos") % 8 / 8)


def clips_in_ms(s: SparkSession, d: str) -> DataFrame:
    """Current clips with times in whole milliseconds."""
    return unique_clips(s, d).select("audio_file", "video_id", "chunk_index", coverage.clock(F.col("start")).alias("start"), coverage.clock(F.col("end")).alias("end"), "text_cohere", "text_source", "asr_confidence", "aligned_words", "squim_stoi")


def _late(s: SparkSession, d: str) -> DataFrame:
    out = exports.late_transcripts(clips_in_ms(s, d), heard_words(s, d), width=60_000)
    return out.select("audio_file", "text_cohere", "text_source", "asr_confidence", "aligned_words")


def _two_stages(s: SparkSession, d: str) -> DataFrame:
    return exports.reference_of_batches(clips_in_ms(s, d), ["chunk_index", "audio_file"]).select("audio_file", "batch", "reference", "late")


def _cut_audio(s: SparkSession, d: str) -> DataFrame:
    v = embedded(s, d).select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"), (F.col("vec_id") % 7 / 8).alias("start"), (F.col("vec_id") % 11 / 8).alias("end"), F.when(F.col("vec_id") % 10 == 0, "quality:snr").alias("reject_code"))
    cut = exports.cut_audio(v, F.col("x"), F.lit(64), 48, F.lit(6.0))
    return cut.select("vec_id", "reject_code", F.size("audio").alias("samples"), F.round(F.get("audio", F.lit(0)), 6).alias("first"))


def _best_language(s: SparkSession, d: str) -> DataFrame:
    one = lambda lang, text, conf: F.struct(F.lit(lang).alias("language"), F.col(text).alias("text"), F.when(~F.isnan(conf), F.col(conf)).alias("confidence"))
    best = exports.best_language(F.array(one("ar", "text_yt", "align_score"), one("en", "text", "asr_confidence"), one("fr", "text_cohere", "asr_confidence")))
    return table(s, d, "chunks").select("video_id", "chunk_index", best.alias("b")).select("video_id", "chunk_index", "b.*")


def _flag_report(s: SparkSession, d: str) -> DataFrame:
    clips = unique_clips(s, d).select("audio_file", "video_id", "speaker", "text", F.coalesce("asr_language", F.lit("unclear")).alias("dialect"), F.nanvl("asr_confidence", F.lit(0.0)).alias("sure"))
    out = exports.flag_report(clips, ["video_id", "speaker"], "dialect", "sure", "audio_file", ["studio", "signal", "archive", "clip", "guest"], ["ar", "unclear"])
    tally = F.array_join(F.transform(F.map_entries("flag_speaker_votes"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), " ")
    return out.select("audio_file", "flag_dialect", "flag_confidence", "flag_basis", "flag_clip_dialect", "flag_clip_confidence", "flag_speaker_dialect", tally.alias("flag_speaker_votes"), F.array_join("flag_lexical_markers", " ").alias("flag_lexical_markers"), "place")


def _results(s: SparkSession, d: str) -> DataFrame:
    return exports.video_results(unique_clips(s, d), table(s, d, "chunks").filter("reject_code IS NOT NULL"), table(s, d, "videos"))


def _video_results(s: SparkSession, d: str) -> DataFrame:
    reasons = F.array_join(F.transform(F.map_entries("reasons"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), " ")
    return _results(s, d).withColumn("reasons", reasons)


def linked(s: SparkSession, d: str) -> DataFrame:
    """A global speaker for each speaker whose name's hash begins with a digit."""
    voices = table(s, d, "metadata").select("speaker").filter("speaker IS NOT NULL").distinct()
    return voices.withColumn("h", F.md5("speaker")).filter(F.col("h").rlike("^[0-9]")).select("speaker", F.concat(F.lit("GLOBAL_SPEAKER_0"), F.substring("h", 1, 1)).alias("global_speaker"))


def _replaced(s: SparkSession, d: str) -> DataFrame:
    rows = unique_clips(s, d)
    cache = rows.filter("text_source <> 'google'").select("audio_file", F.col("text_cohere").alias("text"), F.when(F.col("text_cohere") != "", "ok").otherwise("empty").alias("status"))
    updated, gone, diffs, report = exports.replaced_texts(rows, rows.filter("boundary_clipped IS NULL OR NOT boundary_clipped"), cache)
    path = scratch(s, "replaced")
    for _ in range(2):
        writers.write_retranscribed(path, rows.select("audio_file", "text"), updated.select("audio_file", "text"), gone.select("audio_file"), diffs, report)
    counted = lambda part, df: df.agg(F.lit(part).alias("part"), F.count("*").alias("rows"))
    at = lambda name: writers.VersionedTable(s, f"{path}/{name}").read()
    out = counted("before", s.read.parquet(f"{path}/before"))
    for name in ("metadata", "orphans", "diffs"):
        out = out.unionByName(counted(name, at(name)))
    return out.unionByName(report.select(F.lit("report").alias("part"), F.col("transcripts_identical").alias("rows")))


def _written_split(s: SparkSession, d: str) -> DataFrame:
    rows, kept, rejected = table(s, d, "chunks").select("video_id", "chunk_index", "reject_code", "reject_value"), scratch(s, "kept"), scratch(s, "rejected")
    # judged twice: at first all are kept but those of a text that is missing, then by their reason
    writers.write_split(rows.withColumn("reject_code", F.when(F.col("reject_code") == "text:empty", "x")), kept, rejected)
    writers.write_split(rows, kept, rejected)
    part = lambda path, name: s.read.parquet(path).groupBy("video_id").agg(F.count("*").alias("rows")).withColumn("part", F.lit(name))
    return part(kept, "kept").unionByName(part(rejected, "rejected"))


def _versioned(s: SparkSession, d: str) -> DataFrame:
    store = writers.VersionedTable(s, scratch(s, "versions"))
    store.replace(table(s, d, "chunks").select("video_id", "chunk_index", "text"))
    store.replace(store.read().filter("text <> ''"))
    return store.read()


def _failed(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s, "failed")
    if not writers.write_failed(table(s, d, "videos").select(F.col("video_url").alias("url"), "error"), path):
        return s.createDataFrame([], "spec string")
    return readers.read_specs(s, path).select("spec")


def _jsonl(s: SparkSession, d: str) -> DataFrame:
    path, rows = scratch(s, "lines"), table(s, d, "chunks").select("video_id", "chunk_index", "text")
    for _ in range(2):
        writers.append_lines(rows, path)
    return readers.read_jsonl(s, path, "video_id string, chunk_index int, text string")


def _cache_lines(s: SparkSession, d: str) -> DataFrame:
    path, clips = scratch(s, "cache"), unique_clips(s, d)
    clips.select("audio_file", F.lit("error").alias("status")).write.json(f"{path}/pass=1")
    clips.filter("text_source = 'cohere'").select("audio_file", F.lit("ok").alias("status")).write.json(f"{path}/pass=2")
    s.createDataFrame([('{"audio_file": "torn', ), ("", )], "value string").write.text(f"{path}/pass=3")
    return readers.read_cache(s, path, "audio_file string, status string")


def _word_cache(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s, "words")
    writers.write_word_cache(stream_words(s, d).select("video_id", "pos", "text", (F.col("start") / 1000 + 0.0001).alias("start"), (F.col("end") / 1000).alias("end"), (F.col("pos") % 8 / 8).alias("score")), path)
    return readers.read_word_cache(s, path).select("video_id", "pos", "text", coverage.clock(F.col("start")).alias("start"), coverage.clock(F.col("end")).alias("end"), "score")


def _diarization(s: SparkSession, d: str) -> DataFrame:
    turn = F.struct((F.col("start") / 1000).alias("start"), (F.col("end") / 1000).alias("end"), "speaker")
    content = millis(s, d).groupBy("video_id").agg(F.to_json(F.struct(F.sort_array(F.collect_list(turn)).alias("turns"))).alias("content"))
    turns, _ = readers.diarization_turns(content)
    return turns.select("video_id", coverage.clock(F.col("start")).alias("start"), coverage.clock(F.col("end")).alias("end"), "speaker")


def _listing(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "videos").select("video_id", "title", F.concat(F.lit("channel:"), "channel").alias("channel"))
    below = v.select(F.coalesce("channel", F.lit("root")).alias("parent"), F.col("video_id").alias("child"), F.lit(True).alias("is_video"), "title")
    lists = v.filter("channel IS NOT NULL").select(F.lit("root").alias("parent"), F.col("channel").alias("child"), F.lit(False).alias("is_video"), F.col("channel").alias("title")).distinct()
    listing = below.unionByName(lists).select("*", F.pmod(F.xxhash64("child"), F.lit(1_000_000)).cast("int").alias("position"), F.lit(None).cast("string").alias("live_status"))
    return readers.expand_listing(s, s.createDataFrame([("root", 0)], "spec string, ordinal long"), listing).select("spec", "depth")


def _tracks(s: SparkSession, d: str) -> DataFrame:
    offered = F.when(F.col("lang").isNotNull(), F.array("lang")).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    track = readers.choose_track(F.when(F.col("kind") == "caption", offered).otherwise(none), offered, ["ar*", "en"])
    return table(s, d, "documents").select("doc_id", track.alias("t")).select("doc_id", "t.lang", "t.kind")


def _newest(s: SparkSession, d: str) -> DataFrame:
    files = table(s, d, "documents").filter("video_id IS NOT NULL AND crawled_at IS NOT NULL").select("video_id", F.concat(F.col("doc_id").cast("string"), F.lit("."), F.coalesce("lang", F.lit("und")), F.when(F.col("doc_id") % 2 == 0, ".json3").otherwise(".vtt")).alias("path"), F.col("crawled_at").cast("timestamp").alias("modified"))
    return readers.newest_file(files, "video_id", ["ar", "en"])


def _stream_commits(s: SparkSession, d: str) -> DataFrame:
    path, kind = scratch(s, "committed"), table(s, d, "chunks").schema
    for n in range(2):  # a second run from the start replaces what the first one wrote
        streams.commit_videos(streams.increments(s, f"{d}/chunks.parquet*", kind, None), path, scratch(s, f"progress{n}"))
    return s.read.parquet(path).groupBy("video_id").agg(F.count("*").alias("chunks"))


def _first_arrivals(s: SparkSession, d: str) -> DataFrame:
    events = streams.increments(s, f"{d}/events.parquet*", table(s, d, "events").schema, None).withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.collected(streams.first_arrivals(events.select("user_id", "ts"), "user_id", "ts"), "arrivals").select("user_id")


def _shard_names(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "lineitem").select("l_linestatus", "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("long").alias("bytes"))
    shards = sequence.shards_after_reach(rows, ["l_linestatus"], ["l_orderkey", "l_linenumber", "bytes"], "bytes", 5_000_000).groupBy("l_linestatus", "shard").agg(F.count("*").alias("rows"))
    return shards.select(exports.numbered_shards(shards, "l_linestatus", "shard").alias("name"), "rows")


def _commit_batches(s: SparkSession, d: str) -> DataFrame:
    files = table(s, d, "orders").select(F.col("o_orderpriority").alias("folder"), F.format_string("%012d", "o_orderkey").alias("path"), F.col("o_totalprice").cast("long").alias("bytes"))
    return writers.commit_batches(files, 40, 4_000_000).groupBy("folder", "batch").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def _overlay_marks(s: SparkSession, d: str) -> DataFrame:
    clips = unique_clips(s, d).select("audio_file", "text", "text_source", "text_yt", "text_cohere")
    verdicts = clips.select("audio_file", F.col("text_cohere").alias("text"), F.when(F.col("text_source") == "cohere", "ok").when(F.col("text_yt") == F.col("text"), "ok_orthography_fixed").otherwise("words_changed").alias("status"))
    return tables.overlay_marks(clips.drop("text_yt", "text_cohere"), verdicts)


def _label_runs(s: SparkSession, d: str) -> DataFrame:
    path, scores = F.transform("embedding", lambda x: F.when(x > 0.1, 2).when(x > 0, 1).otherwise(0)), F.transform("embedding", lambda x: x.cast("double"))
    runs = table(s, d, "embeddings").select("vec_id", path.alias("path"), scores.alias("scores")).select("vec_id", F.explode(intervals.label_runs(F.col("path"), F.col("scores"), 0)).alias("r"))
    return runs.select("vec_id", F.col("r.start").alias("first"), F.col("r.end").alias("until"), "r.label", F.round("r.score", 6).alias("score"))


def _means(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.when(x > 0, x.cast("double")).when(x > -0.05, F.lit(0.0))).alias("x"), F.transform("embedding", lambda x: x.cast("double")).alias("y"), F.sequence(F.lit(0), F.size("embedding") - 1).alias("k"))
    tokens = F.transform("k", lambda k: k % 5)
    return v.select("vec_id", F.round(V.nonzero_mean(F.col("x")), 6).alias("mean"), F.round(V.mean_log_prob(F.col("y"), tokens, [0, 3]), 6).alias("confidence"))


def _wav(s: SparkSession, d: str) -> DataFrame:
    v = table(s, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * 4).alias("x"))
    files = v.select("vec_id", wav_bytes_udf("x", F.lit(64)).alias("content"))
    cut = files.select("vec_id", wav_seconds_udf("content").alias("seconds"), wav_samples_udf("content", F.lit(0.25), F.lit(0.75)).alias("part"))
    return cut.select("vec_id", "seconds", F.size("part").alias("samples"), F.round(F.get("part", F.lit(0)), 6).alias("first"))


def _feed(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s, "feed")
    safe = lambda c: F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    enclosure = F.when(F.col("video_url").isNotNull(), F.concat(F.lit('<enclosure length="7" url="'), safe("video_url"), F.lit('"/>'))).otherwise("")
    item = F.concat(F.lit("<item>"), F.coalesce(F.concat(F.lit("<title>"), safe("title"), F.lit("</title>")), F.lit("")), F.lit("<guid>"), safe("video_id"), F.lit("</guid>"), enclosure, F.lit("</item>"))
    edges = s.createDataFrame([("<rss><channel>", 0), ("</channel></rss>", 2)], "value string, o int")
    lines = table(s, d, "videos").select(item.alias("value"), F.lit(1).alias("o")).unionByName(edges)
    lines.repartition(1).sortWithinPartitions("o").select("value").write.text(path)  # a feed is one document
    return readers.read_feed(s, path).select("guid", F.trim("title").alias("title"), "url", "length")


def queries() -> dict[str, Query]:
    """Name to query."""
    t = table
    return {
        "p1_found": lambda s, d: coverage.speaking_periods(t(s, d, "turns")),
        # gates
        "q_gate_reasons": _gate_reasons,
        "q_resolve_text": _resolve,
        "q_row_gates": lambda s, d: gates.row_gates(unique_clips(s, d)).select("audio_file", "reject_code"),
        "q_quality_gates": lambda s, d: gates.apply(unique_clips(s, d), gates.quality_cascade()).select("audio_file", "reject_code", "reject_value"),
        "q_music_gates": lambda s, d: gates.apply(unique_clips(s, d), gates.music_cascade(Limits(reject_music=True))).select("audio_file", "reject_code"),
        "q_export_rows": lambda s, d: gates.summarize(gates.apply(unique_clips(s, d).withColumn("duration", F.nanvl("duration", F.lit(None))), gates.export_cascade(T.squeeze(T.present(F.col("text")))))),
        "q_rejection_summary": lambda s, d: tables.with_share(gates.summarize(t(s, d, "chunks")), "rows"),
        "q_diacritized_status": _diacritized,
        "q_prediction_entries": _predictions,
        # text
        "q_script_ratios": lambda s, d: t(s, d, "chunks").select("video_id", "chunk_index", T.arabic_ratio(F.col("text")).alias("arabic"), T.latin_ratio(F.col("text")).alias("latin"), T.script_ratio(F.col("text"), F.coalesce("asr_language", F.lit("ar"))).alias("script")),
        "q_clean_output": lambda s, d: t(s, d, "chunks").select("video_id", "chunk_index", T.clean_for_output(F.col("text_yt")).alias("clean")),
        "q_clean_text": lambda s, d: t(s, d, "documents").select("doc_id", T.clean_text(F.col("text")).alias("clean")),
        "q_normalize": lambda s, d: t(s, d, "documents").select("doc_id", T.normalize(F.col("text")).alias("normal")),
        "q_vowel_marks": lambda s, d: t(s, d, "documents").select("doc_id", T.has_marks(F.col("text")).alias("has"), T.marks_ratio(F.col("text")).alias("ratio"), T.strip_marks(F.col("text")).alias("bare"), T.strip_final_marks(F.col("text")).alias("without_final")),
        "q_error_rates": _error_rates,
        "q_alignment_words": lambda s, d: t(s, d, "chunks").select("video_id", "chunk_index", T.alignment_words(F.col("text_yt")).alias("words")),
        "q_markers": lambda s, d: t(s, d, "chunks").select("video_id", "chunk_index", F.array_join(T.lexical_markers(F.lower(F.col("text")), ["studio", "signal", "archive", "clip", "guest"]), " ").alias("markers")),
        "q_markup": lambda s, d: t(s, d, "documents").select("doc_id", T.strip_tags(T.present(F.col("text"))).alias("bare")),
        "q_prompts": lambda s, d: t(s, d, "videos").select("video_id", T.fill_template("Transcribe {title} ({lang}).", title=F.coalesce("title", F.lit("?")), lang=F.coalesce("language", F.lit("ar"))).alias("prompt")),
        # sources
        "q_url_ids": lambda s, d: t(s, d, "videos").select("video_id", U.source_id(F.col("video_url"), *HOSTS).alias("source_id"), U.is_local(F.col("video_url")).alias("is_local")),
        "q_source_table": lambda s, d: readers.source_table(readers.source_specs(t(s, d, "videos").filter("video_url IS NOT NULL").select(F.col("video_url").alias("value"), F.col("video_id").alias("ordinal"))), *HOSTS),
        "q_natural_order": lambda s, d: t(s, d, "part").select("p_partkey", U.natural_key(F.col("p_name")).alias("key")),
        "q_path_codes": lambda s, d: t(s, d, "metadata").select(F.col("audio_file"), U.path_code(F.col("audio_file"), "batch").alias("code"), U.path_decode(U.path_code(F.col("audio_file"), "batch"), "batch").alias("back")),
        "q_permanent_errors": lambda s, d: t(s, d, "videos").groupBy(U.is_permanent_error(F.col("error")).alias("permanent"), F.col("error").isNull().alias("fine")).agg(F.count("*").alias("videos")),
        "q_locales": lambda s, d: t(s, d, "documents").groupBy(U.short_locale(F.coalesce("lang", F.lit("und"))).alias("language")).agg(F.count("*").alias("documents")),
        "q_caption_cues": _cues,
        "q_caption_events": _events,
        "q_run_state": _state,
        "q_pending_sources": lambda s, d: readers.pending_sources(t(s, d, "chunks").groupBy("video_id").agg(F.count_if("boundary_clipped").alias("n")).select("video_id", (F.col("n") == 0).alias("complete")), t(s, d, "videos").select(F.col("video_id").alias("source_id"))),
        # intervals and words
        "q_merge_gap": lambda s, d: intervals.merge_same_speaker(disjoint(s, d), 300),
        "q_overlap_sweep": lambda s, d: intervals.overlapped_speech(millis(s, d), 1, 0, 60_000),
        "q_subtract": lambda s, d: intervals.subtract(chunk_spans(s, d), intervals.overlapped_speech(millis(s, d), 1, 0, 60_000), 60_000),
        "q_clip_to": lambda s, d: intervals.clip_to(chunk_spans(s, d), F.lit(60_000), F.lit(600_000)),
        "q_cut_at_turns": lambda s, d: intervals.cut_at_turns(chunk_spans(s, d), millis(s, d), 0.5, 60_000),
        "q_dominant_speaker": _dominant,
        "q_assign_speakers": lambda s, d: intervals.assign_speakers(chunk_spans(s, d), millis(s, d), width=60_000).select("video_id", "start", "end", "speaker"),
        "q_own_words": _own_words,
        "q_plan_windows": lambda s, d: intervals.plan_windows(t(s, d, "sub_words"), 30.0),
        "q_fill_ends": lambda s, d: intervals.fill_ends(stream_words(s, d)),
        "q_pad_filter": lambda s, d: intervals.pad_and_filter(chunk_spans(s, d).drop("chunk_index"), 200, 2000, 12000),
        "q_build_chunks": _build,
        "q_collapse_dominant": lambda s, d: intervals.collapse_dominant(millis(s, d), 0.6).groupBy("video_id", "speaker").agg(F.count("*").alias("turns")),
        "q_dedupe_time": lambda s, d: sequence.dedupe_by_time(stream_words(s, d), 60),
        "q_dedupe_rolling": lambda s, d: sequence.dedupe_rolling(stream_words(s, d)),
        "q_dedupe_track": lambda s, d: sequence.dedupe_track(stream_words(s, d).withColumn("word_timed", F.col("kind") == "yt_auto"), 60),
        # voices
        "q_centroids": _centroids,
        "q_purity": _purity,
        "q_link_speakers": _link,
        "q_votes": lambda s, d: _votes(s, d).drop("tally"),
        "q_flags": _flags,
        "q_namespaced": lambda s, d: millis(s, d).select(intervals.namespaced(F.col("video_id"), F.col("speaker")).alias("speaker")).distinct(),
        # records, caches, reports, exports
        "q_cache_last_wins": lambda s, d: unique_clips(s, d).select("audio_file", "video_id", "chunk_index", "text", "emitted_at"),
        "q_first_seen": lambda s, d: tables.first_seen(t(s, d, "metadata"), "speaker", "audio_file"),
        "q_outstanding": _outstanding,
        "q_live": lambda s, d: tables.live(t(s, d, "chunks").select("video_id", "chunk_index"), t(s, d, "metadata").select("video_id").distinct(), "video_id"),
        "q_orphans": lambda s, d: tables.orphans(t(s, d, "documents").select("doc_id", "video_id"), t(s, d, "videos"), "video_id"),
        "q_text_diffs": _diffs,
        "q_overlay": _overlay,
        "q_records": _records,
        "q_merge_rejections": lambda s, d: tables.merge_rejections(t(s, d, "chunks").filter("reject_code IS NOT NULL").select("video_id", "chunk_index", "reject_code"), t(s, d, "chunks").filter("text_yt = ''").select("video_id", "chunk_index", F.lit("text:empty").alias("reject_code"))),
        "q_drop_videos": lambda s, d: tables.delete_keys(t(s, d, "chunks"), t(s, d, "videos").filter("error IS NOT NULL"), "video_id").groupBy("video_id").agg(F.count("*").alias("chunks")),
        "q_speaker_seconds": lambda s, d: tables.seconds_by(unique_clips(s, d), "speaker"),
        "q_source_share": lambda s, d: tables.with_share(unique_clips(s, d).groupBy("text_source").agg(F.count("*").alias("clips")), "clips"),
        "q_totals": lambda s, d: tables.totals(unique_clips(s, d), t(s, d, "chunks").filter("reject_code IS NOT NULL")),
        "q_top_speakers": lambda s, d: tables.top_with_rest(tables.seconds_by(unique_clips(s, d).filter("speaker IS NOT NULL"), "speaker"), "speaker", "seconds", 15),
        "q_speaker_summary": lambda s, d: tables.speaker_summary(unique_clips(s, d).withColumn("voice", label_key(F.col("speaker"))).filter("voice IS NOT NULL"), "voice"),
        "q_billable": lambda s, d: unique_clips(s, d).agg(F.sum(tables.billable_seconds(F.col("duration")).cast("long")).alias("billable"), tables.estimated_cost(tables.total_seconds(), 0.016).alias("cost"), exports.token_estimate(tables.total_seconds()).alias("million_tokens")),
        "q_export_stats": lambda s, d: tables.export_stats(unique_clips(s, d)),
        "q_references": _references,
        "q_train_validation": _train_validation,
        "q_manifest": _manifest,
        "q_regrouped_paths": lambda s, d: t(s, d, "metadata").select("audio_file", tables.regrouped_path(F.col("speaker"), F.col("audio_file")).alias("path")).distinct(),
        "q_shards": lambda s, d: sequence.shards_after_reach(t(s, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("long").alias("bytes")), ["l_returnflag"], ["l_orderkey", "l_linenumber", "bytes"], "bytes", 5_000_000).groupBy("l_returnflag", "shard").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows")),
        "q_batches": lambda s, d: sequence.batches_before_exceed(chunk_spans(s, d).select("video_id", "chunk_index", (F.col("end") - F.col("start")).alias("ms")), ["video_id"], ["chunk_index"], "ms", 20_000, 4),
        "q_fixed_batches": lambda s, d: sequence.fixed_batches(t(s, d, "chunks").select("video_id", "chunk_index"), ["video_id"], [F.col("chunk_index")], 8),
        "q_slice_rows": lambda s, d: tables.slice_rows(t(s, d, "documents").select("doc_id"), "doc_id", 100, 5000),
        # models
        "q_recognized": _recognized,
        "q_stand_ins": _stand_ins,
        "q_reference_clips": lambda s, d: inference.reference_clip(unique_clips(s, d)),
        "q_single_speaker": lambda s, d: inference.diarized_or_single(millis(s, d), t(s, d, "videos").select("video_id", F.lit(1000).alias("duration"))).groupBy("video_id").agg(F.count("*").alias("turns"), F.count_if(F.col("speaker") == "SPEAKER_00").alias("given")),
        "q_signal_stats": lambda s, d: t(s, d, "embeddings").select("vec_id", signal_stats_udf(F.transform("embedding", lambda x: x.cast("double")), F.lit(8)).alias("s")).select("vec_id", "s.peak_dbfs", "s.rms_dbfs", "s.clipping_ratio", "s.snr_db"),
        "q_best_label": lambda s, d: unique_clips(s, d).select("audio_file", V.best(F.array(F.struct(F.lit("music").alias("label"), "music_score"), F.struct(F.lit("speech").alias("label"), F.col("speech_score").alias("music_score"))), lambda x: F.coalesce(F.nanvl(x["music_score"], F.lit(-1.0)), F.lit(-1.0)))["label"].alias("label")),
        # streams
        "q_stream_sessions": lambda s, d: _stream(s, d, lambda e: streams.gap_sessions(e, "user_id", "ts", "6 hours"), "sessions", "user_id"),
        "q_stream_dedupe": lambda s, d: streams.collected(streams.dedupe_stream(streams.increments(s, f"{d}/events.parquet*", t(s, d, "events").schema, None).select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("at")).withWatermark("ts", "10 minutes"), ["user_id", "event_type"], "at", "ts", 3.6e9), "kept").select("event_id", "user_id"),
        "q_stream_windows": lambda s, d: _stream(s, d, lambda e: streams.tumbling(e, ["event_type"], "ts", "15 minutes"), "windows", "event_type"),
        # datasets: late transcripts, scores, audio, sinks read back
        "q_late_transcripts": _late,
        "q_two_stage_scores": _two_stages,
        "q_cut_audio": _cut_audio,
        "q_best_language": _best_language,
        "q_flag_report": _flag_report,
        "q_marks_report": lambda s, d: exports.marks_report(t(s, d, "documents")),
        "q_run_summary": lambda s, d: exports.run_summary(_results(s, d)),
        "q_video_results": _video_results,
        "q_speaker_document": lambda s, d: exports.speaker_document(unique_clips(s, d), linked(s, d)),
        "q_global_speakers": lambda s, d: exports.with_global_speakers(unique_clips(s, d).select("audio_file", "speaker", "global_speaker"), linked(s, d), t(s, d, "metadata").filter("text <> ''").select("audio_file")),
        "q_replaced_texts": _replaced,
        "q_centroid_union": lambda s, d: readers.centroid_union(embedded(s, d).select((F.col("vec_id") % 97).alias("speaker"), F.col("vec_id").alias("file"), F.get("embedding", F.lit(0)).alias("first"))),
        "q_written_split": _written_split,
        "q_versioned": _versioned,
        "q_failed_list": _failed,
        "q_jsonl": _jsonl,
        "q_cache_lines": _cache_lines,
        "q_word_cache": _word_cache,
        "q_diarization": _diarization,
        "q_listing": _listing,
        "q_tracks": _tracks,
        "q_newest_file": _newest,
        "q_stream_commits": _stream_commits,
        "q_first_arrivals": _first_arrivals,
        "q_retry_queue": lambda s, d: streams.retry_queue(unique_clips(s, d).select("audio_file", "video_id"), t(s, d, "metadata").select("audio_file", F.when(F.col("squim_mos") >= 3, "ok").otherwise("low").alias("status"))),
        "q_shard_names": _shard_names,
        "q_commit_batches": _commit_batches,
        "q_to_upload": lambda s, d: writers.to_upload(t(s, d, "chunks").select(F.concat_ws("/", "video_id", "chunk_index").alias("path")), t(s, d, "metadata").select(F.concat_ws("/", "video_id", "chunk_index").alias("path"))),
        "q_status_counts": lambda s, d: tables.status_counts(unique_clips(s, d), unique_clips(s, d).filter("text_source <> 'google'").select("audio_file", F.when(F.col("text_cohere") != "", "ok").otherwise("empty").alias("status"))),
        "q_overlay_marks": _overlay_marks,
        "q_outstanding_first": lambda s, d: tables.outstanding(unique_clips(s, d).select("audio_file", "video_id"), t(s, d, "metadata").select("audio_file", F.when(F.col("squim_mos") >= 3, "ok").otherwise("low").alias("status")), limit=25),
        "q_label_runs": _label_runs,
        "q_vector_means": _means,
        "q_wav": _wav,
        "q_feed": _feed,
    }
