"""Readers: source lists, listings, captions, caches, feeds, predictions, state. Schemas are always given."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from voxloom.functions import sources as U
from voxloom.functions import text as T
from voxloom.operators.ranking import range_ranked
from voxloom.operators.tables import last_wins

CUE_EVENTS = "struct<events:array<struct<tStartMs:bigint,dDurationMs:bigint,segs:array<struct<utf8:string,tOffsetMs:bigint>>>>>"
DIARIZATION = "struct<turns:array<struct<start:double,end:double,speaker:string>>,overlaps:array<struct<start:double,end:double>>>"
WORD_CACHE = "array<struct<t:string,s:double,e:double,c:double>>"


def source_specs(lines: DataFrame, column: str = "value", ordinal: str = "ordinal") -> DataFrame:
    """Specs of a text source in order: trimmed, without blank lines and ``#`` comments, each once at its first place.

    ``ordinal`` is the line's number; it must come with the lines.
    """
    spec = T.squeeze(F.col(column))
    return lines.select(spec.alias("spec"), ordinal).filter((F.col("spec") != "") & ~F.col("spec").startswith("#")).groupBy("spec").agg(F.min(ordinal).alias(ordinal))


def read_specs(spark: SparkSession, path: str) -> DataFrame:
    """``source_specs`` of a file of any size; a missing file is an error."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("ordinal"))
    return source_specs(lines)


def source_table(specs: DataFrame, hosts: tuple[str, ...], short_hosts: tuple[str, ...]) -> DataFrame:
    """``(spec, source_id, is_local, ordinal)``, places numbered with local sources ahead of remote ones."""
    local = U.is_local(F.col("spec"))
    named = specs.select("spec", U.source_id(F.col("spec"), hosts, short_hosts).alias("source_id"), local.alias("is_local"), F.col("ordinal").alias("line"))
    return range_ranked(named, [], [(~F.col("is_local")).cast("int"), F.col("line")], "ordinal").select("spec", "source_id", "is_local", (F.col("ordinal") - 1).alias("ordinal"))


def expand_listing(spark: SparkSession, specs: DataFrame, listing: DataFrame, max_depth: int = 2) -> DataFrame:
    """Videos below containers, breadth first to ``max_depth``, each once at its first place: ``(spec, depth, path)``.

    ``listing`` has ``parent``, ``child``, ``position``, ``is_video``, ``title`` and ``live_status``; entries without
    child, placeholders and live or coming streams don't count.  Each level is one join, so cycles end with the depth.
    """
    usable = listing.filter(F.col("child").isNotNull() & ~F.coalesce(F.col("live_status"), F.lit("")).isin("is_live", "is_upcoming") & ~F.lower(F.trim(F.coalesce(F.col("title"), F.lit("")))).isin(*U.DEAD_TITLES))
    level = specs.select("spec", F.array(F.col("ordinal").cast("long")).alias("path"), F.lit(0).alias("depth"))
    containers = usable.select(F.col("parent").alias("spec")).distinct().withColumn("holds", F.lit(True))
    found = []
    for depth in range(max_depth + 1):
        known = level.join(containers, "spec", "left")
        found.append(known.filter("holds IS NULL").drop("holds"))
        if depth < max_depth:
            below = known.filter("holds").select(F.col("spec").alias("parent"), "path").join(usable.select("parent", "child", "position"), "parent")
            level = below.select(F.col("child").alias("spec"), F.concat("path", F.array(F.col("position").cast("long"))).alias("path"), F.lit(depth + 1).alias("depth"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("spec").agg(F.min(F.struct("depth", "path")).alias("first")).select("spec", "first.depth", "first.path")


def local_files(spark: SparkSession, folder: str) -> DataFrame:
    """Audio files of a folder, not below it: ``(path, length, key)``, ``key`` being their natural order."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    return files.filter(U.is_audio(F.col("path"))).withColumn("key", U.natural_key(F.substring_index("path", "/", -1)))


def choose_track(manual: Column, automatic: Column, patterns: list[str], prefer_manual: bool = True) -> Column:
    """Language and kind of the caption track: ``struct(lang, kind)``; null without any."""
    m, a = U.preferred_language(manual, patterns), U.preferred_language(automatic, patterns)
    track = lambda lang, kind: F.when(lang.isNotNull(), F.struct(lang.alias("lang"), F.lit(kind).alias("kind")))
    first, second = track(m, "yt_manual"), track(a, "yt_auto")
    return F.coalesce(first, second) if prefer_manual else F.coalesce(second, first)


def newest_file(files: DataFrame, key: str, languages: list[str] = (), suffix: str = ".json3") -> DataFrame:
    """One file per key: of a listed language first, then ``suffix``, then the newest, then by path."""
    rank = F.lit(len(languages))
    for i, lang in reversed(list(enumerate(languages))):
        rank = F.when(F.col("path").contains(f".{lang}."), i).otherwise(rank)
    best = F.min(F.struct(rank.alias("r"), (~F.col("path").endswith(suffix)).cast("int").alias("s"), (-F.unix_micros("modified")).alias("m"), F.col("path")))
    return files.groupBy(key).agg(best.alias("b")).select(key, "b.path")


def caption_events(captions: DataFrame) -> DataFrame:
    """Words of event captions (``video_id``, ``content`` as JSON): ``(video_id, pos, text, start, end, word_timed)``.

    Words start at their segment; the last word of an event ends with it, others where the next word starts.  A track
    has word times if any offset isn't 0.  Malformed content has no words.
    """
    parsed = captions.select("video_id", F.from_json("content", CUE_EVENTS).alias("c")).select("video_id", F.posexplode("c.events").alias("e", "event")).filter("event.tStartMs IS NOT NULL")
    segs = parsed.select("video_id", "e", "event.tStartMs", "event.dDurationMs", F.posexplode("event.segs").alias("g", "seg")).filter(F.trim("seg.utf8") != "")
    words = segs.select("video_id", "e", "g", "tStartMs", "dDurationMs", F.coalesce("seg.tOffsetMs", F.lit(0)).alias("offset"), F.posexplode(T.words(F.col("seg.utf8"))).alias("w", "text"))
    by_video = Window.partitionBy("video_id").orderBy("e", "g", "w")
    start = (F.col("tStartMs") + F.col("offset")) / 1000
    last = F.lead("e").over(by_video).isNull() | (F.lead("e").over(by_video) != F.col("e"))
    timed = words.select("video_id", "e", "g", "w", "text", start.alias("start"), F.when(last & (F.coalesce("dDurationMs", F.lit(0)) > 0), F.greatest(start, (F.col("tStartMs") + F.col("dDurationMs")) / 1000)).otherwise(start).alias("end"), (F.col("offset") != 0).alias("timed"))
    filled = timed.withColumns({"pos": F.row_number().over(by_video) - 1, "end": F.when(F.col("end") > F.col("start"), F.col("end")).otherwise(F.greatest("start", F.coalesce(F.lead("start").over(by_video), "start"))), "word_timed": F.bool_or("timed").over(Window.partitionBy("video_id"))})
    return filled.select("video_id", "pos", "text", "start", "end", "word_timed")


_CUE = r"(\d{1,2}:\d{2}:\d{2}[.,]\d{3})[ \t]*-->[ \t]*(\d{1,2}:\d{2}:\d{2}[.,]\d{3})[^\n]*\n"


def caption_cues(captions: DataFrame) -> DataFrame:
    """Words of cue captions (``video_id``, ``content`` as WebVTT or SRT), like ``caption_events``.

    Cues with inline times start words there; others spread their words evenly over the cue.  Entities are decoded and
    tags dropped.
    """
    plain = F.regexp_replace(T.present(F.col("content")), r"\r\n?", "\n")
    # cut ahead of each cue's times; what precedes the first is the header
    cut = captions.select("video_id", F.posexplode(F.split(plain, r"(?=(?:^|(?<=\n))\d{1,2}:\d{2}:\d{2}[.,]\d{3}[ \t]*-->)")).alias("c", "cue"))
    found = cut.filter(F.col("cue").rlike("^" + _CUE)).select("video_id", "c", T.clock_seconds(F.regexp_extract("cue", _CUE, 1)).alias("from"), T.clock_seconds(F.regexp_extract("cue", _CUE, 2)).alias("to"), T.unescape(F.regexp_extract(F.regexp_replace("cue", "^" + _CUE, ""), r"(?s)^(.*?)(?:\n\s*\n.*)?$", 1)).alias("body"))
    inline = F.col("body").rlike(r"<\d{1,2}:\d{2}:\d{2}[.,]\d{3}>")
    pieces = F.split(F.col("body"), r"(?=<\d{1,2}:\d{2}:\d{2}[.,]\d{3}>)")
    spread = found.select("video_id", "c", "from", "to", inline.alias("timed"), F.posexplode(pieces).alias("p", "piece"))
    start = F.coalesce(T.clock_seconds(F.regexp_extract("piece", r"^<(\d{1,2}:\d{2}:\d{2}[.,]\d{3})>", 1)), F.col("from"))
    tokens = T.words(T.strip_tags(F.regexp_replace("piece", r"^<\d[^>]*>", "")))
    words = spread.select("video_id", "c", "p", "from", "to", "timed", start.alias("at"), F.size(tokens).alias("n"), F.posexplode(tokens).alias("w", "text"))
    by_video = Window.partitionBy("video_id").orderBy("c", "p", "w")
    step = (F.col("to") - F.col("from")) / F.col("n")
    last = F.lead("c").over(by_video).isNull() | (F.lead("c").over(by_video) != F.col("c"))
    begin = F.when(F.col("timed"), F.col("at")).otherwise(F.col("from") + F.col("w") * step)
    end = F.when(~F.col("timed"), F.col("from") + F.col("w") * step + step).when(last, F.greatest("at", "to")).otherwise(F.col("at"))
    timed = words.select("video_id", "c", "p", "w", "text", begin.alias("start"), end.alias("end"), "timed")
    filled = timed.withColumns({"pos": F.row_number().over(by_video) - 1, "end": F.when(F.col("end") > F.col("start"), F.col("end")).otherwise(F.greatest("start", F.coalesce(F.lead("start").over(by_video), "start"))), "word_timed": F.bool_or("timed").over(Window.partitionBy("video_id"))})
    return filled.select("video_id", "pos", "text", "start", "end", "word_timed")


def read_jsonl(spark: SparkSession, path: str, schema: S.StructType | str) -> DataFrame:
    """JSON lines; a malformed line is an error, a missing path an empty table."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.globStatus(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_cache(spark: SparkSession, path: str, schema: str, key: str = "audio_file") -> DataFrame:
    """Append-only cache of JSON lines: malformed lines dropped, the last line of a key wins.

    Order is that of files by path and of lines in them.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_"), F.monotonically_increasing_id().alias("line_"))
    parsed = lines.select("file_", "line_", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r")).filter(F.col(f"r.{key}").isNotNull())
    return last_wins(parsed.select("file_", "line_", "r.*"), [key], ["file_", "line_"]).drop("file_", "line_")


def read_word_cache(spark: SparkSession, path: str) -> DataFrame:
    """Words that ``writers.write_word_cache`` wrote; a video without words has no rows."""
    kind = "pos int, text string, start double, end double, score double, video_id string"
    return spark.read.schema(kind).parquet(path).select("video_id", "pos", "text", "start", "end", "score")


def centroid_union(archives: DataFrame, key: str = "speaker", file: str = "file") -> DataFrame:
    """Centroids of several archives, one per key: of those with the same key that of the later file counts."""
    return last_wins(archives, [key], [file])


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """``(speaker, centroid)`` of a folder of archives, one file per recording; see ``centroid_union``."""
    raw = spark.read.schema("speaker string, centroid array<double>").parquet(path).select("speaker", F.col("_metadata.file_path").alias("file"), "centroid")
    return centroid_union(raw).drop("file")


def cached_words(caches: DataFrame) -> DataFrame:
    """Recognized words of per-video JSON (``video_id``, ``content``): ``(video_id, pos, text, start, end, score)``.

    Missing or truncated content has none; a missing confidence is 0.
    """
    parsed = caches.select("video_id", F.posexplode(F.from_json("content", WORD_CACHE)).alias("pos", "w"))
    return parsed.select("video_id", "pos", F.col("w.t").alias("text"), F.col("w.s").alias("start"), F.col("w.e").alias("end"), F.coalesce("w.c", F.lit(0.0)).alias("score"))


def diarization_turns(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and overlaps of diarization JSON (``video_id``, ``content``)."""
    parsed = results.select("video_id", F.from_json("content", DIARIZATION).alias("d"))
    return parsed.select("video_id", F.inline("d.turns")), parsed.select("video_id", F.inline("d.overlaps"))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Episodes of an RSS file that have an enclosure: title, url, length, duration, date, guid."""
    schema = "title string, guid struct<_VALUE:string>, pubDate string, enclosure struct<_url:string,_length:bigint>, `itunes:duration` string"
    items = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    return items.filter("enclosure._url IS NOT NULL").select("title", F.col("enclosure._url").alias("url"), F.col("enclosure._length").alias("length"), F.col("`itunes:duration`").alias("duration"), F.col("pubDate").alias("published"), F.col("guid._VALUE").alias("guid"))


PREDICTION = "struct<request:struct<contents:array<struct<parts:array<struct<fileData:struct<fileUri:string>,text:string>>>>>,status:string,response:struct<candidates:array<struct<content:struct<parts:array<struct<text:string>>>>>>>"


def prediction_batches(lines: DataFrame, prefix: str) -> DataFrame:
    """Answered batches of prediction lines (``value``): ``(clips, items, error)`` for ``gates.batch_entries``.

    The clips are those that the echoed request names; lines without any are left out.
    """
    parsed = lines.select(F.from_json("value", PREDICTION).alias("r"))
    parts = F.flatten(F.transform("r.request.contents", lambda c: c["parts"]))
    uris = F.transform(F.filter(parts, lambda p: p["fileData"]["fileUri"].isNotNull()), lambda p: U.path_decode(F.regexp_replace(p["fileData"]["fileUri"], r"^[a-z]+://[^/]+/", ""), prefix))
    raw = F.array_join(F.transform(F.get("r.response.candidates", 0)["content"]["parts"], lambda p: F.coalesce(p["text"], F.lit(""))), "")
    answered = parsed.select(uris.alias("clips"), F.from_json(raw, "array<struct<i:int,text:string>>").alias("items"), F.col("r.status").alias("status"), F.get("r.response.candidates", 0).isNotNull().alias("has"))
    error = F.when(F.coalesce("status", F.lit("")) != "", F.concat(F.lit("batch:"), F.substring("status", 1, 60))).when(~F.col("has"), "no_response").when(F.col("items").isNull(), "unparseable")
    return answered.filter(F.size("clips") > 0).select("clips", "items", error.alias("error"))


def run_state(states: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources with their state: ``complete`` false without one, counters 0."""
    s = states.select(F.col("video_id").alias("source_id"), "complete", "kept", "rejected", "seconds_kept")
    joined = sources.join(s, "source_id", "left")
    return joined.withColumns({"complete": F.coalesce("complete", F.lit(False)), "kept": F.coalesce("kept", F.lit(0)), "rejected": F.coalesce("rejected", F.lit(0)), "seconds_kept": F.coalesce("seconds_kept", F.lit(0.0))})


def pending_sources(states: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources that aren't complete yet."""
    return sources.join(states.filter("complete").select(F.col("video_id").alias("source_id")), "source_id", "left_anti")


def fetch(sources: DataFrame, get: Callable[[str, str], dict], clients: list[str], attempts: int = 3, backoff: float = 0.0) -> DataFrame:
    """Fetch remote sources with ``get(spec, client)``: ``(spec, result, error)``, never an exception.

    Each distinct client is tried in turn, with a growing pause; a permanent error ends the attempts.
    """
    ladder = list(dict.fromkeys(clients))
    final = U.PERMANENT

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json
        import time

        for batch in batches:
            rows = []
            for spec in batch["spec"].to_pylist():
                result, error = None, None
                for n, client in enumerate((ladder * attempts)[: max(attempts, len(ladder))]):
                    try:
                        result, error = json.dumps(get(spec, client), sort_keys=True), None
                        break
                    except Exception as e:  # noqa: BLE001 - the message is the result
                        error = str(e)
                        if any(m in error.lower() for m in final):
                            break
                        time.sleep(backoff * (n + 1))
                rows.append((spec, result, error))
            columns = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["spec", "result", "error"])

    return sources.select("spec").mapInArrow(mapper, "spec string, result string, error string")
