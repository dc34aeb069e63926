"""Streaming variants: bounded look-ahead, idempotent commits, windows, sessions, stateful de-duplication, late text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from voxloom.sources.writers import replace_partitions
from voxloom.storage import scratch, shuffle_width


def increments(spark: SparkSession, path: str, schema, files: int | None = 16) -> DataFrame:
    """A folder of parquet files as a stream, at most ``files`` of them ahead at a time; all present ones with None."""
    reader = spark.readStream.schema(schema)
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(path)


def ended(spark: SparkSession, stream: DataFrame, time: str, end: str = "2200-01-01") -> DataFrame:
    """A stream of which all input is there, followed by one row of nulls at the time ``end``.

    The row moves the watermark past everything, so that in append mode the last windows and sessions come out as well
    and no state stays but its own.  All files must come in one batch (see ``increments``): what comes after it is late.
    """
    path = scratch(spark, "end")
    last = [F.lit(end).cast(f.dataType).alias(f.name) if f.name == time else F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields]
    spark.range(1).select(*last).write.parquet(path)
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(path))


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process what is there in micro-batches and stop; a restart with the same checkpoint goes on after the last commit."""
    query = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(each).start()
    query.awaitTermination()


def collected(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All that the stream gives for its present input, as a table in shared storage.

    ``complete`` replaces the table by each batch, ``append`` adds to it; a batch has its own folder, so that a batch
    that runs twice is there once.
    """
    spark = stream.sparkSession
    path, checkpoint = scratch(spark, name), scratch(spark, name + "-progress")
    run_available(stream, lambda df, n: df.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={n}"), checkpoint, mode)
    return spark.read.schema(stream.schema).parquet(path) if mode == "complete" else spark.read.schema(stream.schema).option("basePath", path).option("recursiveFileLookup", "true").parquet(path)


def commit_videos(stream: DataFrame, path: str, checkpoint: str, key: str = "video_id") -> None:
    """Write each batch's videos by replacing their partitions: processing again leaves the same table.

    All rows of a video must come in one batch, as a finished video does.
    """
    run_available(stream, lambda df, _: replace_partitions(df, path, key), checkpoint)


def first_arrivals(stream: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Each key once while its repeats arrive within ``delay``; state older than that is dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def gap_sessions(stream: DataFrame, key: str, time: str, gap: str, delay: str = "10 minutes") -> DataFrame:
    """Sessions per key that end after ``gap`` without an event: start, end of the last gap, events."""
    return stream.withWatermark(time, delay).groupBy(key, F.session_window(time, gap)).agg(F.count("*").alias("events")).select(key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "events")


def tumbling(stream: DataFrame, keys: list[str], time: str, width: str, delay: str = "10 minutes") -> DataFrame:
    """Events per key and window of fixed width."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("events")).select(*keys, F.col("window.start").alias("window_start"), "events")


def spaced_out(times: np.ndarray, last: float | None, epsilon: float) -> tuple[np.ndarray, float | None]:
    """Places of the sorted ``times`` that are more than ``epsilon`` from the last kept one, and the last one then.

    Work follows the kept ones: each next one is found by a search.
    """
    kept, at = [], 0
    while at < len(times):
        if last is not None and abs(times[at] - last) <= epsilon:
            at = int(np.searchsorted(times, last + epsilon, "right"))
            continue
        kept.append(at)
        last = float(times[at])
        at += 1
    return np.array(kept, np.int64), last


def dedupe_stream(stream: DataFrame, keys: list[str], seconds: str, time: str, epsilon: float, idle_ms: int = 3_600_000, buckets: int | None = None) -> DataFrame:
    """Rows whose key's last kept one is more than ``epsilon`` seconds away, with state per bucket of keys.

    Rows of a batch are taken in order of ``seconds``.  Keys are dealt by hash into ``buckets`` (a few per task by
    default), so that Python is entered once a bucket and not once a key.  A bucket's state holds of each key what was
    kept last and when it was seen last; a key that has been idle for ``idle_ms`` by the watermark on ``time`` (set by
    the caller) goes, and a bucket without keys as well.
    """
    names = stream.columns
    spread = buckets or 4 * shuffle_width(stream.sparkSession)
    dealt = stream.withColumn("key_", F.to_json(F.struct(*keys))).withColumn("bucket_", F.pmod(F.xxhash64("key_"), F.lit(spread)))

    def step(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        lasts, seen = ({}, {}) if not state.exists else [dict(zip(state.get[0], x)) for x in state.get[1:]]
        rows = pd.concat(list(parts)) if not state.hasTimedOut else None
        if rows is not None:
            rows = rows.sort_values(["key_", seconds], kind="stable").reset_index(drop=True)
            codes, times = rows["key_"].to_numpy(), rows[seconds].to_numpy(np.float64)
            events = rows[time].to_numpy("datetime64[ms]").astype(np.int64)
            cuts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])).tolist() + [len(codes)]
            chosen = []
            for a, b in zip(cuts, cuts[1:]):
                places, lasts[codes[a]] = spaced_out(times[a:b], lasts.get(codes[a]), epsilon)
                seen[codes[a]] = max(seen.get(codes[a], 0), int(events[a:b].max()))
                chosen.append(places + a)
            yield rows.loc[np.concatenate(chosen), names]
        now = max(state.getCurrentWatermarkMs(), 0)
        held = [k for k in lasts if lasts[k] is not None and seen[k] + idle_ms > now]
        if held:
            state.update((held, [lasts[k] for k in held], [seen[k] for k in held]))
            state.setTimeoutTimestamp(now + idle_ms)
        else:
            state.remove()

    return dealt.groupBy("bucket_").applyInPandasWithState(step, stream.schema, "keys array<string>, lasts array<double>, seen array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)


def late_text(pending: DataFrame, words: DataFrame, key: str, pending_time: str, word_time: str, delay: str = "1 hour") -> DataFrame:
    """Pending rows with text that arrives within ``delay`` of them; after that, without (an outer stream join)."""
    a, b = pending.withWatermark(pending_time, delay), words.withWatermark(word_time, delay).withColumnRenamed(key, "late_key")
    near = (F.col(key) == F.col("late_key")) & (F.col(word_time) >= F.col(pending_time) - F.expr(f"INTERVAL {delay}")) & (F.col(word_time) <= F.col(pending_time) + F.expr(f"INTERVAL {delay}"))
    return a.join(b, near, "leftOuter").drop("late_key")


def until_terminal(poll: Callable[[], list[dict]], wait: Callable[[], None], rounds: int = 1000) -> list[dict]:
    """Poll jobs until each has ended; ``wait`` passes the time between."""
    for _ in range(rounds):
        jobs = poll()
        if all(j["state"] in ("SUCCEEDED", "FAILED", "CANCELLED", "EXPIRED") for j in jobs):
            return jobs
        wait()
    raise TimeoutError("jobs did not end")


def retry_queue(rows: DataFrame, cache: DataFrame, key: str = "audio_file") -> DataFrame:
    """Rows whose last entry isn't ok, to be fed again by the next trigger."""
    return rows.join(cache.filter("status = 'ok'").select(key), key, "left_anti")
