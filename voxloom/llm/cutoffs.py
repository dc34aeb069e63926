"""Score cutoffs per source that keep a target fraction, by a range sort with prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.clips import current_clips, usable_score
from voxloom.storage import shuffle_width, write_table


def _rank_in_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's rank within partition and source; rows come sorted by source."""
    last, rank = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch["source"].dictionary_encode()
        code = codes.indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        ranks = np.arange(1, len(code) + 1) - np.repeat(starts, np.diff(np.append(starts, len(code))))
        if codes.dictionary[int(code[0])].as_py() == last:
            ranks[: starts[1] if len(starts) > 1 else len(code)] += rank
        last, rank = codes.dictionary[int(code[-1])].as_py(), int(ranks[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranks, pa.int64())], names=[*batch.schema.names, "rank"])


def ranked_cutoffs(scored: DataFrame, keep: tuple[int, int] = (4, 5), parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Cutoffs per source and the ranked rows.

    ``scored`` has ``source`` and ``id`` (strings) and ``score`` (double, no null or NaN); rows without source are left
    out.  The cutoff of a source with n rows is the score at rank ceil(keep * n) from the top.  Returns
    ``(source, part, cutoff, n, kept)``, a row for each part that holds rows of the source, where ``kept`` counts the
    rows at or above the cutoff, and the rows ``(source, part, id, score, rank)``.

    Rows are range-partitioned by source, score and id, so that a source with a third of all rows, or one score that
    all rows share, is cut into many parts.  A part's counts per source are summed ahead of it; that names the part
    and the rank there of the wanted row, which is then read by an equality join.
    """
    spark = scored.sparkSession
    parts = parts or 2 * shuffle_width(spark)
    placed = scored.filter(F.col("source").isNotNull()).select("source", "id", "score").repartitionByRange(parts, F.col("source"), F.col("score").desc(), F.col("id"))
    ordered = placed.withColumn("part", F.spark_partition_id()).sortWithinPartitions("source", F.col("score").desc(), "id")
    rows, _ = write_table(ordered.mapInArrow(_rank_in_part, "source string, id string, score double, part int, rank long"), "ranked")

    counts = rows.groupBy("source", "part").agg(F.max("rank").alias("size"))
    of_source = Window.partitionBy("source")
    counts = counts.withColumn("n", F.sum("size").over(of_source)).withColumn("ahead", F.sum("size").over(of_source.orderBy("part")) - F.col("size"))
    up, down = keep
    wanted = F.floor((F.col("n") * up + (down - 1)) / down).cast("long") - F.col("ahead")
    target = counts.filter(wanted.between(1, F.col("size"))).select("source", "part", wanted.alias("rank"))
    cut = rows.join(target, ["source", "part", "rank"]).select("source", F.col("score").alias("cutoff"))
    spread = counts.join(cut, "source").select("source", "part", "cutoff", "n")
    # ties of the cutoff may lie in later parts; a part's rows at or above it count as kept
    kept = rows.join(spread, ["source", "part"]).filter(F.col("score") >= F.col("cutoff")).groupBy("source").agg(F.count("*").alias("kept"))
    return spread.join(kept, "source"), rows


def video_cutoffs(metadata: DataFrame, keep: tuple[int, int] = (4, 5)) -> tuple[DataFrame, DataFrame]:
    """``ranked_cutoffs`` of the current clips' usable ``squim_mos`` per ``video_id``.

    A video without usable scores has no cutoff; clips without ``video_id`` belong to none.
    """
    clips = current_clips(metadata, "video_id", "squim_mos")
    scored = clips.select(F.col("video_id").alias("source"), F.col("audio_file").alias("id"), usable_score(F.col("squim_mos")).alias("score")).filter(F.col("score").isNotNull())
    return ranked_cutoffs(scored, keep)


def cutoff_table(metadata: DataFrame) -> DataFrame:
    """``(video_id, cutoff, n, kept)`` per video with usable scores."""
    cutoffs, _ = video_cutoffs(metadata)
    return cutoffs.groupBy(F.col("source").alias("video_id")).agg(F.first("cutoff").alias("cutoff"), F.first("n").alias("n"), F.first("kept").alias("kept"))


def below_cutoff(metadata: DataFrame) -> DataFrame:
    """``(video_id, audio_file)`` of the clips scoring below their video's cutoff.

    The join is by source and part, so no source gathers in one task.
    """
    cutoffs, rows = video_cutoffs(metadata)
    return rows.join(cutoffs.select("source", "part", "cutoff"), ["source", "part"]).filter(F.col("score") < F.col("cutoff")).select(F.col("source").alias("video_id"), F.col("id").alias("audio_file"))
