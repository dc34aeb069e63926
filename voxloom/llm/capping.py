"""Capping the records of dominant contributors by salted pre-ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.labels import label_key
from voxloom.llm.clips import current_clips, usable_score
from voxloom.operators.ranking import range_ranked
from voxloom.storage import shuffle_width


def cap_contributors(records: DataFrame, contributor: str, order: list[Column], cap: int | None = 15, share: float | None = None, salts: int | None = None) -> DataFrame:
    """``records`` with the boolean ``kept``: whether a row is among its contributor's first by ``order``.

    A contributor keeps at most ``cap`` rows, at most ``share`` of all its rows (rounded up), or the fewer of both; one
    of them must be given.  ``order`` must end in a unique column, else ties are kept or dropped as they come.  Rows
    without contributor are always kept.  An empty table stays empty; of the other columns only one named ``kept`` is
    replaced.

    By count: first rank within contributor and salt, so a contributor with a third of all rows is spread over
    ``salts`` tasks.  Rows behind the cap there are behind it in all; only the at most ``cap * salts`` others of a
    contributor are ranked again together.  A share grows with the contributor, so no salt can bound what is left: then
    rows are ranked over range partitions of contributor and order, whose counts give each contributor's size as well.
    """
    if cap is None and share is None:
        raise ValueError("neither cap nor share is given")
    names = [c for c in records.columns if c != "kept"]
    held = records.select(F.struct(*names).alias("record"), F.col(contributor).alias("c"), *[o.alias(f"o{i}") for i, (o, _) in enumerate(order)])
    ordering = [getattr(F.col(f"o{i}"), how)() for i, (_, how) in enumerate(order)]
    if share is not None:
        ranked = range_ranked(held, ["c"], ordering, "rank", "n")
        most = F.ceil(F.col("n") * share)
        return ranked.select("record.*", (F.col("c").isNull() | (F.col("rank") <= (most if cap is None else F.least(F.lit(cap), most)))).alias("kept"))
    salts = salts or max(64, shuffle_width(records.sparkSession))
    # rows without contributor only travel along
    held = held.withColumn("salt", F.pmod(F.xxhash64(*(f"o{i}" for i in range(len(order)))), F.lit(salts)))
    salted = held.withColumn("ahead", F.row_number().over(Window.partitionBy("c", "salt").orderBy(*ordering)))
    spread = F.when((F.col("ahead") <= cap) & F.col("c").isNotNull(), F.lit(-1)).otherwise(F.col("salt"))
    ranked = salted.withColumn("spread", spread).withColumn("rank", F.row_number().over(Window.partitionBy("c", "spread").orderBy(*ordering)))
    return ranked.select("record.*", (F.col("c").isNull() | ((F.col("spread") == -1) & (F.col("rank") <= cap))).alias("kept"))


def capped_speakers(metadata: DataFrame, cap: int = 15, salts: int | None = None) -> DataFrame:
    """Current clips as ``(audio_file, speaker, score, duration, kept)`` with at most ``cap`` kept per labelled speaker.

    Usable scores come first, from high to low, then longer clips, then ``audio_file``.  Null, NaN and impossible
    scores rank last, as do null and NaN durations among equals.
    """
    clips = current_clips(metadata, "speaker", "squim_mos", "duration")
    clips = clips.select("audio_file", label_key(F.col("speaker")).alias("speaker"), usable_score(F.col("squim_mos")).alias("score"), F.when(~F.isnan("duration"), F.col("duration")).alias("duration"))
    return cap_contributors(clips, "speaker", [(F.col("score"), "desc_nulls_last"), (F.col("duration"), "desc_nulls_last"), (F.col("audio_file"), "asc")], cap, salts=salts)


def shared_speakers(metadata: DataFrame, share: float = 0.5) -> DataFrame:
    """``capped_speakers`` by a share: each labelled speaker keeps at most that part of its clips, rounded up."""
    clips = capped_speakers(metadata).drop("kept")
    return cap_contributors(clips, "speaker", [(F.col("score"), "desc_nulls_last"), (F.col("duration"), "desc_nulls_last"), (F.col("audio_file"), "asc")], None, share)
