"""Current clips of a metadata table that was appended to more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.columns import pick


def current_clips(metadata: DataFrame, *columns: str) -> DataFrame:
    """One row per ``audio_file`` with ``columns`` of its row with the greatest ``emitted_at``.

    A null ``emitted_at`` is older than any time; rows without ``audio_file`` are no clips.  The maximum is taken
    map-side first, so a file that was emitted many times doesn't gather in one task.
    """
    row = F.struct("emitted_at", *columns)
    return pick(metadata, "audio_file", "emitted_at", *columns).filter(F.col("audio_file").isNotNull()).groupBy("audio_file").agg(F.max(row).alias("row")).select("audio_file", *(F.col(f"row.{c}") for c in columns))


def usable_score(score: Column, low: float = 1.0, high: float = 5.0) -> Column:
    """``score`` where it is a number from ``low`` to ``high``, else null."""
    return F.when(~F.isnan(score) & score.between(low, high), score)
