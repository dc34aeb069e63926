"""Queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions.labels import WHITE_SPACE
from voxloom.llm import canonical, capping, cutoffs, encoding, leakage, packing, spam, splits, turns


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Each query takes a session and a folder of tables."""
    t = _table
    return {
        "p2_found": lambda s, d: capping.capped_speakers(t(s, d, "metadata")).filter(~F.col("kept")).select("audio_file"),
        "p2_capped": lambda s, d: capping.capped_speakers(t(s, d, "metadata")),
        "p2_shared": lambda s, d: capping.shared_speakers(t(s, d, "metadata")),
        "p3_found": lambda s, d: splits.grouped_videos(t(s, d, "metadata")),
        "p3_incremental": lambda s, d: splits.grouped_in_batches(t(s, d, "metadata")),
        "p3_report": lambda s, d: splits.split_report(t(s, d, "metadata")),
        "p3_splits": lambda s, d: splits.split_clips(t(s, d, "metadata")),
        "p4_found": lambda s, d: turns.clean_turns(t(s, d, "chunks"), t(s, d, "sub_words"), t(s, d, "label_aliases"), t(s, d, "filler_terms")),
        "p5_found": lambda s, d: canonical.look_alike_fields(t(s, d, "chunks")),
        "p5_canonical": lambda s, d: canonical.canonical_texts(t(s, d, "chunks").select("video_id", "chunk_index", "text", "text_yt", "text_cohere"), ["text", "text_yt", "text_cohere"]).drop("text", "text_yt", "text_cohere"),
        "p6_found": lambda s, d: packing.oversized_clips(t(s, d, "metadata")),
        "p6_containers": lambda s, d: packing.pack_clips(t(s, d, "metadata")),
        "p6_report": lambda s, d: packing.packing_report(t(s, d, "metadata")),
        "p7_found": lambda s, d: cutoffs.below_cutoff(t(s, d, "metadata")),
        "p7_cutoffs": lambda s, d: cutoffs.cutoff_table(t(s, d, "metadata")),
        "p8_ids": lambda s, d: encoding.encode_documents(t(s, d, "documents")),
        "p9_found": lambda s, d: leakage.leaked_items(t(s, d, "documents"), t(s, d, "eval_items")),
        "p10_found": lambda s, d: spam.stuffed_pages(t(s, d, "documents")),
        "p10_scores": lambda s, d: spam.stuffing_scores(t(s, d, "documents")),
    }


_KEY = f"nullif(lower(trim(speaker, '{WHITE_SPACE}')), '')"
_CURRENT = """current AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY audio_file ORDER BY emitted_at DESC NULLS LAST) AS rn FROM metadata WHERE audio_file IS NOT NULL) WHERE rn = 1)"""
_USABLE = "CASE WHEN NOT isnan(squim_mos) AND squim_mos BETWEEN 1 AND 5 THEN squim_mos END"
_CAPPED = f"""WITH {_CURRENT}, scored AS (
  SELECT audio_file, {_KEY} AS speaker, {_USABLE} AS score, CASE WHEN NOT isnan(duration) THEN duration END AS duration FROM current)
SELECT audio_file, speaker, score, duration,
  speaker IS NULL OR row_number() OVER (PARTITION BY speaker ORDER BY score DESC NULLS LAST, duration DESC NULLS LAST, audio_file) <= 15 AS kept
FROM scored"""
_RANKED = f"""WITH {_CURRENT}, scored AS (
  SELECT video_id, audio_file, {_USABLE} AS score FROM current WHERE video_id IS NOT NULL), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY score DESC, audio_file) AS r, count(*) OVER (PARTITION BY video_id) AS n FROM scored WHERE score IS NOT NULL), cuts AS (
  SELECT video_id, n, score AS cutoff FROM ranked WHERE r = (4 * n + 4) // 5)"""

_GROUPS = f"""WITH RECURSIVE ties AS (
  SELECT DISTINCT a.video_id AS a, b.video_id AS b
  FROM (SELECT DISTINCT video_id, {_KEY} AS k FROM metadata) a JOIN (SELECT DISTINCT video_id, {_KEY} AS k FROM metadata) b ON a.k = b.k), reach AS (
  SELECT DISTINCT video_id AS v, video_id AS g FROM metadata WHERE video_id IS NOT NULL
  UNION SELECT reach.v, ties.b FROM reach JOIN ties ON reach.g = ties.a)
SELECT v AS video_id, min(g) AS group_video_id FROM reach GROUP BY v"""


def oracle_sql() -> dict[str, str]:
    """SQL on whole tables; operators without are tested against brute force."""
    return {
        "p2_found": f"SELECT audio_file FROM ({_CAPPED}) WHERE NOT kept",
        "p2_capped": _CAPPED,
        "p2_shared": _CAPPED.replace("audio_file) <= 15 AS kept", "audio_file) <= ceil(count(*) OVER (PARTITION BY speaker) * CAST(0.5 AS DOUBLE)) AS kept"),
        "p3_found": _GROUPS,
        "p3_incremental": _GROUPS,
        "p3_report": "SELECT count(DISTINCT audio_file) AS clips, CAST(0 AS BIGINT) AS quarantined, CAST(0 AS BIGINT) AS torn_voices, CAST(0 AS BIGINT) AS torn_videos, true AS near FROM metadata",
        "p6_found": f"WITH {_CURRENT} SELECT audio_file FROM current WHERE isfinite(duration) AND duration > 30",
        "p6_report": f"WITH {_CURRENT} SELECT count(*) AS clips, CAST(0 AS BIGINT) AS torn, CAST(0 AS BIGINT) AS overfull, true AS tight FROM current WHERE isfinite(duration) AND duration > 0",
        "p7_found": f"{_RANKED} SELECT ranked.video_id, audio_file FROM ranked JOIN cuts USING (video_id) WHERE score < cutoff",
        "p7_cutoffs": f"{_RANKED} SELECT video_id, any_value(cutoff) AS cutoff, any_value(ranked.n) AS n, count(*) FILTER (score >= cutoff) AS kept FROM ranked JOIN cuts USING (video_id) GROUP BY video_id",
    }
