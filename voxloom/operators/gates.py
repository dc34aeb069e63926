"""Ordered gates: the first failing one gives the reason, later measures stay null, rejected rows are kept apart.

A reason is a pair of columns, ``reject_code`` and ``reject_value``; text for display is made of both elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.config import Limits
from voxloom.functions import text as T

#: Sources whose text comes from recognition alone, and the one among them with confidence from 0 to 1.
RECOGNIZED = ("google", "cohere", "google_batch")


@dataclass
class Cascade:
    """Gates in order; ``reason`` is null where all pass."""

    gates: list[tuple[str, Column, Column | None]] = field(default_factory=list)

    def gate(self, code: str, fails: Column, value: Column | None = None) -> Cascade:
        """Add a gate; a null condition passes."""
        self.gates.append((code, fails, value))
        return self

    def reason(self) -> Column:
        """Struct of ``code`` and ``value`` of the first failing gate."""
        none = F.lit(None).cast("double")
        return F.coalesce(*[F.when(fails, F.struct(F.lit(code).alias("code"), (none if value is None else value.cast("double")).alias("value"))) for code, fails, value in self.gates])

    def passed(self, code: str) -> Column:
        """Whether all gates ahead of ``code`` pass, which is when its measure is taken."""
        ahead = F.lit(True)
        for name, fails, _ in self.gates:
            if name == code:
                break
            ahead = ahead & ~F.coalesce(fails, F.lit(False))
        return ahead


def apply(table: DataFrame, cascade: Cascade) -> DataFrame:
    """``table`` with ``reject_code`` and ``reject_value``; a reason that a row has already stays."""
    reason = cascade.reason()
    held = F.col("reject_code") if "reject_code" in table.columns else F.lit(None).cast("string")
    value = F.col("reject_value") if "reject_value" in table.columns else F.lit(None).cast("double")
    out = table.withColumn("reason_", F.when(held.isNull(), reason))
    return out.withColumns({"reject_value": F.when(held.isNull(), F.col("reason_.value")).otherwise(value), "reject_code": F.coalesce(held, F.col("reason_.code"))}).drop("reason_")


def number(c: str) -> Column:
    """A column where it is a number: null for NaN, which would otherwise exceed any limit."""
    return F.when(~F.isnan(c), F.col(c))


def resolve_text(chunks: DataFrame, kind: str = "yt", backend: str = "cohere", limits: Limits = Limits()) -> DataFrame:
    """Choose each chunk's text of captions and recognition, with their error rate; disagreement and absence reject.

    Both there: the captions' text, rejected if the rate exceeds the limit.  Only recognition: its text.  Only
    captions: theirs, rejected.  None: rejected.  Texts are cleaned first.
    """
    cleaned = chunks.withColumns({"text_yt": T.clean_for_output(F.col("text_yt")), "text_cohere": T.clean_for_output(F.col("text_cohere"))})
    normal = cleaned.withColumns({"yt_": T.normalize(F.col("text_yt")), "asr_": T.normalize(F.col("text_cohere"))})
    yt, asr = F.col("text_yt") != "", F.col("text_cohere") != ""
    rated = normal.withColumn("cer_yt_vs_cohere", F.when(yt & asr, T.cer_of_normal(F.col("yt_"), F.col("asr_")))).drop("yt_", "asr_")
    chosen = rated.withColumns({
        "text": F.when(yt, F.col("text_yt")).otherwise(F.col("text_cohere")),
        "text_source": F.when(yt, kind).when(asr, backend).otherwise("none"),
    })
    cascade = Cascade().gate("text:cer", F.col("cer_yt_vs_cohere") > limits.disagreement, F.col("cer_yt_vs_cohere")).gate("text:asr_empty", yt & ~asr).gate("text:empty", ~yt & ~asr)
    return apply(chosen, cascade)


def _text_cascade(text: Column, limits: Limits, confidence_fails: Column, cps: Column) -> Cascade:
    language = F.coalesce(F.nullif(F.col("asr_language"), F.lit("")), F.lit("ar"))
    count, ratio = F.size(T.words(text)), T.script_ratio(text, language)
    return (
        Cascade()
        .gate("text:empty", T.present(text) == "")
        .gate("text:too_short", count < limits.words, count)
        .gate("text:script", ratio < limits.script_share, ratio)
        .gate("text:asr_confidence", confidence_fails, F.col("asr_confidence"))
        .gate("text:cps_low", cps < limits.pace[0], cps)
        .gate("text:cps_high", cps > limits.pace[1], cps)
    )


def floor_of(source: Column, limits: Limits) -> Column:
    """Least confidence for a text source: from 0 to 1 for one, a mean log-probability for the others."""
    return F.when(source.isin("google", "google_batch"), limits.confidence).otherwise(limits.log_confidence)


def text_gates(chunks: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Gates on the chosen text: empty, words, script, confidence of recognized texts, pace, clipped words, alignment."""
    alone = F.col("text_source").isin(*RECOGNIZED)
    cps = T.chars_per_second(F.col("text"), F.col("end") - F.col("start"))
    cascade = _text_cascade(F.col("text"), limits, alone & (number("asr_confidence") < floor_of(F.col("text_source"), limits)), cps)
    if limits.reject_cut_words:
        cascade.gate("text:boundary_clipped", F.col("boundary_clipped"))
    cascade.gate("align:score", ~alone & (number("align_score") < limits.alignment), F.col("align_score"))
    out = apply(chunks, cascade)
    fresh = F.col("reject_code").isNull() | F.col("reject_code").startswith("text:") | F.col("reject_code").startswith("align:")
    language = F.coalesce(F.nullif(F.col("asr_language"), F.lit("")), F.lit("ar"))
    return out.withColumns({
        "arabic_ratio": F.when(fresh & cascade.passed("text:script"), T.arabic_ratio(F.col("text"))),
        "script_ratio": F.when(fresh & cascade.passed("text:script"), T.script_ratio(F.col("text"), language)),
        "chars_per_sec": F.when(fresh & cascade.passed("text:cps_low"), cps),
    })


def row_gates(rows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Gates on stored rows after late recognition; rows still ``pending`` pass untouched.

    The text is the recognized one, the pace counts no vowel marks, and there are no gates on clipping or alignment.
    """
    pending = F.coalesce(F.col("text_source") == "pending", F.lit(False))
    done = rows.filter(~pending).withColumn("text_cohere", T.clean_for_output(F.col("text_cohere")))
    done = done.withColumns({"text": F.col("text_cohere"), "cer_yt_vs_cohere": F.lit(None).cast("double")})
    cps = T.chars_per_second(T.strip_marks(F.col("text")), F.col("duration"))
    gated = apply(done.drop("reject_code", "reject_value"), _text_cascade(F.col("text"), limits, number("asr_confidence") < limits.confidence, cps))
    return gated.unionByName(rows.filter(pending).withColumns({"reject_code": F.lit(None).cast("string"), "reject_value": F.lit(None).cast("double")}), allowMissingColumns=True)


def quality_cascade(limits: Limits = Limits()) -> Cascade:
    """Gates on signal measures; null and NaN pass, silence of minus infinity is too quiet."""
    peak = number("peak_dbfs")
    return (
        Cascade()
        .gate("quality:clipping", number("clipping_ratio") > limits.clipped_share, F.col("clipping_ratio"))
        .gate("quality:too_quiet", peak < limits.peak_dbfs[0], peak)
        .gate("quality:too_hot", peak > limits.peak_dbfs[1], peak)
        .gate("quality:snr", number("snr_db") < limits.snr_db, F.col("snr_db"))
        .gate("quality:stoi", number("squim_stoi") < limits.stoi, F.col("squim_stoi"))
        .gate("quality:pesq", number("squim_pesq") < limits.pesq, F.col("squim_pesq"))
        .gate("quality:mos", number("squim_mos") < limits.mos, F.col("squim_mos"))
    )


def music_cascade(limits: Limits = Limits()) -> Cascade:
    """Gates on accompaniment, then on the music score; none unless the configuration rejects music."""
    cascade = Cascade()
    on = F.lit(limits.reject_music)
    cascade.gate("music:accompaniment", on & (number("accompaniment_ratio") > limits.accompaniment), F.col("accompaniment_ratio"))
    return cascade.gate("music:score", on & (number("music_score") > limits.music), F.col("music_score"))


def export_cascade(text: Column, min_words: int = 2, shortest: float = 1.0, longest: float = 30.0, drop_digits: bool = True, canonical: bool = False) -> Cascade:
    """Gates of an export: words, Arabic script, length, digits."""
    cascade = Cascade().gate("text_too_short", F.size(T.words(text)) < min_words)
    if not canonical:
        cascade.gate("no_arabic_script", F.regexp_count(T.present(text), F.lit(f"[{T.PLAIN_ARABIC}]")) == 0)
    duration = F.coalesce(F.col("duration"), F.lit(0.0))
    cascade.gate("too_short", duration < shortest, duration).gate("too_long", duration > longest, duration)
    if drop_digits:
        cascade.gate("has_digits", T.present(text).rlike(r"[0-9٠-٩۰-۹]"))
    return cascade


def reason_category(code: Column) -> Column:
    """Category of a reason: what stands ahead of its colon; ``kept`` without one."""
    return F.coalesce(F.substring_index(code, ":", 1), F.lit("kept"))


def summarize(table: DataFrame) -> DataFrame:
    """``(category, rows)``."""
    return table.groupBy(reason_category(F.col("reject_code")).alias("category")).agg(F.count("*").alias("rows"))


def split_kept(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept and rejected rows."""
    return table.filter("reject_code IS NULL").drop("reject_code", "reject_value"), table.filter("reject_code IS NOT NULL")


def diacritized_status(source: Column, marked: Column, error: Column) -> Column:
    """Verdict on a text that should only have gained vowel marks: (status, text); text is null unless accepted."""
    clean = T.clean_for_output(marked)
    final = T.strip_final_marks(clean)
    exact = T.same_skeleton(source, clean)
    fallback = F.when(exact, "ok").otherwise("ok_orthography_fixed")
    status = (
        F.when(error.isNotNull() & (error != ""), error)
        .when(clean == "", "empty")
        .when(~exact & ~T.same_words(source, clean), "words_changed")
        .when(~T.same_skeleton(clean, final), "enforcement_broke_skeleton")
        .when(T.marks_ratio(final) == 0, "no_marks")
        .otherwise(fallback)
    )
    return F.struct(status.alias("status"), F.when(status.startswith("ok"), final).alias("text"))


def batch_entries(batches: DataFrame) -> DataFrame:
    """One entry per clip of an answered batch (``clips`` array, ``items`` array of (i, text), ``error``).

    An index outside 1..n discards the whole batch (``index_mismatch``), for a shifted list would be wrong throughout;
    an index without item is ``missing_index``; an empty text is ``ok``.
    """
    n = F.size("clips")
    wrong = F.exists("items", lambda x: x["i"].isNull() | (x["i"] < 1) | (x["i"] > n))
    whole = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("items").isNull(), "no_response").when(wrong, "index_mismatch")
    spread = batches.withColumn("whole", whole).select("*", F.posexplode("clips").alias("at", "audio_file"))
    raw = F.when(F.col("whole").isNull(), F.get(F.filter("items", lambda x: x["i"] == F.col("at") + 1), 0)["text"])
    status = F.coalesce(F.col("whole"), F.when(F.col("raw").isNull(), "missing_index"), F.lit("ok"))
    return spread.withColumn("raw", raw).select("audio_file", F.when(F.col("raw").isNotNull(), T.strip_final_marks(T.clean_for_output(F.col("raw")))).alias("text"), status.alias("status"))


def apply_counts(table: DataFrame) -> DataFrame:
    """``(reject_code, rows)`` of judged rows, null for kept ones."""
    return table.groupBy("reject_code").agg(F.count("*").alias("rows"))
