"""Caches, votes, reports, exports, models, signals, streams, and the catalog against SQL."""

import io
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom import inference as M
from voxloom.functions import audio as A
from voxloom.functions import vectors as V
from voxloom.operators import tables as B
from voxloom.streaming import streams as S


def test_last_wins(spark, rows):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", None, "q"), ("a", 3, "y")], "k string, n int, s string")
    assert rows(B.last_wins(log, ["k"], ["n"])) == [("a", 3, "y"), ("b", None, "q")]
    assert B.last_wins(log.limit(0), ["k"], ["n"]).count() == 0


def test_work_lists(spark, rows):
    r = spark.createDataFrame([("a",), ("b",), ("c",)], "audio_file string")
    cache = spark.createDataFrame([("a", "ok"), ("a", "ok"), ("b", "error")], "audio_file string, status string")
    assert rows(B.outstanding(r, cache)) == [("b",), ("c",)] and rows(B.outstanding(r, cache, limit=1)) == [("b",)]
    assert rows(S.retry_queue(r, cache)) == [("b",), ("c",)]
    assert rows(B.live(r, r.limit(1))) == [("a",)] and rows(B.orphans(r, r.limit(1))) == [("b",), ("c",)]
    assert rows(B.status_counts(r, cache.distinct())) == [("error", 1), ("not_sent", 1), ("ok", 1)]


def test_votes_and_flags(spark, rows):
    e = spark.createDataFrame([("v", f"a{i}", d, c) for i, (d, c) in enumerate([("x", 0.9), ("x", 0.9), ("y", 0.9), ("unclear", 0.9), (None, 0.9), ("x", 0.1)])] + [("w", "b0", "y", 0.9), ("w", "b1", "x", 0.5)], "video_id string, audio_file string, d string, c double")
    got = B.votes(e, ["video_id"], "d", "audio_file")
    assert rows(got, "video_id", "label", "votes", "total") == [("v", "x", 3, 4), ("w", "y", 1, 2)]
    flags = B.flag_labels(e, got, ["video_id"], "d", "c", ["y"])
    assert rows(flags, "audio_file", "flag_basis") == [("a0", "speaker_consensus"), ("a1", "speaker_consensus"), ("a2", "speaker_consensus"), ("a3", "speaker_consensus"), ("a5", "speaker_consensus")]


def test_overlays(spark, rows):
    r = spark.createDataFrame([("a", "one", "yt"), ("b", "two", "yt"), ("c", "three", "yt")], "audio_file string, text string, text_source string")
    cache = spark.createDataFrame([("a", "uno", "ok"), ("b", None, "error")], "audio_file string, text string, status string")
    assert rows(B.overlay_text(r, cache), "audio_file", "text", "gate_status") == [("a", "uno", "ok"), ("b", "two", "error"), ("c", "three", "not_sent")]
    assert rows(B.text_diffs(r, cache)) == [("a", "one", "uno")]
    marked = B.overlay_marks(r, spark.createDataFrame([("a", "كَتب", "ok")], "audio_file string, text string, status string"))
    assert rows(marked, "audio_file", "text_source", "tashkeel_source") == [("a", "yt+diacritized", "diacritized"), ("b", "yt", None), ("c", "yt", None)]


def test_reports(spark, rows):
    nan = float("nan")
    c = spark.createDataFrame([("v", "a", 10.0, 4.0, "f1"), ("v", "a", None, nan, "f2"), ("w", "b", nan, None, "f3")], "video_id string, speaker string, duration double, squim_mos double, audio_file string")
    assert rows(B.seconds_by(c, "speaker")) == [("a", 10.0, 2), ("b", 0.0, 1)]
    s = {r["speaker"]: r for r in B.speaker_summary(c, samples=1).collect()}
    assert (s["a"]["mean_mos"], s["a"]["samples"], s["b"]["mean_mos"]) == (4.0, ["f1"], None)
    t = B.totals(c, c.limit(1)).first()
    assert (t["videos"], t["kept"], t["rejected"], t["hours"]) == (2, 3, 1, 10 / 3600)
    assert rows(B.top_with_rest(spark.createDataFrame([("x", 3.0), ("y", 2.0), ("z", 1.0)], "k string, v double"), "k", "v", 1), "k", "v") == [("(rest)", 3.0), ("x", 3.0)]
    assert spark.range(1).select(B.billable_seconds(F.lit(16.0)), B.billable_seconds(F.lit(0.0))).first()[:] == (30.0, 15.0)


def test_report_queries_keep_all_clips(spark, rows, tmp_path):
    """A clip without a usable duration or score still counts as a clip."""
    from voxloom.plans import queries as core

    nan, inf = float("nan"), float("inf")
    numbers = [(10.0, 4.0), (None, 3.0), (nan, 2.0), (inf, 3.0), (2000.0, None), (5.0, nan), (5.0, inf)]
    clips = [(f"f{i}", f"v{i}", "a", d, m, 0) for i, (d, m) in enumerate(numbers)] + [("g", "w", "b", None, None, 0)]
    spark.createDataFrame(clips, "audio_file string, video_id string, speaker string, duration double, squim_mos double, emitted_at int").withColumn("asr_confidence_alt", F.lit(None).cast("map<string,double>")).write.parquet(str(tmp_path / "metadata.parquet"))
    spark.createDataFrame([("v0", "text:empty"), ("v0", None)], "video_id string, reject_code string").write.parquet(str(tmp_path / "chunks.parquet"))
    made = core.queries()
    got = lambda name, *columns: rows(made[name](spark, str(tmp_path)), *columns)
    assert got("q_speaker_seconds") == [("a", 2020.0, 7), ("b", 0.0, 1)]
    assert got("q_totals", "videos", "kept", "rejected", "hours") == [(8, 8, 1, 2020 / 3600)]
    assert got("q_top_speakers", "speaker", "seconds") == [("a", 2020.0), ("b", 0.0)]
    assert got("q_speaker_summary", "voice", "seconds", "clips", "episodes", "mean_mos") == [("a", 2020.0, 7, 7, 3.0), ("b", 0.0, 1, 1, None)]


def test_subtract_query_takes_all_turns(spark, rows, tmp_path):
    """Holes are where any two speakers talk at once, whatever their labels."""
    from voxloom.plans import queries as core

    turns = [("v", 0.0, 4.0, "SPK02"), ("v", 3.0, 6.0, "SPK03"), ("v", 8.0, 9.0, "SPK01")]
    spark.createDataFrame(turns, "video_id string, start double, end double, speaker string").withColumn("loaded_at", F.lit("2024-01-01 00:00:00").cast("timestamp")).write.parquet(str(tmp_path / "turns.parquet"))
    spark.createDataFrame([("v", 0, 0.0, 5.0), ("v", 1, 7.0, 10.0)], "video_id string, chunk_index int, start double, end double").write.parquet(str(tmp_path / "chunks.parquet"))
    assert rows(core.queries()["q_subtract"](spark, str(tmp_path)), "start", "end") == [(0, 3000), (4000, 5000), (7000, 10000)]


def test_refs_and_manifest(spark):
    df = spark.createDataFrame([("a", 5.0, "b", 0.5, "s", "v"), ("b", 0.5, "a", 5.0, "s", "v"), ("c", 5.0, "a", 5.0, None, "v")], "audio_file string, duration double, ref_audio string, ref_duration double, speaker string, video_id string")
    kept = B.drop_short_refs(df, 2.0)
    lines = {r["audio_file"]: r["value"] for r in B.manifest_rows(kept, "p/", F.lit("t")).collect()}
    assert lines == {"a": '{"audio":"p/a","text":"t","duration":5.0,"speaker":"s","video_id":"v"}', "c": '{"audio":"p/c","text":"t","duration":5.0,"ref_audio":"p/a","ref_duration":5.0,"video_id":"v"}'}
    assert spark.range(1).select(B.regrouped_path(F.lit(None).cast("string"), F.lit("s/x.wav"))).first()[0] == "_unassigned/x.wav"


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], [0.0, 2.0, None, 4.0], [-1.0, -3.0, -9.0], [1, 2, 0])], "a array<double>, z array<double>, c array<double>, s array<double>, t array<int>")
    row = df.select(V.unit(F.col("a")), V.unit(F.col("z")), V.is_zero(F.col("z")), V.nonzero_mean(F.col("c")), V.mean_log_prob(F.col("s"), F.col("t"), [0]), V.cosine_distance(V.unit(F.col("a")), V.unit(F.col("a")))).first()
    assert row[0] == [0.6, 0.8] and row[1] == [0.0, 0.0] and row[2] and row[3] == 3.0 and row[4] == -2.0 and abs(row[5]) < 1e-12


def test_signals(spark):
    tone = (0.5 * np.sin(np.arange(32_000) * 2 * np.pi * 997 / 16_000)).tolist()
    stats = A.signal_stats(tone)
    assert stats["peak_dbfs"] == pytest.approx(-6.02, abs=0.01) and stats["rms_dbfs"] == pytest.approx(-9.03, abs=0.01)
    silent = A.signal_stats([0.0] * 8192)
    assert silent["peak_dbfs"] == float("-inf") and np.isnan(silent["snr_db"]) and np.isnan(A.signal_stats([0.1])["snr_db"])
    assert np.isnan(A.signal_stats([])["peak_dbfs"]) and A.signal_stats([])["clipping_ratio"] == 1.0
    assert np.isnan(A.signal_stats([0.0] * 4096 + [0.5] * 4096)["snr_db"])  # the quiet frames are no signal
    assert A.signal_stats([0.01] * 4096 + [0.1] * 4096)["snr_db"] == pytest.approx(20.0)
    assert A.integrated_loudness(tone, 16_000) == pytest.approx(-9.03, abs=0.1) and np.isnan(A.integrated_loudness([0.0], 16_000))
    gains = spark.createDataFrame([(tone, 40.0), (tone, -6.0), (tone, float("nan")), (tone, 0.0), (tone, None), ([0.0, 0.0], 6.0), ([], 6.0), (None, 6.0)], "x array<double>, g double")
    peaks = [r[0] for r in gains.select(F.array_max(F.transform(A.limited_gain(F.col("x"), F.col("g")), F.abs))).collect()]
    assert peaks[:6] == pytest.approx([10 ** (-1 / 20), 0.5 * 10 ** (-6 / 20), 0.5, 0.5, 0.5, 0.0], abs=1e-4) and peaks[6:] == [None, None]
    quiet = spark.createDataFrame([([0.0] * 16_000 + tone + [0.0] * 16_000, 16_000), (tone[:500], 16_000), ([0.0] * 1000, 16_000), ([], 16_000), (None, 16_000)], "x array<double>, r int")
    assert [r[0] for r in quiet.select(F.size(A.trim_silence(F.col("x"), F.col("r")))).collect()] == [32_000 + 2 * 3200, 500, 960, 0, None]
    assert len(A.linear_resample(tone, 16_000, 24_000)) == 48_000
    content = A.wav_bytes([0.0, 0.5, -0.5, 2.0] * 4000, 16_000)
    assert A.wav_seconds(content) == 1.0 and A.wav_seconds(b"x") == 0.0
    assert wave.open(io.BytesIO(content)).getframerate() == 16_000
    assert len(A.wav_samples(content, 0.25, 9.0)) == 12_000
    df = spark.createDataFrame([(tone, 16_000)], "x array<double>, r int")
    row = df.select(A.signal_stats_udf("x", F.lit(1024)).alias("s"), A.loudness_udf("x", "r").alias("l"), F.size(M.energy_regions("x", "r", F.lit(-40.0))).alias("n")).first()
    assert row["s"]["clipping_ratio"] == 0.0 and row["n"] == 1


def test_models(spark, rows):
    def factory():
        def model(batch):
            if any(r["text"] == "bad" for r in batch):
                raise ValueError("cannot")
            return [(r["text"].upper(), 1.0, "ok") for r in batch]

        return model

    df = spark.createDataFrame([("a", 1.0), ("bad", 1.0), ("c", 1.0)], "text string, duration double")
    got = rows(M.run_model(df, factory, ["text"]).select("text", "result.value", "result.status"))
    assert got == [("a", "A", "ok"), ("bad", None, "error:cannot"), ("c", "C", "ok")]
    with pytest.raises(ValueError, match="unknown backend"):
        M.recognize(df, "other")
    assert M.halving(32) == [32, 16, 8, 4, 2] and M.is_out_of_memory("CUDA out of memory")
    turns = spark.createDataFrame([("v", 0.0, 1.0, "A")], "video_id string, start double, end double, speaker string")
    assert rows(M.diarized_or_single(turns, spark.createDataFrame([("v", 9.0), ("w", 8.0)], "video_id string, duration double"))) == [("v", 0.0, 1.0, "A"), ("w", 0.0, 8.0, "SPEAKER_00")]
    assert rows(M.checked_isolation(spark.createDataFrame([(1.0, 1.2), (1.0, 2.0), (1.0, None)], "duration double, separated_duration double")), "isolated") == [(False,), (False,), (True,)]


def test_spaced_out():
    rng = np.random.default_rng(1)
    for _ in range(200):
        times = np.sort(rng.integers(0, 60, rng.integers(0, 20))).astype(float)
        first = None if rng.random() < 0.3 else float(rng.integers(-5, 65))
        last, want = first, []
        for i, t in enumerate(times):
            if last is None or abs(t - last) > 4:
                want.append(i)
                last = t
        places, now = S.spaced_out(times, first, 4)
        assert places.tolist() == want and now == last


def test_streams(spark, rows, tmp_path):
    kind = "video_id string, k string, at double, ts timestamp"
    data = spark.createDataFrame([("v", "a", float(x), f"2024-01-01 00:00:{int(x):02d}") for x in (0, 5, 5.01, 9)], "video_id string, k string, at double, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    data.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: S.increments(spark, str(tmp_path / "in"), kind)
    seen = S.collected(S.dedupe_stream(stream().withWatermark("ts", "1 hour"), ["k"], "at", "ts", 0.06), "dedupe")
    assert rows(seen, "at") == [(0.0,), (5.0,), (9.0,)]
    for _ in range(2):
        S.commit_videos(stream(), str(tmp_path / "out"), str(tmp_path / "progress"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    once = S.collected(S.first_arrivals(stream(), "k", "ts"), "once")
    assert once.count() == 1
    jobs = iter([[{"state": "RUNNING"}], [{"state": "SUCCEEDED"}]])
    assert S.until_terminal(lambda: next(jobs), lambda: None) == [{"state": "SUCCEEDED"}]


def test_dedupe_query_reads_all_files(spark, rows, tmp_path):
    """No event is late because of the number of files or their order."""
    from voxloom.plans import queries as core

    path = tmp_path / "events.parquet"
    for i in range(40):
        event = spark.createDataFrame([(i, 1, "view")], "event_id long, user_id long, event_type string")
        event.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000 - 7200 * i)).cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(str(path))
    assert rows(core.queries()["q_stream_dedupe"](spark, str(tmp_path)), "event_id") == [(i,) for i in sorted(range(40), key=lambda i: repr((i,)))]


def test_late_text(spark, tmp_path):
    spark.createDataFrame([("a", 0), ("b", 0)], "audio_file string, m int").withColumn("emitted", F.lit("2024-01-01 00:00:00").cast("timestamp")).drop("m").write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([("a", "hi")], "audio_file string, text string").withColumn("heard", F.lit("2024-01-01 00:10:00").cast("timestamp")).write.parquet(str(tmp_path / "w"))
    p = S.increments(spark, str(tmp_path / "p"), "audio_file string, emitted timestamp")
    w = S.increments(spark, str(tmp_path / "w"), "audio_file string, text string, heard timestamp")
    got = S.collected(S.late_text(p, w, "audio_file", "emitted", "heard", "1 hour"), "late")
    assert [tuple(r) for r in got.select("audio_file", "text").filter("text IS NOT NULL").collect()] == [("a", "hi")]


def test_catalog_against_sql(spark):
    """All queries with SQL, over the smallest tables."""
    from verify_oracle import compare, connect
    from voxloom.plans import queries as core

    folder = "/root/testdata/sf0.001"
    con, sqls, made = connect(folder), core.oracle_sql(), core.queries()
    bad = {n: said for n in sqls if (said := compare(spark, con, folder, n, made[n], sqls[n]))}
    assert not bad
