"""Late transcripts, staged scores, flags, cut audio and summaries on small tables with dirt."""

import json

import pytest
from pyspark.sql import functions as F

from voxloom.operators import exports as E
from voxloom.sources import readers as R
from voxloom.sources import writers as W

ROWS = "audio_file string, video_id string, start double, end double, text_cohere string, text_source string"
WORDS = "video_id string, pos int, text string, start double, end double, score double"


def test_late_transcripts(spark, rows):
    clips = spark.createDataFrame([("a", "v", 0.0, 2.0, None, "pending"), ("b", "v", 2.0, 4.0, "old", "pending"), ("c", "w", 0.0, 1.0, "kept", "pending"), ("d", "v", None, None, None, "pending"), ("a", "v", 0.0, 2.0, None, "pending"), ("e", None, 0.0, 1.0, None, "pending")], ROWS)
    words = spark.createDataFrame([("v", 0, "one", 0.0, 0.5, 0.5), ("v", 1, "two", 1.0, 1.4, 1.0), ("v", 2, "edge", 1.8, 2.1, 0.1), ("v", 3, None, 0.0, 1.0, 1.0), ("v", 4, "spot", 1.5, 1.5, 0.4), ("x", 0, "far", 0.0, 1.0, 1.0)], WORDS)
    got = rows(E.late_transcripts(clips, words), "audio_file", "text_cohere", "text_source", "asr_confidence", "aligned_words")
    a = ("a", "one two edge spot", "google_batch", 0.5, 4)
    assert got == sorted([a, a, ("b", "", "google_batch", None, 0), ("c", "kept", "pending", None, None), ("d", "", "google_batch", None, 0), ("e", None, "pending", None, None)], key=repr)
    assert E.late_transcripts(clips.limit(0), words).count() == 0
    assert rows(E.late_transcripts(clips, words.limit(0)).select("text_source").distinct()) == [("pending",)]


def test_reference_of_batches(spark, rows):
    nan = float("nan")
    data = [("f0", "v", 0, None), ("f1", "v", 1, nan), ("f2", "v", 2, 0.5), ("f3", "v", 3, 0.5), ("f4", "v", 4, 0.9), ("g0", "w", 0, None)]
    got = rows(E.reference_of_batches(spark.createDataFrame(data, "audio_file string, video_id string, chunk_index int, squim_stoi double"), ["chunk_index"], 2), "audio_file", "batch", "reference", "late")
    assert got == [("f0", 0, "f3", True), ("f1", 0, "f3", True), ("f2", 1, "f3", True), ("f3", 1, "f3", True), ("f4", 2, "f3", False), ("g0", 0, None, False)]


def test_cut_audio(spark, rows):
    data = [(1, [0.5] * 100, 0.0, 0.5, None), (2, [0.5] * 100, 9.0, 10.0, None), (3, [0.5] * 100, 0.0, 1.0, "x"), (4, None, 0.0, 1.0, None), (5, [], 0.0, 1.0, None), (6, [0.5] * 100, 0.9, 0.1, None)]
    got = E.cut_audio(spark.createDataFrame(data, "id int, x array<double>, start double, end double, reject_code string"), F.col("x"), F.lit(100), 50, F.lit(0.0))
    assert rows(got.select("id", "reject_code", F.size("audio").alias("n"))) == [(1, None, 25), (2, "audio:empty", None), (3, "x", None), (4, "audio:empty", None), (5, "audio:empty", None), (6, "audio:empty", None)]


def test_best_language(spark):
    kind = "c array<struct<language:string,text:string,confidence:double>>"
    cases = [([("a", "", 0.9), ("b", "x", None), ("c", "y", 0.1)], ("c", "y", 0.1)), ([("a", "x", 0.5), ("b", "y", 0.5)], ("a", "x", 0.5)), ([("a", None, 0.3), ("b", "", 0.9)], ("a", "", 0.3)), ([("a", "x", None), ("b", "y", None)], ("a", "x", None))]
    df = spark.createDataFrame([(c,) for c, _ in cases], kind)
    assert [tuple(r[0]) for r in df.select(E.best_language(F.col("c"))).collect()] == [w for _, w in cases]


def test_run_summary_and_results(spark, rows):
    kept = spark.createDataFrame([("v", 10.0), ("v", None), ("v", float("inf"))], "video_id string, duration double")
    rejected = spark.createDataFrame([("v", "a"), ("v", "a"), ("w", "b")], "video_id string, reject_code string")
    videos = spark.createDataFrame([("v", "u", None), ("w", "u2", "oops"), ("x", None, None)], "video_id string, video_url string, error string")
    got = E.video_results(kept, rejected, videos)
    assert [(r["video_id"], r["kept"], r["rejected"], r["seconds_kept"], r["reasons"]) for r in got.orderBy("video_id").collect()] == [("v", 3, 2, 10.0, {"a": 2}), ("w", 0, 1, 0.0, {"b": 1}), ("x", 0, 0, 0.0, {})]
    assert rows(E.run_summary(got), "videos", "kept", "rejected", "failed", "exit_code") == [(3, 3, 3, 1, 0)]
    assert rows(E.run_summary(got.withColumn("kept", F.lit(0))), "exit_code") == [(1,)] and rows(E.run_summary(got.limit(0)), "videos", "exit_code") == [(0, 0)]


def test_global_speakers(spark, rows):
    clips = spark.createDataFrame([("s/a.wav", "s", None), ("t/b.wav", "t", None), ("s/c.wav", "s", None), ("n.wav", None, None)], "audio_file string, speaker string, global_speaker string")
    linked = spark.createDataFrame([("s", "G0")], "speaker string, global_speaker string")
    there = clips.filter("audio_file <> 's/c.wav'").select("audio_file")
    assert rows(E.with_global_speakers(clips, linked, there), "audio_file", "global_speaker") == [("G0/a.wav", "G0"), ("_unassigned/b.wav", None), ("_unassigned/n.wav", None), ("s/c.wav", "G0")]


def test_retranscription_is_written_with_one_backup(spark, rows, tmp_path):
    clips = spark.createDataFrame([("a", "old a", 10.0), ("b", "old b", 10.0), ("gone", "x", 10.0)], "audio_file string, text string, duration double")
    cache = spark.createDataFrame([("a", "new", "ok"), ("b", None, "error")], "audio_file string, text string, status string")
    updated, gone, diffs, report = E.replaced_texts(clips, clips.filter("audio_file <> 'gone'"), cache)
    W.write_retranscribed(str(tmp_path), clips, updated, gone, diffs, report)
    W.write_retranscribed(str(tmp_path), updated.select(*clips.columns), updated, gone, diffs, report)
    assert rows(spark.read.parquet(str(tmp_path / "before")), "text") == [("old a",), ("old b",), ("x",)]
    assert rows(W.VersionedTable(spark, str(tmp_path / "metadata")).read(), "audio_file", "text") == [("a", "new"), ("b", "old b")]
    said = json.loads((tmp_path / "report.json").read_text())
    assert said == {"rows_before": 3, "rows_after": 2, "orphans_removed": 1, "clips_transcribed": 2, "transcripts_changed": 1, "transcripts_identical": 1, "empty_transcripts": 0, "hours": 0.006}


def test_caches_and_archives(spark, rows, tmp_path):
    words = spark.createDataFrame([("v", 0, "a", 0.12345, 1.0, 0.123456), (None, 0, "b", 0.0, 1.0, 0.5)], WORDS)
    for _ in range(2):
        W.write_word_cache(words, str(tmp_path / "words"))
    assert rows(R.read_word_cache(spark, str(tmp_path / "words"))) == [("v", 0, "a", 0.123, 1.0, 0.1235)]
    for name, x in (("a", 1.0), ("b", 2.0)):
        spark.createDataFrame([("s", [x]), (name, [x])], "speaker string, centroid array<double>").coalesce(1).write.parquet(str(tmp_path / "c" / name))
    assert rows(R.read_centroids(spark, str(tmp_path / "c" / "*"))) == [("a", [1.0]), ("b", [2.0]), ("s", [2.0])]


def test_spent_files(spark, tmp_path):
    for name in "abcd":
        (tmp_path / name).write_text("x")
    data = [(str(tmp_path / "a"), False, False), (str(tmp_path / "b"), True, False), (str(tmp_path / "c"), False, True), (str(tmp_path / "d"), None, None), (None, False, False)]
    assert W.delete_spent(spark.createDataFrame(data, "path string, is_local boolean, keep boolean")) == 1
    assert sorted(p.name for p in tmp_path.iterdir()) == ["b", "c", "d"]


def test_flags_and_names(spark, rows):
    kind = "audio_file string, speaker string, text string, dialect string, sure double"
    data = [(f"f{i}", "s", "our Studio clip", "x", 0.9) for i in range(3)] + [("g", "t", None, "y", 0.7), ("h", "t", "", None, 0.9), ("k", None, "", "z", None)]
    got = E.flag_report(spark.createDataFrame(data, kind), ["speaker"], "dialect", "sure", "audio_file", ["studio"], ["unclear"])
    assert rows(got, "audio_file", "flag_dialect", "flag_basis", "place") == [("f0", "x", "speaker_consensus", 1), ("f1", "x", "speaker_consensus", 2), ("f2", "x", "speaker_consensus", 3), ("g", "y", "clip", 4)]
    assert got.filter("place = 1").first()["flag_speaker_votes"] == {"x": 3} and got.filter("place = 1").first()["flag_lexical_markers"] == ["studio"]
    shards = spark.createDataFrame([("k", 0), ("k", 1)], "k string, shard int")
    assert rows(shards.select(E.numbered_shards(shards, "k", "shard").alias("name"))) == [("data/k/train-00000-of-00002.parquet",), ("data/k/train-00001-of-00002.parquet",)]
    assert spark.range(1).select(E.token_estimate(F.lit(1e6))).first()[0] == pytest.approx(32.0)
