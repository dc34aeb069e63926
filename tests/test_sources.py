"""Readers and writers."""

import json

import pytest
from pyspark.sql import functions as F

from voxloom.operators import gates
from voxloom.sources import readers as R
from voxloom.sources import writers as W

CAPTION = "video_id string, content string"


def words(df):
    return [(r["text"], round(r["start"], 3), round(r["end"], 3)) for r in df.orderBy("video_id", "pos").collect()]


def test_event_captions(spark):
    content = json.dumps({"events": [{"tStartMs": 0, "dDurationMs": 2000, "segs": [{"utf8": "hello "}, {"utf8": "big world", "tOffsetMs": 500}]}, {"dDurationMs": 5}, {"tStartMs": 3000, "segs": [{"utf8": "\n"}, {"utf8": "x"}]}]})
    df = spark.createDataFrame([("v", content), ("bad", "{nope"), ("none", None)], CAPTION)
    got = R.caption_events(df)
    assert words(got) == [("hello", 0.0, 0.5), ("big", 0.5, 0.5), ("world", 0.5, 2.0), ("x", 3.0, 3.0)]
    assert got.first()["word_timed"]


def test_cue_captions(spark):
    content = "WEBVTT\n\n1\n00:00:01.000 --> 00:00:03.000 align:start\n<c>one</c> two\nthree &amp; four\n\n2\n00:00:04,000 --> 00:00:06,000\nfive <00:00:04.500><c> six</c><00:00:05.000> seven\n"
    got = R.caption_cues(spark.createDataFrame([("v", content), ("w", "no cues"), ("x", None)], CAPTION))
    assert words(got) == [("one", 1.0, 1.4), ("two", 1.4, 1.8), ("three", 1.8, 2.2), ("&", 2.2, 2.6), ("four", 2.6, 3.0), ("five", 4.0, 4.5), ("six", 4.5, 5.0), ("seven", 5.0, 6.0)]


def test_specs(spark, rows, tmp_path):
    (tmp_path / "list.txt").write_text("# note\n\n b \na\nb\nfile:///x.mp3\n")
    table = R.source_table(R.read_specs(spark, str(tmp_path / "list.txt")), ("video.example",), ("v.example",))
    assert [r["spec"] for r in table.orderBy("ordinal").collect()] == ["b", "a", "file:///x.mp3"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        R.read_specs(spark, str(tmp_path / "none.txt"))


def test_listing(spark, rows):
    kind = "parent string, child string, position int, is_video boolean, title string, live_status string"
    listing = spark.createDataFrame([("c", "v1", 0, True, "t", None), ("c", "p", 1, False, "t", None), ("c", None, 2, True, "t", None), ("c", "v3", 3, True, "[Private video]", None), ("c", "v4", 4, True, "t", "is_live"), ("p", "v2", 0, True, "t", None), ("p", "c", 1, False, "t", None), ("p", "v1", 2, True, "t", None)], kind)
    specs = spark.createDataFrame([("c", 0), ("v9", 1)], "spec string, ordinal long")
    assert rows(R.expand_listing(spark, specs, listing), "spec", "depth") == [("v1", 1), ("v2", 2), ("v9", 0)]


def test_jsonl_and_cache(spark, rows, tmp_path):
    assert R.read_jsonl(spark, str(tmp_path / "missing"), "a int").count() == 0
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"a": 1}\n{oops\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        R.read_jsonl(spark, str(bad), "a int").collect()
    log = tmp_path / "cache.jsonl"
    log.write_text('{"audio_file": "x", "status": "error"}\n{broken\n{"audio_file": "y", "status": "ok"}\n{"audio_file": "x", "status": "ok"}\n')
    assert rows(R.read_cache(spark, str(log), "audio_file string, status string")) == [("x", "ok"), ("y", "ok")]


def test_words_and_turns(spark, rows):
    df = spark.createDataFrame([("v", '[{"t":"a","s":0.0,"e":1.0,"c":0.5},{"t":"b","s":1.0,"e":2.0}]'), ("w", "[{"), ("x", None)], CAPTION)
    assert rows(R.cached_words(df), "text", "score") == [("a", 0.5), ("b", 0.0)]
    turns, overlaps = R.diarization_turns(spark.createDataFrame([("v", '{"turns":[{"start":0,"end":2,"speaker":"A"}],"overlaps":[]}')], CAPTION))
    assert rows(turns) == [("v", 0.0, 2.0, "A")] and overlaps.count() == 0


def test_feed(spark, rows, tmp_path):
    (tmp_path / "feed.xml").write_text('<rss><channel><item><title>One</title><guid>g</guid><enclosure url="u1" length="5"/></item><item><title>Two</title></item></channel></rss>')
    assert rows(R.read_feed(spark, str(tmp_path / "feed.xml")), "title", "url", "length") == [("One", "u1", 5)]


def test_predictions(spark, rows):
    def line(uri, answer, status=""):
        return json.dumps({"request": {"contents": [{"parts": [{"text": "p"}, {"fileData": {"fileUri": f"store://b/batch/clips/{uri}.flac"}}]}]}, "status": status, "response": {"candidates": [{"content": {"parts": [{"text": answer}]}}]} if answer is not None else None})

    lines = spark.createDataFrame([(line("a/b_c", '[{"i":1,"text":"x"}]'),), (line("d", "no"),), (line("e", None),), (line("f", "[]", "quota"),), ("{}",)], "value string")
    assert rows(gates.batch_entries(R.prediction_batches(lines, "batch")), "audio_file", "status") == [("a/b_c.wav", "ok"), ("d.wav", "unparseable"), ("e.wav", "no_response"), ("f.wav", "batch:quota")]


def test_tracks_and_files(spark):
    df = spark.createDataFrame([(["en"], ["ar"]), ([], ["ar"]), ([], [])], "m array<string>, a array<string>")
    got = [r[0] for r in df.select(R.choose_track(F.col("m"), F.col("a"), ["ar", "en"])).collect()]
    assert [tuple(x) if x else None for x in got] == [("en", "yt_manual"), ("ar", "yt_auto"), None]
    files = spark.createDataFrame([("v", "v.en.vtt", "2024-01-02 00:00:00"), ("v", "v.ar.vtt", "2024-01-01 00:00:00"), ("v", "v.ar.json3", "2024-01-01 00:00:00")], "video_id string, path string, modified string").withColumn("modified", F.col("modified").cast("timestamp"))
    assert R.newest_file(files, "video_id", ["ar"]).first()["path"] == "v.ar.json3"


def test_fetch(spark, rows):
    def get(spec, client):
        if spec == "gone":
            raise ValueError("Private video, sorry")
        if client == "first":
            raise ValueError("try another")
        return {"id": spec, "client": client}

    got = rows(R.fetch(spark.createDataFrame([("a",), ("gone",)], "spec string"), get, ["first", "first", "second"]))
    assert got == [("a", '{"client": "second", "id": "a"}', None), ("gone", None, "Private video, sorry")]


def test_state(spark, rows):
    states = spark.createDataFrame([("a", True, 1, 2, 3.0), ("b", False, 0, 0, 0.0)], "video_id string, complete boolean, kept long, rejected long, seconds_kept double")
    found = spark.createDataFrame([("a",), ("b",), ("c",)], "source_id string")
    assert rows(R.pending_sources(states, found)) == [("b",), ("c",)]
    assert rows(R.run_state(states, found), "source_id", "complete", "kept") == [("a", True, 1), ("b", False, 0), ("c", False, 0)]


def test_local_files(spark, tmp_path):
    for name in ("10.mp3", "2.MP3", "x.txt"):
        (tmp_path / name).write_bytes(b"1")
    assert [r["path"].rsplit("/", 1)[-1] for r in R.local_files(spark, str(tmp_path)).orderBy("key").collect()] == ["2.MP3", "10.mp3"]


def test_versions(spark, rows, tmp_path):
    store = W.VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        store.read()
    store.replace(spark.range(3))
    store.replace(store.read().filter("id > 0"))
    store.replace(store.read().filter("id > 1"))
    assert rows(store.read()) == [(2,)] and store.version() == 3


def test_versions_survive_a_crash(spark, rows, tmp_path):
    store = W.VersionedTable(spark, str(tmp_path / "t"))
    store.replace(spark.range(20))
    store.replace(spark.range(20, 40))
    # a crash ahead of the marker: the version before is current, and what was left behind is written anew
    spark.range(3).write.parquet(f"{store.versions.folder(3)}/rows")
    assert store.version() == 2 and store.read().count() == 20 and store.versions.note(2) == {}
    assert store.replace(store.read().unionByName(spark.range(1))) == 3 and store.read().count() == 21
    with pytest.raises(Exception, match="(?i)exist"):
        store.versions.complete(3)  # a second writer of the same number
    for v in (2, 3):
        W.delete_path(spark, f"{store.versions.folder(v)}/{W.Versions.MARKER}")
    with pytest.raises(RuntimeError, match="none is complete"):
        store.replace(spark.range(2))


def test_small_files_are_replaced_in_one_step(spark, tmp_path):
    for text in ("old", "new"):
        W.write_text(spark, str(tmp_path / "f.txt"), text)
        assert (tmp_path / "f.txt").read_text() == text
    assert not (tmp_path / "f.txt.draft").exists()


def test_emptied_videos_vanish(spark, rows, tmp_path):
    kept, rejected = str(tmp_path / "kept"), str(tmp_path / "rejected")
    kind = "video_id string, x int, reject_code string, reject_value double"
    W.write_split(spark.createDataFrame([("a", 1, None, None), ("b", 2, None, None), ("c/ d", 3, "q", 1.0)], kind), kept, rejected)
    for _ in range(2):
        W.write_split(spark.createDataFrame([("a", 1, "q", 0.5), ("c/ d", 3, None, None)], kind), kept, rejected)
    assert rows(spark.read.parquet(kept), "video_id", "x") == [("b", 2), ("c/ d", 3)]
    assert rows(spark.read.parquet(rejected), "video_id", "x") == [("a", 1)]


def test_working_folder_of_a_cluster_must_be_named():
    from voxloom import storage

    class Settings:
        def get(self, key, default=None):
            return default

    class Context:
        def __init__(self, master):
            self.applicationId, self.master = master, master

        def getConf(self):
            return Settings()

    class Session:
        conf = Settings()

        def __init__(self, master):
            self.sparkContext = Context(master)

    assert storage.shared_root(Session("local[2]")).startswith("file://")
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        storage.shared_root(Session("spark://host:7077"))


def test_partitions(spark, rows, tmp_path):
    path, df = str(tmp_path / "p"), spark.createDataFrame([("a b/c", 1), ("d", 2)], "video_id string, x int")
    for _ in range(2):
        W.replace_partitions(df, path)
    W.replace_partitions(df.filter("x = 2").withColumn("x", F.lit(5)), path)
    assert rows(spark.read.parquet(path), "video_id", "x") == [("a b/c", 1), ("d", 5)]
    assert W.drop_video(spark, path, "a b/c") == 1 and W.drop_video(spark, path, "zzz") == 0
    assert rows(spark.read.parquet(path), "video_id") == [("d",)]


def test_small_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    W.write_document(df, str(tmp_path / "d.json"))
    assert json.loads((tmp_path / "d.json").read_text()) == {"k": "a", "n": 1}
    failed = spark.createDataFrame([("u", "oops"), ("w", None)], "url string, error string")
    assert W.write_failed(failed, str(tmp_path / "failed")) == 1 and (tmp_path / "failed").exists()
    assert W.write_failed(failed.filter("error IS NULL"), str(tmp_path / "failed")) == 0 and not (tmp_path / "failed").exists()
    W.write_shards(df.withColumn("shard", F.lit(0)), str(tmp_path / "s"), ["k", "shard"])
    assert (tmp_path / "s" / "k=a" / "shard=0").exists()
    assert "| n | 1 |" in W.markdown_card("T", {"n": 1})
