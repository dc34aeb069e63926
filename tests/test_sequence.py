"""Folds, batches, splits and references against plain ones."""

import random

from pyspark.sql import functions as F

from voxloom.operators import sequence as Q

WORD = "video_id string, pos int, text string, start double, end double"


def kept(df):
    return sorted(r["pos"] for r in df.collect())


def test_time_repeats(spark):
    words = spark.createDataFrame([("v", 0, "a", 0.0, 1.0), ("v", 1, "A!", 0.05, 1.0), ("v", 2, "a", 0.10, 1.0), ("v", 3, "b", 0.1, 1.0), ("v", 4, "...", 0.2, 1.0), ("v", 5, "a", 9.0, 9.1), ("w", 6, "a", 0.05, 1.0)], WORD)
    assert kept(Q.dedupe_by_time(words)) == [0, 2, 3, 5, 6]
    assert Q.dedupe_by_time(words.limit(0)).count() == 0


def test_rolling(spark):
    text = "a b c b c d e a a x y x y x y z".split()
    keep = [i for i, k in enumerate(Q.collapse_rolling(text)) if k]
    words = spark.createDataFrame([(v, i, t, float(i), float(i)) for v in "vw" for i, t in enumerate(text)], WORD)
    assert kept(Q.dedupe_rolling(words)) == sorted(keep * 2)
    assert [text[i] for i in keep] == "a b c d e a a x y z".split()


def test_rolling_streams_alike(spark):
    rng = random.Random(4)
    text = [rng.choice("abc") for _ in range(3000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 97)
    try:
        words = spark.createDataFrame([("v", i, t, float(i), float(i)) for i, t in enumerate(text)], WORD)
        assert kept(Q.dedupe_rolling(words)) == [i for i, k in enumerate(Q.collapse_rolling(text)) if k]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_tracks(spark):
    rows = [("v", i, t, float(i), float(i), k, timed) for k, timed, base in (("yt_manual", False, 0), ("yt_auto", False, 100), ("yt_auto", True, 200)) for i, t in enumerate(["a", "b", "a", "b", "[x]"], base)]
    df = spark.createDataFrame(rows, WORD + ", kind string, word_timed boolean").withColumn("video_id", F.concat("video_id", "kind", F.col("word_timed").cast("string")))
    assert kept(Q.dedupe_track(df)) == [0, 1, 2, 3, 100, 101, 200, 201, 202, 203]


def test_shards_and_batches(spark, rows):
    df = spark.createDataFrame([("k", i, s) for i, s in enumerate([5.0, 6.0, 1.0, 20.0, None, 3.0])], "k string, i int, size double")
    assert [r[1] for r in rows(Q.shards_after_reach(df, ["k"], ["i"], "size", 10), "i", "shard")] == [0, 0, 1, 1, 2, 2]
    assert [r[1] for r in rows(Q.batches_before_exceed(df, ["k"], ["i"], "size", 10, 2), "i", "batch")] == [0, 1, 1, 2, 3, 3]
    assert [r[1] for r in rows(Q.fixed_batches(df, ["k"], [F.col("i")], 4), "i", "batch")] == [0, 0, 0, 0, 1, 1]


def test_packs_over_batches(spark):
    """Against plain folds, whatever the batches of rows are."""
    rng = random.Random(6)
    data = [(k, i, rng.choice([None, 0.0, 0.1, 1.5, 3.0, 30.0])) for k in ("a", "b", None) for i in range(300)]
    shards, batches = {}, {}
    for key in ("a", "b", None):
        shard, held, batch, total, n = 0, 0.0, 0, 0.0, 0
        for k, i, size in data:
            if k != key:
                continue
            x = size or 0.0
            shards[k, i], held = shard, held + x
            if held >= 7:
                shard, held = shard + 1, 0.0
            if n and (total + x > 5 or n >= 4):
                batch, total, n = batch + 1, 0.0, 0
            batches[k, i], total, n = batch, total + x, n + 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 41)
    try:
        df = spark.createDataFrame(data, "k string, i int, size double")
        assert {(r["k"], r["i"]): r["shard"] for r in Q.shards_after_reach(df, ["k"], ["i"], "size", 7).collect()} == shards
        assert {(r["k"], r["i"]): r["batch"] for r in Q.batches_before_exceed(df, ["k"], ["i"], "size", 5, 4).collect()} == batches
        assert Q.shards_after_reach(df.limit(0), ["k"], ["i"], "size", 7).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_split(spark):
    df = spark.createDataFrame([(f"{g}{i}", g) for g, n in (("a", 40), ("b", 1), ("c", 5)) for i in range(n)], "audio_file string, g string")
    got = Q.train_validation(df, F.col("g"), "audio_file", 0.1)
    counts = {r["g"]: r["n"] for r in got.filter("split = 'validation'").groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert counts == {"a": 4}
    again = Q.train_validation(df.repartition(7), F.col("g"), "audio_file", 0.1)
    assert got.select("audio_file", "split").exceptAll(again.select("audio_file", "split")).count() == 0


def test_references(spark):
    kind = "audio_file string, speaker string, duration double, squim_mos double"
    df = spark.createDataFrame([("a1", "a", 5.0, 4.0), ("a2", "a", 5.0, 3.0), ("a3", "a", 1.0, 5.0), ("b1", "b", 1.0, None), ("c1", "c", 50.0, 1.0), ("c2", "c", 60.0, float("nan"))], kind)
    got = {r["audio_file"]: r["ref_audio"] for r in Q.assign_references(df, F.col("speaker"), [F.col("audio_file")]).collect()}
    assert got == {"a1": "a2", "a2": "a1", "a3": "a1", "b1": None, "c1": "c2", "c2": "c1"}
