"""Interval algebra: case tables and random timelines against plain folds."""

import random

import pytest
from pyspark.sql import functions as F

from voxloom.operators import intervals as I

SPAN = "video_id string, start double, end double"
TURN = SPAN + ", speaker string"


@pytest.mark.parametrize(("holes", "left"), [([(4, 6)], [(0, 4), (6, 10)]), ([(0, 10)], []), ([(2, 4), (3, 6)], [(0, 2), (6, 10)]), ([], [(0, 10)]), ([(10, 12)], [(0, 10)])])
def test_subtract(spark, rows, holes, left):
    regions = spark.createDataFrame([("v", 0.0, 10.0)], SPAN)
    got = I.subtract(regions, spark.createDataFrame([("v", float(a), float(b)) for a, b in holes], SPAN), 3.0)
    assert rows(got, "start", "end") == sorted((float(a), float(b)) for a, b in left)


def test_subtract_keeps_repeats(spark):
    regions = spark.createDataFrame([("v", 0.0, 4.0)] * 2, SPAN)
    assert I.subtract(regions, spark.createDataFrame([("v", 1.0, 2.0)], SPAN)).count() == 4


@pytest.mark.parametrize("width", [1.0, 60.0])
def test_overlap_join_once_each(spark, width):
    rng = random.Random(1)
    a = [(rng.choice("xy"), s := rng.random() * 20, s + rng.random() * 8) for _ in range(60)]
    b = [(rng.choice("xy"), s := rng.random() * 20, s + rng.random() * 3) for _ in range(60)]
    got = I.overlap_join(spark.createDataFrame(a, SPAN), spark.createDataFrame(b, SPAN), width)
    want = [(*x, *y) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and x[2] > y[1]]
    assert sorted(tuple(r) for r in got.select("video_id", "start", "end", "r_video_id", "r_start", "r_end").collect()) == sorted(want)


def test_merge_same_speaker(spark, rows):
    pieces = spark.createDataFrame([("v", 0.0, 3.0, "A"), ("v", 3.2, 6.0, "A"), ("v", 6.1, 7.0, "B"), ("v", 7.1, 8.0, "A"), ("v", 11.0, 12.0, "A")], TURN)
    assert rows(I.merge_same_speaker(pieces), "start", "end", "speaker") == [(0.0, 6.0, "A"), (11.0, 12.0, "A"), (6.1, 7.0, "B"), (7.1, 8.0, "A")]


def test_overlapped_speech(spark, rows):
    turns = spark.createDataFrame([("v", 0.0, 5.0, "A"), ("v", 4.0, 6.0, "B"), ("v", 4.5, 7.0, "A"), ("v", 8.0, 9.0, "A"), ("v", 8.0, 9.0, "A")], TURN)
    assert rows(I.overlapped_speech(turns), "start", "end") == [(4.0, 6.0)]
    assert I.overlapped_speech(turns.limit(0)).count() == 0


def test_assign_speakers(spark, rows):
    region = spark.createDataFrame([("v", 0.0, 10.0), ("w", 0.0, 1.0)], SPAN)
    turns = spark.createDataFrame([("v", 0.0, 5.0, "A"), ("v", 5.0, 8.0, "B")], TURN)
    assert rows(I.assign_speakers(region, turns)) == [("v", 0.0, 5.0, "A"), ("v", 5.0, 8.0, "B"), ("w", 0.0, 1.0, "SPEAKER_00")]


def test_dominant_is_one_turn_and_first_of_ties(spark, rows):
    slices = spark.createDataFrame([("v", 0.0, 4.0)], SPAN)
    turns = spark.createDataFrame([("v", 0.0, 2.0, "B"), ("v", 2.0, 4.0, "A")], TURN)
    assert rows(I.dominant_speaker(slices, turns), "speaker") == [("B",)]
    thin = spark.createDataFrame([("v", 0.0, 1.9, "B"), ("v", 2.0, 3.0, "B")], TURN)
    assert I.dominant_speaker(slices, thin).count() == 0


def chunks_and_words(spark, chunks, words):
    c = spark.createDataFrame([("v", i, float(a), float(b)) for i, (a, b) in enumerate(chunks)], "video_id string, chunk_index int, start double, end double")
    w = spark.createDataFrame([("v", i, f"w{i}", float(a), float(b), s) for i, (a, b, s) in enumerate(words)], "video_id string, pos int, text string, start double, end double, score double")
    return {r["chunk_index"]: r for r in I.own_words(c, w).collect()}


def test_word_ownership(spark):
    got = chunks_and_words(spark, [(0, 5), (5, 10), (20, 30)], [(1, 1.5, -2.0), (2, 2.5, -4.0), (6, 6.5, -1.0)])
    assert (got[0]["text"], got[0]["score"], got[0]["aligned_words"]) == ("w0 w1", -3.0, 2)
    assert got[1]["text"] == "w2"
    assert (got[2]["text"], got[2]["score"], got[2]["aligned_words"], got[2]["boundary_clipped"]) == ("", None, 0, False)


def test_word_clipping_and_halves(spark):
    assert chunks_and_words(spark, [(0, 5)], [(4.6, 5.4, None)])[0]["boundary_clipped"]
    padded = chunks_and_words(spark, [(0, 5.2), (4.8, 10)], [(5.0, 5.15, None)])
    assert not padded[0]["boundary_clipped"] and not padded[1]["boundary_clipped"] and padded[0]["text"] == padded[1]["text"] == "w0"
    assert [r["text"] for _, r in sorted(chunks_and_words(spark, [(0, 5), (5, 10)], [(4.6, 5.2, None)]).items())] == ["w0", ""]
    assert [r["text"] for _, r in sorted(chunks_and_words(spark, [(0, 5), (5, 10)], [(4.5, 5.5, None), (7.0, 7.0, None)]).items())] == ["w0", "w0 w1"]


def test_windows_tile(spark):
    words = spark.createDataFrame([("v", i, i * 10.0) for i in range(60)], "video_id string, pos int, start double")
    got = sorted((r["first_pos"], r["end_pos"]) for r in I.plan_windows(words, 200.0).collect())
    assert got == [(0, 20), (20, 40), (40, 60)]


def test_split_span():
    assert I.split_span(0, 20, [(0, 5), (5.3, 11), (12, 20)]) == [(0, 11), (12, 20)]
    assert all(b - a <= 12 for a, b in I.split_span(0, 30, [(0, 30)])) and len(I.split_span(0, 30, [(0, 30)])) == 3
    assert I.split_span(0, 5, []) == [(0, 5)]


def test_build_chunks(spark, rows):
    region = spark.createDataFrame([("v", 0.0, 5.0), ("v", 5.3, 11.0), ("v", 12.0, 20.0)], SPAN)
    turn = spark.createDataFrame([("v", 0.0, 20.0, "A")], TURN)
    got = rows(I.build_chunks(region, turn), "start", "end", "speaker", "chunk_index")
    assert got == [(0.0, 11.2, "A", 0), (11.8, 20.2, "A", 1)]
    assert I.build_chunks(spark.createDataFrame([("v", 0.0, 0.5)], SPAN), turn).count() == 0
    short = I.build_chunks(spark.createDataFrame([("v", 0.0, 3.0), ("v", 3.2, 6.0)], SPAN), turn, spark.createDataFrame([("v", 6.1)], "video_id string, duration double"))
    assert rows(short, "start", "end") == [(0.0, 6.1)]


def test_fill_and_collapse(spark, rows):
    words = spark.createDataFrame([("v", 0, 1.0, 1.0), ("v", 1, 2.0, None), ("v", 2, 3.0, 4.0)], "video_id string, pos int, start double, end double")
    assert rows(I.fill_ends(words), "pos", "end") == [(0, 2.0), (1, 3.0), (2, 4.0)]
    turns = spark.createDataFrame([("v", 0.0, 95.0, "A"), ("v", 95.0, 100.0, "B"), ("w", 0.0, 6.0, "A"), ("w", 6.0, 10.0, "B")], TURN)
    assert rows(I.collapse_dominant(turns), "video_id", "speaker") == [("v", "A"), ("v", "A"), ("w", "A"), ("w", "B")]


def test_label_runs(spark):
    row = spark.range(1).select(I.label_runs(F.array(*map(F.lit, [0, 5, 5, 0, 7, 0])), F.array(*[F.lit(x) for x in [0.0, -1.0, -3.0, 0.0, -4.0, 0.0]]), 0).alias("r")).first()["r"]
    assert [tuple(x) for x in row] == [(1, 3, 5, -2.0), (4, 5, 7, -4.0)]


def test_bogus_ends_are_not_expanded(spark, rows):
    from voxloom.operators import intervals as I

    kind = "video_id string, start double, end double, speaker string"
    left = spark.createDataFrame([("v", 0.0, 10.0, "a"), ("v", 5.0, 1e15, "b"), ("w", 0.0, 1e9, "c"), ("v", None, 3.0, "d"), ("v", 20.0, 30.0, "e")], kind)
    right = spark.createDataFrame([("v", 1.0, 2.0, "x"), ("v", 8.0, 9e14, "y"), ("v", 1e12, 1e12 + 1, "z"), ("w", 5e8, 5e8 + 1, "u"), ("v", 3.0, None, "n")], kind)
    got = rows(I.overlap_join(left, right, 1.0).select("speaker", "r_speaker"))
    assert got == [("a", "x"), ("a", "y"), ("b", "y"), ("b", "z"), ("c", "u"), ("e", "y")]
