"""Periods and gaps against a plain fold."""

import random

import numpy as np
import pytest

from voxloom.operators.coverage import periods_and_gaps, run_union, speaking_periods

TURNS = "video_id string, start double, end double, speaker string"


def fold(turns):
    out = set()
    groups = {}
    for v, s, e, who in turns:
        if v is None or who is None or not who.strip() or s is None or e is None or not (np.isfinite(s) and np.isfinite(e)):
            continue
        a, b = int(np.floor(s * 1000 + 0.5)), int(np.floor(e * 1000 + 0.5))
        if b > a:
            groups.setdefault((v, who.strip().upper()), []).append((a, b))
    for key, spans in groups.items():
        now = None
        for a, b in sorted(spans):
            if now and a <= now[1]:
                now[1] = max(now[1], b)
            else:
                if now:
                    out |= {(*key, "period", *now), (*key, "gap", now[1], a)}
                now = [a, b]
        out.add((*key, "period", *now))
    return out


@pytest.mark.parametrize("shard_ms", [7, 1000, 600_000])
def test_random_turns(spark, shard_ms):
    rng = random.Random(shard_ms)
    turns = [(rng.choice("ab"), x := rng.randrange(400) / 10, x + rng.choice([-1, 0, 0.1, 0.5, 3, 20]), rng.choice(["s1", " S1", "s2 "])) for _ in range(300)]
    got = speaking_periods(spark.createDataFrame(turns, TURNS).repartition(3), shard_ms=shard_ms)
    assert set(map(tuple, got.collect())) == fold(turns)


def test_dirt(spark):
    nan, inf = float("nan"), float("inf")
    turns = [("v", 0.0, 1.0, "a"), ("v", 0.0, 1.0, "A "), ("v", 1.0, 2.0, "a"), ("v", None, 2.0, "a"), ("v", 3.0, None, "a"), ("v", nan, 9.0, "a"), ("v", 1.0, inf, "a"), ("v", 5.0, 4.0, "a"), ("v", 2.0, 2.0004, "a"), ("v", 3.0, 4.0, " "), ("v", 3.0, 4.0, None), (None, 3.0, 4.0, "a"), ("v", -3.0, -2.0, "a")]
    got = speaking_periods(spark.createDataFrame(turns, TURNS))
    assert set(map(tuple, got.collect())) == {("v", "A", "period", -3000, -2000), ("v", "A", "gap", -2000, 0), ("v", "A", "period", 0, 2000)}


def test_empty_and_clashing_columns(spark):
    assert speaking_periods(spark.createDataFrame([], TURNS)).collect() == []
    extra = spark.createDataFrame([("v", 0.0, 1.0, "a", 7, 8, 9)], TURNS + ", shard int, s int, VIDEO_ID int")
    assert [tuple(r) for r in speaking_periods(extra).collect()] == [("v", "A", "period", 0, 1000)]


def test_very_long_intervals_have_levels_of_their_own(spark):
    spans = spark.createDataFrame([("v", 0, 10**12), ("v", 5, 6), ("v", 2 * 10**12, 2 * 10**12 + 1)], "video_id string, start_ms long, end_ms long")
    got = periods_and_gaps(spans, ["video_id"], shard_ms=1000)
    assert {tuple(r) for r in got.collect()} == {("v", "period", 0, 10**12), ("v", "gap", 10**12, 2 * 10**12), ("v", "period", 2 * 10**12, 2 * 10**12 + 1)}


@pytest.mark.parametrize("most_pieces, hold", [(2, 3), (3, 500_000)])
def test_levels_and_streamed_blocks(spark, most_pieces, hold):
    rng = random.Random(most_pieces)
    turns = [(rng.choice("ab"), x := rng.randrange(4000) / 10, x + rng.choice([0.1, 0.5, 3, 90, 1000]), rng.choice(["s1", "s2", "s3"])) for _ in range(60)]
    turns += [("c", x / 10, (x + rng.choice([1, 2])) / 10, "s") for x in range(1500)] + [("d", -9e14, 9e14, "s"), ("d", 5.0, 6.0, "s"), ("d", 9.1e14, 9.2e14, "s")]
    got = speaking_periods(spark.createDataFrame(turns, TURNS).repartition(3), shard_ms=700, most_pieces=most_pieces, hold=hold)
    assert sorted(map(tuple, got.collect())) == sorted(fold(turns))


def test_run_union_of_far_owners():
    owner, s, e = run_union(np.array([0, 1, 1]), np.array([0, 2**61, 2**61 + 5]), np.array([1, 2**61 + 5, 2**61 + 6]))
    assert (owner.tolist(), s.tolist(), e.tolist()) == ([0, 1], [0, 2**61], [1, 2**61 + 6])
