"""Ranks over range partitions against plain ones."""

import random

from pyspark.sql import functions as F

from voxloom.operators.ranking import range_ranked


def test_ranks_of_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot", "hot", "hot", "a", None]), rng.randrange(5)) for i in range(2000)]
    got = range_ranked(spark.createDataFrame(rows, "id int, k string, x int"), ["k"], [F.col("x").desc(), F.col("id")], "r", "n", parts=9)
    want = {}
    for key in {k for _, k, _ in rows}:
        group = sorted((r for r in rows if r[1] == key), key=lambda r: (-r[2], r[0]))
        want |= {r[0]: (i, len(group)) for i, r in enumerate(group, 1)}
    assert {r["id"]: (r["r"], r["n"]) for r in got.collect()} == want


def test_whole_table_and_empty(spark):
    df = spark.createDataFrame([(5, 1), (3, 2), (4, 3)], "x int, part int")
    assert sorted((r["x"], r["part"], r["place"]) for r in range_ranked(df, [], [F.col("x")], "place").collect()) == [(3, 2, 1), (4, 3, 2), (5, 1, 3)]
    assert range_ranked(df.limit(0), ["x"], [F.col("x")]).count() == 0
