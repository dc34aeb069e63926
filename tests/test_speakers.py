"""Voices: trimmed centroids, purity, linkage."""

import numpy as np
import pytest

from voxloom.operators import speakers as S

CLIP = "id int, speaker string, embedding array<double>"
E1, E2, FAR = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [-1.0, 0.0, 0.0]


def test_purity(spark):
    df = spark.createDataFrame([(i, "a", E1) for i in range(5)] + [(5, "a", E2), (6, "a", [0.0] * 3), (7, "b", E2)], CLIP)
    got = {r["id"]: r for r in S.purity(df, ["speaker"], "embedding", ["id"]).collect()}
    assert [i for i in got if got[i]["off_speaker"]] == [5]
    assert got[6]["speaker_distance"] is None and got[7]["speaker_conf"] == pytest.approx(1.0)
    assert S.purity(df.limit(0), ["speaker"], "embedding", ["id"]).count() == 0


def test_trimmed_centroid(spark):
    df = spark.createDataFrame([(i, "a", E1) for i in range(6)] + [(6, "a", FAR), (7, "a", FAR)], CLIP)
    assert S.robust_centroids(df, ["speaker"], "embedding", ["id"]).first()["centroid"][0] > 0.99


def brute(vectors, threshold):
    groups = [[i] for i in range(len(vectors))]
    d = np.clip(1 - vectors @ vectors.T, 0, 2)
    while len(groups) > 1:
        best = min((np.mean([d[i, j] for i in a for j in b]), x, y) for x, a in enumerate(groups) for y, b in enumerate(groups) if x < y)
        if best[0] >= threshold:
            break
        groups[best[1]] += groups.pop(best[2])
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("seed", range(6))
def test_average_linkage(seed):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(24, 5))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    labels = S.average_linkage(v, 0.5)
    assert {frozenset(np.flatnonzero(labels == c)) for c in set(labels)} == brute(v, 0.5)


def test_labels_by_seconds(spark, rows):
    df = spark.createDataFrame([("x", E1, 10.0), ("y", E2, 300.0), ("z", FAR, 50.0)], "speaker string, centroid array<double>, seconds double")
    linked = S.link_speakers(df)
    assert rows(linked) == [("x", "GLOBAL_SPEAKER_02"), ("y", "GLOBAL_SPEAKER_00"), ("z", "GLOBAL_SPEAKER_01")]
    assert rows(S.drop_thin(linked, df, 30.0)) == [("y", "GLOBAL_SPEAKER_00"), ("z", "GLOBAL_SPEAKER_01")]
    assert rows(S.drop_thin(linked, df, 0.0)) == rows(linked)
    pooled = spark.createDataFrame([("p", E1, 100.0), ("q", E1, 100.0), ("r", E2, 150.0)], df.schema)
    assert dict(rows(S.link_speakers(pooled)))["p"] == dict(rows(S.link_speakers(pooled)))["q"] == "GLOBAL_SPEAKER_00"
    assert S.link_speakers(df.limit(0)).count() == 0
    assert rows(S.link_speakers(df.limit(1)), "global_speaker") == [("GLOBAL_SPEAKER_00",)]
