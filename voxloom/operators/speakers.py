"""Voices: robust centroids, purity, and linking over recordings by average linkage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions import vectors as V
from voxloom.operators.ranking import range_ranked


def mean_vectors(table: DataFrame, keys: list[str], vector: str, out: str = "centroid") -> DataFrame:
    """Unit mean vector per key; sums run map-side per dimension."""
    spread = table.select(*keys, F.posexplode(vector).alias("d", "x"))
    sums = spread.groupBy(*keys, "d").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = sums.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("d", "x"))).alias("v"))
    return ordered.select(*keys, V.unit(F.transform("v", lambda p: p["x"])).alias(out))


def robust_centroids(table: DataFrame, keys: list[str], vector: str, order: list[str]) -> DataFrame:
    """Per key the mean of all vectors, or from 4 on of the half (at least 2) nearest to it. Zero vectors don't count.

    ``order`` breaks ties.  The half is found by ranks over range partitions, so a voice of any size spreads over tasks.
    """
    used = table.filter(~V.is_zero(F.col(vector)))
    first = mean_vectors(used, keys, vector, "provisional")
    near = used.join(first, keys).withColumn("distance", V.cosine_distance(F.col(vector), F.col("provisional")))
    ranked = range_ranked(near.select(*keys, *order, vector, "distance"), keys, [F.col("distance"), *map(F.col, order)], "rank", "n")
    kept = ranked.filter((F.col("n") < 4) | (F.col("rank") <= F.greatest(F.lit(2), F.floor(F.col("n") / 2))))
    return mean_vectors(kept, keys, vector)


def purity(table: DataFrame, keys: list[str], vector: str, order: list[str], most: float = 0.45) -> DataFrame:
    """``table`` with ``speaker_distance``, ``speaker_conf`` and ``off_speaker`` by the key's centroid.

    Zero vectors have none and aren't off.
    """
    centroids = robust_centroids(table, keys, vector, order)
    joined = table.join(centroids, keys, "left")
    distance = F.when(~V.is_zero(F.col(vector)), V.cosine_distance(F.col(vector), F.col("centroid")))
    return joined.withColumn("speaker_distance", distance).withColumns({"speaker_conf": 1 - F.col("speaker_distance"), "off_speaker": F.coalesce(F.col("speaker_distance") > most, F.lit(False))}).drop("centroid")


def average_linkage(vectors: np.ndarray, threshold: float) -> np.ndarray:
    """Cluster number per unit vector: clusters merge while their mean cosine distance is below ``threshold``.

    The mean distance of two clusters is 1 less the inner product of their sums over the product of their sizes, so
    the sums stand for all pairs: memory follows the vectors and not their square.  A chain of nearest neighbours finds
    the merges, which are cut afterwards at the threshold, as average linkage allows: its merge distances never fall.
    """
    n = len(vectors)
    sums, size, name = np.array(vectors, np.float64), np.ones(n), np.arange(n)
    merges, chain = [], []
    alive = np.ones(n, bool)
    left = n
    while left > 1:
        if 2 * left < len(name):  # what was merged away needn't be compared any more
            place = np.cumsum(alive) - 1
            chain = [int(place[c]) for c in chain]
            sums, size, name, alive = sums[alive], size[alive], name[alive], np.ones(left, bool)
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        a = chain[-1]
        distance = np.clip(1.0 - sums @ sums[a] / (size * size[a]), 0.0, 2.0)
        distance[~alive] = np.inf
        distance[a] = np.inf
        b = int(distance.argmin())
        if len(chain) > 1 and distance[chain[-2]] <= distance[b]:
            b = chain[-2]
        if len(chain) < 2 or b != chain[-2]:
            chain.append(b)
            continue
        del chain[-2:]
        merges.append((float(distance[b]), int(name[a]), int(name[b])))
        sums[a] += sums[b]
        size[a] += size[b]
        alive[b] = False
        left -= 1
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for d, a, b in sorted(merges):
        if d < threshold:
            parent[find(b)] = find(a)
    return np.array([find(i) for i in range(n)])


def link_speakers(centroids: DataFrame, threshold: float = 0.35, block: str | None = None) -> DataFrame:
    """``(speaker, global_speaker)``: voices of all recordings clustered, labels numbered by pooled seconds, then size.

    ``centroids`` has ``speaker``, ``centroid`` and ``seconds``, a row per voice and recording.  Linkage needs all
    voices of a block at once, whose vectors and not their pairs lie in memory: without ``block`` that is one task for
    all voices; with it, voices are linked within the blocks of that column and numbered over all.
    """
    keyed = centroids.select("speaker", "centroid", F.coalesce("seconds", F.lit(0.0)).alias("seconds"), (F.col(block).cast("string") if block else F.lit("")).alias("block"))

    def link(table: pa.Table) -> pa.Table:
        order = table.sort_by("speaker")
        vectors = np.array(order["centroid"].to_pylist(), np.float64)
        clusters = average_linkage(vectors, threshold) if len(vectors) > 1 else np.zeros(len(vectors), int)
        names = order["speaker"].to_pylist()
        return pa.table({"speaker": order["speaker"], "seconds": order["seconds"], "cluster": pa.array([names[c] for c in clusters], pa.string())})

    linked = keyed.groupBy("block").applyInArrow(link, "speaker string, seconds double, cluster string")
    pooled = linked.groupBy("cluster").agg(F.sum("seconds").alias("seconds"), F.count("*").alias("members"))
    return linked.select("speaker", "cluster").join(number_labels(pooled), "cluster").select("speaker", "global_speaker")


def number_labels(pooled: DataFrame) -> DataFrame:
    """``(cluster, global_speaker)``, numbered from 00 by seconds, then members, then name."""
    ranked = range_ranked(pooled, [], [F.desc("seconds"), F.desc("members"), F.col("cluster")], "rank_")
    rank = F.col("rank_") - 1
    return ranked.select("cluster", F.concat(F.lit("GLOBAL_SPEAKER_"), F.when(rank < 100, F.lpad(rank.cast("string"), 2, "0")).otherwise(rank.cast("string"))).alias("global_speaker"))


def drop_thin(linked: DataFrame, seconds: DataFrame, least: float = 30.0) -> DataFrame:
    """Links of the global speakers that pool at least ``least`` seconds, numbered anew; 0 or less keeps all as is."""
    if least <= 0:
        return linked
    pooled = linked.join(seconds.select("speaker", "seconds"), "speaker", "left").groupBy(F.col("global_speaker").alias("cluster")).agg(F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"), F.count("*").alias("members"))
    numbered = number_labels(pooled.filter(F.col("seconds") >= least)).withColumnRenamed("global_speaker", "now")
    return linked.join(numbered, linked["global_speaker"] == numbered["cluster"]).select("speaker", F.col("now").alias("global_speaker"))
