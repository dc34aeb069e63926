"""Vectors as arrays of numbers, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """``v`` at length 1; a zero vector stays."""
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n)).otherwise(F.transform(v, lambda x: x.cast("double")))


def is_zero(v: Column) -> Column:
    """Whether all components are 0, as for clips too short to embed."""
    return ~F.exists(v, lambda x: x != 0)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 minus the inner product of unit vectors."""
    return F.lit(1.0) - dot(a, b)


def nonzero_mean(values: Column) -> Column:
    """Mean of the values other than 0 and null; null without any."""
    kept = F.filter(values, lambda x: x.isNotNull() & (x != 0))
    return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda s, x: s + x) / F.size(kept))


def mean_log_prob(scores: Column, tokens: Column, special: list[int]) -> Column:
    """Mean of the scores whose tokens aren't special ones; null without any."""
    pairs = F.filter(F.arrays_zip(scores.alias("s"), tokens.alias("t")), lambda p: ~p["t"].isin(*special))
    return F.when(F.size(pairs) > 0, F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + p["s"]) / F.size(pairs))


def best(candidates: Column, *keys) -> Column:
    """The candidate with the greatest keys; of equal ones the first. ``keys`` map a candidate to a value."""
    ranked = F.transform(candidates, lambda x, i: F.struct(*[k(x).alias(f"k{n}") for n, k in enumerate(keys)], (-i).alias("first"), x.alias("value")))
    return F.array_max(ranked)["value"]
