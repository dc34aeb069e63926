"""Selection of columns from tables that may hold others of clashing names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only; of columns equal but for case the exactly named one, of equal ones the first."""
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*[F.col(f"`{n}`") for n in names])
    place = {c: i for i, c in reversed(list(enumerate(df.columns)))}
    numbered = df.toDF(*[f"column_{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"column_{place[n]}").alias(n) for n in names])
