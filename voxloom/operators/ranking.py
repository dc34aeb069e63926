"""Ranks and places without gathering a key, or the whole table, in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.storage import shuffle_width, write_table


def _rank_in_part(keys: list[str]):
    """Arrow mapper: rank of each row within partition and key; rows come sorted by key."""

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list | None = None
        rank = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            opens = np.zeros(n, bool)
            for k in keys:
                column = batch[k] if pa.types.is_dictionary(batch[k].type) else batch[k].dictionary_encode(null_encoding="encode")
                codes = column.indices.to_numpy(zero_copy_only=False)
                opens[1:] |= codes[1:] != codes[:-1]
            first = [batch[k][0].as_py() for k in keys]
            opens[0] = first != last
            starts = np.flatnonzero(opens)
            ranks = np.arange(1, n + 1)
            if len(starts):
                ranks[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, n)))
            ranks[: starts[0] if len(starts) else n] += rank
            last, rank = [batch[k][n - 1].as_py() for k in keys], int(ranks[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranks, pa.int64())], names=[*batch.schema.names, "rank_in_part_"])

    return mapper


def range_ranked(table: DataFrame, keys: list[str], order: list[Column], rank: str = "rank", size: str | None = None, parts: int | None = None) -> DataFrame:
    """``table`` with the ``rank`` from 1 of each row within ``keys`` by ``order``, and maybe the ``size`` of its group.

    ``order`` should settle ties.  Without keys the whole table is numbered.  Null keys are a group of their own; an
    empty table stays empty.

    Rows are range-partitioned by keys and order, so a group of any size is cut into parts.  Ranks within a part are
    written with the rows; a group's parts are at most as many as partitions, and their counts summed ahead give the
    rest.
    """
    spark = table.sparkSession
    names = table.columns
    n = parts or 2 * shuffle_width(spark)
    by = [F.col(k) for k in keys]
    placed = table.repartitionByRange(n, *by, *order).withColumn("part_number_", F.spark_partition_id()).sortWithinPartitions(*by, *order)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    rows, _ = write_table(placed.mapInArrow(_rank_in_part(keys), fields + ", rank_in_part_ long"), "ranked")
    counts = rows.groupBy(*keys, "part_number_").agg(F.count("*").alias("here"))
    of_key = Window.partitionBy(*(keys or [F.lit(0)]))
    ahead = counts.select(*[F.col(k).alias(f"key_{k}") for k in keys], F.col("part_number_").alias("part_"), (F.sum("here").over(of_key.orderBy("part_number_")) - F.col("here")).alias("ahead"), F.sum("here").over(of_key).alias("group_size"))
    same = rows["part_number_"] == ahead["part_"]
    for k in keys:
        same = same & rows[k].eqNullSafe(ahead[f"key_{k}"])
    joined = rows.join(ahead, same)
    return joined.select(*[rows[c] for c in names if c not in (rank, size)], (F.col("rank_in_part_") + F.col("ahead")).alias(rank), *([F.col("group_size").alias(size)] if size else []))
