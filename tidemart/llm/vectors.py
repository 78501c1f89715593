"""Searches of vectors in blocks: which rows take part, how queries meet blocks, the nearest of all.

A query set meets every block of rows once; within a block each operator finds its own nearest by
its own index, and the nearest of the nearest are found by a group per query.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.shared import row_hash


def proper(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, v): the rows whose vector is neither null, empty, zero nor holds a null or non-finite
    number, with a number each. Several rows may share an id, or be the same; null ids take no part.
    """
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(f"`{key}`").cast("bigint").alias("vec_id"),
                          F.col(f"`{vector}`").cast("array<double>").alias("v"))
    sound = rows.where(F.col("vec_id").isNotNull() & v.isNotNull()).where(~bad).where(
        F.exists(v, lambda x: x != 0.0))
    return sound.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v")


def in_blocks(rows: DataFrame, queries: DataFrame, search: Callable[[pa.Table, pa.Table], pa.Table],
              schema: str, together: list[str], n_blocks: int, n_chunks: int) -> DataFrame:
    """`search(chunk of queries, block of rows)` for every pair of a chunk and a block.

    Rows fall into `n_blocks` blocks and queries into `n_chunks` chunks by the hash of `row`; only
    those with equal columns `together` meet. Each row is sent once per chunk, each query once per
    block, so choose the numbers for blocks and chunks of thousands.
    """
    def spread(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        mine = (row_hash("row", seed=3) % parts).cast("int")
        return df.withColumn(own, mine).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    keys = [*together, "block", "chunk"]
    # columns of their own: Spark prunes those of a side that shares its columns with the other
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])
    blocks = spread(rows, "block", n_blocks, "chunk", n_chunks)
    chunks = spread(queries, "chunk", n_chunks, "block", n_blocks)
    return chunks.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInArrow(search, schema)


def nearest(found: DataFrame, k: int, *order: Column) -> DataFrame:
    """`rank` 1 to k of the rows of each query, which is a row itself (query_row)."""
    by = Window.partitionBy("query_row").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
