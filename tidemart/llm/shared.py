"""What several operators need: tables of a folder, written intermediates, components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, compression: str | None = None,
          at_once: int | None = None) -> DataFrame:
    """The rows as written below the shared folder: lineage ends here, lost executors lose nothing.

    The folder belongs to the run; whoever empties spark.checkpoint.dir removes it. `at_once`: how many
    rows a writer gathers, and a reader takes, at the most; for large rows, as Parquet looks at the
    size of what it has gathered every hundred rows only.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}"
    writer = df.write
    if at_once:
        writer = writer.option("parquet.block.row.count.limit", at_once)
    writer.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_hash(*parts: Column | str, seed: int = 0) -> Column:
    """60 uniform bits of a row's key, the same in every engine that has MD5; null keys are a value."""
    texts = [F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("~"))
             for p in parts]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


HASH_BITS = 60
ROWS_PER_BATCH = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """`df`, for Python functions over texts: from now on the session hands rows to Python
    ROWS_PER_BATCH at a time at the most, as a batch is held in memory with its texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(key)) > ROWS_PER_BATCH:
        df.sparkSession.conf.set(key, str(ROWS_PER_BATCH))
    return df


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run`, a function over batches, after which a Python worker holds no memory it doesn't use.

    Workers outlive their tasks and stages; what the allocators keep for later adds up in an executor.
    """
    @wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return whole


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text. A null id counts as ''."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == part


def components(edges: DataFrame, longest: int = 60) -> DataFrame:
    """Connected components of the links (a, b): rows (node, root) of all linked nodes but
    the roots; a root is the smallest node of its component.

    Large-star and small-star steps in turn, each a group minimum and a join, until the links are
    stars. Links are written after each round; only a count and a sum of hashes reach the driver.
    """
    now = saved(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = _mark(now)
    for _ in range(longest):
        now = saved(_small_star(_large_star(now)), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError(f"links have not become stars in {longest} rounds")


def _mark(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), total).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
