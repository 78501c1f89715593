"""Sharding by a two-pass external shuffle.

Pass one scatters the records over buckets by a seeded hash, each small enough for memory. Pass two
gathers each bucket, shuffles it (Fisher-Yates) and deals it out. Native throughout.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.shared import row_hash, saved

BUCKET_BYTES = 8 << 20
RECORD_BYTES = 128      # what a record takes besides its text
COPIES_AT_ONCE = 10_000


def text_size(text: str) -> Column:
    """Bytes of the text in UTF-8, none for null, plus 1."""
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1).cast("bigint")


def shuffled(records: DataFrame, shards: int = 8, text: str = "text", key: str = "doc_id",
             seed: int = 23, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The records with `shard` (0 to shards - 1) and `slot` (gapless from 0 in each shard).

    The order of all records is bucket after bucket, each bucket in the order of its shuffle; they
    are dealt to the shards in turn, so that counts differ by one at most. Records go to buckets by
    the hash of key and all columns; copies of one record that would fill a bucket are numbered first and
    go by their numbers too. Beforehand are counted all bytes, for the number of buckets, the copies
    of each record, and the records of each bucket, for where it begins. The same records, shards
    and seed give the same result. No records: no rows.
    """
    columns = records.columns
    size = text_size(text) + RECORD_BYTES
    total = records.agg(F.sum(size)).first()[0] or 0
    buckets = max(2 * shards, math.ceil(total / bucket_bytes))
    record = F.struct(*[F.col(f"`{c}`") for c in columns])
    mark = row_hash(F.col(f"`{key}`").cast("string"), F.xxhash64(record).cast("string"), seed=seed)
    marked = records.select(mark.alias("__hash"), F.xxhash64(record).alias("__tie"),
                            record.alias("__record"), size.alias("__size"))
    placed = _spread_copies(marked, bucket_bytes, seed).withColumn(
        "__bucket", F.col("__hash") % buckets)
    counts = placed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))

    scattered = placed.repartition(buckets, "__bucket")
    # a fixed order before the shuffle, whatever order the records arrive in
    gathered = scattered.groupBy("__bucket").agg(F.collect_list(
        F.struct("__hash", "__tie", "__record")).alias("bag"))
    gathered = gathered.select("__bucket", F.array_sort("bag", _by_hash).alias("bag"))
    mixed = gathered.sortWithinPartitions("__bucket").select(
        "__bucket", F.shuffle("bag", F.lit(seed)).alias("bag"))
    dealt = mixed.join(begins, "__bucket").select(
        "begin", F.posexplode("bag").alias("place", "item"))
    order = F.col("begin") + F.col("place")
    return dealt.select(*[F.col("item.__record").getField(c).alias(c) for c in columns],
                        (order % shards).cast("int").alias("shard"),
                        F.floor(order / shards).cast("bigint").alias("slot"))


def _spread_copies(marked: DataFrame, bucket_bytes: int, seed: int) -> DataFrame:
    """Rows (__hash, __tie, __record); copies of one record that outgrow a bucket get new hashes.

    Such copies are counted before the shuffle and written out again by number, COPIES_AT_ONCE in
    a row. Records are taken as equal where both of their hashes are (124 bits).
    """
    marks = ["__hash", "__tie"]
    many = saved(marked.groupBy(*marks).agg(F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("n"))
                 .where(F.col("bytes") > bucket_bytes).where("n > 1").select(*marks), "copies")
    few = marked.join(many, marks, "left_anti").select(*marks, "__record")
    counted = marked.join(many, marks, "left_semi").groupBy(*marks).agg(
        F.first("__record").alias("__record"), F.count(F.lit(1)).alias("n"))
    chunks = counted.select("*", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / COPIES_AT_ONCE))).alias("chunk"))
    begin = F.col("chunk") * COPIES_AT_ONCE
    numbered = chunks.repartition(*marks, "chunk").select(*marks, "__record", F.explode(F.sequence(
        begin, F.least(begin + COPIES_AT_ONCE, F.col("n")) - 1)).alias("copy"))
    return few.unionByName(numbered.select(
        row_hash(F.col("__hash").cast("string"), F.col("copy").cast("string"), seed=seed)
        .alias("__hash"), "__tie", "__record"))


def _by_hash(a: Column, b: Column) -> Column:
    """Order of two records by hash, then by the hash of all columns; equal ones are the same."""
    less = (a["__hash"] < b["__hash"]) | ((a["__hash"] == b["__hash"]) & (a["__tie"] < b["__tie"]))
    same = (a["__hash"] == b["__hash"]) & (a["__tie"] == b["__tie"])
    return F.when(less, -1).when(same, 0).otherwise(1)


def write_shards(records: DataFrame, path: str, **how) -> None:
    """One folder per shard, its files and their records in slot order."""
    placed = shuffled(records, **how)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(path)
