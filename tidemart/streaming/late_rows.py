"""Rows that come too late for the windows of a summary, kept and counted.

A stateful query drops such rows and tells their number only. Beside it, this branch reads the same
topic without state: a ledger holds how far the event time had come in each micro-batch, so the
watermark of a batch follows from the batches before it, a replay judges by the same one, and what
the windows leave out is written to a topic and counted by window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.times import interval_millis
from tidemart.sources.batches import BatchTable

REACHED = T.StructType([T.StructField("batch", T.LongType()), T.StructField("ts", T.LongType())])
# Spark drops rows by the watermark that the batch before began with: that of the batches up to the
# last but one.
BEHIND = 2


@dataclass(frozen=True)
class Ledger:
    """How far the event time had come in each micro-batch of one query."""

    spark: SparkSession
    path: str
    delay: str

    @property
    def table(self) -> BatchTable:
        return BatchTable(self.spark, self.path, REACHED)

    def watermark(self, batch_id: int) -> int | None:
        """Epoch ms behind which rows of a batch are late; None while nothing is."""
        before = self.table.batches(before=batch_id - BEHIND + 1)
        reached = before.agg(F.max("ts")).first()[0]
        return None if reached is None else reached - interval_millis(self.delay)

    def note(self, rows: DataFrame, batch_id: int, ts: str = "ts") -> None:
        """One row for the batch: the largest event time in it and in those before."""
        here = rows.agg(F.max(ts).alias("ts")).select(F.lit(batch_id).cast("bigint").alias("batch"), "ts")
        last = self.table.batches(after=batch_id - 2, before=batch_id).select(
            F.lit(batch_id).cast("bigint").alias("batch"), "ts")
        self.table.append(here.unionByName(last).groupBy("batch").agg(F.max("ts").alias("ts")), batch_id)
        self.table.forget(before=batch_id - BEHIND)


def window_end(width: str, ts: str = "ts") -> Column:
    """Epoch ms at which the tumbling window of a row ends."""
    size = interval_millis(width)
    return (F.floor(F.col(ts) / F.lit(size)) + 1) * size


def late(rows: DataFrame, watermark: int | None, width: str, ts: str = "ts") -> DataFrame:
    """Rows whose window of `width` had closed: its end is not behind the watermark."""
    if watermark is None:
        return rows.where("false")
    return rows.where(window_end(width, ts) <= watermark)


def late_counts(rows: DataFrame, width: str, ts: str = "ts") -> DataFrame:
    """Late rows by the window they belong to: stt, edt, late_ct."""
    size = interval_millis(width)
    end = window_end(width, ts)
    shown = [F.date_format(F.timestamp_millis(x), "yyyy-MM-dd HH:mm:ss") for x in (end - size, end)]
    return rows.groupBy(shown[0].alias("stt"), shown[1].alias("edt")).agg(
        F.count(F.lit(1)).alias("late_ct"))
