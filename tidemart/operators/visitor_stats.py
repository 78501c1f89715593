"""Visitor statistics per window, version, channel, area and new flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.times import window_text, with_event_time
from tidemart.operators.visits import is_entry

KEYS = ["vc", "ch", "ar", "is_new"]
MEASURES = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def _measures(pages: DataFrame, **given: Column) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return pages.select(*[F.col(f"common.{k}").alias(k) for k in KEYS],
                        *[given.get(m, zero).cast("bigint").alias(m) for m in MEASURES], "ts")


def page_measures(pages: DataFrame) -> DataFrame:
    """One view and its dwell time per page; an entry page also starts a session."""
    return _measures(pages, pv_ct=F.lit(1),
                     sv_ct=F.when(is_entry(), 1).otherwise(0),
                     dur_sum=F.coalesce(F.col("page.during_time"), F.lit(0)))


def unique_visitor_measures(uniques: DataFrame) -> DataFrame:
    return _measures(uniques, uv_ct=F.lit(1))


def jump_measures(jumps: DataFrame) -> DataFrame:
    return _measures(jumps, uj_ct=F.lit(1))


def visitor_stats(pages: DataFrame, uniques: DataFrame, jumps: DataFrame,
                  width: str = "10 seconds", delay: str = "11 seconds") -> DataFrame:
    """Sums of all measures per tumbling window; ts is the earliest of the window."""
    rows = (page_measures(pages).unionByName(unique_visitor_measures(uniques))
            .unionByName(jump_measures(jumps)))
    rows = with_event_time(rows, F.timestamp_millis("ts"), delay)
    rows = rows.withColumn("window", F.window("event_time", width))
    stats = rows.groupBy("window", *KEYS).agg(
        *[F.sum(m).alias(m) for m in MEASURES], F.min("ts").alias("ts"))
    return stats.select(*window_text(), *KEYS, *MEASURES, "ts")
