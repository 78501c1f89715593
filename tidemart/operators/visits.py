"""Visit layer: entry pages, daily unique visitors, bounces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.times import interval_millis, with_event_time


def is_entry(last_page: str = "page.last_page_id") -> Column:
    """A page reached from nowhere: no previous page, or an empty one."""
    return F.coalesce(F.col(last_page), F.lit("")) == ""


def entry_pages(pages: DataFrame) -> DataFrame:
    return pages.where(is_entry())


def unique_visitors(pages: DataFrame, order=("ts", "seq"), day_start: str = "0 hours",
                    delay: str = "1 day", salts: int = 4) -> DataFrame:
    """First entry page per device and day.

    A day is a one-day window, counted from `day_start` in UTC ('16 hours' for UTC+8).
    Batch: the row of rank one, which is pruned before the shuffle. Stream: a row of the first
    micro-batch that has one; a day is kept in state until `delay` after its end, and rows that come
    later than that are dropped. There, a device's rows of a day are first told apart by place in
    `salts` partitions of the state, each of which lets one row through, so that a device with very
    many rows sends no more than `salts` of them to the partition that decides.
    """
    entries = with_event_time(entry_pages(pages), F.timestamp_millis("ts"), delay)
    # The event time itself must not outlive the window: one event-time column per stream.
    entries = (entries.withColumn("day", F.window("event_time", "1 day", "1 day", day_start))
               .withColumn("mid", F.col("common.mid")).drop("event_time"))
    if pages.isStreaming:
        place = [c for c in order if c in pages.columns]
        salted = entries.withColumn("salt", F.pmod(F.xxhash64(*place), F.lit(salts)))
        first = salted.dropDuplicates(["mid", "day", "salt"]).dropDuplicates(["mid", "day"])
    else:
        rank = F.row_number().over(Window.partitionBy("mid", "day").orderBy(*order))
        first = entries.withColumn("rank", rank).where("rank = 1")
    return first.select(*pages.columns)


def user_jumps(pages: DataFrame, timeout: str = "10 seconds", delay: str = "1 second") -> DataFrame:
    """Entry pages that no further page of the same device follows within `timeout`.

    A follow-up at the very end of the timeout is too late; one in the same millisecond
    counts. No pair of rows is ever formed: time is cut into cells as long as the timeout,
    and an entry in cell n is followed in time if and only if

    * the last follow-up in cell n is not before it, or
    * the first follow-up in cell n + 1 is less than `timeout` after it.

    Both bounds come from one aggregate over windows of two cells that begin at every cell,
    so the join key is (device, cell), which spreads a busy device over time.
    """
    width = interval_millis(timeout)
    span, step = f"{2 * width} milliseconds", f"{width} milliseconds"
    cells = with_event_time(pages, F.timestamp_millis("ts"), delay)
    # The test mentions the event time, which keeps filters on it above the watermark of a stream:
    # pages of both kinds move the time on.
    cells = (cells.withColumn("mid", F.col("common.mid"))
             .withColumn("entry", F.when(F.col("event_time").isNotNull(), is_entry())))
    cells = cells.withColumn("cell", F.window("event_time", span, step)).drop("event_time")
    turn = F.unix_millis("cell.start") + width

    bounds = (cells.where("NOT entry").select("mid", "cell", "ts", turn.alias("turn"))
              .groupBy("mid", "cell")
              .agg(F.max(F.when(F.col("ts") < F.col("turn"), F.col("ts"))).alias("last_here"),
                   F.min(F.when(F.col("ts") >= F.col("turn"), F.col("ts"))).alias("first_next")))
    entries = cells.where(F.col("entry") & (F.col("ts") < turn))
    followed = ((F.col("last_here") >= F.col("ts"))
                | (F.col("first_next") < F.col("ts") + width))
    return (entries.join(bounds, ["mid", "cell"], "left_outer")
            .where(~F.coalesce(followed, F.lit(False)))
            .select(*pages.columns))
