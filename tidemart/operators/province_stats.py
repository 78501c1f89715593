"""Province statistics, as SQL over the wide-order table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions.times import parse_time, with_event_time

PROVINCE = ("province_id, province_name, province_area_code, province_iso_code, "
            "province_3166_2_code")


def order_wide_table(wide: DataFrame, delay: str = "0 seconds", view: str = "order_wide") -> str:
    """The topic as an SQL table with rowtime and watermark."""
    with_event_time(wide, parse_time("create_time"), delay, "rowtime").createOrReplaceTempView(view)
    return view


def province_stats(wide: DataFrame, width: str = "10 seconds", delay: str = "0 seconds",
                   amount: str = "split_total_amount", view: str = "order_wide") -> DataFrame:
    """Orders, details and amount per tumbling window and province.

    The inner query leaves one row per order, so the outer one counts distinct orders; both
    aggregate before they shuffle, so a province with most of the orders is no hot spot.
    """
    table = order_wide_table(wide, delay, view)
    return wide.sparkSession.sql(f"""
        WITH windowed AS (
            SELECT window(rowtime, '{width}') AS window, {PROVINCE}, order_id,
                   {amount} AS amount
            FROM {table}),
        per_order AS (
            SELECT window, {PROVINCE}, order_id,
                   count(*) AS details, CAST(sum(amount) AS {schemas.MONEY}) AS amount
            FROM windowed
            GROUP BY window, {PROVINCE}, order_id)
        SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
               {PROVINCE},
               CAST(sum(amount) AS {schemas.MONEY}) AS order_amount,
               count(order_id) AS order_count,
               sum(details) AS detail_count
        FROM per_order
        GROUP BY window, {PROVINCE}""")


def with_clock(stats: DataFrame, columns: list[str]) -> DataFrame:
    """Sink-side ts (processing time in ms) and the column order of the table."""
    return stats.withColumn("ts", F.unix_timestamp() * 1000).select(*columns)
