"""Order layer: time columns, interval joins, the wide order row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions.times import text_to_millis, with_event_time
from tidemart.operators.dims import join_product, join_province, join_user


def order_times(orders: DataFrame) -> DataFrame:
    """create_date, create_hour and create_ts from the create_time text."""
    day_and_clock = F.split("create_time", " ")
    return (orders.withColumn("create_date", F.get(day_and_clock, F.lit(0)))
            .withColumn("create_hour", F.get(F.split(F.get(day_and_clock, F.lit(1)), ":"), F.lit(0)))
            .withColumn("create_ts", text_to_millis("create_time")))


def detail_times(details: DataFrame) -> DataFrame:
    return details.withColumn("create_ts", text_to_millis("create_time"))


def spread(many: DataFrame, one: DataFrame, over: Column, salts: int) -> tuple:
    """Salt a join: `many` gets one of `salts` numbers, `one` a copy for each of them.

    For streams, where AQE cannot split the partition of a hot key. `one` has few rows per
    key, so its copies are bounded by `salts`.
    """
    salt = F.pmod(F.xxhash64(over), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return many.withColumn("_salt", salt), one.withColumn("_salt", copies)


def join_order_details(orders: DataFrame, details: DataFrame, before: str = "5 seconds",
                       after: str = "5 seconds", delay: str = "0 seconds",
                       salts: int = 1) -> DataFrame:
    """Orders with their details, created at most `before` earlier or `after` later.

    Both bounds included. The same plan serves batch and streams. What follows from other columns is
    made behind the join, so that it is neither shuffled nor kept as state.
    """
    left = with_event_time(orders, F.timestamp_millis(text_to_millis("create_time")), delay, "order_at")
    right = with_event_time(details, F.timestamp_millis(text_to_millis("create_time")), delay,
                            "detail_at")
    if salts > 1:
        right, left = spread(right, left, F.struct("id", "sku_id"), salts)
    order, detail = left.alias("o"), right.alias("d")
    on = (F.col("o.id") == F.col("d.order_id")) & F.expr(
        f"d.detail_at BETWEEN o.order_at - INTERVAL {before} AND o.order_at + INTERVAL {after}")
    if salts > 1:
        on = on & (F.col("o._salt") == F.col("d._salt"))
    joined = order.join(detail, on, "inner").select(
        F.col("d.id").alias("detail_id"), F.col("o.id").alias("order_id"), "d.sku_id",
        "d.order_price", "d.sku_num", "d.sku_name", "o.province_id", "o.order_status",
        "o.user_id", "o.total_amount", "o.activity_reduce_amount", "o.coupon_reduce_amount",
        "o.original_total_amount", "o.feight_fee",
        F.lit(None).cast(schemas.MONEY).alias("split_feight_fee"),
        "d.split_activity_amount", "d.split_coupon_amount", "d.split_total_amount",
        "o.expire_time", "o.create_time", "o.operate_time")
    return order_times(joined).drop("create_ts")


def enrich_orders(wide: DataFrame, users: DataFrame, provinces: DataFrame, products: DataFrame,
                  as_of: Column | None = None, how: str = "left") -> DataFrame:
    """User, province and product columns. The detail's own sku name gives way to the product's."""
    wide = join_user(wide, users, as_of, how)
    wide = join_province(wide, provinces, how)
    wide = join_product(wide, products, how)
    return wide.select(*schemas.ORDER_WIDE.names)


# Columns that two partial wide rows of one order detail can fill for each other.
MERGED = ["order_status", "create_time", "create_date", "coupon_reduce_amount",
          "activity_reduce_amount", "original_total_amount", "feight_fee", "total_amount",
          "user_id", "sku_id", "sku_name", "order_price", "sku_num", "split_activity_amount",
          "split_coupon_amount", "split_total_amount"]


def merge_partial(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Partial rows by key; in each merged column the first non-null value wins.

    A row that only one side has is kept; other columns come from the first side alone.
    """
    other = second.select(*keys, *[F.col(c).alias(f"_{c}") for c in MERGED])
    merged = {c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in MERGED}
    return (first.join(other, keys, "full").withColumns(merged)
            .select(*first.columns))
