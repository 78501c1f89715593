"""Payment layer: payments joined to the wide orders they pay for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions.times import parse_time, with_event_time
from tidemart.operators.orders import spread

# Where both sides have a column, the payment's value stands.
FROM_PAYMENT = {"payment_id": "id", "subject": "subject", "payment_type": "payment_type",
                "payment_create_time": "create_time", "callback_time": "callback_time",
                "order_id": "order_id", "user_id": "user_id", "total_amount": "total_amount"}


def join_payments(payments: DataFrame, wide: DataFrame, before: str = "15 minutes",
                  after: str = "0 seconds", delay: str = "1 second", salts: int = 1) -> DataFrame:
    """Payments with wide orders created at most `before` earlier or `after` later.

    A time that cannot be read joins with nothing.
    """
    left = with_event_time(payments, parse_time("create_time"), delay, "paid_at")
    right = with_event_time(wide, parse_time("create_time"), delay, "ordered_at")
    if salts > 1:
        right, left = spread(right, left, F.struct("detail_id", "sku_id"), salts)
    on = (F.col("p.order_id") == F.col("w.order_id")) & F.expr(
        f"w.ordered_at BETWEEN p.paid_at - INTERVAL {before} AND p.paid_at + INTERVAL {after}")
    if salts > 1:
        on = on & (F.col("p._salt") == F.col("w._salt"))
    joined = left.alias("p").join(right.alias("w"), on, "inner")
    columns = [F.col(f"p.{FROM_PAYMENT[c]}").alias(c) if c in FROM_PAYMENT
               else F.col("w.create_time").alias(c) if c == "order_create_time"
               else F.col(f"w.{c}") for c in schemas.PAYMENT_WIDE.names]
    return joined.select(*columns)


def untimed_payments(payments: DataFrame) -> DataFrame:
    """Payments whose time cannot be read; they are left out of the join."""
    return payments.where(parse_time("create_time").isNull())
