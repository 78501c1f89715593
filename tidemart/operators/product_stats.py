"""Product statistics per window and sku, from seven streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart import codes, schemas
from tidemart.functions.times import text_to_millis, window_text, with_event_time
from tidemart.operators.dims import join_product

COUNTS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
          "comment_ct", "good_comment_ct"]
AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
# Distinct ids per window and sku; a row carries at most one of them.
ORDER_IDS = {"order_ct": "order_id", "paid_order_ct": "paid_order_id",
             "refund_order_ct": "refund_order_id"}


def _measures(rows: DataFrame, sku, ts, **given: Column) -> DataFrame:
    def value(name: str, kind: str, default) -> Column:
        return given.get(name, F.lit(default)).cast(kind).alias(name)

    return rows.select(sku.cast("bigint").alias("sku_id"), ts.cast("bigint").alias("ts"),
                       *[value(c, "bigint", 0) for c in COUNTS],
                       *[value(c, schemas.MONEY, 0) for c in AMOUNTS],
                       *[value(c, "bigint", None) for c in ORDER_IDS.values()])


def page_measures(pages: DataFrame, detail_page: str = "good_detail") -> DataFrame:
    """Clicks on a product's own page, and displays of products on any page, in one pass."""
    clicked = ((F.col("page.page_id") == detail_page) & (F.col("page.item_type") == "sku_id"))
    click = F.when(clicked, F.array(F.struct(F.col("page.item").alias("item"),
                                             F.lit(1).alias("click"))))
    shown = F.filter("displays", lambda d: d["item_type"] == "sku_id")
    display = F.transform(shown, lambda d: F.struct(d["item"].alias("item"),
                                                    F.lit(0).alias("click")))
    none = F.array().cast("array<struct<item: string, click: int>>")
    events = F.concat(F.coalesce(click, none), F.coalesce(display, none))
    rows = pages.select("ts", F.inline(events))
    return _measures(rows, F.col("item").try_cast("bigint"), F.col("ts"),
                     click_ct=F.col("click"), display_ct=1 - F.col("click"))


def favor_measures(favors: DataFrame) -> DataFrame:
    return _measures(favors, F.col("sku_id"), text_to_millis("create_time"), favor_ct=F.lit(1))


def cart_measures(carts: DataFrame) -> DataFrame:
    return _measures(carts, F.col("sku_id"), text_to_millis("create_time"), cart_ct=F.lit(1))


def order_measures(wide: DataFrame, amount: str = "split_total_amount") -> DataFrame:
    return _measures(wide, F.col("sku_id"), text_to_millis("create_time"),
                     order_id=F.col("order_id"), order_sku_num=F.col("sku_num"),
                     order_amount=F.coalesce(F.col(amount), F.lit(0)))


def payment_measures(paid: DataFrame) -> DataFrame:
    return _measures(paid, F.col("sku_id"), text_to_millis("payment_create_time"),
                     paid_order_id=F.col("order_id"),
                     payment_amount=F.coalesce(F.col("split_total_amount"), F.lit(0)))


def refund_measures(refunds: DataFrame) -> DataFrame:
    return _measures(refunds, F.col("sku_id"), text_to_millis("create_time"),
                     refund_order_id=F.col("order_id"),
                     refund_amount=F.coalesce(F.col("refund_amount"), F.lit(0)))


def comment_measures(comments: DataFrame) -> DataFrame:
    good = F.when(F.col("appraise") == codes.APPRAISE["good"], 1).otherwise(0)
    return _measures(comments, F.col("sku_id"), text_to_millis("create_time"),
                     comment_ct=F.lit(1), good_comment_ct=good)


def product_measures(pages, favors, carts, wide, paid, refunds, comments,
                     detail_page: str = "good_detail",
                     amount: str = "split_total_amount") -> DataFrame:
    return reduce(DataFrame.unionByName, [
        page_measures(pages, detail_page), favor_measures(favors), cart_measures(carts),
        order_measures(wide, amount), payment_measures(paid), refund_measures(refunds),
        comment_measures(comments)])


def _cents(rows: DataFrame) -> DataFrame:
    """The amounts as whole cents: sums of them are added as longs instead of wide decimals."""
    return rows.withColumns({c: (F.col(c) * 100).cast("bigint") for c in AMOUNTS})


def per_order(measures: DataFrame, width: str = "10 seconds", delay: str = "2 seconds") -> DataFrame:
    """Sums per tumbling window, sku and order id, amounts in cents: the first of two aggregates.

    On a stream all rows of a window come in one micro-batch, when the watermark has passed its end,
    and none comes later.
    """
    rows = with_event_time(_cents(measures), F.timestamp_millis("ts"), delay)
    rows = rows.withColumn("window", F.window("event_time", width))
    return rows.groupBy("window", "sku_id", *ORDER_IDS.values()).agg(*_sums())


def _sums() -> list[Column]:
    return [F.sum(c).cast("bigint").alias(c) for c in COUNTS + AMOUNTS] + [F.min("ts").alias("ts")]


def counted_orders(rows: DataFrame) -> DataFrame:
    """Sums and distinct order counts per window and sku, from `per_order`: the second aggregate.

    Every id stands in one row by now and is simply counted. A stream needs no state for it if it is
    done within each micro-batch (foreachBatch), as that has its windows whole.
    """
    counts = [F.count(c).alias(name) for name, c in ORDER_IDS.items()]
    stats = rows.groupBy("window", "sku_id").agg(*_sums(), *counts)
    cent = F.lit("0.01").cast("decimal(2,2)")
    amounts = [(F.col(c).cast("decimal(20,0)") * cent).cast(schemas.MONEY).alias(c) for c in AMOUNTS]
    return stats.select(*window_text(), "sku_id", *COUNTS, *amounts, *ORDER_IDS, "ts")


def window_product_stats(measures: DataFrame, width: str = "10 seconds",
                         delay: str = "2 seconds") -> DataFrame:
    """Sums and distinct order counts per tumbling window and sku.

    Two aggregates instead of three distinct counts: the first groups by the ids as well,
    after which every id stands in one row and is simply counted. That works on streams, keeps no
    set per group, and spreads a product that sells in very many orders.
    """
    return counted_orders(per_order(measures, width, delay))


def enrich_product_stats(stats: DataFrame, products: DataFrame, how: str = "left") -> DataFrame:
    """Names, price and ids from the dimensions, joined after the aggregate."""
    return (join_product(stats, products, how, price="sku_price")
            .select(*schemas.PRODUCT_STATS_COLUMNS))
