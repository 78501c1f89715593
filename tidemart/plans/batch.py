"""Batch plans: the layers joined end to end over bounded tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.operators import logs as log_ops
from tidemart.operators import orders as order_ops
from tidemart.operators import product_stats as product_ops
from tidemart.operators import province_stats as province_ops
from tidemart.operators import visitor_stats as visitor_ops
from tidemart.operators.dims import join_province, product_dimension
from tidemart.operators.payments import join_payments
from tidemart.operators.visits import unique_visitors, user_jumps


def split_logs(lines: DataFrame, order=("ts", "seq"),
               saved: str | None = None) -> dict[str, DataFrame]:
    """Raw lines (value, seq) to page, start, display and dirty rows.

    The branches share the parsed and repaired rows. With `saved`, a shared folder, those are
    written there once and the branches read them; without, each branch computes them itself,
    which is right when only one of them is wanted.
    """
    logs = log_ops.repair_new_flags(log_ops.parse_logs(lines), order)
    if saved:
        logs.write.mode("overwrite").parquet(saved)
        logs = lines.sparkSession.read.schema(logs.schema).parquet(saved)
    pages = log_ops.page_logs(logs)
    return {"page": pages, "start": log_ops.start_logs(logs),
            "display": log_ops.display_logs(pages), "dirty": log_ops.dirty_lines(lines)}


def visit_columns(pages: DataFrame, *order: str) -> DataFrame:
    """Only what the visitor statistics read, so that their shuffles carry no more."""
    return pages.select(
        F.struct("common.mid", "common.vc", "common.ch", "common.ar", "common.is_new")
        .alias("common"),
        F.struct("page.during_time", "page.last_page_id").alias("page"), *order)


def visitor_stats(pages: DataFrame, width: str = "10 seconds", timeout: str = "10 seconds",
                  order=("ts", "seq"), day_start: str = "0 hours") -> DataFrame:
    narrow = visit_columns(pages, *order)
    return visitor_ops.visitor_stats(narrow, unique_visitors(narrow, order, day_start),
                                     user_jumps(narrow, timeout), width)


def order_wide(orders: DataFrame, details: DataFrame, users: DataFrame, provinces: DataFrame,
               skus: DataFrame, spus: DataFrame, trademarks: DataFrame, categories: DataFrame,
               as_of: Column | None = None, how: str = "left") -> DataFrame:
    products = product_dimension(skus, spus, trademarks, categories)
    return order_ops.enrich_orders(order_ops.join_order_details(orders, details),
                                   users, provinces, products, as_of, how)


def province_stats(orders: DataFrame, details: DataFrame, provinces: DataFrame,
                   width: str = "10 seconds") -> DataFrame:
    wide = join_province(order_ops.join_order_details(orders, details), provinces)
    return province_ops.province_stats(wide, width)


def product_stats(pages: DataFrame, favors: DataFrame, carts: DataFrame, orders: DataFrame,
                  details: DataFrame, payments: DataFrame, refunds: DataFrame,
                  comments: DataFrame, products: DataFrame,
                  width: str = "10 seconds", saved: str | None = None) -> DataFrame:
    """Wide rows serve orders and payments without their dimensions: those join afterwards.

    With `saved`, a shared folder, orders are joined to their details once: the five columns that
    the measures need are written there and read twice.
    """
    wide = order_ops.join_order_details(orders, details).select(
        "order_id", "sku_id", "sku_num", "split_total_amount", "create_time")
    if saved:
        wide.write.mode("overwrite").parquet(saved)
        wide = orders.sparkSession.read.schema(wide.schema).parquet(saved)
    blank = {f.name: F.lit(None).cast(f.dataType) for f in schemas.ORDER_WIDE
             if f.name not in wide.columns}
    paid = join_payments(payments, wide.withColumns(blank))
    measures = product_ops.product_measures(pages, favors, carts, wide, paid, refunds, comments)
    return product_ops.enrich_product_stats(
        product_ops.window_product_stats(measures, width), products)
