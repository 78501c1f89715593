from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rows import frame, values
from tidemart import schemas
from tidemart.functions.times import (interval_millis, millis_to_text, parse_time, text_to_millis,
                                      whole_seconds)
from tidemart.operators import dims, orders, payments

DIM = schemas.dimension


def infos(spark, *times):
    return frame(spark, schemas.ORDER_INFO, [
        {"id": i, "user_id": 1, "province_id": 1, "create_time": t} for i, t in enumerate(times)])


def details(spark, *rows):
    return frame(spark, schemas.ORDER_DETAIL, [
        {"id": i, "order_id": o, "sku_id": 5, "create_time": t,
         "split_total_amount": Decimal("1.50")} for i, (o, t) in enumerate(rows)])


@pytest.mark.parametrize("salts", [1, 4])
def test_order_join_bounds(spark, salts):
    left = infos(spark, "2021-03-15 12:00:10", "2021-03-15 12:00:10")
    right = details(spark, (0, "2021-03-15 12:00:05"), (0, "2021-03-15 12:00:15"),
                    (0, "2021-03-15 12:00:04"), (0, "2021-03-15 12:00:16"),
                    (1, "2021-03-15 12:00:10"), (7, "2021-03-15 12:00:10"), (0, "soon"))
    joined = orders.join_order_details(left, right, salts=salts)
    assert values(joined, "order_id", "detail_id") == [(0, 0), (0, 1), (1, 4)]


def test_order_join_to_the_millisecond(spark):
    """With bounds of 5.000 s, a gap of 5.001 s is out."""
    left = infos(spark, "2021-03-15 12:00:10")
    right = details(spark, (0, "2021-03-15 12:00:15"))
    inside = orders.join_order_details(left, right, after="5000 milliseconds")
    outside = orders.join_order_details(left, right, after="4999 milliseconds")
    assert (inside.count(), outside.count()) == (1, 0)


def test_order_columns(spark):
    left = infos(spark, "2021-03-15 09:08:07")
    row = orders.join_order_details(left, details(spark, (0, "2021-03-15 09:08:07"))).first()
    assert (row.create_date, row.create_hour) == ("2021-03-15", "09")
    assert row.split_feight_fee is None
    ts = orders.order_times(left).first().create_ts
    assert ts == 1615799287000


def payment(spark, *times):
    return frame(spark, schemas.PAYMENT_INFO, [
        {"id": 100 + i, "order_id": 0, "user_id": 9, "total_amount": Decimal("7.00"),
         "create_time": t} for i, t in enumerate(times)])


@pytest.mark.parametrize("salts", [1, 3])
def test_payment_bounds(spark, salts):
    wide = frame(spark, schemas.ORDER_WIDE, [
        {"order_id": 0, "detail_id": 1, "user_id": 3, "total_amount": Decimal("2.00"),
         "split_total_amount": Decimal("1.00"), "create_time": "2021-03-15 12:30:00"}])
    paid = payment(spark, "2021-03-15 12:30:00", "2021-03-15 12:45:00", "2021-03-15 12:45:01",
                   "2021-03-15 12:29:59", "2021-03-15 00:30:00", None, "later")
    joined = payments.join_payments(paid, wide, salts=salts)
    assert values(joined, "payment_id") == [(100,), (101,)]
    row = joined.where("payment_id = 101").first()
    assert (row.user_id, row.total_amount, row.split_total_amount) == (9, 7, 1)
    assert row.order_create_time == "2021-03-15 12:30:00"
    assert row.payment_create_time == "2021-03-15 12:45:00"
    assert joined.columns == schemas.PAYMENT_WIDE.names
    assert values(payments.untimed_payments(paid), "id") == [(105,), (106,)]


def dimension_tables(spark):
    return {
        "users": frame(spark, DIM(["id", "birthday", "gender"]),
                       [{"id": "1", "birthday": "1990-06-02", "gender": "F"}]),
        "provinces": frame(spark, DIM(["id", "name", "area_code", "iso_code", "iso_3166_2"]),
                           [{"id": "1", "name": "Here", "area_code": "01"}]),
        "skus": frame(spark, DIM(["id", "sku_name", "price", "spu_id", "tm_id", "category3_id"]),
                      [{"id": "5", "sku_name": "thing", "price": "9.99", "spu_id": "6",
                        "tm_id": "7", "category3_id": "8"},
                       {"id": "9", "sku_name": "odd", "price": "cheap", "spu_id": "x"}]),
        "spus": frame(spark, DIM(["id", "spu_name"]), [{"id": "6", "spu_name": "things"}]),
        "trademarks": frame(spark, DIM(["id", "tm_name"]), [{"id": "7", "tm_name": "brand"}]),
        "categories": frame(spark, DIM(["id", "name"]), []),
    }


def test_missing_dimensions_keep_the_row(spark):
    tables = dimension_tables(spark)
    products = dims.product_dimension(*[tables[t] for t in
                                        ("skus", "spus", "trademarks", "categories")])
    joined = orders.join_order_details(
        infos(spark, "2021-03-15 12:00:00", "2021-03-15 12:00:00").withColumn(
            "user_id", F.when(F.col("id") == 1, 77).otherwise(F.col("user_id"))),
        details(spark, (0, "2021-03-15 12:00:00"), (1, "2021-03-15 12:00:00")))
    joined = joined.withColumn("province_id", F.when(F.col("order_id") == 0, 1))
    wide = orders.enrich_orders(joined, tables["users"], tables["provinces"], products,
                                F.lit("2021-06-01").cast("date"))
    assert wide.columns == schemas.ORDER_WIDE.names
    assert values(wide, "order_id", "user_age", "user_gender", "province_name", "sku_name",
                  "spu_name", "tm_name", "category3_id", "category3_name") == [
        (0, 30, "F", "Here", "thing", "things", "brand", 8, None),
        (1, None, None, None, "thing", "things", "brand", 8, None)]
    inner = orders.enrich_orders(joined, tables["users"], tables["provinces"], products, how="inner")
    assert inner.count() == 1
    odd = products.where("id = '9'").first()
    assert (odd.sku_name, odd.price, odd.spu_id) == ("odd", None, None)


def test_merge_partial_rows(spark):
    first = frame(spark, schemas.ORDER_WIDE, [{"detail_id": 1, "user_id": 4, "sku_num": None}])
    second = frame(spark, schemas.ORDER_WIDE, [
        {"detail_id": 1, "user_id": 5, "sku_num": 2, "split_total_amount": Decimal("3.00")}])
    row = orders.merge_partial(first, second, ["detail_id"]).first()
    assert (row.user_id, row.sku_num, row.split_total_amount) == (4, 2, 3)
    lone = frame(spark, schemas.ORDER_WIDE, [{"detail_id": 2, "user_id": 6}])
    both = orders.merge_partial(first, lone, ["detail_id"]).orderBy("detail_id").collect()
    assert [(r.detail_id, r.user_id) for r in both] == [(1, 4), (2, 6)]


def test_times(spark):
    df = spark.createDataFrame([("2021-03-15 12:00:00",), ("2021-03-15",), (None,)], "t string")
    assert [r[0] for r in df.select(text_to_millis("t")).collect()] == [1615809600000, None, None]
    assert df.select(text_to_millis("t", "+08:00")).first()[0] == 1615780800000
    assert spark.range(1).select(
        millis_to_text(F.lit(1615780800000), "+08:00")).first()[0] == "2021-03-15 12:00:00"
    assert spark.range(1).select(
        F.unix_millis(whole_seconds(F.lit(1615780800999)))).first()[0] == 1615780800000
    assert spark.range(1).select(parse_time(F.lit("2021-03-15T12:00:00"))).first()[0] is None
    for odd in ("2021-03-15 10:0:5.1", "2021-3-15 010:00:00", "2021-03-15 12:00:0 "):
        assert spark.range(1).select(parse_time(F.lit(odd))).first()[0] is None
    assert interval_millis("15 minutes") == 900_000


def test_a_key_finds_the_row_with_its_own_text(spark):
    """Keys "7", "07" and " 7" all cast to 7; the text of the key is "7"."""
    facts = spark.createDataFrame([(7, "a"), (8, "b")], "k bigint, f string")
    dimension = spark.createDataFrame([("7", "seven"), ("07", "other"), (" 7", "blank"), ("x", "none"), (None, "n")],
                                      "id string, name string")
    joined = dims.join_dimension(facts, dimension, "k", {"name": "name"})
    assert sorted(map(tuple, joined.select("k", "name").collect())) == [(7, "seven"), (8, None)]
