"""Schemas of every topic, dimension and output table."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "DECIMAL(18,2)"

_LONG, _INT, _TEXT, _MONEY = T.LongType(), T.IntegerType(), T.StringType(), T.DecimalType(18, 2)
_TEXTS = T.MapType(_TEXT, _TEXT)


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# One raw log line. `start` stays text: only its presence is tested. A display keeps
# every key it came with, so its elements are maps.
LOG = struct(
    common=struct(ar=_TEXT, ba=_TEXT, ch=_TEXT, is_new=_TEXT, md=_TEXT, mid=_TEXT, os=_TEXT,
                  uid=_TEXT, vc=_TEXT),
    page=struct(during_time=_LONG, item=_TEXT, item_type=_TEXT, last_page_id=_TEXT,
                page_id=_TEXT),
    displays=T.ArrayType(_TEXTS),
    start=_TEXT,
    ts=_LONG)

# The same lines as the keyword job reads them.
LOG_MAPS = struct(
    common=_TEXTS, page=_TEXTS, ts=_LONG)

# Value of a change topic as the capture tool writes it; seq is optional.
CHANGE_ENVELOPE = struct(
    op=_TEXT, before=_TEXTS, after=_TEXTS, seq=_LONG)

# A normalised change.
CHANGE = struct(
    database=_TEXT, table=_TEXT, type=_TEXT, data=_TEXTS, before=_TEXTS, seq=_LONG)

# A change as a dimension table keeps it.
KEYED_CHANGE = struct(key=_TEXT, seq=_LONG, type=_TEXT, data=_TEXTS)

# The columns of a stored dimension, in order.
STORED_COLUMN = struct(position=_LONG, name=_TEXT)

# A version of a rule, as the routing job notes it down.
RULE_VERSION = struct(**{c: _TEXT for c in (
    "source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk",
    "sink_extend")}, since=_LONG, gone=T.BooleanType())

# First row flagged new, per device.
FIRST_VISIT = struct(mid=_TEXT, ts=_LONG)

RULE_COLUMNS = ["source_table", "operate_type", "sink_type", "sink_table",
                "sink_columns", "sink_pk", "sink_extend"]

ORDER_INFO = struct(
    id=_LONG, province_id=_LONG, user_id=_LONG, order_status=_TEXT, total_amount=_MONEY,
    activity_reduce_amount=_MONEY, coupon_reduce_amount=_MONEY, original_total_amount=_MONEY,
    feight_fee=_MONEY, expire_time=_TEXT, create_time=_TEXT, operate_time=_TEXT)

ORDER_DETAIL = struct(
    id=_LONG, order_id=_LONG, sku_id=_LONG, sku_num=_LONG, order_price=_MONEY,
    split_total_amount=_MONEY, split_activity_amount=_MONEY, split_coupon_amount=_MONEY,
    sku_name=_TEXT, create_time=_TEXT)

PAYMENT_INFO = struct(
    id=_LONG, order_id=_LONG, user_id=_LONG, total_amount=_MONEY, subject=_TEXT,
    payment_type=_TEXT, create_time=_TEXT, callback_time=_TEXT)

FAVOR_INFO = struct(
    sku_id=_LONG, create_time=_TEXT)
CART_INFO = struct(
    sku_id=_LONG, create_time=_TEXT)
REFUND_INFO = struct(
    sku_id=_LONG, order_id=_LONG, refund_amount=_MONEY, create_time=_TEXT)
COMMENT_INFO = struct(
    sku_id=_LONG, appraise=_TEXT, create_time=_TEXT)

ORDER_WIDE = struct(
    detail_id=_LONG, order_id=_LONG, sku_id=_LONG, order_price=_MONEY, sku_num=_LONG,
    sku_name=_TEXT, province_id=_LONG, order_status=_TEXT, user_id=_LONG, total_amount=_MONEY,
    activity_reduce_amount=_MONEY, coupon_reduce_amount=_MONEY, original_total_amount=_MONEY,
    feight_fee=_MONEY, split_feight_fee=_MONEY, split_activity_amount=_MONEY,
    split_coupon_amount=_MONEY, split_total_amount=_MONEY, expire_time=_TEXT, create_time=_TEXT,
    operate_time=_TEXT, create_date=_TEXT, create_hour=_TEXT, province_name=_TEXT,
    province_area_code=_TEXT, province_iso_code=_TEXT, province_3166_2_code=_TEXT, user_age=_INT,
    user_gender=_TEXT, spu_id=_LONG, tm_id=_LONG, category3_id=_LONG, spu_name=_TEXT,
    tm_name=_TEXT, category3_name=_TEXT)

PAYMENT_WIDE = struct(
    payment_id=_LONG, subject=_TEXT, payment_type=_TEXT, payment_create_time=_TEXT,
    callback_time=_TEXT, detail_id=_LONG, order_id=_LONG, sku_id=_LONG, order_price=_MONEY,
    sku_num=_LONG, sku_name=_TEXT, province_id=_LONG, order_status=_TEXT, user_id=_LONG,
    total_amount=_MONEY, activity_reduce_amount=_MONEY, coupon_reduce_amount=_MONEY,
    original_total_amount=_MONEY, feight_fee=_MONEY, split_feight_fee=_MONEY,
    split_activity_amount=_MONEY, split_coupon_amount=_MONEY, split_total_amount=_MONEY,
    order_create_time=_TEXT, province_name=_TEXT, province_area_code=_TEXT,
    province_iso_code=_TEXT, province_3166_2_code=_TEXT, user_age=_INT, user_gender=_TEXT,
    spu_id=_LONG, tm_id=_LONG, category3_id=_LONG, spu_name=_TEXT, tm_name=_TEXT,
    category3_name=_TEXT)

# Column order of the summary tables; sinks insert by position.
VISITOR_STATS_COLUMNS = ["stt", "edt", "vc", "ch", "ar", "is_new",
                         "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts"]
LATE_COLUMNS = ["stt", "edt", "late_ct"]
PRODUCT_STATS_COLUMNS = [
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
    "category3_id", "category3_name", "display_ct", "click_ct", "favor_ct", "cart_ct",
    "order_sku_num", "order_amount", "order_ct", "payment_amount", "paid_order_ct",
    "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct", "ts"]
PROVINCE_STATS_COLUMNS = ["stt", "edt", "province_id", "province_name", "province_area_code",
                          "province_iso_code", "province_3166_2_code", "order_amount",
                          "order_count", "ts"]
KEYWORD_STATS_COLUMNS = ["keyword", "ct", "source", "stt", "edt", "ts"]


def dimension(columns: list[str]) -> T.StructType:
    """A stored dimension: every column is text."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])
