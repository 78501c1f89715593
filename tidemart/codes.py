"""Business codes carried by the source tables."""

# --- fixed values -----------------------------------------------------------
ORDER_STATUS = {
    "unpaid": "1001",
    "paid": "1002",
    "cancelled": "1003",
    "finished": "1004",
    "refunding": "1005",
    "refunded": "1006",
}
PAYMENT_TYPE = {"alipay": "1101", "wechat": "1102", "unionpay": "1103"}
APPRAISE = {"good": "1201", "fair": "1202", "bad": "1203", "automatic": "1204"}
REFUND_REASON = {
    "quality": "1301",
    "not as described": "1302",
    "out of stock": "1303",
    "wrong size": "1304",
    "ordered by mistake": "1305",
    "no longer wanted": "1306",
    "other": "1307",
}
COUPON_STATUS = {"unused": "1401", "in use": "1402", "used": "1403"}
REFUND_TYPE = {"money only": "1501", "return of goods": "1502"}
SOURCE_TYPE = {"query": "2401", "promotion": "2402", "recommendation": "2403", "activity": "2404"}
ACTIVITY_RULE_TYPE = {"amount off": "3101", "percent off": "3102", "discount": "3103"}
COUPON_TYPE = {"amount off": "3201", "percent off": "3202", "voucher": "3203"}
COUPON_RANGE_TYPE = {"category3": "3301", "trademark": "3302", "spu": "3303"}
KEYWORD_SOURCE = {"search": "SEARCH", "click": "CLICK", "cart": "CART", "order": "ORDER"}
SINK_TYPE = {"dimension": "hbase", "fact": "kafka", "summary": "clickhouse"}
# --- end of fixed values ----------------------------------------------------
