"""The test tables in the shape of the warehouse's topics. Plain expressions, no aggregates.

One day of shop traffic: an order's time follows from its key, a line's time from its order's key
and its own columns, so that some lines, payments and dimension keys miss the bounds on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart import schemas

DAY = "2021-03-15 00:00:00"
DAY_SECONDS = 1615766400  # the same in epoch seconds
FAR = "2100-01-01"  # 4102444800 s


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("string")


def _stored(text: Column) -> Column:
    """A text as a topic would hold it: built once per row.

    A generator, because the optimizer copies plain expressions into every filter above them.
    """
    return F.explode(F.array(text))


def _placed(key: str) -> Column:
    """Second at which the order with this key was placed."""
    return F.lit(DAY_SECONDS) + (F.col(key) * 7) % 86400


def _money(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast(schemas.MONEY)


# --- page log, from events ------------------------------------------------------
def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_rows_of(table(spark, sf_dir, "events"))


def log_rows_of(events: DataFrame) -> DataFrame:
    """events -> parsed log rows: (common, page, displays, start, ts, seq)."""
    kind, number, user = F.col("event_type"), F.col("event_id"), F.col("user_id")
    none = F.lit(None).cast("string")

    def label(prefix: str, value: Column) -> Column:
        return F.concat(F.lit(prefix), value.cast("string"))

    common = F.struct(
        label("", user % 7 + 110000).alias("ar"), none.alias("ba"),
        label("ch_", user % 3).alias("ch"), label("", number % 2).alias("is_new"),
        none.alias("md"), label("mid_", user).alias("mid"), none.alias("os"),
        label("", user).alias("uid"), label("v", number % 3).alias("vc"))
    last_page = (F.when((kind == "view") & (number % 2 == 0), none)
                 .when(kind == "view", F.lit(""))
                 .when(kind == "click", F.lit("search")).otherwise(F.lit("home")))
    page = F.struct(
        F.floor(F.col("value") * 100).cast("bigint").alias("during_time"),
        F.get_json_object("props", "$.k").alias("item"),
        F.when(number % 4 == 0, "promotion_id").otherwise("sku_id").alias("item_type"),
        last_page.alias("last_page_id"),
        F.when(kind == "click", "good_detail").otherwise(kind).alias("page_id"))

    def display(n: int) -> Column:
        return F.create_map(
            F.lit("item"), label("", (number * 7 + n) % 2000),
            F.lit("item_type"), F.when((number + n) % 4 == 0, "promotion_id").otherwise("sku_id"),
            F.lit("order"), F.lit(str(n)))
    displays = (F.when((kind == "signup") & (number % 3 == 1), F.array(display(1)))
                .when((kind == "signup") & (number % 3 == 2), F.array(display(1), display(2))))
    start = F.when((kind == "error") & (number % 2 == 0), F.lit('{"entry":"icon"}'))
    return events.select(common.alias("common"), page.alias("page"), displays.alias("displays"),
                         start.alias("start"),
                         F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
                         number.alias("seq"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as raw JSON lines; one in fifty is cut short, one in fifty a bare number."""
    whole = F.to_json(F.struct("common", "page", "displays", "start", "ts"))
    value = (F.when(F.col("seq") % 50 == 7, F.substring(whole, 1, 40))
             .when(F.col("seq") % 50 == 9, F.col("seq").cast("string")).otherwise(whole))
    return log_rows(spark, sf_dir).select(_stored(value).alias("value"), "seq")


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_rows(spark, sf_dir).where("start IS NULL").drop("start")


# --- orders -----------------------------------------------------------------------
def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_info_of(table(spark, sf_dir, "orders"))


def order_info_of(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 26).alias("province_id"),
        F.when(F.col("o_orderkey") % 31 == 1, -F.col("o_custkey") - 1)
        .otherwise(F.col("o_custkey")).alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        _money("o_totalprice").alias("total_amount"),
        _money(F.lit(0)).alias("activity_reduce_amount"),
        _money(F.lit(0)).alias("coupon_reduce_amount"),
        _money("o_totalprice").alias("original_total_amount"), _money(F.lit(5)).alias("feight_fee"),
        _text(_placed("o_orderkey") + 900).alias("expire_time"),
        _stored(_text(_placed("o_orderkey"))).alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"))


def _split_amount() -> Column:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return _money(price * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")))


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_detail_of(table(spark, sf_dir, "lineitem"))


def order_detail_of(lines: DataFrame) -> DataFrame:
    """Lines are created from 8 s before to 7 s after their order."""
    shift = (F.col("l_linenumber") * 5 + F.col("l_partkey")) % 16 - 8
    return lines.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        _money("l_extendedprice").alias("order_price"), _split_amount().alias("split_total_amount"),
        _money(F.lit(0)).alias("split_activity_amount"),
        _money(F.lit(None)).alias("split_coupon_amount"),
        F.concat(F.lit("line "), F.col("l_partkey").cast("string")).alias("sku_name"),
        _stored(_text(_placed("l_orderkey") + shift)).alias("create_time"))


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payment_info_of(table(spark, sf_dir, "orders"))


def payment_info_of(orders: DataFrame) -> DataFrame:
    """Orders of status F or O, paid 0 to 19 minutes later; one in 101 has no readable time."""
    time = F.when(F.col("o_orderkey") % 101 == 0, F.lit("soon")).otherwise(
        _text(_placed("o_orderkey") + F.col("o_orderkey") % 20 * 60))
    return orders.where("o_orderstatus <> 'P'").select(
        (F.col("o_orderkey") + 1000000000).alias("id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"), _money("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("subject"), F.lit("1101").alias("payment_type"),
        _stored(time).alias("create_time"), time.alias("callback_time"))


def refund_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_partkey").alias("sku_id"), F.col("l_orderkey").alias("order_id"),
        _split_amount().alias("refund_amount"),
        _text(_placed("l_orderkey") + 3600).alias("create_time"))


def comment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    appraise = F.when(F.col("l_linestatus") == "F", "1201").otherwise("1203")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("sku_id"), appraise.alias("appraise"),
        _text(_placed("l_orderkey") + 7200).alias("create_time"))


def _from_events(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind).select(
        (F.col("event_id") % 2000).alias("sku_id"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("create_time"))


def favor_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, "purchase")


def cart_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(spark, sf_dir, "error")


# --- dimensions (all columns text) ---------------------------------------------------
def _texts(df: DataFrame, **columns) -> DataFrame:
    return df.select(*[(F.col(c) if isinstance(c, str) else c).cast("string").alias(n)
                       for n, c in columns.items()])


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") * 37 % 20000).cast("int"))
    return _texts(table(spark, sf_dir, "customer"), id="c_custkey", name="c_name", birthday=born,
                  gender=F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M"))


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("n_nationkey").cast("string")
    return _texts(table(spark, sf_dir, "nation"), id="n_nationkey", name="n_name",
                  area_code=F.concat(F.lit("0"), number), iso_code=F.concat(F.lit("CN-"), number),
                  iso_3166_2=F.concat(F.lit("R"), F.col("n_regionkey").cast("string")))


def skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(table(spark, sf_dir, "part"), id="p_partkey", sku_name="p_name",
                  price=_money("p_retailprice"), spu_id=F.col("p_partkey") % 120,
                  tm_id=F.substring("p_brand", 7, 10), category3_id=F.col("p_size") % 6)


def spus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(table(spark, sf_dir, "supplier"), id="s_suppkey", spu_name="s_name")


def trademarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(table(spark, sf_dir, "part").select("p_brand").distinct(),
                  id=F.substring("p_brand", 7, 10), tm_name="p_brand")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(table(spark, sf_dir, "region"), id="r_regionkey", name="r_name")


# --- change records ------------------------------------------------------------------
def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured changes of customers and orders (topic, op, before, after, seq).

    Every customer is created in one of 60 tables; every tenth is changed later with the name left
    out and the gender set to null; every 25th is deleted after that. Orders are created only.
    """
    return envelopes_of(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"))


def envelopes_of(customers: DataFrame, orders: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("map<string,string>")
    key = F.col("c_custkey")
    topic = F.concat(F.lit("mysql.shop.table_"), (key % 60).cast("string"))

    def text(column) -> Column:
        return (F.col(column) if isinstance(column, str) else column).cast("string")

    def entry(**values) -> Column:
        return F.create_map(*[x for n, v in values.items() for x in (F.lit(n), text(v))])

    created = entry(id=key, name="c_name", segment="c_mktsegment",
                    gender=F.when(key % 2 == 0, "F").otherwise("M"))
    changed = entry(id=key, segment=F.lit("CHANGED"), gender=F.lit(None))
    parts = [
        customers.select(topic.alias("topic"), F.lit("c").alias("op"), nothing.alias("before"),
                         created.alias("after"), (key * 4).alias("seq")),
        customers.where("c_custkey % 10 = 0").select(
            topic, F.lit("UPDATE"), created, changed, key * 4 + 1),
        customers.where("c_custkey % 25 = 0").select(
            topic, F.lit("d"), changed, nothing, key * 4 + 2),
        orders.select(
            F.lit("mysql.shop.order_info"), F.lit("create"), nothing,
            entry(id="o_orderkey", user_id="o_custkey", status="o_orderstatus"),
            F.col("o_orderkey") * 4 + 3)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return rows


def rule_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the rule table, from parts: each part sets or deletes a rule of one table.

    The rule of the order table comes from the nations, so that it is always there.
    """
    part = table(spark, sf_dir, "part")
    number = F.col("p_partkey")
    kind = F.when(F.col("p_size") % 3 == 0, "kafka").when(F.col("p_size") % 3 == 1, "hbase") \
        .otherwise("clickhouse")
    target = F.concat(F.when(F.col("p_size") % 3 == 1, "dim_").otherwise("dwd_"),
                      (number % 50).cast("string"))
    columns = F.when(number % 2 == 0, "id,segment,gender").otherwise("id,name,gender")

    def rule(**values) -> Column:
        return F.create_map(*[x for n, v in values.items() for x in (F.lit(n), v.cast("string"))])

    set_rule = rule(source_table=F.concat(F.lit("table_"), (number % 50).cast("string")),
                    operate_type=F.when(number % 100 < 50, "insert").otherwise("update"),
                    sink_type=kind, sink_table=target, sink_columns=columns,
                    sink_pk=F.when(number % 3 == 0, "id").when(number % 3 == 1, ""),
                    sink_extend=F.lit(None))
    delete = F.col("p_size") == 50
    nothing = F.lit(None).cast("map<string,string>")
    orders = rule(source_table=F.lit("order_info"), operate_type=F.lit("insert"),
                  sink_type=F.lit("kafka"), sink_table=F.lit("dwd_order_info"),
                  sink_columns=F.concat(F.lit("id,user_id"),
                                        F.when(F.col("n_nationkey") == 24, ",status").otherwise("")),
                  sink_pk=F.lit("id"), sink_extend=F.lit(None))
    return part.select(
        F.when(delete, "delete").otherwise("update").alias("type"),
        F.when(delete, nothing).otherwise(set_rule).alias("data"),
        F.when(delete, set_rule).alias("before"), number.alias("seq")).union(
        table(spark, sf_dir, "nation").select(
            F.lit("insert"), orders, nothing, F.col("n_nationkey").cast("bigint")))


# --- search texts -------------------------------------------------------------------
def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as searched texts: page-log lines with common and page as maps."""
    number = F.col("doc_id")
    page = F.create_map(
        F.lit("last_page_id"), F.when(number % 5 == 0, "home").otherwise("search"),
        F.lit("item"), F.when(number % 7 != 0, F.col("text")))
    return table(spark, sf_dir, "documents").select(
        F.create_map(F.lit("mid"), F.col("source")).alias("common"), page.alias("page"),
        ((F.lit(DAY_SECONDS) + number * 60) * 1000 + number % 1000).alias("ts"))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary: the words of the benchmark texts."""
    from tidemart.functions.words import split_words
    words = split_words(table(spark, sf_dir, "benchmark").select("text"), "text")
    return words.distinct()
