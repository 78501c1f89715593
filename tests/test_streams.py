"""Streams give what batch gives, over several files and micro-batches."""

import datetime
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import entry_queries
from rows import frame, page, pages, values
from tidemart import schemas
from tidemart.functions.json_rows import parse_topic, to_topic
from tidemart.operators import logs, orders, product_stats, visitor_stats, visits
from tidemart.plans import batch as plans
from tidemart.sources.dimensions import DimensionStore
from tidemart.sources.summaries import SummarySink
from tidemart.sources.topics import Topics, console
from tidemart.streaming.first_visits import FirstVisits
from tidemart.streaming.jump_timers import timed_jumps
from tidemart.streaming.late_rows import Ledger
from tidemart.streaming.jobs import SUMMARIES, TOPICS, Warehouse

T0 = 1615809600000
FAR = 4102444800000


def put_files(folder, topic, lines, files=4):
    """Lines in arrival order, cut into files whose times rise."""
    path = f"{folder}/topic={topic}"
    os.makedirs(path, exist_ok=True)
    size = -(-len(lines) // files)
    for n in range(files):
        target = f"{path}/part-{n}.txt"
        with open(target, "w") as out:
            out.writelines(line + "\n" for line in lines[n * size:(n + 1) * size])
        os.utime(target, (1_700_000_000 + n * 10, 1_700_000_000 + n * 10))


def run(spark, stream, folder, name):
    query = (stream.writeStream.format("parquet").outputMode("append")
             .option("path", f"{folder}/{name}/rows").trigger(availableNow=True)
             .option("checkpointLocation", f"{folder}/{name}/state").start())
    query.awaitTermination()
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    assert len([p for p in query.recentProgress if p.numInputRows]) > 1
    return spark.read.schema(stream.schema).parquet(f"{folder}/{name}/rows"), dropped


def some_pages(n=400):
    rng = random.Random(3)
    times = sorted(rng.sample(range(T0, T0 + 600_000), n))
    rows = [page(f"m{rng.randrange(6)}", t, rng.choice([None, "", "home"]), seq=i, during=t % 9,
                 vc=f"v{rng.randrange(2)}", displays=[{"item": "4", "item_type": "sku_id"}])
            for i, t in enumerate(times)]
    return rows + [page("closing", FAR, "home", seq=n,
                        displays=[{"item": "4", "item_type": "sku_id"}])]


def as_lines(rows):
    return [json.dumps({k: v for k, v in r.items() if k != "seq"}) for r in rows]


def page_stream(spark, folder):
    topics = Topics(folder, files_per_trigger=1)
    return parse_topic(topics.read(spark, "p"), schemas.LOG).drop("start")


@pytest.fixture
def paged(spark, folder):
    rows = some_pages()
    put_files(folder, "p", as_lines(rows))
    return pages(spark, rows), page_stream(spark, folder)


def real(df):
    return df.where(F.col("ts") < FAR)


def test_jumps(spark, folder, paged):
    want = real(visits.user_jumps(paged[0]))
    got, dropped = run(spark, visits.user_jumps(paged[1]), folder, "jumps")
    assert values(got, "common.mid", "ts") == values(want, "common.mid", "ts")
    assert dropped == 0


@pytest.mark.parametrize("timeout", ["10 seconds", "2 seconds", "100 seconds"])
def test_jumps_by_timers(spark, folder, paged, timeout):
    want = real(visits.user_jumps(paged[0], timeout))
    got, dropped = run(spark, timed_jumps(paged[1], timeout, buckets=3), folder, "timed")
    assert values(got, "common", "page", "ts") == values(want, "common", "page", "ts") and want.count()
    assert dropped == 0


def test_timers_of_odd_pages(spark, folder):
    """No device, repeated rows, a follow-up in the same millisecond, out of order within the delay."""
    rows = [page("a", T0), page("a", T0 + 9_999, "home"), page("b", T0), page("b", T0 + 10_000, "home"),
            page(None, T0), page(None, T0 + 1, "home"), page("c", T0 + 5), page("c", T0 + 5),
            page("d", T0 + 7, "home"), page("d", T0 + 7), page("e", T0 + 900, "home"), page("e", T0 + 400),
            page("far", FAR, "home")]
    put_files(folder, "p", as_lines(rows), files=2)
    got, _ = run(spark, timed_jumps(page_stream(spark, folder)), folder, "odd")
    assert values(got, "common.mid", "ts") == values(visits.user_jumps(pages(spark, rows)), "common.mid", "ts")
    assert values(got, "common.mid") == [("b",), ("c",), ("c",), (None,)]


def test_a_bounce_leaves_at_its_own_timeout(spark, folder):
    """The timer tells it in the micro-batch behind the one that moves the watermark to ts + 10 s; by
    windows it takes until both cells have passed."""
    at = T0 + 1_000
    moves = [at, at + 9_000, at + 11_000, at + 11_500, at + 16_000, at + 21_000, at + 22_000, at + 23_000]
    rows = [page("m", moves[0])] + [page("clock", t, "home") for t in moves[1:]]
    told = {}
    for name, jumps in (("timers", timed_jumps), ("windows", visits.user_jumps)):
        put_files(f"{folder}/{name}", "p", as_lines(rows), files=len(rows))
        stream = jumps(page_stream(spark, f"{folder}/{name}"))
        seen = []

        def note(batch, batch_id, seen=seen):
            seen += [batch_id] * batch.where("common.mid = 'm'").count()
        query = (stream.writeStream.foreachBatch(note).trigger(availableNow=True)
                 .option("checkpointLocation", f"{folder}/{name}/state").start())
        query.awaitTermination()
        assert len(seen) == 1
        told[name] = seen[0]
    # batch 2 brings the watermark to ts + 10 s, which counts from the next batch on
    assert told["timers"] == 3 and told["windows"] > 3


def test_unique_visitors_of_a_busy_device(spark, folder):
    rows = [page("busy" if i % 3 else f"m{i}", T0 + i * 1_000, None, seq=i) for i in range(600)]
    rows.append(page("closing", FAR, seq=600))
    put_files(folder, "p", as_lines(rows))
    for salts in (1, 4):
        got, dropped = run(spark, visits.unique_visitors(page_stream(spark, folder), salts=salts), folder,
                           f"busy{salts}")
        kept = values(real(got).groupBy("common.mid").count(), "mid", "count")
        assert len(kept) == 201 and {n for _, n in kept} == {1}


def test_a_day_of_visitors_is_forgotten(spark, folder):
    """State is dropped once the watermark is a delay behind the day."""
    day = 86_400_000
    rows = [page(f"m{i}", T0 + d * day + i * 1_000, None) for d in range(4) for i in range(50)]
    put_files(folder, "p", as_lines(rows), files=4)
    stream = visits.unique_visitors(page_stream(spark, folder), delay="5 minutes")
    query = (stream.writeStream.format("noop").trigger(availableNow=True)
             .option("checkpointLocation", f"{folder}/state").start())
    query.awaitTermination()
    held = [max(s.numRowsTotal for s in p.stateOperators) for p in query.recentProgress if p.numInputRows]
    assert len(held) == 4 and max(held) <= 100     # two days at the most, not four


def test_unique_visitors(spark, folder, paged):
    got, _ = run(spark, visits.unique_visitors(paged[1]), folder, "uniques")
    assert values(real(got), "common.mid") == values(
        real(visits.unique_visitors(paged[0])), "common.mid")


def test_visitor_stats_of_pages(spark, folder, paged):
    def stats(df):
        none = df.where("false")
        return visitor_stats.visitor_stats(df, none, none)
    want = real(stats(paged[0]))
    got, dropped = run(spark, stats(paged[1]), folder, "stats")
    assert values(got, *want.columns) == values(want, *want.columns) and dropped == 0


def test_product_stats(spark, folder, paged):
    def stats(df):
        return product_stats.window_product_stats(product_stats.page_measures(df))
    want = real(stats(paged[0]))
    got, _ = run(spark, stats(paged[1]), folder, "products")
    assert values(got, *want.columns) == values(want, *want.columns) and got.count() > 30


def test_late_rows_are_dropped(spark, folder):
    # Spark judges lateness by the watermark of the batch before, so a row two batches later is late.
    rows = [page("m", T0 + 60_000), page("m", T0 + 61_000), page("m", T0), page("m", FAR)]
    put_files(folder, "p", as_lines(rows))
    df = page_stream(spark, folder)
    none = df.where("false")
    got, dropped = run(spark, visitor_stats.visitor_stats(df, none, none), folder, "late")
    assert values(got, "ts") == [(T0 + 60_000,)] and dropped == 1
    assert values(got, "pv_ct") == [(2,)]


def test_late_rows_are_kept_and_counted(spark, folder):
    """The branch keeps exactly what the windows of the statistics drop."""
    rows = [page("m", T0 + 60_000), page("m", T0 + 61_000), page("a", T0), page("b", T0 + 49_000),
            page("c", T0 + 50_000), page("d", T0 + 61_000), page("m", FAR), page("m", FAR), page("e", T0)]
    put_files(folder, TOPICS["page"], as_lines(rows), files=9)
    house = Warehouse(spark, Topics(folder, files_per_trigger=1), DimensionStore(spark, f"{folder}/dims"),
                      SummarySink(f"{folder}/sums"), f"{folder}/state", once=True, lag="1 second")
    house.late_pages().awaitTermination()
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{folder}/topic={TOPICS['late_page']}")
    kept = sorted(json.loads(r.value)["common"]["mid"] for r in lines.collect())
    df = parse_topic(Topics(folder, files_per_trigger=1).read(spark, TOPICS["page"]), schemas.LOG).drop("start")
    none = df.where("false")
    stats = visitor_stats.visitor_stats(df, none, none, "10 seconds", "1 second")
    _, dropped = run(spark, stats, folder, "late")
    assert kept == ["a", "b", "c", "e"] and dropped == len(kept)
    counts = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/sums/{SUMMARIES['late']}")
    assert values(counts, "stt", "late_ct") == [("2021-03-15 12:00:00", 1), ("2021-03-15 12:00:00", 1),
                                                ("2021-03-15 12:00:40", 1), ("2021-03-15 12:00:50", 1)]


def test_the_ledger_judges_a_replay_alike(spark, folder):
    ledger = Ledger(spark, folder, "10 seconds")
    rows = [spark.createDataFrame([(t,)], "ts bigint") for t in (50_000, 90_000, 70_000, 100_000)]
    for n, df in enumerate(rows):
        marks = [ledger.watermark(n) for _ in range(2)]
        for _ in range(2):
            ledger.note(df, n)
        assert marks == [[None, None, 40_000, 80_000][n]] * 2


def test_flags_across_batches_and_replays(spark, folder):
    visits_seen = FirstVisits(spark, folder)
    first = pages(spark, [page("a", 5, is_new="1"), page("a", 3, is_new="1"), page("b", 1)])
    second = pages(spark, [page("a", 1, is_new="1"), page("b", 9, is_new="1"),
                           page("c", 9, is_new="1")])
    for _ in range(2):
        assert values(visits_seen.repair(first, 0), "common.mid", "ts", "common.is_new") == [
            ("a", 3, "1"), ("a", 5, "0"), ("b", 1, "0")]
    for _ in range(2):
        assert values(visits_seen.repair(second, 1), "common.mid", "ts", "common.is_new") == [
            ("a", 1, "0"), ("b", 9, "1"), ("c", 9, "1")]
    visits_seen.compact()
    assert values(visits_seen.read(), "mid", "ts") == [("a", 3), ("b", 9), ("c", 9)]
    assert values(visits_seen.repair(second, 1), "common.mid", "common.is_new") == [
        ("a", "0"), ("b", "1"), ("c", "1")]
    third = pages(spark, [page("c", 10, is_new="1"), page("d", 10, is_new="1")])
    assert values(visits_seen.repair(third, 2), "common.mid", "common.is_new") == [
        ("c", "0"), ("d", "1")]


def test_replayed_batch_reaches_a_stream_reader_once(spark, folder):
    topics = Topics(folder, files_per_trigger=1)
    lines = spark.createDataFrame([("t", "a"), ("u", "b")], "topic string, value string")
    got = 0
    for _ in range(2):
        topics.put_routed(lines, 0)
        query = (topics.read(spark, "t").writeStream.format("parquet")
                 .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/at")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        got = spark.read.parquet(f"{folder}/out").count()
    assert got == 1


def test_console_shows_rows(spark, folder, paged):
    query = console(paged[1]).option("checkpointLocation", folder).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None and query.lastProgress["numInputRows"] > 0


def test_kafka_options():
    """The connector is not installed; the options are all that can be looked at."""
    topics = Topics(kafka={"kafka.bootstrap.servers": "nowhere:1"}, starting="earliest")
    assert topics.starting == "earliest" and topics.kafka


def clock(ms):
    from datetime import datetime, timezone
    return datetime.fromtimestamp(ms / 1000, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def test_changes_that_go_nowhere_are_kept(spark, folder):
    house = Warehouse(spark, Topics(folder), DimensionStore(spark, f"{folder}/dims"),
                      SummarySink(f"{folder}/sums"), f"{folder}/state", once=True)
    put_files(folder, TOPICS["raw_db"], ["{broken", json.dumps(
        {"table": "nowhere", "type": "insert", "data": {"id": "1"}, "seq": 1})], files=1)
    rules = spark.createDataFrame(
        [], "type string, data map<string,string>, before map<string,string>, seq long")
    house.route_changes(lambda: rules).awaitTermination()

    def topic(name):
        lines = spark.read.option("recursiveFileLookup", "true").text(f"{folder}/topic={TOPICS[name]}")
        return [r["value"] for r in lines.collect()]
    assert topic("dirty_db") == ["{broken"]
    assert [json.loads(v)["table"] for v in topic("unrouted")] == ["nowhere"]


def test_rules_that_change_within_a_batch(spark, folder):
    house = Warehouse(spark, Topics(folder), DimensionStore(spark, f"{folder}/dims"),
                      SummarySink(f"{folder}/sums"), f"{folder}/state", once=True, rules_as_of=True)
    put_files(folder, TOPICS["raw_db"], [json.dumps(
        {"table": "t", "type": "insert", "data": {"id": str(n)}, "seq": n}) for n in (1, 5, 9)], files=1)
    rules = spark.createDataFrame(
        [("update", {"source_table": "t", "operate_type": "insert", "sink_type": "kafka",
                     "sink_table": f"out{n}", "sink_columns": "id"}, None, n) for n in (4, 8)],
        "type string, data map<string,string>, before map<string,string>, seq long")
    house.route_changes(lambda: rules).awaitTermination()
    for topic, want in (("out4", ['{"id":"5"}']), ("out8", ['{"id":"9"}'])):
        lines = spark.read.option("recursiveFileLookup", "true").text(f"{folder}/topic={topic}")
        assert [r.value for r in lines.collect()] == want
    left = spark.read.option("recursiveFileLookup", "true").text(f"{folder}/topic={TOPICS['unrouted']}")
    assert [json.loads(r.value)["seq"] for r in left.collect()] == [1]


def test_payments_without_a_time_have_a_topic(spark, folder):
    house = Warehouse(spark, Topics(folder), DimensionStore(spark, f"{folder}/dims"),
                      SummarySink(f"{folder}/sums"), f"{folder}/state", once=True)
    put_files(folder, TOPICS["payment"], [json.dumps({"id": n, "create_time": t}) for n, t in (
        (1, "2021-03-15 12:00:00"), (2, "yesterday"), (3, None))], files=1)
    house.untimed_payments().awaitTermination()
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{folder}/topic={TOPICS['untimed_payment']}")
    assert sorted(json.loads(r.value)["id"] for r in lines.collect()) == [2, 3]


def test_whole_warehouse(spark, folder):
    """Raw lines and database changes through all jobs to the four summary tables."""
    house = Warehouse(spark, Topics(folder, files_per_trigger=1),
                      DimensionStore(spark, f"{folder}/dims"), SummarySink(f"{folder}/sums"),
                      f"{folder}/state", once=True, as_of="2021-06-01")

    def finish(query):
        query.awaitTermination()
        assert query.exception() is None

    def topic(name):
        return spark.read.option("recursiveFileLookup", "true").text(
            f"{folder}/topic={TOPICS[name]}")

    def table(name):
        return spark.read.option("recursiveFileLookup", "true").parquet(
            f"{folder}/sums/{SUMMARIES[name]}")

    # Logs.
    raw = some_pages(120)
    for r in raw[:60]:
        r["common"]["is_new"] = "1"
    raw[5]["page"].update(last_page_id="search", item="red hat")
    raw[6]["page"].update(page_id="good_detail", item="4", item_type="sku_id")
    lines = as_lines(raw)
    lines.insert(3, "{broken")
    lines.insert(9, json.dumps({"common": {"mid": "m1", "is_new": "0"}, "start": {"a": 1}, "ts": T0}))
    put_files(folder, TOPICS["raw_log"], lines)
    finish(house.split_logs())
    assert [r.value for r in topic("dirty").collect()] == ["{broken"]
    assert topic("start").count() == 1 and topic("page").count() == 121
    assert topic("display").count() == 121
    split = logs.parse_logs(topic("page"))
    assert split.where("common.is_new = '1'").count() == len({r["common"]["mid"] for r in raw[:60]})

    # Dimensions and orders arrive as captured changes and are routed by rules.
    rules = []
    for source, target, columns in (
            ("user_info", "dim_user_info", "id,birthday,gender"),
            ("base_province", "dim_base_province", "id,name,area_code,iso_code,iso_3166_2"),
            ("sku_info", "dim_sku_info", "id,sku_name,price,spu_id,tm_id,category3_id"),
            ("spu_info", "dim_spu_info", "id,spu_name"),
            ("base_trademark", "dim_base_trademark", "id,tm_name"),
            ("base_category3", "dim_base_category3", "id,name")):
        rules.append(("hbase", source, target, columns))
    names = {"order_info": "order_info", "order_detail": "order_detail", "payment_info": "payment",
             "favor_info": "favor", "cart_info": "cart", "order_refund_info": "refund",
             "comment_info": "comment"}
    kinds = {"order_info": schemas.ORDER_INFO, "order_detail": schemas.ORDER_DETAIL,
             "payment_info": schemas.PAYMENT_INFO, "favor_info": schemas.FAVOR_INFO,
             "cart_info": schemas.CART_INFO, "order_refund_info": schemas.REFUND_INFO,
             "comment_info": schemas.COMMENT_INFO}
    for source, name in names.items():
        rules.append(("kafka", source, TOPICS[name], ",".join(kinds[source].names)))
    rule_rows = spark.createDataFrame(
        [("insert", {"source_table": s, "operate_type": "insert", "sink_type": k, "sink_table": t,
                     "sink_columns": c, "sink_pk": "id"}, None, i)
         for i, (k, s, t, c) in enumerate(rules)],
        "type string, data map<string,string>, before map<string,string>, seq long")

    changed = [("user_info", {"id": 1, "birthday": "1990-01-01", "gender": "F", "password": "x"}),
               ("base_province", {"id": 1, "name": "Here", "area_code": "01"}),
               ("sku_info", {"id": 4, "sku_name": "hat", "price": "2.50", "spu_id": 6, "tm_id": 7,
                             "category3_id": 8}),
               ("spu_info", {"id": 6, "spu_name": "hats"}), ("base_trademark", {"id": 7, "tm_name": "B"}),
               ("base_category3", {"id": 8, "name": "headwear"})]
    for n in [0, 1, 2, 3, 9]:
        ms = FAR if n == 9 else T0 + n * 4_000
        changed += [
            ("order_info", {"id": n, "user_id": 1, "province_id": 1, "total_amount": 9.5,
                            "create_time": clock(ms)}),
            ("order_detail", {"id": 10 + n, "order_id": n, "sku_id": 4, "sku_num": 2,
                              "order_price": 2.5, "split_total_amount": 5,
                              "create_time": clock(ms + 1_000)}),
            ("payment_info", {"id": 20 + n, "order_id": n, "user_id": 1, "total_amount": 9.5,
                              "create_time": clock(ms + 60_000)})]
    for kind in ("favor_info", "cart_info", "comment_info", "order_refund_info"):
        changed += [(kind, {"sku_id": 4, "order_id": 0, "refund_amount": 1.25, "appraise": "1201",
                            "create_time": clock(t)}) for t in (T0, FAR)]
    records = [json.dumps({"topic": f"mysql.shop.{t}", "op": "c", "after": d}) for t, d in changed]
    put_files(folder, "captured", records)
    captured = house.topics.read(spark, "captured").select(
        F.get_json_object("value", "$.topic").alias("topic"), "value", "seq")
    finish(house.capture_changes(captured))
    assert topic("raw_db").count() == len(changed)
    finish(house.route_changes(lambda: rule_rows))
    assert topic("order_info").count() == 5
    assert values(house.dimensions.read("dim_user_info"), "id", "gender") == [("1", "F")]

    # From here on all topics are drained in one go: the closing rows stand at the end of each
    # topic, and reading one topic faster than another would make the slower one late.
    house.topics = Topics(folder)
    for job in (house.unique_visits, house.user_jumps, house.order_wide, house.payment_wide,
                house.visitor_stats, house.product_stats, house.province_stats,
                house.keyword_stats):
        finish(job())

    wide = parse_topic(topic("order_wide"), schemas.ORDER_WIDE)
    assert wide.count() == 5
    row = wide.where("order_id = 2").first()
    assert (row.user_age, row.province_name, row.sku_name, row.tm_name, row.category3_name) == (
        31, "Here", "hat", "B", "headwear")
    assert parse_topic(topic("payment_wide"), schemas.PAYMENT_WIDE).count() == 5

    visitors = table("visitor")
    assert visitors.columns == schemas.VISITOR_STATS_COLUMNS
    batch = plans.visitor_stats(split.drop("start").withColumn(
        "seq", F.col("ts")))
    totals = [F.sum(c) for c in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")]
    assert visitors.agg(*totals).first() == real(batch).agg(*totals).first()

    products = table("product")
    assert products.columns == schemas.PRODUCT_STATS_COLUMNS
    sums = products.agg(*[F.sum(c).alias(c) for c in schemas.PRODUCT_STATS_COLUMNS[11:24]]).first()
    assert (sums.order_ct, sums.order_sku_num, sums.order_amount) == (4, 8, 20)
    assert (sums.paid_order_ct, sums.payment_amount) == (4, 20)
    assert (sums.favor_ct, sums.cart_ct, sums.comment_ct, sums.good_comment_ct) == (1, 1, 1, 1)
    assert (sums.refund_order_ct, float(sums.refund_amount)) == (1, 1.25)
    assert (sums.click_ct, sums.display_ct) == (1, 120)  # the closing page stays open
    assert values(products.select("sku_name", "spu_name", "tm_name", "category3_name").distinct(),
                  "*") == [("hat", "hats", "B", "headwear")]

    assert values(table("province"), "stt", "province_name", "order_count") == [
        ("2021-03-15 12:00:00", "Here", 3), ("2021-03-15 12:00:10", "Here", 1)]
    assert values(table("keyword"), "keyword", "ct", "source") == [
        ("hat", 1, "SEARCH"), ("red", 1, "SEARCH")]


def test_order_join_with_salts(spark, folder):
    """Stream-stream join, details of one order spread over eight state partitions."""
    info = [{"id": 0, "create_time": clock(T0)}, {"id": 9, "create_time": clock(FAR)}]
    detail = [{"id": i, "order_id": 0, "sku_id": i, "split_total_amount": 1,
               "create_time": clock(T0 + i * 100)} for i in range(80)]
    detail.append({"id": 99, "order_id": 9, "sku_id": 1, "create_time": clock(FAR)})
    put_files(folder, "o", [json.dumps(r) for r in info], files=2)
    put_files(folder, "d", [json.dumps(r) for r in detail])
    topics = Topics(folder, files_per_trigger=1)
    left = parse_topic(topics.read(spark, "o").drop("seq"), schemas.ORDER_INFO)
    right = parse_topic(topics.read(spark, "d").drop("seq"), schemas.ORDER_DETAIL)
    # The order stream ends after two batches, the detail stream after four.
    joined = orders.join_order_details(left, right, salts=8, delay="1 minute")
    got, _ = run(spark, joined, folder, "joined")
    want = orders.join_order_details(frame(spark, schemas.ORDER_INFO, info), frame(
        spark, schemas.ORDER_DETAIL, [{k: v for k, v in r.items() if k != "split_total_amount"}
                                      for r in detail]))
    assert values(got, "order_id", "detail_id") == values(want, "order_id", "detail_id")
    assert to_topic(got).count() == got.count()


def test_state_of_drained_streams_is_on_disk(spark, folder):
    """The state is kept by RocksDB, and a join that gives matches alone ends with its last rows."""
    lines = [f"{n % 50},{T0 // 1000 + n % 50}" for n in range(200)]
    put_files(folder, "a", lines)

    def side():
        parts = F.split("value", ",")
        rows = Topics(folder).read(spark, "a").select(
            parts[0].alias("key"), F.timestamp_seconds(parts[1].cast("long")).alias("at"))
        return rows.withWatermark("at", "1 second")

    one, other = side().alias("x"), side().alias("y")
    joined = one.join(other, F.expr("x.key = y.key AND x.at = y.at")).select("x.key")
    rows = entry_queries.drain(joined, "drained", closing=False)
    assert spark.read.parquet(rows).count() == 50 * 16
    state = f"{rows.removesuffix('rows')}checkpoint"
    files = [f for _, _, names in os.walk(f"{state}/state") for f in names]
    assert any("changelog" in f or f.endswith(".zip") for f in files)
    assert not any(f.endswith(".delta") for f in files)
    assert [f for f in os.listdir(f"{state}/commits") if f.isdigit()] == ["0"]
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def shop_tables(spark, folder, n=40):
    """Tables of one shop day with `n` orders of one line each; one row to order 0 closes the windows."""
    def put(name, schema, *rows):
        made = f"{folder}/made/{name}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(made)
        part = next(f for f in os.listdir(made) if f.endswith(".parquet"))
        os.replace(f"{made}/{part}", f"{folder}/{name}.parquet")

    put("orders", "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderpriority string", *[(i, i, "O", 10.0, "1") for i in range(n)])
    put("lineitem", "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string",
        *[(i, 8, 0, 2.0, 5.0, 0.0, "R", "F") for i in range(n)])
    put("customer", "c_custkey long, c_name string", *[(i, "c") for i in range(n)])
    put("nation", "n_nationkey long, n_name string, n_regionkey long", *[(i, "n", 1) for i in range(26)])
    put("part", "p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double",
        (8, "p", "Brand#12", 1, 1.0))
    put("supplier", "s_suppkey long, s_name string", (8, "s"))
    put("region", "r_regionkey long, r_name string", (1, "r"))
    put("events", "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
        "props string", *[(i, datetime.datetime(2021, 3, 15), 1, "click", 1.0, '{"k": "8"}') for i in range(4)])
    return folder


def drained(spark, folder, name, monkeypatch):
    """The rows of a registered stream, and the files of the state of each stream that it drains."""
    states, drain = [], entry_queries.drain

    def noted(*args, **more):
        rows = drain(*args, **more)
        states.append([f for _, _, names in os.walk(f"{rows.removesuffix('rows')}checkpoint/state")
                       for f in names if not f.endswith(".crc")])
        return rows

    monkeypatch.setattr(entry_queries, "drain", noted)
    return entry_queries.QUERIES[name](spark, shop_tables(spark, folder)).collect(), states


def test_order_join_writes_its_state_once(spark, folder, monkeypatch):
    """The state holds what the join needs, as files of the store, without a log of the same; the
    settings for that are those of the drained query alone."""
    changelogs = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    rows, states = drained(spark, folder, "stream_order_join", monkeypatch)
    assert len(rows) == 40 and {(r.create_date, r.create_hour) for r in rows} == {("2021-03-15", "00")}
    assert len(states) == 1 and any(f.endswith(".sst") for f in states[0])
    assert not any(f.endswith(".changelog") for f in states[0])
    assert spark.conf.get(changelogs) == "true"
    assert spark.conf.get("spark.sql.streaming.stateStore.unloadOnCommit") == "false"


def test_province_stats_write_the_state_of_both_jobs_once(spark, folder, monkeypatch):
    rows, states = drained(spark, folder, "stream_province_stats", monkeypatch)
    assert sum(r.order_count for r in rows) == sum(r.detail_count for r in rows) == 40
    assert len(states) == 2     # the join, then the statistics
    for files in states:
        assert any(f.endswith(".sst") for f in files) and not any(f.endswith(".changelog") for f in files)


def test_payment_join_writes_its_state_once(spark, folder, monkeypatch):
    """Orders are paid 0 to 19 minutes later, of which 15 are waited for; order 0 at no readable time."""
    rows, states = drained(spark, folder, "stream_payment_wide", monkeypatch)
    want = [i for i in range(40) if i % 101 and i % 20 <= 15]
    assert sorted(r.order_id for r in rows) == want
    assert {(r.user_id, r.sku_id) for r in rows} == {(i, 8) for i in want}
    assert len(states) == 1 and any(f.endswith(".sst") for f in states[0])
    assert not any(f.endswith(".changelog") for f in states[0])


def test_product_stats_keep_state_of_the_first_aggregate_only(spark, folder, monkeypatch):
    """Orders of a window come in one micro-batch, within which they are counted; sums are exact."""
    entry_sets, drain = [], entry_queries.drain

    def noted(*args, **more):
        rows = drain(*args, **more)
        entry_sets.append(os.listdir(f"{rows.removesuffix('rows')}checkpoint/state"))
        return rows

    monkeypatch.setattr(entry_queries, "drain", noted)
    got = entry_queries.QUERIES["stream_product_stats"](spark, shop_tables(spark, folder))
    rows = got.where("order_ct > 0").collect()
    assert [(r.sku_id, r.order_ct, r.order_sku_num, float(r.order_amount)) for r in rows] == [(8, 40, 80, 200.0)]
    assert got.schema["order_amount"].dataType == T.DecimalType(18, 2)
    assert [sorted(s) for s in entry_sets] == [["0"]]       # one operator with state


def test_orders_are_counted_within_batches(spark, folder):
    """Repeated lines, orders in several skus and windows, amounts with cents, late and null ids: what
    is counted within each micro-batch equals the statistics in batch."""
    lines = [{"order_id": [None, 1, 1, 2, 3][i % 5], "sku_id": i % 3, "sku_num": i, "create_time": clock(T0 + i * 700),
              "split_total_amount": [0.1, -0.25, 123456789012.34][i % 3]} for i in range(60)]
    put_files(folder, "lines", [json.dumps(r) for r in lines + [
        {"order_id": 9, "sku_id": 1, "sku_num": 1, "create_time": clock(FAR)}]], files=3)
    topics = Topics(folder, files_per_trigger=1)
    rows = parse_topic(topics.read(spark, "lines").drop("seq"), schemas.ORDER_WIDE)
    stream = product_stats.per_order(product_stats.order_measures(rows), delay="1 hour")
    found = entry_queries.run_stream(stream, "counted", step=product_stats.counted_orders)
    table = parse_topic(spark.read.text(topics.folder("lines")), schemas.ORDER_WIDE)
    want = product_stats.window_product_stats(product_stats.order_measures(table)).where("stt < '2022'")
    assert values(found, *want.columns) == values(want, *want.columns) and found.count() > 3
