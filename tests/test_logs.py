import json

import pytest
from pyspark.sql import functions as F

from rows import page, pages, values
from tidemart.functions.json_rows import is_json_object, to_topic
from tidemart.functions.names import camel
from tidemart.operators import logs
from tidemart.plans.batch import split_logs

GOOD = [
    '{"common":{"mid":"a","is_new":"1"},"page":{"page_id":"home"},"ts":5}',
    ' {"common":{"mid":"b","is_new":0},"page":{"page_id":"p","during_time":"12"},"ts":"7"}',
    '{"common":{"mid":"c"},"page":{"during_time":"long"},"ts":9,"extra":[1,{"x":2}]}',
    '{"common":{"mid":"d"},"start":{"entry":"icon"},"ts":1}',
    "{'common':{'mid':'e'},'ts':2}",
]
BAD = ["{bad", "5", "", "[1]", "null", '{"a":1} x', '{"a":1}}', '{"a":1},{"b":2}', '{"a":01}',
       '"text"']


def lines(spark, texts):
    return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, seq long")


def test_only_syntax_makes_a_line_dirty(spark):
    df = lines(spark, GOOD + BAD)
    assert [r.value for r in logs.dirty_lines(df).orderBy("seq").collect()] == BAD
    assert logs.good_lines(df).count() == len(GOOD)
    assert df.where(is_json_object() == False).count() == len(BAD)  # noqa: E712


def test_null_line_is_neither_lost_nor_parsed(spark):
    df = spark.createDataFrame([(None, 1)], "value string, seq long")
    assert logs.dirty_lines(df).count() == 1
    assert logs.parse_logs(df).count() == 0


def test_fields_are_converted_one_by_one(spark):
    rows = {r.common.mid: r for r in logs.parse_logs(lines(spark, GOOD)).collect()}
    assert rows["a"].ts == 5 and rows["a"].common.is_new == "1"
    assert rows["b"].ts == 7 and rows["b"].page.during_time == 12 and rows["b"].common.is_new == "0"
    assert rows["c"].ts == 9 and rows["c"].page.during_time is None
    assert json.loads(rows["d"].start) == {"entry": "icon"}


@pytest.mark.parametrize("saved", [False, True])
def test_branches(spark, folder, saved):
    display = '{"common":{"mid":"a"},"page":{"page_id":"p1"},"ts":1,' \
              '"displays":[{"item":7,"item_type":"sku_id","pos":2},{"item":"8","page_id":"x"}]}'
    branches = split_logs(lines(spark, [display, *GOOD, *BAD]),
                          saved=f"{folder}/logs" if saved else None)
    assert branches["page"].count() == 5 and "start" not in branches["page"].columns
    assert [r.common.mid for r in branches["start"].collect()] == ["d"]
    assert branches["dirty"].count() == len(BAD)
    shown = [r.display for r in branches["display"].collect()]
    assert sorted(shown, key=lambda d: d["item"]) == [
        {"item": "7", "item_type": "sku_id", "pos": "2", "page_id": "p1"},
        {"item": "8", "page_id": "p1"}]


def test_displays_of_a_start_line_are_not_shown(spark):
    line = '{"common":{"mid":"a"},"start":{"x":1},"displays":[{"item":1}],"ts":1}'
    assert split_logs(lines(spark, [line]))["display"].count() == 0


def test_new_flag_stays_on_first_row_only(spark):
    rows = [page("m", 10, is_new="1"), page("m", 20, is_new="1"), page("m", 30, is_new="0"),
            page("m", 90_000_000, is_new="1"), page("n", 5, is_new="0"), page("n", 6, is_new="1"),
            page("o", 7, is_new="1", seq=2), page("o", 7, is_new="1", seq=1),
            page(None, 8, is_new="1"), page("p", None, is_new="1", seq=3)]
    fixed = logs.repair_new_flags(pages(spark, rows))
    assert values(fixed, "common.mid", "ts", "seq", "common.is_new") == sorted([
        ("m", 10, 10, "1"), ("m", 20, 20, "0"), ("m", 30, 30, "0"), ("m", 90_000_000, 90_000_000, "0"),
        ("n", 5, 5, "0"), ("n", 6, 6, "1"), ("o", 7, 1, "1"), ("o", 7, 2, "0"),
        (None, 8, 8, "1"), ("p", None, 3, "1")], key=repr)


def test_topic_text_round_trip(spark):
    df = pages(spark, [page("m", 1, displays=[{"item": "1", "k": None}])]).drop("seq")
    back = logs.parse_logs(to_topic(df)).drop("start")
    assert back.collect() == df.collect()


def test_camel_case():
    assert camel("SPU_ID") == "spuId" and camel("iso_3166_2") == "iso31662" and camel("id") == "id"


def test_one_hot_device(spark):
    """A third of all rows on one mid: flags are right, and the join key spreads them."""
    rows = (spark.range(3000).select(
        F.struct(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("mid"),
                 F.lit("1").alias("is_new")).alias("common"),
        F.col("id").alias("ts"), F.col("id").alias("seq")))
    fixed = logs.repair_new_flags(rows).where("common.mid = 'hot'")
    assert values(fixed.where("common.is_new = '1'"), "ts") == [(0,)]
    assert fixed.count() == 1000


def test_payload_keeps_every_key(spark):
    """Undeclared keys and the start object stay; odd but good lines give no all-null rows."""
    rows = [(0, '{"common":{"mid":"a","is_new":"1","sid":7},"start":{"entry":"icon"},"err":[1,"2"],"ts":5}'),
            (1, '{"common":{"mid":"a","is_new":"1","sid":8},"actions":[{"k":1.5}],"ts":6}'),
            (2, "{'ts': '7','common':{'mid':'a','is_new':'0'}}"),
            (3, '{"ts":"1","ts":"8","common":{"mid":"a","is_new":"1"}}')]
    lines = spark.createDataFrame(rows, "seq bigint, value string").withColumn(
        "line", F.col("value"))
    parsed = logs.parse_logs(lines)
    assert {(r.seq, r.ts, r.common.mid) for r in parsed.collect()} == {
        (0, 5, "a"), (1, 6, "a"), (2, 7, "a"), (3, 8, "a")}
    fixed = logs.repair_new_flags(parsed)
    assert logs.payload(logs.start_logs(fixed)).first().value == rows[0][1]
    pages = [json.loads(r.value.replace("'", '"')) for r in logs.payload(
        logs.page_logs(fixed)).collect()]
    assert sorted(pages, key=lambda p: int(p["ts"])) == [
        {"common": {"mid": "a", "is_new": "0", "sid": 8}, "actions": [{"k": 1.5}], "ts": 6},
        {"common": {"mid": "a", "is_new": "0"}, "ts": "7"},
        {"common": {"mid": "a", "is_new": "0"}, "ts": "8"}]
