import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rows import frame, page, pages, values
from tidemart import schemas
from tidemart.functions.words import (dictionary_matches, dictionary_words, register_split_words,
                                      split_words)
from tidemart.operators import keyword_stats as keyword_ops
from tidemart.operators import product_stats as product_ops
from tidemart.operators import visitor_stats as visitor_ops
from tidemart.operators.dims import product_dimension
from tidemart.operators.province_stats import province_stats, with_clock
from tidemart.plans import batch as plans

T0 = 1615809600000  # 2021-03-15 12:00:00 UTC


def test_visitor_stats(spark):
    who = {"vc": "v1", "ch": "web", "ar": "11", "is_new": "1"}
    rows = [page("a", T0, during=5, **who), page("a", T0 + 3_000, last="home", during=None, **who),
            page("b", T0 + 9_999, during=7, **who), page("b", T0 + 10_000, last="", during=1, **who)]
    stats = plans.visitor_stats(pages(spark, rows))
    assert values(stats, "stt", "edt", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts") == [
        ("2021-03-15 12:00:00", "2021-03-15 12:00:10", 2, 3, 2, 1, 12, T0),
        ("2021-03-15 12:00:10", "2021-03-15 12:00:20", 0, 1, 1, 1, 1, T0 + 10_000)]
    assert sorted(stats.columns) == sorted(schemas.VISITOR_STATS_COLUMNS)


def test_visitor_keys_may_be_null(spark):
    df = pages(spark, [page("a", T0), page("b", T0 + 1)])
    none = df.where("false")
    assert values(visitor_ops.visitor_stats(df, none, none), "vc", "pv_ct") == [(None, 2)]


def test_page_measures_of_products(spark):
    shown = [{"item": "3", "item_type": "sku_id"}, {"item": "4", "item_type": "coupon"},
             {"item": "x", "item_type": "sku_id"}]
    rows = [page(ts=1, page_id="good_detail", item="3", item_type="sku_id", displays=shown),
            page(ts=2, page_id="good_detail", item="3", item_type="sku_ids"),
            page(ts=3, page_id="home", item="3", item_type="sku_id"),
            page(ts=4, page_id="home", displays=[])]
    measures = product_ops.page_measures(pages(spark, rows))
    assert values(measures, "sku_id", "click_ct", "display_ct", "ts") == sorted(
        [(3, 1, 0, 1), (3, 0, 1, 1), (None, 0, 1, 1)], key=repr)


def wide(spark, *rows):
    return frame(spark, schemas.ORDER_WIDE, [
        {"order_id": o, "sku_id": s, "sku_num": 2, "create_time": t, "province_id": 1,
         "province_name": "Here", "total_amount": Decimal("9.00"),
         "split_total_amount": Decimal(a)} for o, s, t, a in rows])


def test_distinct_orders_per_product(spark):
    """Two details of one order count once; a window with a single row reports its order."""
    rows = wide(spark, (1, 5, "2021-03-15 12:00:01", "1.25"), (1, 5, "2021-03-15 12:00:02", "2.25"),
                (2, 5, "2021-03-15 12:00:03", "3.00"), (3, 6, "2021-03-15 12:00:11", "4.00"))
    refunds = frame(spark, schemas.REFUND_INFO, [
        {"sku_id": 5, "order_id": 1, "refund_amount": Decimal("0.50"),
         "create_time": "2021-03-15 12:00:04"}])
    comments = frame(spark, schemas.COMMENT_INFO, [
        {"sku_id": 5, "appraise": a, "create_time": "2021-03-15 12:00:05"} for a in ("1201", "1203")])
    measures = product_ops.order_measures(rows).unionByName(
        product_ops.refund_measures(refunds)).unionByName(product_ops.comment_measures(comments))
    stats = product_ops.window_product_stats(measures)
    assert values(stats, "sku_id", "order_ct", "order_sku_num", "order_amount", "paid_order_ct",
                  "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct") == [
        (5, 2, 6, Decimal("6.50"), 0, 1, Decimal("0.50"), 2, 1),
        (6, 1, 2, Decimal("4.00"), 0, 0, Decimal("0.00"), 0, 0)]
    empty = [frame(spark, schemas.dimension(c), []) for c in (
        ["id", "sku_name", "price", "spu_id", "tm_id", "category3_id"], ["id", "spu_name"],
        ["id", "tm_name"], ["id", "name"])]
    named = product_ops.enrich_product_stats(stats, product_dimension(*empty))
    assert named.columns == schemas.PRODUCT_STATS_COLUMNS and named.count() == 2
    whole = product_ops.window_product_stats(product_ops.order_measures(rows, "total_amount"))
    assert values(whole, "order_amount") == [(Decimal("27.00"),), (Decimal("9.00"),)]


def test_province_stats(spark):
    rows = wide(spark, (1, 5, "2021-03-15 12:00:01", "1.25"), (1, 6, "2021-03-15 12:00:01", "2.25"),
                (2, 5, "2021-03-15 12:00:09", "3.00"), (3, 5, "2021-03-15 12:00:10", "4.00"))
    stats = province_stats(rows)
    assert values(stats, "stt", "province_name", "order_count", "detail_count", "order_amount") == [
        ("2021-03-15 12:00:00", "Here", 2, 3, Decimal("6.50")),
        ("2021-03-15 12:00:10", "Here", 1, 1, Decimal("4.00"))]
    clocked = with_clock(stats, schemas.PROVINCE_STATS_COLUMNS)
    assert clocked.columns == schemas.PROVINCE_STATS_COLUMNS
    assert clocked.first().ts > T0


def log_maps(spark, *rows):
    return frame(spark, schemas.LOG_MAPS, [
        {"common": {}, "page": {"last_page_id": last, "item": item}, "ts": ts}
        for last, item, ts in rows])


def test_keyword_stats(spark):
    log = log_maps(spark, ("search", "Red shoes, RED hat", T0), ("home", "blue", T0),
                   ("search", None, T0), ("search", "red", T0 + 9_999), ("search", "red", T0 + 10_000))
    search = keyword_ops.search_rows(log)
    assert search.count() == 3
    want = [("hat", 1, "2021-03-15 12:00:00"), ("red", 1, "2021-03-15 12:00:10"),
            ("red", 3, "2021-03-15 12:00:00"), ("shoes", 1, "2021-03-15 12:00:00")]
    stats = keyword_ops.keyword_stats(search)
    assert values(stats, "keyword", "ct", "stt") == want
    assert values(stats, "source", "edt")[0] == ("SEARCH", "2021-03-15 12:00:10")
    register_split_words(spark)
    assert values(keyword_ops.keyword_stats(search, splitter="split_words"),
                  "keyword", "ct", "stt") == want
    dictionary = spark.createDataFrame([("ed",), ("sho",)], "word string")
    found = keyword_ops.keyword_stats(search, "1 day", dictionary=dictionary)
    assert values(found, "keyword", "ct") == [("ed", 4), ("sho", 1)]


def test_words_of_many_alphabets(spark):
    df = spark.createDataFrame([(1, "Élan, naïve_x\t42! 我爱我的祖国")], "id int, t string")
    assert sorted(r.word for r in split_words(df, "t").collect()) == sorted(
        ["élan", "naïve", "x", "42", "我爱我的祖国"])
    dictionary = spark.createDataFrame([("祖国",), ("我",), ("爱",), ("国家",)], "word string")
    found = {r.word: r.ct for r in dictionary_words(df, "t", dictionary).collect()}
    assert found == {"祖国": 1, "我": 2, "爱": 1}


def test_long_runs_are_cut_without_gaps(spark):
    """Pieces of a run overlap: every place of every word is found, in runs longer than a piece."""
    text = "".join(chr(97 + (i * i + 3 * i // 7) % 11) for i in range(2_000))
    words = sorted({text[i:i + n] for n in (2, 5) for i in range(0, 1_990, 9)})
    want = {w: sum(text.startswith(w, i) for i in range(len(text))) for w in words}
    df = spark.createDataFrame([(1, text + " " + text)], "id int, t string")
    dictionary = spark.createDataFrame([(w,) for w in words], "word string")
    counted = dictionary_words(df, "t", dictionary)
    assert {r.word: r.ct for r in counted.collect()} == {w: 2 * n for w, n in want.items()}
    placed = dictionary_matches(df, "t", dictionary)
    again = placed.groupBy("word").agg(F.count("*").alias("ct"))
    assert {r.word: r.ct for r in again.collect()} == {w: 2 * n for w, n in want.items()}


def test_dictionary_words_of_any_length(spark):
    long = "x" * 300 + "y"
    df = spark.createDataFrame([(1, f"abcdefghij {long}")], "id int, t string")
    dictionary = spark.createDataFrame([("abcdefghij",), ("abc",), ("j",), (long,), ("",)], "word string")
    assert values(dictionary_words(df, "t", dictionary), "word", "ct") == [
        ("abc", 1), ("abcdefghij", 1), ("j", 1), (long, 1)]
    assert dictionary_words(df, "t", dictionary.where("false")).count() == 0


def test_words_longer_than_any_piece_in_bounded_memory(spark):
    """One entry of 40,000 letters, a text of 80,000 with all but two places the same."""
    text = "ab" * 20_000 + "c" + "ab" * 20_000
    entry = "ab" * 20_000
    df = spark.createDataFrame([("x", text), ("y", "short"), ("z", "ab" * 19_999)], "a string, t string")
    dictionary = spark.createDataFrame([(entry,), ("ba" * 100,), ("bca",), ("no" * 70,)], "word string")
    counts = {(r.a, r.word): r.ct for r in dictionary_words(df, "t", dictionary).collect()}
    inner = 20_000 - 100        # places of 200 letters that begin with b, on each side
    assert counts == {("x", entry): 2, ("x", "ba" * 100): 2 * inner, ("x", "bca"): 1,
                      ("z", "ba" * 100): inner - 1}


@pytest.mark.parametrize("seed", range(3))
def test_places_of_all_lengths_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("ab") for _ in range(rng.choice([5, 70, 300, 900]))) for _ in range(6)]
    some = [t[i:i + n] for t in texts for n in (1, 3, 63, 64, 65, 66, 127, 128, 129, 200, 256, 257, 500)
            for i in [rng.randrange(len(t))]]
    words = sorted({w for w in some if w} | {"a" * 65, "b" * 128})
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "a int, t string")
    dictionary = spark.createDataFrame([(w,) for w in words + words[:2]], "word string")
    want = {(i, w): sum(t.startswith(w, k) for k in range(len(t))) for i, t in enumerate(texts) for w in words}
    got = {(r.a, r.word): r.ct for r in dictionary_words(df, "t", dictionary).collect()}
    assert got == {k: n for k, n in want.items() if n}
    placed = dictionary_matches(df, "t", dictionary).groupBy("a", "word").count()
    assert {(r["a"], r["word"]): r["count"] for r in placed.collect()} == got
