import json
import random

import pytest
from pyspark.sql import Observation

from rows import frame, values
from tidemart import schemas
from tidemart.operators import routing
from tidemart.sources.changes import normalise_changes, read_envelopes
from tidemart.sources.dimensions import DimensionStore, change_rows, merge_changes


def envelope_rows(spark, *rows):
    return spark.createDataFrame(
        rows, "topic string, op string, before map<string,string>, after map<string,string>, seq long")


def test_normalise(spark):
    rows = normalise_changes(envelope_rows(
        spark, ("s.shop.user", "CREATE", None, {"id": "1"}, 1), ("s.shop.user", "u", {}, {"id": "1"}, 2),
        ("s.shop.user", "DELETE", {"id": "1"}, None, 3), ("s.shop.user", "r", None, {"id": "2"}, 4),
        ("s.shop.user", "Truncate", None, None, 5), ("odd", "c", None, {}, 6)))
    assert values(rows, "seq", "database", "table", "type", "data") == [
        (1, "shop", "user", "insert", {"id": "1"}), (2, "shop", "user", "update", {"id": "1"}),
        (3, "shop", "user", "delete", {}), (4, "shop", "user", "read", {"id": "2"}),
        (5, "shop", "user", "truncate", {}), (6, None, None, "insert", {})]


def test_capture_records_are_parsed(spark):
    value = json.dumps({"op": "u", "before": {"id": 1}, "after": {"id": 1, "n": None, "p": "2.50"}})
    rows = spark.createDataFrame([("s.d.t", value, 1), ("s.d.t", "{oops", 2)],
                                 "topic string, value string, seq long")
    row = normalise_changes(read_envelopes(rows)).collect()
    assert len(row) == 1 and row[0].data == {"id": "1", "n": None, "p": "2.50"}


def test_parse_changes_counts_what_it_drops(spark):
    good = json.dumps({"database": "d", "table": "t", "type": "insert", "data": {"id": 3}})
    own = json.dumps({"table": "t", "type": "insert", "data": None, "seq": 70})
    rows = spark.createDataFrame([(good, 1), ("{oops", 2), (own, 3)], "value string, seq long")
    seen = Observation()
    parsed = routing.parse_changes(rows, seen)
    assert values(parsed, "seq", "data") == [(1, {"id": "3"}), (70, None)]
    assert seen.get["dropped"] == 1
    assert routing.nonempty_changes(parsed).count() == 1


RULE = {"source_table": "user", "operate_type": "insert", "sink_type": "hbase",
        "sink_table": "dim_user", "sink_columns": "id,name", "sink_pk": None, "sink_extend": None}


def rule_changes(spark, *rows):
    return spark.createDataFrame(
        [(t, d, b, s) for t, d, b, s in rows],
        "type string, data map<string,string>, before map<string,string>, seq long")


def changes(spark, *rows):
    return frame(spark, schemas.CHANGE, [
        {"table": t, "type": k, "data": d, "before": b, "seq": i}
        for i, (t, k, d, b) in enumerate(rows)])


def test_newest_rule_wins_and_a_delete_removes(spark):
    rules = routing.latest_rules(rule_changes(
        spark, ("insert", RULE, None, 1), ("update", {**RULE, "sink_columns": "id"}, None, 2),
        ("insert", {**RULE, "operate_type": "update"}, None, 3),
        ("delete", None, {**RULE, "operate_type": "update"}, 4),
        ("insert", {**RULE, "source_table": "gone"}, None, 5),
        ("delete", {}, {**RULE, "source_table": "gone"}, 6),
        ("insert", {**RULE, "source_table": "gone", "sink_columns": "back"}, None, 7)))
    assert values(rules, "source_table", "operate_type", "sink_columns") == [
        ("gone", "insert", "back"), ("user", "insert", "id")]


def test_routing(spark):
    rules = routing.latest_rules(rule_changes(
        spark, ("insert", RULE, None, 1),
        ("insert", {**RULE, "source_table": "orders", "sink_type": "kafka", "sink_table": "dwd_o",
                    "sink_columns": "id, name"}, None, 2),
        ("insert", {**RULE, "source_table": "sums", "sink_type": "clickhouse"}, None, 3)))
    rows = changes(
        spark, ("user", "insert", {"id": "1", "name": "it's", "extra": "x"}, None),
        ("user", "update", {"id": "1"}, None), ("orders", "insert", {"id": "2", "name": None}, None),
        ("sums", "insert", {"id": "3"}, None), ("other", "insert", {"id": "4"}, None))
    routed = routing.route(rows, rules)
    dims = routing.dimension_branch(routed)
    assert values(dims, "sink_table", "sink_pk", "data") == [
        ("dim_user", "id", {"id": "1", "name": "it's"})]
    # ' name' is not trimmed, so it is not the column name.
    assert values(routing.fact_payload(routing.fact_branch(routed)), "topic", "value") == [
        ("dwd_o", '{"id":"2"}')]
    assert values(routing.unrouted(rows, rules), "seq") == [(1,), (3,), (4,)]


def test_store_upserts_replays_and_compacts(spark, folder):
    store = DimensionStore(spark, folder)
    assert store.create("DIM_User", ["id", "name", "tm_name"])
    assert not store.create("dim_user", ["id"])
    assert store.read("dim_user").columns == ["id", "name", "tm_name"]
    assert store.read("dim_user").count() == 0
    first = changes(spark, ("u", "insert", {"id": "1", "name": "a", "tm_name": "t"}, None),
                    ("u", "insert", {"id": "2", "name": "b", "tm_name": "t"}, None),
                    ("u", "insert", {"name": "no key"}, None))
    store.upsert("dim_user", first, 0)
    later = changes(spark, ("u", "x", {}, None), ("u", "x", {}, None), ("u", "x", {}, None),
                    ("u", "update", {"id": "1", "name": "it's"}, None),
                    ("u", "update", {"id": "2", "name": None}, None),
                    ("u", "insert", {"id": "3", "name": "c"}, None))
    want = [("1", "it's", "t"), ("2", None, "t"), ("3", "c", None)]
    for _ in range(2):  # the second time is a replay
        store.upsert("dim_user", later, 1)
        assert values(store.read("dim_user"), "id", "name", "tm_name") == want
    store.compact("dim_user")
    assert values(store.read("dim_user"), "id", "name", "tm_name") == want
    store.upsert("dim_user", changes(spark, *[("u", "x", {}, None)] * 6,
                                     ("u", "update", {"id": "3", "tm_name": "new"}, None)), 2)
    assert values(store.lookup("dim_user", "3"), "id", "name", "tm_name") == [("3", "c", "new")]
    assert store.read("dim_user", camel=True).columns == ["id", "name", "tmName"]
    with pytest.raises(ValueError):
        store.read("dim_none")
    with pytest.raises(ValueError):
        store.create("dim_bad", ["name"])


def test_create_missing(spark, folder):
    store = DimensionStore(spark, folder)
    rules = routing.latest_rules(rule_changes(
        spark, ("insert", RULE, None, 1),
        ("insert", {**RULE, "source_table": "o", "sink_type": "kafka", "sink_table": "x"}, None, 2)))
    assert store.create_missing(rules) == ["dim_user"]
    assert store.create_missing(rules) == []


def test_order_of_arrival_does_not_matter(spark, folder):
    """The same changes in any order, with a compaction after any of them, give one table."""
    rows = [(9, "update", {"id": "1", "name": "new9"}), (5, "insert", {"id": "1", "name": "old5", "type": "a"}),
            (4, "insert", {"id": "2", "name": "gone", "type": "b"}), (7, "delete", {}),
            (8, "update", {"id": "2", "type": "c"})]
    def one(seq, kind, data):
        return spark.createDataFrame(
            [(kind, data, {"id": "2"} if kind == "delete" else None, seq)],
            "type string, data map<string,string>, before map<string,string>, seq bigint")
    for at, order in enumerate(([0, 1, 2, 3, 4], [4, 3, 2, 1, 0], [3, 1, 4, 0, 2])):
        store = DimensionStore(spark, f"{folder}/{at}")
        store.create("t", ["id", "name", "type"])
        for batch_id, i in enumerate(order):
            store.upsert("t", one(*rows[i]), batch_id, on_delete="remove")
            if batch_id % 2 == at % 2:
                store.compact("t")
        assert values(store.read("t"), "id", "name", "type") == [
            ("1", "new9", "a"), ("2", None, "c")]
        assert values(store.lookup("t", "2"), "type") == [("c",)]


def test_table_grows_with_its_rules(spark, folder):
    store = DimensionStore(spark, folder)
    store.create("t", ["id", "name"])
    store.upsert("t", changes(spark, ("u", "insert", {"id": "1", "name": "a"}, None)), 0)
    store.compact("t")
    assert store.grow("t", ["id", "phone"]) == ["phone"] and store.grow("t", ["phone"]) == []
    assert values(store.read("t"), "id", "name", "phone") == [("1", "a", None)]
    store.upsert("t", changes(spark, ("x", "x", {}, None),
                              ("u", "update", {"id": "1", "phone": "5"}, None)), 1)
    assert values(store.read("t"), "id", "name", "phone") == [("1", "a", "5")]
    plan = store.lookup("t", "1")._jdf.queryExecution().toString()
    assert "EqualTo(_key,1)" in plan and "EqualTo(key,1)" in plan


def test_deletes(spark):
    stored = frame(spark, schemas.dimension(["id", "name"]), [{"id": "1", "name": "a"},
                                                              {"id": "2", "name": "b"}])
    rows = changes(spark, ("u", "delete", {}, {"id": "1"}), ("u", "delete", {}, {"id": "2"}),
                   ("u", "insert", {"id": "2"}, None))
    kept = merge_changes(stored, change_rows(rows), ["id", "name"])
    assert values(kept, "id", "name") == [("1", "a"), ("2", "b")]
    removed = merge_changes(stored, change_rows(rows, on_delete="remove"), ["id", "name"])
    assert values(removed, "id", "name") == [("2", None)]
    with pytest.raises(ValueError):
        change_rows(rows, on_delete="maybe")


def test_rules_as_of_each_change(spark):
    """A rule changes, goes and comes again between the changes of one batch."""
    def version(seq, columns, kind="update"):
        rule = {"source_table": "t", "operate_type": "insert", "sink_type": "kafka", "sink_table": f"x{seq}",
                "sink_columns": columns, "sink_pk": ""}
        return (kind, None if kind == "delete" else rule, rule if kind == "delete" else None, seq)
    versions = routing.rule_versions(spark.createDataFrame(
        [version(10, "id"), version(20, "id,a"), version(30, "id", "delete"), version(40, "b"),
         version(40, "id", "delete"), version(50, "b")],
        "type string, data map<string,string>, before map<string,string>, seq bigint"))
    rows = spark.createDataFrame(
        [("t", "insert", {"id": "1", "a": "2", "b": "3"}, None, n) for n in (5, 10, 19, 20, 29, 30, 39, 40, 50, 99)]
        + [("t", "insert", {"b": "3"}, None, None), ("t", "update", {"id": "1"}, None, 99)],
        "table string, type string, data map<string,string>, before map<string,string>, seq bigint")
    got = sorted(((r.seq or 0, r.sink_table, sorted(r.data), r.sink_pk)
                  for r in routing.route_as_of(rows, versions).collect()))
    assert got == [(0, "x50", ["b"], "id"), (10, "x10", ["id"], "id"), (19, "x10", ["id"], "id"),
                   (20, "x20", ["a", "id"], "id"), (29, "x20", ["a", "id"], "id"),
                   (50, "x50", ["b"], "id"), (99, "x50", ["b"], "id")]
    left = routing.unrouted_as_of(rows, versions)
    assert sorted((r.type, r.seq) for r in left.collect()) == [
        ("insert", 5), ("insert", 30), ("insert", 39), ("insert", 40), ("update", 99)]


def test_versions_are_not_listed_for_each_change(spark, monkeypatch):
    """Many versions of many rules, numbers that repeat or are missing: each change finds the one version
    that a search through all gives, and no list of versions travels with a change."""
    monkeypatch.setattr(routing, "STRETCHES", 7)
    rng = random.Random(5)
    tables, kinds = ["t", "u", "v", None], ["insert", "update", None]
    rules = [(rng.choice(tables), rng.choice(kinds), rng.randrange(400)) for _ in range(300)]
    rules = {r: (f"x{i}", rng.random() < 0.2) for i, r in enumerate(rules)}
    versions = spark.createDataFrame(
        [(t, k, since, sink, gone, "kafka", "id", "") for (t, k, since), (sink, gone) in rules.items()],
        "source_table string, operate_type string, since bigint, sink_table string, gone boolean, "
        "sink_type string, sink_columns string, sink_pk string")
    rows = [(rng.choice(tables), rng.choice(kinds), {"id": str(n)}, None,
             rng.choice([None, 0, 399, *[rng.randrange(500) for _ in range(9)]])) for n in range(900)]
    changes = spark.createDataFrame(
        rows, "table string, type string, data map<string,string>, before map<string,string>, seq bigint")

    def wanted(table, kind, data, _, seq):
        reached = [(since, *found) for (t, k, since), found in rules.items() if t and k
                   and (t, k) == (table, kind) and (seq is None or since <= seq)]
        since, sink, gone = max(reached, default=(0, None, True))
        return int(data["id"]), None if gone else sink

    got = routing.rules_as_of(changes, versions)
    assert sorted((int(r.data["id"]), r.rule and r.rule.sink_table) for r in got.collect()) == sorted(
        (wanted(*r) for r in rows))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Join" not in plan
