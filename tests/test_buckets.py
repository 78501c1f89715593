"""Folded tables: what a fold writes and a look-up reads follows the change, not the table."""

import os
import string

import pytest
from pyspark.sql import functions as F

from rows import page, pages, values
from tidemart.operators import routing
from tidemart.sources.dimensions import DimensionStore
from tidemart.sources.files import escaped, unescaped
from tidemart.sources.topics import Topics
from tidemart.streaming.first_visits import FirstVisits


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names
               if f.endswith(".parquet"))


def opened(df):
    """Files that a frame reads, with their sizes."""
    paths = [p.removeprefix("file://").removeprefix("file:") for p in df.inputFiles()]
    return len(paths), sum(map(os.path.getsize, paths))


def inserts(spark, low, high, kind="insert", name="a" * 40):
    return spark.range(low, high).select(
        F.lit(kind).alias("type"), F.create_map(F.lit("id"), F.col("id").cast("string"), F.lit("name"),
                                                F.concat(F.lit(name), F.sha2(F.col("id").cast("string"), 256)))
        .alias("data"), F.lit(None).cast("map<string,string>").alias("before"), F.col("id").alias("seq"))


def test_a_fold_writes_what_changed(spark, folder):
    store = DimensionStore(spark, folder, rows_each=100)
    store.create("t", ["id", "name"])
    store.upsert("t", inserts(spark, 0, 5000), 0)
    store.compact("t")
    first = store._folded("t").newest()
    assert first.buckets >= 32 and first.rows == 5000
    whole = size(f"{folder}/t/data")
    store.upsert("t", inserts(spark, 7, 9, "update", "b" * 40).withColumn("seq", F.lit(9000)), 1)
    store.compact("t")
    second = store._folded("t").newest()
    changed = [b for b in second.parts if second.parts[b] != first.parts[b]]
    assert 1 <= len(changed) <= 2 and second.rows == 5000
    assert size(f"{folder}/t/data/upto=1") < whole * 3 / first.buckets
    rows = {r["id"]: r["name"] for r in store.read("t").collect()}
    assert len(rows) == 5000 and rows["7"].startswith("b") and rows["8"].startswith("b")
    assert sum(n.startswith("b") for n in rows.values()) == 2


def test_a_look_up_opens_one_bucket(spark, folder):
    store = DimensionStore(spark, folder, rows_each=100)
    store.create("t", ["id", "name"])
    store.upsert("t", inserts(spark, 0, 3000), 0)
    store.compact("t")
    found = store.lookup("t", "77")
    assert [r["id"] for r in found.collect()] == ["77"]
    assert opened(found)[0] <= 1 + 1     # its bucket; batches that are folded already are not read
    assert store.lookup("t", "nobody").count() == 0


def test_folds_in_a_row_equal_one_merge(spark, folder):
    """Growing through several sizes, with deletes, late inserts and old data removed."""
    store = DimensionStore(spark, folder, rows_each=20)
    store.create("t", ["id", "name"])
    for batch_id in range(6):
        rows = inserts(spark, batch_id * 40, batch_id * 40 + 60, name=f"{batch_id}-").withColumn(
            "seq", F.lit(batch_id))
        if batch_id == 4:
            gone = rows.limit(0).unionByName(rows.select(
                F.lit("delete").alias("type"), F.col("data").alias("data"), F.col("data").alias("before"),
                F.lit(99).cast("bigint").alias("seq")).limit(5))
            rows = rows.withColumn("seq", rows.seq.cast("bigint")).unionByName(gone)
        store.upsert("t", rows, batch_id, on_delete="remove")
        if batch_id != 2:
            store.compact("t")
    rows = {r["id"]: r["name"][:2] for r in store.read("t").collect()}
    assert len(rows) == 260 - 5
    assert all(rows[str(i)] == f"{min(5, i // 40)}-" for i in range(260) if str(i) in rows)
    base = store._folded("t").newest()
    assert base.buckets > 4 and base.upto == 5
    kept = {(int(f.split("=")[1])) for f in os.listdir(f"{folder}/t/data")}
    assert kept <= {0, 1, 3, 4, 5} and len(os.listdir(f"{folder}/t/base")) <= 2 + 0


def devices(spark, low, high, flag="1"):
    return spark.range(low, high).select(
        F.struct(F.concat(F.lit("m"), F.col("id")).alias("mid"), F.lit(flag).alias("is_new")).alias("common"),
        F.col("id").alias("ts"), F.col("id").alias("seq"))


@pytest.mark.parametrize("history", [2000, 20_000])
def test_flags_cost_what_the_batch_holds(spark, folder, history):
    visits_seen = FirstVisits(spark, folder, rows_each=200)
    visits_seen.repair(devices(spark, 0, history), 0)
    visits_seen.repair(devices(spark, history, history + 1), 1)
    visits_seen.compact()
    assert visits_seen.folded.newest().rows == history
    batch = pages(spark, [page("m5", 9, is_new="1"), page("fresh", 9, is_new="1"), page("m6", 1)])
    firsts = batch.select("common.mid").where("mid <> 'm6'")
    files, read = opened(visits_seen.known(firsts, before=2))
    # two buckets and the batch that is not folded yet, however many devices there are
    assert files <= 2 + 1 and read < 200_000     # most of it are the filters
    assert values(visits_seen.repair(batch, 2), "common.mid", "common.is_new") == [
        ("fresh", "1"), ("m5", "0"), ("m6", "0")]


def test_devices_are_looked_for_by_name(spark, folder):
    visits_seen = FirstVisits(spark, folder)
    visits_seen.repair(devices(spark, 0, 300), 0)
    visits_seen.repair(devices(spark, 300, 301), 1)
    visits_seen.compact()
    plan = visits_seen.known(devices(spark, 3, 5).select("common.mid"), 2)._jdf.queryExecution().toString()
    assert "In(mid, [" in plan
    many = visits_seen.known(devices(spark, 0, 1500).select("common.mid"), 2)
    assert many.count() == 301


def test_names_of_folders(spark, folder):
    """Names are spelt as Spark spells them, and read back."""
    names = [f"x{c}y" for c in string.printable.strip() + " \t\né日"] + ["a%3Ab", "%", "table=1"]
    rows = spark.createDataFrame([(n, 1) for n in names], "name string, n int")
    rows.write.partitionBy("name").parquet(f"{folder}/rows")
    written = {f.split("=", 1)[1] for f in os.listdir(f"{folder}/rows") if f.startswith("name=")}
    assert written == {escaped(n) for n in names}
    assert {unescaped(f) for f in written} == set(names)
    with pytest.raises(ValueError):
        escaped("")


def test_tables_and_topics_of_any_name(spark, folder):
    store = DimensionStore(spark, f"{folder}/dims")
    names = ["a:b", "c/d", "e=f", "g h", "Plain", "per%cent", "[x]{y}*?"]
    rows = inserts(spark, 0, 2)
    for name in names:
        store.create(name, ["id", "name"])
        store.upsert(name, rows, 0)
        assert store.read(name).count() == 2
        store.upsert(name, inserts(spark, 1, 4, "update"), 1)
        store.compact(name)
        assert store.read(name).count() == 4 and store.lookup(name, "3").count() == 1
    assert sorted(store.tables()) == sorted(n.lower() for n in names)
    topics = Topics(f"{folder}/topics")
    lines = spark.createDataFrame([(n, n) for n in names], "topic string, value string")
    for _ in range(2):
        topics.put_routed(lines, 0)
    for name in names:
        query = (topics.read(spark, name).writeStream.format("memory").queryName("one")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        assert [r.value for r in spark.table("one").collect()] == [name]


def test_a_rule_without_a_table_serves_nothing(spark):
    changes = spark.createDataFrame([("t", "insert", {"id": "1"}, None, 1)],
                                    "table string, type string, data map<string,string>, "
                                    "before map<string,string>, seq bigint")
    rules = spark.createDataFrame([("t", "insert", "hbase", "", "id", "id"), ("t", "insert", "kafka", None, "id", "")],
                                  "source_table string, operate_type string, sink_type string, "
                                  "sink_table string, sink_columns string, sink_pk string")
    assert routing.route(changes, rules).count() == 0
    assert routing.unrouted(changes, rules).count() == 1
