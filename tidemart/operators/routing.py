"""Change routing by rules kept as data."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemart import codes, schemas
from tidemart.functions.json_rows import is_json_object, parse_topic

STRETCHES = 100     # of numbers, in which changes are sorted with the versions of their rules


def parse_changes(lines: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Typed change rows; bad lines are dropped, and counted where an observation is given.

    Changes are ordered by their own seq, or by their place in the topic if they bring none.
    """
    if observation is not None:
        lines = lines.observe(observation, F.count_if(~is_json_object()).alias("dropped"))
    place = F.col("seq") if "seq" in lines.columns else F.lit(None).cast("bigint")
    rows = parse_topic(lines.where(is_json_object()).select("value", place.alias("place")),
                       schemas.CHANGE)
    return rows.withColumn("seq", F.coalesce("seq", "place")).drop("place")


def nonempty_changes(changes: DataFrame) -> DataFrame:
    """Changes that carry data. An empty map (a delete) counts as data."""
    return changes.where(F.col("data").isNotNull())


def latest_rules(changes: DataFrame) -> DataFrame:
    """Newest rule per source table and operation, from the changes of the rule table.

    A delete carries its key in `before` and takes the rule out. Of changes with one number a delete
    counts last, others by their content.
    """
    row = F.when(F.col("type") == "delete", F.col("before")).otherwise(F.col("data"))
    rules = changes.select(*[row[c].alias(c) for c in schemas.RULE_COLUMNS], "type", "seq")
    newest = Window.partitionBy("source_table", "operate_type").orderBy(
        F.desc("seq"), F.desc(F.col("type") == "delete"), *[F.desc(c) for c in schemas.RULE_COLUMNS])
    return (rules.withColumn("rank", F.row_number().over(newest))
            .where("rank = 1 AND type <> 'delete'")
            .select(*schemas.RULE_COLUMNS))


def rule_versions(changes: DataFrame) -> DataFrame:
    """Every version of the rules, from the changes of the rule table: their columns, `since` (the
    number from which it counts) and `gone` (a delete).

    Of changes with one number the one that `latest_rules` would take counts.
    """
    row = F.when(F.col("type") == "delete", F.col("before")).otherwise(F.col("data"))
    rules = changes.select(*[row[c].alias(c) for c in schemas.RULE_COLUMNS],
                           F.coalesce("seq", F.lit(0)).cast("bigint").alias("since"),
                           (F.col("type") == "delete").alias("gone"))
    first = Window.partitionBy("source_table", "operate_type", "since").orderBy(
        F.desc("gone"), *[F.desc(c) for c in schemas.RULE_COLUMNS])
    return rules.withColumn("rank", F.row_number().over(first)).where("rank = 1").drop("rank")


def rules_as_of(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """The changes with `rule`: the version that counts at each one's own number, null if none does.

    A version counts from its number up to the next one's; changes and rules are numbered together, as
    a capture tool numbers all changes of one database. A change without a number takes the newest.

    Changes and versions are sorted together by number, so a change meets one version, however many
    there are. Numbers are cut into STRETCHES with about as many changes each, so that the changes of
    one table are no single group; a stretch begins with the version that those before it leave.
    """
    shares = [i / STRETCHES for i in range(1, STRETCHES)]
    bounds = sorted(set(changes.agg(F.percentile_approx("seq", shares, 1000)).first()[0] or []))

    def stretch(number: str) -> Column:
        return reduce(add, [(F.col(number) >= b).cast("int") for b in bounds], F.lit(0))

    ruled = F.struct("since", *[c for c in versions.columns
                                if c not in ("source_table", "operate_type", "since")])
    key = ["_table", "_type", "_stretch"]
    rules = versions.where("source_table IS NOT NULL AND operate_type IS NOT NULL").select(
        F.col("source_table").alias("_table"), F.col("operate_type").alias("_type"),
        stretch("since").alias("_stretch"), ruled.alias("rule"))
    late = len(bounds) + 1 + F.pmod(F.xxhash64(F.map_entries("data")), F.lit(STRETCHES)).cast("int")
    rows = changes.select(
        F.col("table").alias("_table"), F.col("type").alias("_type"),
        F.when(F.col("seq").isNull(), late).otherwise(stretch("seq")).alias("_stretch"),
        F.coalesce("seq", F.lit((1 << 63) - 1)).alias("_at"), F.struct(*changes.columns).alias("_row"))
    before = Window.partitionBy(*key[:2]).orderBy("_stretch").rowsBetween(
        Window.unboundedPreceding, -1)
    begin = (rows.select(*key).distinct().unionByName(rules, allowMissingColumns=True)
             .groupBy(*key).agg(F.max("rule").alias("rule"))
             .withColumn("rule", F.last("rule", ignorenulls=True).over(before))
             .where("rule IS NOT NULL"))
    # of one number the versions come first
    line = rows.unionByName(rules.unionByName(begin).withColumn("_at", F.col("rule.since")),
                            allowMissingColumns=True)
    so_far = Window.partitionBy(*key).orderBy("_at", F.col("_row").isNotNull(), "rule").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    now = line.withColumn("rule", F.last("rule", ignorenulls=True).over(so_far))
    return now.where("_row IS NOT NULL").select(
        "_row.*", F.when(~F.col("rule.gone"), F.col("rule")).alias("rule"))


def route_as_of(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """`route` by the rules valid as of each change, so that a rule may change between two of them."""
    ruled = rules_as_of(changes, versions).where(F.coalesce("rule.sink_table", F.lit("")) != "")
    data = keep_columns(F.col("data"), F.col("rule.sink_columns")).alias("data")
    return ruled.select(
        *[data if c == "data" else F.col(c) for c in changes.columns], "rule.sink_type",
        "rule.sink_table", F.coalesce(F.nullif("rule.sink_pk", F.lit("")), F.lit("id")).alias("sink_pk"))


def unrouted_as_of(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """Changes that no rule, or one for another kind of sink, serves as of their own number."""
    served = F.col("rule.sink_type").isin(codes.SINK_TYPE["fact"], codes.SINK_TYPE["dimension"]) & (
        F.coalesce("rule.sink_table", F.lit("")) != "")
    return rules_as_of(changes, versions).where(~F.coalesce(served, F.lit(False))).select(*changes.columns)


def keep_columns(data: Column, sink_columns: Column) -> Column:
    """Only the entries whose key stands in the comma list; no trimming."""
    wanted = F.split(sink_columns, ",")
    return F.map_filter(data, lambda key, _: F.array_contains(wanted, key))


def _named(rules: DataFrame) -> DataFrame:
    """Rules that say where to: one without a sink table serves nothing."""
    return rules.where(F.coalesce("sink_table", F.lit("")) != "")


def route(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Changes with a rule: `data` cut to the rule's columns, and where it goes.

    No hint is set on the rules: Spark broadcasts them while its statistics show that they
    are small, and splits skewed partitions otherwise.
    """
    rules = _named(rules)
    on = [changes["table"] == rules["source_table"], changes["type"] == rules["operate_type"]]
    data = keep_columns(F.col("data"), F.col("sink_columns")).alias("data")
    kept = [data if c == "data" else changes[c] for c in changes.columns]
    return changes.join(rules, on, "inner").select(
        *kept, "sink_type", "sink_table", F.coalesce(F.nullif("sink_pk", F.lit("")),
                                                     F.lit("id")).alias("sink_pk"))


def fact_branch(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sink_type") == codes.SINK_TYPE["fact"])


def dimension_branch(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sink_type") == codes.SINK_TYPE["dimension"])


def unrouted(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Changes that go nowhere: no rule, or a rule for another kind of sink."""
    served = _named(rules).where(F.col("sink_type").isin(codes.SINK_TYPE["fact"],
                                                 codes.SINK_TYPE["dimension"]))
    on = [changes["table"] == served["source_table"], changes["type"] == served["operate_type"]]
    # No anti join: Spark pushes one below a union, and where a part has one table and one type
    # only, that leaves no key to join by.
    return changes.join(served, on, "left").where("source_table IS NULL").select(*[
        changes[c] for c in changes.columns])


def fact_payload(facts: DataFrame) -> DataFrame:
    """What a fact topic receives: the data alone."""
    return facts.select(F.col("sink_table").alias("topic"), F.to_json("data").alias("value"))
