"""Dimension tables: latest row per key, every column text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart import codes, schemas
from tidemart.functions.names import camel_columns
from tidemart.sources.batches import BatchTable
from tidemart.sources.buckets import BucketedTable
from tidemart.sources.files import escaped, folders, holding_batch, unescaped

CHANGE_ROWS = schemas.KEYED_CHANGE
PLACE = "struct<seq: bigint, step: int, tie: bigint>"


def change_rows(changes: DataFrame, key: str | Column = "id",
                on_delete: str = "ignore") -> DataFrame:
    """Changes (type, data, before, seq) keyed by the value of the key column, which is one name
    or a column of names.

    Deletes are left out, or with on_delete='remove' kept under the key they had.
    """
    name = F.lit(key) if isinstance(key, str) else key
    value = F.try_element_at("data", name)
    if on_delete == "remove":
        gone = F.col("type") == "delete"
        value = F.when(gone, F.try_element_at("before", name)).otherwise(value)
    elif on_delete == "ignore":
        changes = changes.where("type <> 'delete'")
    else:
        raise ValueError(f"on_delete must be 'ignore' or 'remove', not {on_delete!r}")
    more = [c for c in ("sink_table",) if c in changes.columns]
    return changes.select(value.alias("key"), "seq", "type", "data", *more).where(
        "key IS NOT NULL")


# -- states ---------------------------------------------------------------------
# A state is all that is known of one key: its last kind of change (_type, _at), its last delete
# (_gone), and per column the value and the place of the change that set it (_<column>_at). States
# of one key merge in any order, so it does not matter when a table was compacted.

def _place() -> Column:
    """Where a change stands. Changes with equal numbers (rows of one file share theirs) are put in
    an order by kind, then by content, the same for every column."""
    step = F.when(F.col("type") == "delete", 2).when(F.col("type") == "update", 1).otherwise(0)
    return F.struct(F.coalesce("seq", F.lit(0)).cast("bigint").alias("seq"), step.alias("step"),
                    F.xxhash64(F.to_json("data")).alias("tie"))


def _states(changes: DataFrame, columns: list[str]) -> DataFrame:
    gone = F.col("type") == "delete"
    placed = changes.select("key", "type", "data", _place().alias("place"))
    return placed.select(
        F.col("key").alias("_key"), F.col("type").alias("_type"), F.col("place").alias("_at"),
        F.when(gone, F.col("place")).alias("_gone"),
        *[F.try_element_at("data", F.lit(c)).alias(c) for c in columns],
        *[F.when(~gone & F.map_contains_key("data", c), F.col("place")).alias(f"_{c}_at")
          for c in columns])


def _plain_states(rows: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Rows without a history: older than every change."""
    first = F.expr("named_struct('seq', -1L, 'step', 0, 'tie', 0L)")
    return rows.select(
        F.col(key).alias("_key"), F.lit("insert").alias("_type"), first.alias("_at"),
        F.lit(None).cast(PLACE).alias("_gone"), *columns,
        *[first.alias(f"_{c}_at") for c in columns])


def _by_key(states: DataFrame, columns: list[str]) -> DataFrame:
    """One state per key; combined before the shuffle, so a key that changes all the time costs no
    more than others."""
    return states.groupBy("_key").agg(
        F.max_by("_type", "_at").alias("_type"), F.max("_at").alias("_at"),
        F.max("_gone").alias("_gone"),
        *[F.max_by(c, f"_{c}_at").alias(c) for c in columns],
        *[F.max(f"_{c}_at").alias(f"_{c}_at") for c in columns])


def _onto(base: DataFrame, delta: DataFrame, columns: list[str]) -> DataFrame:
    """The states of a base with newer ones merged in; both have one state per key.

    The base is only joined with the few keys of the delta, never aggregated, and Spark
    broadcasts the delta while its statistics show it to be small.
    """
    newer = delta.select(*[F.col(c).alias(f"new_{c}") for c in delta.columns])
    joined = base.join(newer, F.col("_key") == F.col("new__key"), "left")

    def pick(name: str, at: str) -> Column:
        later = F.col(f"new_{at}").isNotNull() & (
            F.col(at).isNull() | (F.col(f"new_{at}") > F.col(at)))
        return F.when(later, F.col(f"new_{name}")).otherwise(F.col(name)).alias(name)

    both = joined.select(
        "_key", pick("_type", "_at"), pick("_at", "_at"), pick("_gone", "_gone"),
        *[pick(c, f"_{c}_at") for c in columns],
        *[pick(f"_{c}_at", f"_{c}_at") for c in columns])
    known = base.select("_key").join(delta.select("_key"), "_key", "left_semi")
    return both.unionByName(delta.join(known, "_key", "left_anti"))


def _live(states: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose last change is no delete; what was set before a delete is gone."""
    def value(c: str) -> Column:
        kept = F.col("_gone").isNull() | (F.col(f"_{c}_at") > F.col("_gone"))
        return F.when(kept, F.col(c)).alias(c)
    return states.where("_type <> 'delete'").select(*[value(c) for c in columns])


def merge_changes(stored: DataFrame | None, changes: DataFrame, columns: list[str],
                  key: str = "id") -> DataFrame:
    """The stored table with keyed changes applied: per column, the newest change that has it.

    A column that a change does not carry keeps its value; one that it carries as null becomes
    null; a delete clears the row. One aggregate by key.
    """
    states = _states(changes, columns)
    if stored is not None:
        states = states.unionByName(_plain_states(stored, columns, key))
    return _live(_by_key(states, columns), columns)


# -- store ------------------------------------------------------------------------
@dataclass(frozen=True)
class DimensionStore:
    """All dimension tables below one shared folder.

    Changes of a micro-batch go to `changes/table=<name>/batch=<id>`, all tables in one write; a
    table's own folder holds the names of its columns and its base, in buckets of some `rows_each` keys,
    of which a fold rewrites those with changes. A finished batch never changes: a replay leaves it
    as it is, so a stream with a new checkpoint needs a new store. Tables may have any name but an
    empty one; upper and lower case are the same.
    """

    spark: SparkSession
    root: str
    rows_each: int = 1 << 17

    @property
    def _changes(self) -> str:
        return f"{self.root.rstrip('/')}/changes"

    def _table(self, table: str) -> BatchTable:
        name = escaped(table.lower())
        return BatchTable(self.spark, f"{self.root.rstrip('/')}/{name}", CHANGE_ROWS,
                          filled=f"{self._changes}/table={name}")

    def _folded(self, table: str) -> BucketedTable:
        return BucketedTable(self.spark, self._table(table).path, "_key", self.rows_each)

    def _names(self, table: str) -> BatchTable:
        return BatchTable(self.spark, f"{self._table(table).path}/columns", schemas.STORED_COLUMN)

    def exists(self, table: str) -> bool:
        return self._names(table).has(0)

    def tables(self) -> list[str]:
        """Tables that have changes."""
        return [unescaped(name.split("=", 1)[1]) for name in folders(self.spark, self._changes)
                if name.startswith("table=")]

    def columns(self, table: str) -> list[str]:
        """Column names in the order they came; a few rows of configuration."""
        rows = self._names(table).batches().orderBy("position").collect()
        return list(dict.fromkeys(r.name for r in rows))

    def _add(self, table: str, columns: list[str], position: int, step: int) -> None:
        rows = self.spark.createDataFrame(
            [(position + i, name) for i, name in enumerate(columns)], schemas.STORED_COLUMN)
        self._names(table).append(rows.coalesce(1), step)

    def create(self, table: str, columns: list[str], key: str = "id") -> bool:
        """Make an empty table if there is none; a failure is raised."""
        if self.exists(table):
            return False
        if key not in columns:
            raise ValueError(f"table {table}: key column {key!r} is not one of {columns}")
        self._add(table, columns, 0, 0)
        return True

    def grow(self, table: str, columns: list[str]) -> list[str]:
        """Add the columns that the table lacks; of the changes so far, those since the base count."""
        have = self.columns(table)
        lacking = [c for c in columns if c not in have]
        if lacking:
            self._add(table, lacking, len(have), self._names(table).last_batch() + 1)
        return lacking

    def create_missing(self, rules: DataFrame) -> list[str]:
        """Make the table of every dimension rule, with the columns of all its rules; a table that
        is there gets the columns it lacks. Rules are configuration: a few rows."""
        wanted: dict[str, tuple[dict[str, None], str]] = {}
        for r in (rules.where((F.col("sink_type") == codes.SINK_TYPE["dimension"])
                              & (F.coalesce("sink_table", F.lit("")) != ""))
                  .select("sink_table", "sink_columns", "sink_pk").distinct()
                  .orderBy("sink_table", "sink_columns").collect()):
            columns, _ = wanted.setdefault(r.sink_table.lower(), ({}, r.sink_pk or "id"))
            columns.update(dict.fromkeys(c.strip() for c in (r.sink_columns or "").split(",")))
        made = [name for name, (columns, key) in wanted.items()
                if self.create(name, list(columns), key)]
        for name in wanted.keys() - set(made):
            self.grow(name, list(wanted[name][0]))
        return made

    def put(self, routed: DataFrame, batch_id: int, on_delete: str = "ignore") -> None:
        """Add one micro-batch of changes that name their table (sink_table) and key (sink_pk); one
        write, whose cost is what the batch holds, not what the tables hold."""
        name = F.lower("sink_table")
        done = holding_batch(self.spark, self._changes, "table", batch_id)
        rows = change_rows(routed.where(~name.isin(done)) if done else routed,
                           F.col("sink_pk"), on_delete)
        (rows.select(name.alias("table"), F.lit(batch_id).alias("batch"), *CHANGE_ROWS.names)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("table", "batch").parquet(self._changes))

    def upsert(self, table: str, changes: DataFrame, batch_id: int, key: str = "id",
               on_delete: str = "ignore") -> None:
        """The same for changes of one table."""
        self.put(changes.withColumn("sink_table", F.lit(table)).withColumn("sink_pk", F.lit(key)),
                 batch_id, on_delete)

    def _current(self, table: str, columns: list[str], key_is: str | None = None) -> DataFrame:
        """One state per key, of one key where it is given: looked for before anything is merged, and
        in its own bucket only."""
        batches, folded = self._table(table), self._folded(table)
        base = folded.newest()
        delta = self._delta(table, columns, base.upto, key_is=key_is)
        if base.upto < 0:
            return delta
        buckets = None
        if key_is is not None:
            keys = self.spark.createDataFrame([(key_is,)], "key string")
            buckets = folded.numbers(base, keys, "key")
        old = folded.read(base, delta.schema, buckets)
        if key_is is not None:
            old = old.where(F.col("_key") == key_is)
        return _onto(old, delta, columns) if batches.has_batches(after=base.upto) else old

    def _delta(self, table: str, columns: list[str], after: int, before: int | None = None,
               key_is: str | None = None) -> DataFrame:
        """The states that the batches after one, and before another, come to."""
        changes = self._table(table).batches(after=after, before=before)
        if key_is is not None:
            changes = changes.where(F.col("key") == key_is)
        return _by_key(_states(changes, columns), columns)

    def _read(self, table: str, camel: bool, key_is: str | None = None) -> DataFrame:
        if not self.exists(table):
            raise ValueError(f"no dimension table {table} below {self.root}")
        columns = self.columns(table)
        rows = _live(self._current(table, columns, key_is), columns)
        return camel_columns(rows) if camel else rows

    def read(self, table: str, camel: bool = False) -> DataFrame:
        """Current rows. Without changes since the base, a plain scan."""
        return self._read(table, camel)

    def lookup(self, table: str, value: str, camel: bool = False) -> DataFrame:
        """The row of one key; the key reaches the scans."""
        return self._read(table, camel, value)

    def compact(self, table: str) -> None:
        """Fold the batches so far into the base, in the background or every n batches: the buckets
        with changed keys are written anew, the others stay."""
        batches, folded = self._table(table), self._folded(table)
        last, upto = batches.last_batch(), folded.newest().upto
        if last > upto:
            columns = self.columns(table)
            delta = self._delta(table, columns, upto, last + 1)
            folded.fold(delta, lambda old, new: _onto(old, new, columns), delta.schema, last)
            batches.forget(before=folded.before_last() + 1)
