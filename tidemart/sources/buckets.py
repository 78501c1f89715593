"""A base table in hash buckets of its key. A fold rewrites the buckets that changed; the others stay
where they are and are named by the new base."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.sources.files import exists, folders, remove_folder

PART = "bucket int, buckets int, folder bigint, rows bigint"
ALL = -1     # the row of a list that stands for the table


@dataclass(frozen=True)
class Base:
    """A finished base: folded up to a batch, and per bucket the fold that wrote it and its rows."""

    upto: int = -1
    buckets: int = 1
    parts: dict[int, tuple[int, int]] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(rows for _, rows in self.parts.values())


@dataclass(frozen=True)
class BucketedTable:
    """Rows by the hash of `key`, which is text, some `rows_each` in a bucket.

    A fold writes `data/upto=<n>/bucket=<b>` for the buckets it changes, then the list of all buckets
    with their folders, `base/upto=<n>`, which counts once it is whole. The number of buckets
    doubles as the table grows; only then everything is written again. Data that neither of the two
    newest lists names is removed.
    """

    spark: SparkSession
    path: str
    key: str
    rows_each: int = 1 << 17
    options: dict[str, str] = field(default_factory=dict)

    def number(self, buckets: int, key: Column | None = None) -> Column:
        """The bucket of a row, or of a key that stands elsewhere."""
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(buckets)).cast("int")

    def _lists(self) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in folders(self.spark, f"{self.path}/base")
                      if exists(self.spark, f"{self.path}/base/{name}/_SUCCESS"))

    def _base(self, upto: int) -> Base:
        """One list: as many rows as there are buckets."""
        rows = self.spark.read.schema(PART).parquet(f"{self.path}/base/upto={upto}").collect()
        return Base(upto, next(r.buckets for r in rows if r.bucket == ALL),
                    {r.bucket: (r.folder, r.rows) for r in rows if r.bucket != ALL})

    def newest(self) -> Base:
        done = self._lists()
        return self._base(done[-1]) if done else Base()

    def read(self, base: Base, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
        """The rows of all buckets or of some. Columns that came after a bucket was written are null."""
        wanted = base.parts if buckets is None else [b for b in buckets if b in base.parts]
        paths = [f"{self.path}/data/upto={base.parts[b][0]}/bucket={b}" for b in wanted]
        if not paths:
            return self.spark.range(0).select(
                *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        return self.spark.read.schema(schema).parquet(*paths)

    def numbers(self, base: Base, keys: DataFrame, key: str) -> list[int]:
        """The buckets that some keys fall into, as many numbers as there are buckets at the most."""
        found = keys.select(self.number(base.buckets, F.col(key)).alias("b")).distinct().collect()
        return sorted(r.b for r in found)

    def fold(self, delta: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame],
             schema: T.StructType, upto: int) -> None:
        """A new base: `merged(old rows, delta)` in the buckets that the delta's keys fall into."""
        base = self.newest()
        delta = delta.persist()
        try:
            most, buckets = base.rows + delta.count(), base.buckets
            while most > buckets * self.rows_each:
                buckets *= 2
            if buckets == base.buckets:
                touched = self.numbers(base, delta, self.key)
                rows = merged(self.read(base, schema, touched), delta)
                kept = {b: p for b, p in base.parts.items() if b not in touched}
            else:
                rows, kept = merged(self.read(base, schema), delta), {}
            folder = f"{self.path}/data/upto={upto}"
            (rows.withColumn("bucket", self.number(buckets)).repartition("bucket")
             .sortWithinPartitions("bucket", self.key).write.mode("overwrite").options(**self.options)
             .partitionBy("bucket").parquet(folder))
        finally:
            delta.unpersist()
        written = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(
            "bucket", T.IntegerType())])).parquet(folder).groupBy("bucket").count().collect()
        parts = kept | {r["bucket"]: (upto, r["count"]) for r in written}
        listed = [(ALL, buckets, upto, 0), *((b, buckets, f, n) for b, (f, n) in parts.items())]
        self.spark.createDataFrame(listed, PART).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/base/upto={upto}")
        self._clean()

    def _clean(self) -> None:
        """The list before the newest stays for readers that have begun with it, and what it names."""
        done = self._lists()
        named = {(f, b) for upto in done[-2:] for b, (f, _) in self._base(upto).parts.items()}
        for upto in done[:-2]:
            remove_folder(self.spark, f"{self.path}/base/upto={upto}")
        for name in folders(self.spark, f"{self.path}/data"):
            path, fold = f"{self.path}/data/{name}", int(name.split("=")[1])
            if fold > done[-1]:
                continue
            held = [int(b.split("=")[1]) for b in folders(self.spark, path) if b.startswith("bucket=")]
            gone = [b for b in held if (fold, b) not in named]
            if len(gone) == len(held):
                remove_folder(self.spark, path)
            else:
                for b in gone:
                    remove_folder(self.spark, f"{path}/bucket={b}")

    def before_last(self) -> int:
        """What the list before the newest is folded up to; batches up to it are in both lists."""
        done = self._lists()
        return done[-2] if len(done) > 1 else -1
