"""New-visitor flags on a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.operators.logs import ORDER, first_new_rows, repair_new_flags
from tidemart.sources.batches import BatchTable
from tidemart.sources.buckets import BucketedTable

FIRST_VISITS = schemas.FIRST_VISIT
ROWS_EACH = 1 << 20         # devices in a bucket
MOST_NAMED = 1000           # devices that are looked for by name, which the Bloom filters answer
# Row groups of some 30,000 devices, each with a filter that says which devices it cannot hold.
OPTIONS = {"parquet.block.size": str(1 << 20), "parquet.bloom.filter.enabled#mid": "true",
           "parquet.bloom.filter.expected.ndv#mid": "32768"}


@dataclass(frozen=True)
class FirstVisits:
    """Devices that have shown the new flag, with the time they first did.

    What a micro-batch costs follows from the devices it flags as new, not from all devices so far:
    it opens the buckets they fall into, and within them the row groups that may hold one.
    """

    spark: SparkSession
    path: str
    rows_each: int = ROWS_EACH

    @property
    def table(self) -> BatchTable:
        return BatchTable(self.spark, self.path, FIRST_VISITS)

    @property
    def folded(self) -> BucketedTable:
        return BucketedTable(self.spark, self.path, "mid", self.rows_each, OPTIONS)

    def read(self, before: int | None = None) -> DataFrame:
        base = self.folded.newest()
        return self.folded.read(base, FIRST_VISITS).unionByName(
            self.table.batches(after=base.upto, before=before))

    def known(self, devices: DataFrame, before: int) -> DataFrame:
        """The rows so far of some devices (mid), which may hold others too, before a batch."""
        base = self.folded.newest()
        rows = self.folded.read(base, FIRST_VISITS, self.folded.numbers(base, devices, "mid"))
        named = [r.mid for r in devices.select("mid").limit(MOST_NAMED + 1).collect()]
        if len(named) <= MOST_NAMED:
            rows = rows.where(F.col("mid").isin(named))
        return rows.unionByName(self.table.batches(after=base.upto, before=before))

    def repair(self, logs: DataFrame, batch_id: int, order=ORDER) -> DataFrame:
        """Flags of one micro-batch, against all earlier batches; records its new devices.

        Only batches before this one are looked at, so a replay gives the same flags. `logs` is read
        several times, so it should be persisted.
        """
        table = self.table
        firsts = first_new_rows(logs, order).persist()
        try:
            seen = self.known(firsts, batch_id).join(firsts.select("mid"), "mid", "left_semi")
            fresh = firsts.join(seen.select("mid"), "mid", "left_anti")
            table.append(fresh.select("mid", F.col("ts").cast("bigint").alias("ts")), batch_id)
        finally:
            firsts.unpersist()
        # The rows just written name the devices; their places are found again in the batch.
        new = first_new_rows(logs, order).join(
            table.batches(after=batch_id - 1, before=batch_id + 1).select("mid"), "mid", "left_semi")
        return repair_new_flags(logs, order, new)

    def compact(self) -> None:
        """Fold all batches but the newest, which may yet be replayed, into the buckets they touch."""
        last = self.table.last_batch() - 1
        upto = self.folded.newest().upto
        if last > upto:
            delta = self.table.batches(after=upto, before=last + 1)
            self.folded.fold(delta, lambda old, new: old.unionByName(new), FIRST_VISITS, last)
            self.table.forget(before=self.folded.before_last() + 1)
