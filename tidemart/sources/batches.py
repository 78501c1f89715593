"""A parquet table that a stream fills, one folder per micro-batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemart.sources.files import exists, folders, remove_folder


@dataclass(frozen=True)
class BatchTable:
    """Rows by micro-batch. A replayed batch overwrites its own folder, so every batch counts once.

    `filled` names the folder of the batches where another writer fills it. Such folders appear
    whole, by a rename, and carry no mark of their own.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    filled: str | None = None

    @property
    def _batches(self) -> str:
        return self.filled or f"{self.path}/batches"

    def _batch_ids(self) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in folders(self.spark, self._batches)
                      if name.startswith("batch="))

    def _finished(self, batch_id: int) -> bool:
        folder = f"{self._batches}/batch={batch_id}"
        return exists(self.spark, folder if self.filled else f"{folder}/_SUCCESS")

    def append(self, rows: DataFrame, batch_id: int) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(
            f"{self._batches}/batch={batch_id}")

    def has(self, batch_id: int) -> bool:
        return self._finished(batch_id)

    def batches(self, after: int = -1, before: int | None = None) -> DataFrame:
        """Rows of the batches after one and before another."""
        wanted = [n for n in self._batch_ids()
                  if n > after and (before is None or n < before) and self._finished(n)]
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(
            *[f"{self._batches}/batch={n}" for n in wanted])

    def has_batches(self, after: int) -> bool:
        return self.last_batch() > after

    def forget(self, before: int) -> None:
        """Remove the folders of the batches before one."""
        for n in self._batch_ids():
            if n < before:
                remove_folder(self.spark, f"{self._batches}/batch={n}")

    def last_batch(self) -> int:
        return max(self._batch_ids(), default=-1)
