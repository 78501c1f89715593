"""Summary sinks: parquet folders or a JDBC table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class SummarySink:
    """Where summary tables go.

    `jdbc`: options of the JDBC writer (url, driver, user ...), rows are inserted by position in the
    order of `columns`. Otherwise parquet below `root`, one folder per micro-batch, which a
    replayed batch overwrites.
    """

    root: str | None = None
    jdbc: dict[str, str] = field(default_factory=dict)
    batch_size: int = 1000

    def put(self, rows: DataFrame, table: str, columns: list[str], batch_id: int) -> None:
        rows = rows.select(*columns)
        if self.jdbc:
            (rows.write.format("jdbc").options(**self.jdbc)
             .option("dbtable", table).option("batchsize", self.batch_size)
             .mode("append").save())
        else:
            rows.write.mode("overwrite").parquet(f"{self.folder(table)}/batch={batch_id}")

    def folder(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"
