"""Topics as streams of text: a Kafka cluster, or folders of text files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemart.sources.files import escaped, holding_batch, make_folder


@dataclass(frozen=True)
class Topics:
    """Where topics live.

    `kafka`: options for the Kafka source and sink (servers, security); the connector must be on
    the class path. Otherwise `root` is a shared folder with one folder `topic=<name>` each.
    `starting` is where a new query begins on Kafka.
    """

    root: str | None = None
    kafka: dict[str, str] = field(default_factory=dict)
    starting: str = "latest"
    files_per_trigger: int | None = None

    def folder(self, topic: str) -> str:
        return f"{self.root.rstrip('/')}/topic={escaped(topic)}"

    def read(self, spark: SparkSession, topic: str, group: str | None = None) -> DataFrame:
        """Stream of (value, seq): the text and its place in the topic.

        Kafka numbers every row. Of a file only its time is known, so its rows share a place;
        records whose order matters should bring a number of their own.
        """
        if self.kafka:
            options = {**self.kafka, "subscribe": topic, "startingOffsets": self.starting}
            if group:
                options["kafka.group.id"] = group
            # Offsets repeat between partitions; the partition makes the place unique.
            return spark.readStream.format("kafka").options(**options).load().select(
                F.col("value").cast("string").alias("value"),
                (F.shiftleft("offset", 16) + F.col("partition")).alias("seq"))
        make_folder(spark, self.folder(topic))
        reader = spark.readStream.option("recursiveFileLookup", "true")
        if self.files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.files_per_trigger)
        return reader.text(self.folder(topic)).select(
            "value", F.unix_millis("_metadata.file_modification_time").alias("seq"))

    def write(self, lines: DataFrame, topic: str) -> DataStreamWriter:
        """Writer of a stream with a `value` column; exactly once for files."""
        lines = lines.select("value")
        if self.kafka:
            return (lines.writeStream.format("kafka").options(**self.kafka)
                    .option("topic", topic))
        return lines.writeStream.format("text").option("path", self.folder(topic))

    def put(self, lines: DataFrame, topic: str, batch_id: int) -> None:
        """Write one micro-batch to one topic, from inside foreachBatch."""
        self.put_routed(lines.select(F.lit(topic).alias("topic"), "value"), batch_id)

    def put_routed(self, lines: DataFrame, batch_id: int) -> None:
        """Write one micro-batch, each row to the topic it names.

        Files: the folder of one batch of one topic appears whole and never changes; a replay
        leaves it as it is, so stream readers get every row once. A stream with a new checkpoint
        needs new topics. Kafka: at least once.
        """
        if self.kafka:
            lines.select("topic", "value").write.format("kafka").options(**self.kafka).save()
            return
        done = holding_batch(lines.sparkSession, self.root.rstrip("/"), "topic", batch_id)
        if done:
            lines = lines.where(~F.col("topic").isin(done))
        (lines.select("topic", F.lit(batch_id).alias("batch"), "value")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("topic", "batch").text(self.root))


def start(writer: DataStreamWriter, checkpoint: str, name: str, once: bool = False,
          interval: str | None = None) -> StreamingQuery:
    """Start in append mode with a checkpoint; `once` drains what is there and stops."""
    writer = (writer.outputMode("append").queryName(name)
              .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}"))
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    return stream.writeStream.foreachBatch(work)


def console(df: DataFrame, rows: int = 20) -> DataStreamWriter:
    """Show a stream while developing."""
    return df.writeStream.format("console").option("numRows", rows).option("truncate", "false")
