"""Database change records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions.json_rows import is_json_object, parse_topic

# Operation names and their one-letter codes -> what the warehouse calls them.
OPERATIONS = {"c": "insert", "create": "insert", "u": "update", "d": "delete", "r": "read"}


def read_envelopes(records: DataFrame) -> DataFrame:
    """Capture-tool records (topic, value, seq) to op, before, after and seq.

    A record's own seq goes before its place in the topic.
    """
    placed = records.where(is_json_object()).withColumnRenamed("seq", "place")
    rows = parse_topic(placed, schemas.CHANGE_ENVELOPE)
    return rows.withColumn("seq", F.coalesce("seq", "place")).drop("place")


def normalise_changes(envelopes: DataFrame) -> DataFrame:
    """Envelopes (topic, op, before, after, seq) to database, table, type and data.

    Database and table are the second and third part of the topic name. A delete has no
    `after` and gets empty data; `before` stays, as it holds the key of a deleted row.
    """
    parts = F.split("topic", r"\.")
    op = F.lower("op")
    names = F.create_map(*[F.lit(x) for pair in OPERATIONS.items() for x in pair])
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return envelopes.select(
        F.get(parts, F.lit(1)).alias("database"), F.get(parts, F.lit(2)).alias("table"),
        F.coalesce(F.try_element_at(names, op), op).alias("type"),
        F.coalesce("after", none).alias("data"), "before", "seq")
