"""JSON text to typed rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISFIT = "_misfit"


def is_json_object(value: str = "value") -> Column:
    """True when the whole text is one JSON object. Only syntax counts, not field types.

    Between brackets, a lone object is an array of length one; trailing text, a second
    object or an open brace is not. Names and texts may stand in single quotes.
    """
    text = F.col(value)
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.coalesce(one & F.ltrim(text).startswith("{"), F.lit(False))


def json_variant(value: str = "value") -> Column:
    """The text as a variant, by the same reader as `is_json_object`: single quotes are good, and
    so are repeated names, of which the last counts, in sessions with the package's settings."""
    return F.from_json(F.col(value), "variant")


def parse_topic(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON objects to typed rows, text and numbers turned into each other as needed.

    Other columns of the source (topic, seq) stay. from_json reads the text once and is enough
    for well-typed rows. Where it reports a misfit (say a number written as text), the row is
    read again as a variant, whose cast converts field by field and gives null only for the
    field that cannot be converted. What no variant holds keeps the fields of the first reading.

    The row is unpacked by `inline`, and not by a projection, because the optimizer copies what
    a projection computes into every later filter on it, and each copy would read the text again.
    """
    rest = [c for c in lines.columns if c != value]
    strict = F.from_json(
        F.col(value), T.StructType([*schema.fields, T.StructField(MISFIT, T.StringType())]),
        {"columnNameOfCorruptRecord": MISFIT})
    lenient = F.try_variant_get(json_variant(value), "$", schema.simpleString())
    read = lines.where(F.col(value).isNotNull()).select(*rest, value, strict.alias("_strict"))
    typed = F.struct(*[F.col(f"_strict.{name}") for name in schema.names])
    row = F.when(F.col(f"_strict.{MISFIT}").isNull(), typed).otherwise(F.coalesce(lenient, typed))
    return read.select(*rest, F.inline(F.array(row)))


def to_topic(df: DataFrame, *columns: str) -> DataFrame:
    """Rows as one JSON text column, ready for a topic."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))
