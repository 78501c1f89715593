"""Times as text, epoch milliseconds and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def parse_time(text, fmt: str = TIME_FORMAT) -> Column:
    """Text to timestamp in the session zone; null where the text does not fit.

    The usual format goes through a cast, which is several times faster than a pattern; the
    cast takes other shapes too, so the shape is looked at first.
    """
    text = F.col(text) if isinstance(text, str) else text
    if fmt == TIME_FORMAT:
        fits = text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$")
        return F.when(fits, text.try_cast("timestamp"))
    return F.try_to_timestamp(text, F.lit(fmt))


def text_to_millis(text, zone: str | None = None, fmt: str = TIME_FORMAT) -> Column:
    """Text to epoch ms, read in the session zone or at a fixed offset such as '+08:00'."""
    text = F.col(text) if isinstance(text, str) else text
    if zone is None:
        return F.unix_millis(parse_time(text, fmt))
    return F.unix_millis(parse_time(F.concat(text, F.lit(zone)), fmt + "XXX"))


def millis_to_text(millis, zone: str | None = None, fmt: str = TIME_FORMAT) -> Column:
    """Epoch ms to text, shown in the session zone or in the zone given."""
    moment = F.timestamp_millis(millis)
    if zone is not None:
        moment = F.to_utc_timestamp(F.from_utc_timestamp(moment, zone), F.current_timezone())
    return F.date_format(moment, fmt)


def whole_seconds(millis) -> Column:
    """Epoch ms to a timestamp cut to the whole second."""
    millis = F.col(millis) if isinstance(millis, str) else millis
    return F.timestamp_seconds(F.floor(millis / F.lit(1000)))


def with_event_time(df: DataFrame, moment: Column, delay: str, name: str = "event_time") -> DataFrame:
    """Add an event-time column; on a stream it carries a watermark."""
    df = df.withColumn(name, moment)
    return df.withWatermark(name, delay) if df.isStreaming else df


def window_text(window: str = "window") -> list[Column]:
    """Window bounds as the text columns stt and edt."""
    return [F.date_format(F.col(f"{window}.start"), TIME_FORMAT).alias("stt"),
            F.date_format(F.col(f"{window}.end"), TIME_FORMAT).alias("edt")]


def interval_millis(interval: str) -> int:
    """'10 seconds' and the like as milliseconds."""
    amount, unit = interval.split()
    per = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(amount) * per[unit.rstrip("s")]
