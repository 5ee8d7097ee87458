"""Time parsing and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The accepted spellings of event_time.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
PLAIN_SECONDS = "yyyy-MM-dd HH:mm:ss"


def parse_event_time(text: Column) -> Column:
    """Timestamp without zone from any accepted spelling, else NULL.

    The shape of the text tells which spelling it can be, so each text is
    parsed once; a failed parse is an exception inside Spark and not cheap.
    """
    separator = F.substring(text, 11, 1)
    read = lambda fmt: F.try_to_timestamp(text, F.lit(fmt))
    iso = F.when(text.contains("."), read(ISO_MICROS)).otherwise(read(ISO_SECONDS))
    return F.when(separator == "T", iso).when(separator == " ", read(PLAIN_SECONDS)).cast("timestamp_ntz")


def parse_to_second(text: Column) -> Column:
    """Same, cut to whole seconds: a fraction of any length is dropped first."""
    iso = F.replace(F.substring_index(text, ".", 1), F.lit("T"), F.lit(" "))
    plain = F.when(text.contains("T"), iso).otherwise(text)
    return F.try_to_timestamp(plain, F.lit(PLAIN_SECONDS)).cast("timestamp_ntz")


def epoch_seconds(moment: Column) -> Column:
    return F.unix_seconds(moment.cast("timestamp"))


def epoch_micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def with_day_parts(events: DataFrame) -> DataFrame:
    """Add ``hour`` and ``date_str``."""
    return events.withColumns({
        "hour": F.hour("event_time"),
        "date_str": F.date_format("event_time", "yyyy-MM-dd"),
    })


def with_calendar(events: DataFrame) -> DataFrame:
    """Add the calendar columns the models use; Sunday is day 1."""
    return events.withColumns({
        "hour": F.hour("event_time"),
        "day_of_week": F.dayofweek("event_time"),
        "month": F.month("event_time"),
        "year": F.year("event_time"),
        "date": F.date_format("event_time", "yyyy-MM-dd"),
    })
