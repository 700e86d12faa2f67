"""Tolerant date handling: text in flight, typed columns at rest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings which a plain cast does not take.
TIMESTAMP_FORMATS = ("yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss.SSS", "yyyy/MM/dd'T'HH:mm:ss")
DATE_FORMATS = ("yyyy/MM/dd", *TIMESTAMP_FORMATS)

Cast = Callable[[Column], Column]


def to_timestamp_or_null(text: Column | str) -> Column:
    """TIMESTAMP, or NULL where the text is malformed."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(
        text.try_cast("timestamp"),
        *[F.try_to_timestamp(text, F.lit(fmt)) for fmt in TIMESTAMP_FORMATS],
    )


def to_date_or_null(text: Column | str) -> Column:
    """DATE, or NULL where the text is malformed."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(
        text.try_cast("date"),
        *[F.try_to_timestamp(text, F.lit(fmt)).cast("date") for fmt in DATE_FORMATS],
    )


def ingestion_schema(schema: T.StructType) -> tuple[T.StructType, dict[str, Cast]]:
    """The schema in flight, and the cast which restores each changed column.

    Dates and timestamps travel as text: the sources hold years no
    nanosecond timestamp can carry and stamps with 60 seconds.
    """
    fields, casts = [], {}
    for field in schema.fields:
        if isinstance(field.dataType, T.DateType):
            casts[field.name] = to_date_or_null
        elif isinstance(field.dataType, T.TimestampType):
            casts[field.name] = to_timestamp_or_null
        changed = T.StringType() if field.name in casts else field.dataType
        fields.append(T.StructField(field.name, changed, True, field.metadata))
    return T.StructType(fields), casts


def has_bad_seconds(text: Column | str) -> Column:
    """The third ``:``-separated item is a number below 0 or from 60 on.

    Items which are no number (an offset after the seconds) are not counted.
    """
    text = F.col(text) if isinstance(text, str) else text
    seconds = F.rtrim(F.get(F.split(text, ":"), F.lit(2)), F.lit("Z")).try_cast("double")
    return F.coalesce((seconds >= 60) | (seconds < 0), F.lit(False))
