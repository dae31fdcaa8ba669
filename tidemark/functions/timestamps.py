"""Watermark text, cut-offs and load partitions.

Every value is TIMESTAMP_NTZ. Text of that type is written and read without the session
time zone, so truncation and formatting go through text instead of ``date_trunc`` and
``date_format``, which convert to the zoned type first.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import as_column, clean_text

# The accepted shapes of timestamp text, the zero date of MySQL, the time
# zone of load dates, and the start of time for a table that was never merged.
_DAY = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_CLOCK = r"[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}([.][0-9]{1,6})?"
SPACED = f"{_DAY} {_CLOCK}"
ZULU = f"{_DAY}T{_CLOCK}Z"
ZERO_DATE = "0000-00-00"
LOAD_ZONE = "Asia/Kolkata"
EPOCH = "1970-01-01 00:00:00"


def ntz(value: datetime | str | Column) -> Column:
    """A TIMESTAMP_NTZ from a literal or a column."""
    if isinstance(value, datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return (F.lit(value) if isinstance(value, str) else value).cast("timestamp_ntz")


def parse_timestamp(c: Column | str, shapes: tuple[str, ...] = (SPACED, ZULU)) -> Column:
    """Text in one of the shapes as a timestamp, other text as NULL; a ``Z`` is dropped."""
    text = as_column(c)
    return F.when(text.rlike(f"^({'|'.join(shapes)})$"), text.try_cast("timestamp_ntz"))


def unreadable(text: Column | str, parsed: Column | str) -> Column:
    """Is there text from which no time was read? Zero dates of a source are meant to be NULL."""
    own = clean_text(as_column(text).cast("string"))
    return own.isNotNull() & ~own.startswith(ZERO_DATE) & as_column(parsed).isNull()


def parse_watermark(c: Column | str) -> Column:
    """Stored watermark: seconds, with or without a fraction (also takes a timestamp column)."""
    return parse_timestamp(as_column(c).cast("string"), (SPACED,))


def format_watermark(c: Column | str) -> Column:
    """Seconds when they are whole, else six digits of fraction."""
    text = as_column(c).cast("timestamp_ntz").cast("string")
    return F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)


def cdc_cutoff(c: Column | str, minutes: int) -> Column:
    """Watermark less the lookback, down to the minute."""
    moved = as_column(c).cast("timestamp_ntz") - F.expr(f"interval {int(minutes)} minutes")
    return F.substring(moved.cast("string"), 1, 16).cast("timestamp_ntz")


def zero_date_to_null(c: Column | str) -> Column:
    """Timestamp text of a source that writes zero dates; those and unreadable text are NULL."""
    text = as_column(c).cast("string")
    return F.when(~text.startswith(ZERO_DATE), text.try_cast("timestamp_ntz"))


def load_partition(ts: datetime | str | Column, zone: str = LOAD_ZONE) -> tuple[Column, Column]:
    """Load date and two-digit hour of a UTC time, as text in the load zone."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), ntz(ts)).cast("string")
    return F.substring(local, 1, 10), F.substring(local, 12, 2)
