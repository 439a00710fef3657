"""Time columns computed from epoch milliseconds.

Working on the number keeps every result in UTC whatever the session's time zone is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

DAY_MS = 86_400_000
HOUR_MS = 3_600_000
MINUTE_MS = 60_000


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds of a timestamp column; a zone-less timestamp counts as UTC."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, TimestampType):
        return F.unix_millis(col)
    if isinstance(dtype, TimestampNTZType):
        day = F.unix_date(col.cast("date")).cast("long") * DAY_MS
        clock = F.hour(col).cast("long") * HOUR_MS + F.minute(col).cast("long") * MINUTE_MS
        second = F.floor(F.date_part(F.lit("SECOND"), col) * 1000).cast("long")
        return day + clock + second
    return col.cast("long")


def day_of(millis: Column) -> Column:
    """The UTC date of epoch milliseconds."""
    into_day = F.pmod(millis, F.lit(DAY_MS))
    return F.date_from_unix_date(((millis - into_day) / DAY_MS).cast("int"))


def hour_start(millis: Column) -> Column:
    """The first millisecond of the hour."""
    return millis - F.pmod(millis, F.lit(HOUR_MS))


def _padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def bucket_columns(millis: Column) -> dict[str, Column]:
    """The four directory levels of a bucketed table, zero-padded."""
    day = day_of(millis)
    hour = F.floor(F.pmod(millis, F.lit(DAY_MS)) / HOUR_MS)
    return {
        "year": _padded(F.year(day), 4),
        "month": _padded(F.month(day), 2),
        "day": _padded(F.day(day), 2),
        "hour": _padded(hour, 2),
    }


def bucket_path(millis: Column) -> Column:
    """`year=…/month=…/day=…/hour=…` as one string."""
    parts = [F.concat(F.lit(f"{name}="), col) for name, col in bucket_columns(millis).items()]
    return F.concat_ws("/", *parts)


def log_folder(millis: Column) -> Column:
    """The commit log's `MM-DD-YYYY/HH/mm` folder of a commit time."""
    parts = bucket_columns(millis)
    minute = F.floor(F.pmod(millis, F.lit(HOUR_MS)) / MINUTE_MS)
    date = F.concat_ws("-", parts["month"], parts["day"], parts["year"])
    return F.concat_ws("/", date, parts["hour"], _padded(minute, 2))
