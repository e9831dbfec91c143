"""UTC day and instant literals, and filters on event times.

Operators work on TIMESTAMP_NTZ columns that hold UTC. A table may store its times as TIMESTAMP
instead: ``within`` then compares instants, which the scan can use, and converts afterwards.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


def day_of(value: dt.date | str) -> dt.date:
    """A calendar day from a date or its ISO text."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def date_literal(value: dt.date | str) -> Column:
    return F.lit(day_of(value))


def utc_time(value: dt.datetime | str) -> dt.datetime:
    """Naive UTC time; a zoned one is converted, a naive one is taken as UTC."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def utc_literal(value: dt.datetime | str) -> Column:
    """Zone-less UTC literal."""
    return F.lit(utc_time(value).isoformat(sep=" ")).cast("timestamp_ntz")


def utc_wall(rows: DataFrame, name: str) -> Column:
    """The UTC wall time of a time column, whatever the session zone and its clock changes."""
    if isinstance(rows.schema[name].dataType, TimestampType):
        micros = F.unix_micros(F.col(name))
        return F.timestamp_add("MICROSECOND", micros, utc_literal("1970-01-01 00:00:00")).alias(name)
    return F.col(name)


def within(
    rows: DataFrame,
    name: str,
    since: dt.datetime | None = None,
    below: dt.datetime | None = None,
    upto: dt.datetime | None = None,
) -> DataFrame:
    """Rows with ``since <= name``, ``name < below`` and ``name <= upto``, the column as UTC wall time.

    Literals have the column's own type, so the bounds reach the scan.
    """
    stored = isinstance(rows.schema[name].dataType, TimestampType)

    def literal(value: dt.datetime) -> Column:
        if not stored:
            return utc_literal(value)
        since_epoch = utc_time(value) - dt.datetime(1970, 1, 1)
        return F.timestamp_micros(F.lit(since_epoch // dt.timedelta(microseconds=1)).cast("bigint"))

    column = F.col(name)
    for value, test in ((since, column.__ge__), (below, column.__lt__), (upto, column.__le__)):
        if value is not None:
            rows = rows.filter(test(literal(value)))
    return rows.withColumn(name, utc_wall(rows, name)) if stored else rows
