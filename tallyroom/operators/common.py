"""Row selection and small-frame helpers used by several operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tallyroom.functions import date_literal, day_of, within

Excluded = Sequence[str] | DataFrame

# A frame cut to at most this many rows by a limit may be broadcast without measuring it.
BROADCAST_ROWS = 10_000


def without_users(rows: DataFrame, excluded: Excluded) -> DataFrame:
    """Drop the excluded users and, as ``NOT IN`` does, the rows without a user."""
    if isinstance(excluded, DataFrame):
        known = rows.filter(F.col("user_id").isNotNull())
        return known.join(excluded.select("user_id"), "user_id", "left_anti")
    kept = F.col("user_id").isNotNull()
    if excluded:
        kept &= ~F.col("user_id").isin(*excluded)
    return rows.filter(kept)


def _midnight(day: dt.date | str) -> dt.datetime:
    return dt.datetime.combine(day_of(day), dt.time())


def on_day(rows: DataFrame, day: dt.date | str, partition_date: str | None = None) -> DataFrame:
    """Rows of one UTC day.

    ``partition_date`` names a column that holds each row's UTC day, if the table is laid out by
    one; the scan is then pruned to that partition.
    """
    start = _midnight(day)
    if partition_date:
        rows = rows.filter(F.col(partition_date) == date_literal(day))
    return within(rows, "event_timestamp", since=start, below=start + dt.timedelta(days=1))


def before(
    rows: DataFrame, moment: dt.datetime, partition_date: str | None = None
) -> DataFrame:
    """Rows before a UTC moment."""
    if partition_date:
        last = (moment - dt.timedelta(microseconds=1)).date()
        rows = rows.filter(F.col(partition_date) <= date_literal(last))
    return within(rows, "event_timestamp", below=moment)


def up_to_day(rows: DataFrame, day: dt.date | str, partition_date: str | None = None) -> DataFrame:
    """Rows up to and including one UTC day."""
    return before(rows, _midnight(day) + dt.timedelta(days=1), partition_date)


def in_days(
    rows: DataFrame, first_day: dt.date | str, last_day: dt.date | str, partition_date: str | None = None
) -> DataFrame:
    """Rows of the UTC days from the first to the last."""
    if partition_date:
        rows = rows.filter(F.col(partition_date).between(date_literal(first_day), date_literal(last_day)))
    return within(
        rows, "event_timestamp", since=_midnight(first_day), below=_midnight(last_day) + dt.timedelta(days=1)
    )


def payers_of_day(
    purchases: DataFrame, day: dt.date | str, excluded: Excluded, partition_date: str | None = None
) -> DataFrame:
    """The distinct users who bought that day."""
    day_rows = on_day(purchases, day, partition_date)
    return without_users(day_rows, excluded).select("user_id").distinct()


def limited(df: DataFrame, n: int) -> DataFrame:
    """Hint a frame already cut to ``n`` rows for broadcast when that bound is small."""
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def big(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("bigint")


def descending(name: str) -> Column:
    """Sort value that puts the largest number first and NULL last under ``min``."""
    return F.coalesce(-F.col(name).cast("double"), F.lit(float("inf")))


def folded(rows: DataFrame, keys: Sequence[str]) -> GroupedData:
    """All rows as one group, or a group for each value of the keys."""
    return rows.groupBy(*keys)


def side_by_side(*frames: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row out of several frames of at most one row each; with ``keys`` one for each of their values.

    The frames are stacked, with NULL where a column is not theirs, and folded by ``max``;
    an empty frame leaves NULLs. No join is needed to line them up.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return folded(stacked, keys).agg(*[F.max(name).alias(name) for name in stacked.columns if name not in keys])
