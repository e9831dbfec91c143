"""Exact distinct counts of users that add up over days and products.

A count of distinct users cannot be summed, the sets behind it can be united. Users have numbers, and
a set is stored as bitmaps of 32,768 numbers each: a day costs one row per block of users and key,
whatever its events, and a week or month is the union of its days' rows; the events are not read again.

Numbers are given once and stay. They run on within each task that gave them, so blocks are filled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUMBERS = "user_id string, number bigint"
# Numbers of one call of ``numbered_users`` begin at a multiple of this, beyond all earlier ones.
RUN = 1 << 33


def numbered_users(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Numbers for the distinct users that ``known`` (``user_id, number``) does not have.

    Write the result beside ``known`` before it is used: numbers of an unwritten frame may differ
    from one evaluation to the next.
    """
    fresh = users.select("user_id").filter(F.col("user_id").isNotNull()).distinct()
    start = 0
    if known is not None:
        fresh = fresh.join(known, "user_id", "left_anti")
        highest = known.agg(F.max("number")).first()[0]
        start = 0 if highest is None else (highest // RUN + 1) * RUN
    return fresh.select("user_id", (F.monotonically_increasing_id() + F.lit(start)).alias("number"))


def user_bitmaps(rows: DataFrame, numbers: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, block, users``: the sets of users of every key as bitmaps.

    Rows are combined per user and key before they meet the numbers.
    """
    seen = rows.select(*keys, "user_id").distinct().join(numbers, "user_id")
    return seen.groupBy(*keys, F.bitmap_bucket_number("number").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")
    )


def united_counts(bitmaps: DataFrame, keys: list, name: str) -> DataFrame:
    """Distinct users per ``keys``, which may be coarser than the keys of the bitmaps."""
    united = bitmaps.groupBy(*keys, "block").agg(F.bitmap_or_agg("users").alias("users"))
    names = [column for column in united.columns if column not in ("block", "users")]
    return united.groupBy(*names).agg(F.sum(F.bitmap_count("users")).alias(name))
