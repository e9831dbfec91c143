"""The payer cohort from a kept state instead of the whole history.

The state has one row per user: purchases, their value, and the last day of one, up to a day. A day
needs the state of the day before and the rows that have arrived since, which may be late: rows of
earlier days are history that was not known yet. Rows of later days wait, and have to be given again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.functions import date_literal, round2
from tallyroom.operators.common import Excluded, big, up_to_day, without_users

Day = dt.date | str
STATE = "user_id string, purchases bigint, value decimal(28,2), last_purchase_date date"


def _per_user(purchases: DataFrame, through: Day, excluded: Excluded, partition_date: str | None) -> DataFrame:
    rows = without_users(up_to_day(purchases, through, partition_date), excluded)
    return rows.groupBy("user_id").agg(
        F.count("*").alias("purchases"),
        F.sum("amount_usd").cast("decimal(28,2)").alias("value"),
        F.max(F.to_date("event_timestamp")).alias("last_purchase_date"),
    )


def payer_state(
    purchases: DataFrame, through: Day, excluded: Excluded = (), partition_date: str | None = None
) -> DataFrame:
    """The state after a day, from the whole history."""
    return _per_user(purchases, through, excluded, partition_date)


def advanced_state(
    state: DataFrame, arrivals: DataFrame, through: Day, excluded: Excluded = (), partition_date: str | None = None
) -> DataFrame:
    """The state with the arrived rows up to a day; arrivals are combined per user before they travel."""
    both = state.unionByName(_per_user(arrivals, through, excluded, partition_date))
    return both.groupBy("user_id").agg(
        F.sum("purchases").alias("purchases"),
        F.sum("value").cast("decimal(28,2)").alias("value"),
        F.max("last_purchase_date").alias("last_purchase_date"),
    )


def payers_of_arrivals(
    arrivals: DataFrame, report_date: Day, excluded: Excluded = (), partition_date: str | None = None
) -> DataFrame:
    """The day's payers, with what has arrived of them that day and late."""
    day = date_literal(report_date)
    event_day = F.to_date("event_timestamp")
    rows = without_users(up_to_day(arrivals, report_date, partition_date), excluded)
    per_user = rows.groupBy("user_id").agg(
        F.count("*").alias("purchases"),
        F.sum("amount_usd").cast("decimal(28,2)").alias("value"),
        F.max(F.when(event_day < day, event_day)).alias("last_purchase_date"),
        F.count_if(event_day == day).alias("today_purchases"),
        F.sum(F.when(event_day == day, F.col("amount_usd")).otherwise(0)).cast("decimal(28,2)").alias("today_value"),
    )
    return per_user.filter("today_purchases > 0")


def cohort_from_state(state: DataFrame, payers: DataFrame, report_date: Day) -> DataFrame:
    """The rows of ``daily.cohort_rows`` from the state before the day and ``payers_of_arrivals``."""
    known = state.select(
        "user_id",
        F.col("purchases").alias("s_purchases"),
        F.col("value").alias("s_value"),
        F.col("last_purchase_date").alias("s_last"),
    )
    rows = payers.join(known, "user_id", "left")
    last = F.greatest("s_last", "last_purchase_date")  # nulls do not count
    nothing = F.lit(0).cast("decimal(28,2)")
    value = F.coalesce(F.col("s_value") + F.col("value"), "s_value", "value")
    today = F.when(F.col("s_purchases") > 0, F.coalesce("today_value", nothing)).otherwise(F.col("today_value"))
    return rows.select(
        "user_id",
        F.when(last.isNull(), "new").otherwise("return").alias("payer_type"),
        (F.coalesce("s_purchases", F.lit(0)) + F.col("purchases")).alias("lifetime_purchases"),
        round2(value).alias("lifetime_value_usd"),
        round2(today).alias("today_revenue_usd"),
        last.alias("last_prior_purchase_date"),
        big(F.date_diff(date_literal(report_date), last)).alias("days_since_last_purchase"),
    )
