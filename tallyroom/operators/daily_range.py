"""The daily reports for every day of a range at once.

Each operator gives, beside ``report_date``, the columns of its namesake for one day, and for each day
the same rows. The tables are read once for the whole range. A payer's history is a running sum over
the days on which the payer bought: one row per payer and day, and everything before the range is one
row per payer, so the windows hold at most as many rows of a payer as the range has days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyroom import params
from tallyroom.functions import cents, date_literal, day_of, mean2, product_label, round2
from tallyroom.operators.boxes import mix_by, openers_by, openers_of, payer_boxes, prices_by
from tallyroom.operators.common import Excluded, big, in_days, limited, up_to_day, without_users
from tallyroom.operators.daily import kpi_columns, new_and_returning, with_products
from tallyroom.operators.observations import observation_figures, ranked_observations

Day = dt.date | str
_DAY_OF_EVENT = "to_date(event_timestamp)"


def days_between(spark: SparkSession, first_day: Day, last_day: Day) -> DataFrame:
    """``report_date``: every day of the range."""
    first, last = day_of(first_day), day_of(last_day)
    if last < first:
        raise ValueError(f"the range ends on {last}, before it begins on {first}")
    days = spark.range((last - first).days + 1)
    return days.select(F.date_add(date_literal(first), F.col("id").cast("int")).alias("report_date"))


def _dated(rows: DataFrame, first_day: Day, last_day: Day, excluded: Excluded, partition_date: str | None) -> DataFrame:
    rows = without_users(in_days(rows, first_day, last_day, partition_date), excluded)
    return rows.withColumn("report_date", F.expr(_DAY_OF_EVENT))


def _every_day(found: DataFrame, first_day: Day, last_day: Day, counts: tuple[str, ...]) -> DataFrame:
    """A row for days without rows as well, their counts 0. There is one row per day on both sides."""
    days = days_between(found.sparkSession, first_day, last_day)
    return days.join(found, "report_date", "left").fillna(0, list(counts))


def daily_active_users_range(
    logins: DataFrame, first_day: Day, last_day: Day, excluded: Excluded = (), partition_date: str | None = None
) -> DataFrame:
    found = (
        _dated(logins, first_day, last_day, excluded, partition_date)
        .groupBy("report_date")
        .agg(F.count_distinct("user_id").alias("daily_active_users"))
    )
    return _every_day(found, first_day, last_day, ("daily_active_users",)).orderBy("report_date")


def purchase_summary_range(
    purchases: DataFrame, first_day: Day, last_day: Day, excluded: Excluded = (), partition_date: str | None = None
) -> DataFrame:
    found = (
        _dated(purchases, first_day, last_day, excluded, partition_date)
        .groupBy("report_date")
        .agg(
            F.count_distinct("user_id").alias("total_payers"),
            F.count("*").alias("total_transactions"),
            round2(F.sum("amount_usd")).alias("total_revenue_usd"),
            mean2(cents(F.sum("amount_usd")), F.count("amount_usd")).alias("avg_transaction_usd"),
            F.count("coupon_code").alias("transactions_with_coupon"),
        )
    )
    counts = ("total_payers", "total_transactions", "transactions_with_coupon")
    return _every_day(found, first_day, last_day, counts).orderBy("report_date")


def revenue_by_product_range(
    purchases: DataFrame, first_day: Day, last_day: Day, excluded: Excluded = (), partition_date: str | None = None
) -> DataFrame:
    return (
        _dated(purchases, first_day, last_day, excluded, partition_date)
        .groupBy("report_date", "product_slug")
        .agg(
            F.count_distinct("user_id").alias("payers"),
            F.count("*").alias("transactions"),
            round2(F.sum("amount_usd")).alias("revenue_usd"),
            mean2(cents(F.sum("amount_usd")), F.count("amount_usd")).alias("avg_usd"),
        )
        .withColumn("product_label", product_label(F.col("product_slug")))
        .select("report_date", "product_slug", "product_label", "payers", "transactions", "revenue_usd", "avg_usd")
        .orderBy("report_date", F.desc("revenue_usd"), "product_slug")
    )


def top_spenders_range(
    purchases: DataFrame,
    first_day: Day,
    last_day: Day,
    excluded: Excluded = (),
    n: int = params.TOP_SPENDERS,
    partition_date: str | None = None,
) -> DataFrame:
    """Every day's n highest spenders with the products they bought that day, in time order."""
    rows = _dated(purchases, first_day, last_day, excluded, partition_date)
    spent = rows.groupBy("report_date", "user_id").agg(
        F.count("*").alias("transactions"), round2(F.sum("amount_usd")).alias("total_spend_usd")
    )
    order = [F.desc("total_spend_usd"), F.asc("user_id")]
    leaders = _first_of_day(spent, order, n)
    days = (day_of(last_day) - day_of(first_day)).days + 1
    return with_products(rows, limited(leaders, n * days), "report_date").orderBy("report_date", *order)


def payer_cohort_range(
    purchases: DataFrame, first_day: Day, last_day: Day, excluded: Excluded = (), partition_date: str | None = None
) -> DataFrame:
    """New or returning state and history of each day's payers."""
    first = date_literal(first_day)
    history = without_users(up_to_day(purchases, last_day, partition_date), excluded)
    # All days before the range are one row, on no day of it.
    facts = (
        history.groupBy("user_id", F.when(F.expr(_DAY_OF_EVENT) >= first, F.expr(_DAY_OF_EVENT)).alias("report_date"))
        .agg(F.count("*").alias("n"), F.sum("amount_usd").alias("value"), F.max(F.expr(_DAY_OF_EVENT)).alias("latest"))
    )
    by_day = Window.partitionBy("user_id").orderBy(F.asc_nulls_first("report_date"))
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = facts.withColumns(
        {
            "last_prior_purchase_date": F.lag("latest").over(by_day),
            "lifetime_purchases": F.sum("n").over(upto),
            "lifetime_value_usd": round2(F.sum("value").over(upto)),
        }
    ).filter(F.col("report_date").isNotNull())
    is_new = F.col("last_prior_purchase_date").isNull()
    # The sum of one day of a longer history counts the other days as 0.
    today = F.when(is_new, F.col("value")).otherwise(F.coalesce("value", F.lit(0)))
    return running.select(
        "report_date",
        "user_id",
        F.when(is_new, "new").otherwise("return").alias("payer_type"),
        "lifetime_purchases",
        "lifetime_value_usd",
        round2(today).alias("today_revenue_usd"),
        "last_prior_purchase_date",
        big(F.date_diff("report_date", "last_prior_purchase_date")).alias("days_since_last_purchase"),
    ).orderBy("report_date", "payer_type", F.desc("lifetime_value_usd"), "user_id")


def returning_payers_range(cohort: DataFrame) -> DataFrame:
    """Returning part of every day's cohort, highest lifetime value first."""
    return (
        cohort.filter(F.col("payer_type") == "return")
        .select("report_date", "user_id", "lifetime_value_usd", "lifetime_purchases", "days_since_last_purchase")
        .orderBy("report_date", F.desc("lifetime_value_usd"), "user_id")
    )


def cohort_kpis_range(active: DataFrame, summary: DataFrame, cohort: DataFrame) -> DataFrame:
    """KPIs of every day from the three range results; one row per day, those without payers included."""
    split = cohort.groupBy("report_date").agg(*new_and_returning())
    rows = active.join(summary, "report_date", "full").join(split, "report_date", "full")
    counts = ["daily_active_users", "total_payers", "total_transactions", "transactions_with_coupon", "new_count", "ret_count"]
    return kpi_columns(rows.fillna(0, counts), "report_date").orderBy("report_date")


def _first_of_day(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The ``n`` first rows of each day; each task keeps no more of a day ahead of the shuffle."""
    place = F.row_number().over(Window.partitionBy("report_date").orderBy(*order))
    return rows.withColumn("place", place).filter(F.col("place") <= n).drop("place")


def payer_box_activity_range(
    box_events: DataFrame,
    purchases: DataFrame,
    first_day: Day,
    last_day: Day,
    excluded: Excluded = (),
    partition_date: str | None = None,
) -> DataFrame:
    """The rollup that the box reports read, of every day's payers."""
    events = _dated(box_events, first_day, last_day, excluded, partition_date)
    payers = _dated(purchases, first_day, last_day, excluded, partition_date).select("report_date", "user_id").distinct()
    return payer_boxes(events, payers, "report_date")


def top_boxes_range(activity: DataFrame, n: int = params.TOP_BOXES) -> DataFrame:
    """Most opened boxes of every day."""
    order = [F.desc("total_opens"), F.asc("box_display_name"), F.asc("box_volatility")]
    return _first_of_day(prices_by(activity, "report_date"), order, n).orderBy("report_date", *order)


def top_openers_range(activity: DataFrame, n: int = params.TOP_OPENERS) -> DataFrame:
    """The payers who opened most, every day."""
    order = [F.desc("total_boxes_opened"), F.asc("user_id")]
    return _first_of_day(openers_by(activity, "report_date"), order, n).orderBy("report_date", *order)


def top_box_openers_range(activity: DataFrame) -> DataFrame:
    """All payers who opened their day's top box."""
    openers = openers_of(activity, top_boxes_range(activity, 1), "report_date")
    return openers.orderBy("report_date", F.desc("opens"), "user_id")


def box_mix_range(boxes: DataFrame, openers: DataFrame, first_day: Day, last_day: Day) -> DataFrame:
    """Concentration and volatility mix of every day's listed boxes; days without boxes have a row of zeros."""
    days = days_between(boxes.sparkSession, first_day, last_day)
    return mix_by(boxes, openers, "report_date", every=[days]).orderBy("report_date")


def observations_range(
    products: DataFrame,
    boxes: DataFrame,
    spenders: DataFrame,
    openers: DataFrame,
    kpis: DataFrame,
    returning: DataFrame,
    mix: DataFrame,
    n: int = params.TOP_OBSERVATIONS,
) -> DataFrame:
    """Every day's n observations of highest priority, from the range results."""
    figures = observation_figures(products, boxes, spenders, openers, kpis, returning, mix)
    return ranked_observations(figures, n, keep=["report_date"]).orderBy("report_date", "rank")
