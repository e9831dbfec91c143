"""Purchases and logins of one UTC day: totals, products, spenders, payer cohort, KPIs.

``partition_date`` names the column of each row's UTC day where the tables are laid out by one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom import params
from tallyroom.functions import cents, date_literal, mean2, product_label, round2, whole_pct
from tallyroom.operators.common import (
    Excluded,
    big,
    limited,
    on_day,
    side_by_side,
    up_to_day,
    without_users,
)

Day = dt.date | str


def daily_active_users(
    logins: DataFrame,
    report_date: Day,
    excluded: Excluded = (),
    partition_date: str | None = None,
) -> DataFrame:
    """Distinct users who logged in that day (one row)."""
    day = without_users(on_day(logins, report_date, partition_date), excluded)
    return day.agg(F.count_distinct("user_id").alias("daily_active_users"))


def purchase_summary(
    purchases: DataFrame,
    report_date: Day,
    excluded: Excluded = (),
    partition_date: str | None = None,
) -> DataFrame:
    """Totals of the day (one row; the sums are NULL on a day without purchases)."""
    day = without_users(on_day(purchases, report_date, partition_date), excluded)
    return day.agg(
        F.count_distinct("user_id").alias("total_payers"),
        F.count("*").alias("total_transactions"),
        round2(F.sum("amount_usd")).alias("total_revenue_usd"),
        mean2(cents(F.sum("amount_usd")), F.count("amount_usd")).alias("avg_transaction_usd"),
        F.count("coupon_code").alias("transactions_with_coupon"),
    )


def revenue_by_product(
    purchases: DataFrame,
    report_date: Day,
    excluded: Excluded = (),
    partition_date: str | None = None,
) -> DataFrame:
    """Payers, transactions and revenue per product, highest revenue first."""
    day = without_users(on_day(purchases, report_date, partition_date), excluded)
    return (
        day.groupBy("product_slug")
        .agg(
            F.count_distinct("user_id").alias("payers"),
            F.count("*").alias("transactions"),
            round2(F.sum("amount_usd")).alias("revenue_usd"),
            mean2(cents(F.sum("amount_usd")), F.count("amount_usd")).alias("avg_usd"),
        )
        .select(
            "product_slug",
            product_label(F.col("product_slug")).alias("product_label"),
            "payers",
            "transactions",
            "revenue_usd",
            "avg_usd",
        )
        .orderBy(F.desc("revenue_usd"), "product_slug")
    )


def top_spenders(
    purchases: DataFrame,
    report_date: Day,
    excluded: Excluded = (),
    n: int = params.TOP_SPENDERS,
    partition_date: str | None = None,
) -> DataFrame:
    """The day's n highest spenders with the products they bought, in time order.

    Only the leaders' purchases are listed. Their lists are put together per minute first, so
    even a user with a large share of the day's rows is sorted in up to 1,440 parts.
    """
    day = without_users(on_day(purchases, report_date, partition_date), excluded)
    leaders = (
        day.groupBy("user_id")
        .agg(
            F.count("*").alias("transactions"),
            round2(F.sum("amount_usd")).alias("total_spend_usd"),
        )
        .orderBy(F.desc("total_spend_usd"), "user_id")
        .limit(n)
    )
    return with_products(day, limited(leaders, n)).orderBy(F.desc("total_spend_usd"), "user_id")


def with_products(rows: DataFrame, leaders: DataFrame, *keys: str) -> DataFrame:
    """The leaders, one row per user and ``keys``, with the products of their rows in time order."""
    keys = (*keys, "user_id")
    known = [*keys, "transactions", "total_spend_usd"]
    minute = F.hour("event_timestamp") * 60 + F.minute("event_timestamp")
    listed = (
        rows.select(*keys, "event_timestamp", "event_id", "product_slug")
        .join(leaders, list(keys))
        .groupBy(*known, minute.alias("minute"))
        .agg(
            F.expr(
                "listagg(product_slug, ', ') WITHIN GROUP "
                "(ORDER BY event_timestamp, event_id, product_slug)"
            ).alias("part")
        )
    )
    parts = F.expr("listagg(part, ', ') WITHIN GROUP (ORDER BY minute)")
    return listed.groupBy(*known).agg(parts.alias("products_bought"))


def cohort_rows(
    purchases: DataFrame,
    report_date: Day,
    excluded: Excluded = (),
    partition_date: str | None = None,
) -> DataFrame:
    """New or returning state and history of each of the day's payers, in no order.

    One pass over the history up to the day: conditional aggregates per user, then the users
    without a purchase on the day drop out. Rows are combined before the shuffle and no payer
    set is joined. Pass a history already narrowed to the payers where that set is small
    (``plans.daily_report`` does).
    """
    day = date_literal(report_date)
    event_day = F.to_date("event_timestamp")
    history = without_users(up_to_day(purchases, report_date, partition_date), excluded)
    per_user = history.groupBy("user_id").agg(
        F.max(F.when(event_day < day, event_day)).alias("last_prior_purchase_date"),
        F.count_if(event_day == day).alias("today_purchases"),
        F.count("*").alias("lifetime_purchases"),
        round2(F.sum("amount_usd")).alias("lifetime_value_usd"),
        round2(F.sum(F.when(event_day == day, F.col("amount_usd")).otherwise(0))).alias(
            "today_revenue_usd"
        ),
    )
    return per_user.filter(F.col("today_purchases") > 0).select(
        "user_id",
        F.when(F.col("last_prior_purchase_date").isNull(), "new")
        .otherwise("return")
        .alias("payer_type"),
        "lifetime_purchases",
        "lifetime_value_usd",
        "today_revenue_usd",
        "last_prior_purchase_date",
        big(F.date_diff(day, "last_prior_purchase_date")).alias("days_since_last_purchase"),
    )


def cohort_order(cohort: DataFrame) -> DataFrame:
    """New payers first, each group by lifetime value."""
    return cohort.orderBy("payer_type", F.desc("lifetime_value_usd"), "user_id")


def payer_cohort(
    purchases: DataFrame,
    report_date: Day,
    excluded: Excluded = (),
    partition_date: str | None = None,
) -> DataFrame:
    """The day's payers with their state and history, ordered."""
    return cohort_order(cohort_rows(purchases, report_date, excluded, partition_date))


def returning_payers(cohort: DataFrame) -> DataFrame:
    """Returning part of the cohort, highest lifetime value first."""
    return (
        cohort.filter(F.col("payer_type") == "return")
        .select("user_id", "lifetime_value_usd", "lifetime_purchases", "days_since_last_purchase")
        .orderBy(F.desc("lifetime_value_usd"), "user_id")
    )


def new_and_returning() -> list[Column]:
    """Payers and revenue of the two halves of a cohort, as aggregates."""
    is_new = F.col("payer_type") == "new"
    # Two-digit doubles go back to decimals: the sum must not depend on the order of the rows.
    today = F.col("today_revenue_usd").cast("decimal(18,2)")
    return [
        F.count_if(is_new).alias("new_count"),
        F.count_if(~is_new).alias("ret_count"),
        F.sum(F.when(is_new, today)).cast("double").alias("new_rev"),
        F.sum(F.when(~is_new, today)).cast("double").alias("ret_rev"),
    ]


def cohort_kpis(active: DataFrame, summary: DataFrame, cohort: DataFrame) -> DataFrame:
    """KPIs of the day in one row; every zero denominator and missing sum gives 0."""
    return kpi_columns(side_by_side(active, summary, cohort.agg(*new_and_returning())))


def kpi_columns(row: DataFrame, *keys: str) -> DataFrame:
    """The KPIs of rows that hold active users, totals and both halves of the cohort."""
    row = row.select(
        *keys,
        F.col("daily_active_users").alias("dau"),
        "total_payers",
        "total_transactions",
        *[
            F.coalesce(F.col(name), F.lit(0.0)).alias(name)
            for name in ("total_revenue_usd", "avg_transaction_usd")
        ],
        "transactions_with_coupon",
        "new_count",
        "ret_count",
        F.coalesce("new_rev", F.lit(0.0)).alias("new_rev"),
        F.coalesce("ret_rev", F.lit(0.0)).alias("ret_rev"),
        whole_pct(F.col("new_count"), F.col("total_payers")).alias("pct_new"),
    )

    def per_head(total: str, heads: str):
        return F.coalesce(F.col(total) / F.nullif(F.col(heads), F.lit(0)), F.lit(0.0))

    return row.select(
        "*",
        (100 - F.col("pct_new")).alias("pct_ret"),
        per_head("new_rev", "new_count").alias("new_avg"),
        per_head("ret_rev", "ret_count").alias("ret_avg"),
        whole_pct(F.col("new_rev"), F.col("total_revenue_usd")).alias("new_rev_pct"),
        whole_pct(F.col("ret_rev"), F.col("total_revenue_usd")).alias("ret_rev_pct"),
        per_head("total_revenue_usd", "total_payers").alias("arppu"),
    )
