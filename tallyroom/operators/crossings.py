"""Users whose latest purchase lifted them over a spend tier, with that tier and purchases."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom import params
from tallyroom.functions import clock_text, round2, within
from tallyroom.functions.time import utc_time
from tallyroom.operators.common import before, big

AsOf = dt.datetime | str


def vendor_cost_by_user(vendor_pricing: DataFrame) -> DataFrame:
    """Price plus fee over all pricing rows of a user; a row lacking either side adds nothing."""
    return vendor_pricing.groupBy("user_id").agg(
        round2(F.sum(F.col("vendor_price") + F.col("vendor_fee"))).alias("total_vendor_cost")
    )


def _crossed(threshold: float) -> Column:
    spent = F.col("lifetime_purchases_usd")
    return (spent >= threshold) & (spent - F.col("last_purchase_amount_usd") < threshold)


def newly_crossed(
    user_crm: DataFrame,
    internal_users: DataFrame,
    as_of: AsOf,
    tiers: Sequence[tuple[float, str]] = params.TIERS,
) -> DataFrame:
    """Outside users whose purchase of the past 24 h crossed a tier, with the highest one.

    A purchase after ``as_of`` belongs to a later report and does not count.
    """
    ranked = params.ordered_tiers(tiers)
    now = utc_time(as_of)
    since = now - dt.timedelta(hours=params.CROSSING_WINDOW_HOURS)
    label = reduce(
        lambda case, tier: case.when(_crossed(tier.threshold), tier.label),
        ranked[1:],
        F.when(_crossed(ranked[0].threshold), ranked[0].label),
    )
    return (
        within(user_crm, "last_purchase_at", since=since, upto=now)
        .filter(reduce(or_, [_crossed(tier.threshold) for tier in ranked]))
        .join(internal_users.select("user_id"), "user_id", "left_anti")
        .select(
            "user_id",
            F.col("lifetime_purchases_usd").cast("double").alias("ltv_usd"),
            label.alias("tier_crossed"),
        )
    )


def priced_rows(crossed: DataFrame, vendor_costs: DataFrame) -> DataFrame:
    """Net spend of the crossing users; the flag tells who has no pricing row at all."""
    costs = vendor_costs.withColumn("priced", F.lit(True))
    cost = F.coalesce("total_vendor_cost", F.lit(0.0))
    return crossed.join(costs, "user_id", "left").select(
        "user_id",
        "ltv_usd",
        round2(F.col("ltv_usd") - cost).alias("net_spend_usd"),
        F.col("priced").isNull().alias("no_vendor_pricing"),
        "tier_crossed",
    )


def crossing_order(crossings: DataFrame) -> DataFrame:
    """Highest lifetime value first."""
    return crossings.orderBy(F.desc("ltv_usd"), "user_id")


def tier_crossings(
    user_crm: DataFrame,
    vendor_pricing: DataFrame,
    internal_users: DataFrame,
    as_of: AsOf,
    tiers: Sequence[tuple[float, str]] = params.TIERS,
) -> DataFrame:
    """Crossing users of the past 24 h with their net spend, highest lifetime value first."""
    crossed = newly_crossed(user_crm, internal_users, as_of, tiers)
    return crossing_order(priced_rows(crossed, vendor_cost_by_user(vendor_pricing)))


def last_purchase_rows(
    crossings: DataFrame,
    purchases: DataFrame,
    as_of: AsOf,
    n: int = params.ENTRANT_PURCHASES,
    partition_date: str | None = None,
) -> DataFrame:
    """The newest n purchases of each crossing user before ``as_of``, in no order.

    The ranking comes before the join: it keeps n rows per user already ahead of its shuffle,
    so no user's whole history travels, and the join then finds its partitioning in place.
    """
    newest = Window.partitionBy("user_id").orderBy(
        F.desc("event_timestamp"), F.desc("event_id"), F.desc("amount_usd"), F.desc("product_slug")
    )
    return (
        before(purchases, utc_time(as_of), partition_date)
        .filter(F.col("user_id").isNotNull())
        .select(
            "user_id",
            "event_timestamp",
            F.col("amount_usd").cast("double").alias("amount_usd"),
            "product_slug",
            F.row_number().over(newest).alias("rn"),
        )
        .filter(F.col("rn") <= n)
        .withColumn("rn", big("rn"))
        .join(crossings.select("user_id"), "user_id", "left_semi")
    )


def entrant_last_purchases(
    crossings: DataFrame,
    purchases: DataFrame,
    as_of: AsOf,
    n: int = params.ENTRANT_PURCHASES,
    partition_date: str | None = None,
) -> DataFrame:
    """The newest n purchases of each crossing user, newest first within a user."""
    return last_purchase_rows(crossings, purchases, as_of, n, partition_date).orderBy("user_id", "rn")


def entrant_feed(
    crossings: DataFrame,
    last_purchases: DataFrame,
    offset_hours: int = params.DISPLAY_OFFSET_HOURS,
) -> DataFrame:
    """Crossing users with their latest purchases as an array, newest first."""
    shown = F.struct(
        "rn",
        clock_text(F.col("event_timestamp"), offset_hours).alias("local_time"),
        "amount_usd",
        F.coalesce(F.nullif("product_slug", F.lit("")), F.lit("—")).alias("product_slug"),
    )
    # Bounded: the ranking left a fixed number of purchases per user.
    lists = last_purchases.groupBy("user_id").agg(
        F.sort_array(F.collect_list(shown)).alias("purchases")
    )
    return crossing_order(
        crossings.join(lists, "user_id", "left").select(
            *crossings.columns,
            "purchases",
            big(F.coalesce(F.size("purchases"), F.lit(0))).alias("purchase_count"),
        )
    )
