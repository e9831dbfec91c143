"""Box opens of the day's payers.

All three reports read one rollup per (user, box, volatility). Rows are combined before any
shuffle, so a user or a box with a third of the opens arrives as a handful of partial rows, and
the payers meet the rollup after a stage boundary: adaptive execution then knows both sizes and
broadcasts the payers only when they really are small.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom import params
from tallyroom.functions import mean2, round2, whole_pct
from tallyroom.operators.common import (
    Excluded,
    big,
    descending,
    folded,
    limited,
    on_day,
    payers_of_day,
    side_by_side,
    without_users,
)

Day = dt.date | str

# A box price is a ratio; it is kept in whole units of its twelfth digit until the mean is rounded.
PRICE_SCALE = 12


def payer_box_activity(
    box_events: DataFrame,
    purchases: DataFrame,
    report_date: Day,
    excluded: Excluded = (),
    partition_date: str | None = None,
) -> DataFrame:
    """Opens, coins and price parts per payer, box and volatility: one row each."""
    events = without_users(on_day(box_events, report_date, partition_date), excluded)
    return payer_boxes(events, payers_of_day(purchases, report_date, excluded, partition_date))


def payer_boxes(events: DataFrame, payers: DataFrame, *keys: str) -> DataFrame:
    """The rollup of the payers' rows, per ``keys`` as well."""
    units = F.col("total_coins_spent").cast("decimal(18,2)") * F.lit(Decimal(10**PRICE_SCALE))
    price = F.round(units / F.nullif("boxes_opened_count", F.lit(0)), 0).cast("decimal(38,0)")
    per_user = events.groupBy(*keys, "user_id", "box_display_name", "box_volatility").agg(
        F.sum("boxes_opened_count").alias("opens"),
        F.sum("total_coins_spent").alias("coins"),
        F.sum(price).alias("price_sum"),
        F.count(price).alias("price_rows"),
    )
    return per_user.join(payers, [*keys, "user_id"], "left_semi")


def prices_by(activity: DataFrame, *keys: str) -> DataFrame:
    """Opens, openers and price per box, and per ``keys``; the price is the plain mean of coins per opened box."""
    return activity.groupBy(*keys, "box_display_name", "box_volatility").agg(
        F.sum("opens").alias("total_opens"),
        F.count("*").alias("unique_openers"),
        mean2(F.sum("price_sum"), F.sum("price_rows"), PRICE_SCALE).alias("box_price_coins"),
    )


def openers_by(activity: DataFrame, *keys: str) -> DataFrame:
    """Opens, boxes and coins per payer, and per ``keys``."""
    return activity.groupBy(*keys, "user_id").agg(
        F.sum("opens").alias("total_boxes_opened"),
        F.count_distinct("box_display_name").alias("distinct_boxes"),
        F.round(F.sum("coins"), 0).cast("double").alias("total_coins_spent"),
    )


def top_boxes_of(activity: DataFrame, n: int = params.TOP_BOXES) -> DataFrame:
    """Most opened boxes of a rollup."""
    return (
        prices_by(activity)
        .orderBy(F.desc("total_opens"), "box_display_name", "box_volatility")
        .limit(n)
    )


def top_openers_of(activity: DataFrame, n: int = params.TOP_OPENERS) -> DataFrame:
    """Payers of a rollup who opened most."""
    return openers_by(activity).orderBy(F.desc("total_boxes_opened"), "user_id").limit(n)


def top_box_opener_rows(activity: DataFrame) -> DataFrame:
    """Who opened the first box of ``top_boxes_of``, over all its volatilities, in no order."""
    return openers_of(activity, limited(top_boxes_of(activity, 1), 1))


def openers_of(activity: DataFrame, leaders: DataFrame, *keys: str) -> DataFrame:
    """Who opened the leading box, which must have a name, per ``keys``."""
    named = leaders.filter(F.col("box_display_name") != "").select(*keys, "box_display_name")
    return (
        activity.join(named, [*keys, "box_display_name"])
        .groupBy(*keys, "box_display_name", "user_id")
        .agg(
            F.sum("opens").alias("opens"),
            round2(F.sum("coins")).alias("coins_spent"),
        )
    )


def opener_order(openers: DataFrame) -> DataFrame:
    """Most opens first."""
    return openers.orderBy(F.desc("opens"), "user_id")


def top_boxes(
    box_events: DataFrame,
    purchases: DataFrame,
    report_date: Day,
    excluded: Excluded = (),
    n: int = params.TOP_BOXES,
    partition_date: str | None = None,
) -> DataFrame:
    """The day's n most opened (box, volatility) pairs among payers."""
    return top_boxes_of(payer_box_activity(box_events, purchases, report_date, excluded, partition_date), n)


def top_openers(
    box_events: DataFrame,
    purchases: DataFrame,
    report_date: Day,
    excluded: Excluded = (),
    n: int = params.TOP_OPENERS,
    partition_date: str | None = None,
) -> DataFrame:
    """The day's n payers with most opens."""
    return top_openers_of(payer_box_activity(box_events, purchases, report_date, excluded, partition_date), n)


def top_box_openers(
    box_events: DataFrame,
    purchases: DataFrame,
    report_date: Day,
    excluded: Excluded = (),
    partition_date: str | None = None,
) -> DataFrame:
    """All payers who opened the day's top box."""
    activity = payer_box_activity(box_events, purchases, report_date, excluded, partition_date)
    return opener_order(top_box_opener_rows(activity))


def box_mix(boxes: DataFrame, openers: DataFrame) -> DataFrame:
    """Concentration and volatility mix over the listed boxes (one row)."""
    return mix_by(boxes, openers)


def mix_by(boxes: DataFrame, openers: DataFrame, *keys: str, every: Sequence[DataFrame] = ()) -> DataFrame:
    """The mix per ``keys``; ``every`` frames name values of the keys that get a row in any case."""
    opens = F.col("total_opens")
    risky = F.when(F.col("box_volatility") >= params.HIGH_VOLATILITY, opens).otherwise(0)
    listed = folded(boxes, keys).agg(
        F.sum(opens).alias("total_opens_all"),
        F.min(
            F.struct(descending("total_opens"), "box_display_name", "box_volatility", opens)
        ).alias("top"),
        F.sum(F.col("box_volatility") * opens).alias("volatility_opens"),
        F.sum(risky).alias("high_vol_opens"),
    ).select(
        *keys,
        "total_opens_all",
        F.col("top.total_opens").alias("top_box_opens"),
        "volatility_opens",
        "high_vol_opens",
    )
    first_user = folded(openers, keys).agg(
        F.min(F.struct(descending("opens"), "user_id", "opens")).alias("top")
    ).select(*keys, F.col("top.opens").alias("top_user_opens"))
    row = side_by_side(listed, first_user, *every, keys=keys)
    total = F.col("total_opens_all")
    zero = big(F.lit(0))
    return row.select(
        *keys,
        F.coalesce(total, zero).alias("total_opens_all"),
        F.coalesce("top_box_opens", zero).alias("top_box_opens"),
        whole_pct(F.col("top_box_opens"), total).alias("top_box_pct"),
        F.coalesce("top_user_opens", zero).alias("top_user_opens"),
        whole_pct(F.col("top_user_opens"), F.col("top_box_opens")).alias("top_user_pct"),
        F.coalesce(F.col("volatility_opens") / F.nullif(total, zero), F.lit(0.0)).alias(
            "weighted_vol"
        ),
        F.coalesce("high_vol_opens", zero).alias("high_vol_opens"),
        whole_pct(F.col("high_vol_opens"), total).alias("high_vol_pct"),
    )
