"""The loyalty roster: figures per user, merge with hand-kept notes, heat scores, summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom import params
from tallyroom.functions import cents, date_literal, mean2, py_round1, stripped, utc_wall
from tallyroom.sources.cells import KEPT_COLUMNS, cell, last_rows, row_order
from tallyroom.sources.schemas import NOTE_COLUMNS, ROSTER_COLUMNS




def latest_vendor_pricing(vendor_pricing: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Newest pricing row per order.

    Rows of one instant are told apart by the ``tie_break`` columns, descending, and in the end
    by price and fee themselves, so the result never depends on the order of the rows. One row
    per order is left ahead of the shuffle.
    """
    order = ["event_timestamp", *tie_break, "vendor_price", "vendor_fee"]
    newest = Window.partitionBy("order_id").orderBy(*map(F.desc, order))
    return (
        vendor_pricing.withColumn("rn", F.row_number().over(newest))
        .filter(F.col("rn") == 1)
        .select("order_id", "vendor_price", "vendor_fee")
    )


def stored_procurement_cost(
    orders_created: DataFrame, vendor_pricing: DataFrame, hot_orders: list, tie_break: Sequence[str] = ()
) -> DataFrame:
    """``procurement_cost_by_user`` over tables stored in buckets of the order id (``sources.buckets``).

    Newest price, events per order and user, and their join all find the rows of an order in one
    bucket: nothing is shuffled until costs are summed per user. ``hot_orders`` are the few orders
    with more rows than an average bucket; their events, which ``orders_created`` should give from a
    reading that splits files, meet their prices in a broadcast.
    """
    cost = F.coalesce("vendor_price", F.lit(0)) + F.coalesce("vendor_fee", F.lit(0))
    hot = F.coalesce(F.col("order_id").isin(*hot_orders), F.lit(False)) if hot_orders else F.lit(False)
    latest = latest_vendor_pricing(vendor_pricing.filter(F.col("order_id").isNotNull()), tie_break)
    events = F.count("*").cast("decimal(18,0)").alias("events")
    per_order = orders_created.filter(F.col("order_id").isNotNull() & ~hot).groupBy("order_id", "user_id").agg(events)
    parts = [per_order.join(latest.filter(~hot), "order_id", "left")]
    if hot_orders:
        of_hot = orders_created.filter(hot).groupBy("order_id", "user_id").agg(events)
        parts.append(of_hot.join(F.broadcast(latest.filter(hot)), "order_id", "left"))
    rows = [part.select("user_id", (cost * F.col("events")).alias("cost")) for part in parts]
    rows.append(orders_created.filter(F.col("order_id").isNull()).select("user_id", F.lit(0).alias("cost")))
    return (
        reduce(DataFrame.unionByName, rows)
        .groupBy("user_id")
        .agg(F.sum("cost").cast("double").alias("total_procurement_cost"))
    )


def procurement_cost_by_user(
    orders_created: DataFrame, latest_pricing: DataFrame, users: DataFrame | None = None
) -> DataFrame:
    """Latest price and fee over a user's orders, each counted as 0 where it is missing.

    With ``users`` only their orders meet the prices; others are left out.

    Repeated events of one order by one user are counted before the join, so an order id that
    holds a large share of all rows reaches it as one row per user. Events without an order id
    cannot match and go around the join instead of piling up in one of its partitions.
    """
    cost = F.coalesce("vendor_price", F.lit(0)) + F.coalesce("vendor_fee", F.lit(0))
    ordered = F.col("order_id").isNotNull()
    events = (
        orders_created.filter(ordered)
        .groupBy("order_id", "user_id")
        .agg(F.count("*").cast("decimal(18,0)").alias("events"))
    )
    if users is not None:
        events = events.join(users.select("user_id"), "user_id", "left_semi")
    # The second key says nothing new, but with it the prices are shuffled for this join alone, and
    # adaptive execution may then split an order id that very many users share.
    again = F.xxhash64("order_id").alias("again")
    priced = (
        events.select("*", again)
        .join(latest_pricing.select("*", again), ["order_id", "again"], "left")
        .select("user_id", (cost * F.col("events")).alias("cost"))
    )
    unpriced = orders_created.filter(~ordered).select("user_id", F.lit(0).alias("cost"))
    return (
        priced.unionByName(unpriced)
        .groupBy("user_id")
        .agg(F.sum("cost").cast("double").alias("total_procurement_cost"))
    )


def vip_users(
    user_crm: DataFrame,
    internal_users: DataFrame,
    tiers: Sequence[tuple[float, str]] = params.TIERS,
) -> DataFrame:
    """Rows of the outside users at or above the lowest tier."""
    lowest = params.ordered_tiers(tiers)[-1]
    return user_crm.filter(F.col("lifetime_purchases_usd") >= lowest.threshold).join(
        internal_users.select("user_id"), "user_id", "left_anti"
    )


def vip_roster(
    user_crm: DataFrame,
    procurement_costs: DataFrame,
    internal_users: DataFrame,
    tiers: Sequence[tuple[float, str]] = params.TIERS,
) -> DataFrame:
    """The VIP users' tier and figures, highest value first."""
    return roster_rows(vip_users(user_crm, internal_users, tiers), procurement_costs, tiers)


def roster_rows(
    vips: DataFrame,
    procurement_costs: DataFrame,
    tiers: Sequence[tuple[float, str]] = params.TIERS,
) -> DataFrame:
    """Tier and figures of users already picked by ``vip_users``, highest value first."""
    ranked = params.ordered_tiers(tiers)
    spent = F.col("lifetime_purchases_usd")
    tier = reduce(
        lambda case, t: case.when(spent >= t.threshold, t.label),
        ranked[1:],
        F.when(spent >= ranked[0].threshold, ranked[0].label),
    )
    cost = F.coalesce("total_procurement_cost", F.lit(0.0))
    return (
        vips.join(procurement_costs, "user_id", "left")
        .select(
            "user_id",
            tier.alias("tier"),
            spent.cast("double").alias("ltv_usd"),
            (spent.cast("double") - cost).alias("net_spend_usd"),
            F.to_date(utc_wall(vips, "last_purchase_at")).alias("last_purchase_date"),
            "days_since_last_purchase",
            "days_since_last_session",
            "lifecycle_state",
            "total_purchases",
            mean2(cents(spent), F.col("total_purchases")).alias("avg_transaction_usd"),
            "country",
            "favorite_box_category",
        )
        .orderBy(F.desc("ltv_usd"), "user_id")
    )


def merge_roster(
    roster: DataFrame, roster_prev: DataFrame, sheet_order: Sequence[str] = ("sheet_row",)
) -> DataFrame:
    """Fresh figures with the identity and manager columns of the previous roster.

    A user new to the roster starts at the "new" stage; everything else that is missing becomes
    blank, and so does a cell that holds nothing but a zero. Of repeated previous rows the last in ``sheet_order`` counts, rows without a user are
    ignored, and users no longer on the roster drop out.
    """
    kept = KEPT_COLUMNS
    last = Window.partitionBy("user_id").orderBy(*map(F.desc, sheet_order))
    previous = (
        roster_prev.filter(F.col("user_id") != "")
        .withColumn("rn", F.row_number().over(last))
        .filter(F.col("rn") == 1)
        .select("user_id", *kept, F.lit(True).alias("known"))
    )
    is_new = F.col("known").isNull()

    def carried(name: str) -> Column:
        value = cell(name)
        if name == "relationship_stage":
            value = F.when(is_new, params.NEW_STAGE).otherwise(value)
        return value.alias(name)

    return roster.join(previous, "user_id", "left").select(
        *roster.columns, *map(carried, kept), is_new.alias("is_new")
    )


def merge_sheet(
    base: DataFrame,
    sheet: DataFrame,
    current: DataFrame,
    sheet_order: Sequence[str] = ("sheet_row",),
    prefer: str = "sheet",
) -> DataFrame:
    """Three-way merge of an edited sheet: ``user_id``, the kept columns and ``conflicts``.

    ``base`` is the roster the sheet was exported from, ``current`` the one stored now. A cell that
    only one of sheet and current has changed takes the changed value; one that both have changed
    to the same value takes that; where they differ it takes the value of ``prefer`` (``sheet`` or
    ``current``) and ``conflicts`` holds the field, the three values and the one taken.

    Every user of any of the three has a row. A user without a row in the base has blank cells there.
    One who is missing in the sheet or in the current roster counts as not edited there: people who
    joined after the export keep their notes, and a row deleted from the sheet deletes nothing. Of
    repeated rows the last in ``sheet_order`` counts (in ``sheet_row`` for the other two), and rows
    without a user are ignored. Each side is combined per user before it travels.
    """
    if prefer not in ("sheet", "current"):
        raise ValueError(f"prefer must be sheet or current, not {prefer}")
    sides = {"base": base, "current": current}
    rows = last_rows(sheet, sheet_order, "sheet")
    for name, side in sides.items():
        rows = rows.join(last_rows(side, row_order(side), name), "user_id", "full")

    def value(side: str, name: str) -> Column:
        before = F.coalesce(f"base.{name}", F.lit(""))
        return before if side == "base" else F.coalesce(f"{side}.{name}", before)

    def clash(name: str) -> Column:
        ours, theirs, before = value("sheet", name), value("current", name), value("base", name)
        return (ours != before) & (theirs != before) & (ours != theirs)

    def merged(name: str) -> Column:
        edited = value("sheet", name) != value("base", name)
        taken = F.when(edited, value("sheet", name)).otherwise(value("current", name))
        return F.when(clash(name), value(prefer, name)).otherwise(taken)

    listed = [
        F.when(
            clash(name),
            F.struct(
                F.lit(name).alias("field"),
                *[value(side, name).alias(side) for side in ("base", "sheet", "current")],
                merged(name).alias("taken"),
            ),
        )
        for name in KEPT_COLUMNS
    ]
    return rows.select(
        "user_id", *[merged(name).alias(name) for name in KEPT_COLUMNS], F.array_compact(F.array(*listed)).alias("conflicts")
    )


def sheet_conflicts(merged_sheet: DataFrame) -> DataFrame:
    """One row per cell that sheet and current roster have changed in different ways."""
    return merged_sheet.select("user_id", F.inline("conflicts"))


def last_notes(log: DataFrame) -> DataFrame:
    """``user_id`` and the kept columns from a log ``user_id, field, value, sequence``.

    Each cell is the last value that was not blank, over all versions: what a user who has left the
    roster had when leaving, or before it was cleared. Rows are combined per user before they travel.
    """
    cells = [
        F.coalesce(F.max_by(F.when(F.col("field") == name, F.col("value")), F.when(F.col("field") == name, F.col("sequence"))), F.lit("")).alias(name)
        for name in KEPT_COLUMNS
    ]
    return log.groupBy("user_id").agg(*cells)


def with_returning(roster_prev: DataFrame, notes: DataFrame, sheet_order: Sequence[str] = ("sheet_row",)) -> DataFrame:
    """The previous roster and the ``last_notes`` of users who are not on it.

    Merged with it, users who come back find their notes instead of starting at the "new" stage.
    """
    known = roster_prev.filter(F.col("user_id") != "").select("user_id")
    away = notes.join(known, "user_id", "left_anti")
    order = [name for name in sheet_order if name != "user_id"]
    return roster_prev.select("user_id", *KEPT_COLUMNS, *order).unionByName(away, allowMissingColumns=True)


def heat_scores(merged: DataFrame, today: dt.date | str) -> DataFrame:
    """Recency, context and heat score of every roster row, coldest first."""
    per_day = F.col("days_since_last_session").cast("double") / F.lit(float(params.RECENCY_DAYS))
    left = F.lit(100.0) - per_day * F.lit(100.0)
    # Whole days give whole thirds of a tenth: no ties, so the nearest tenth needs no care.
    days_known = F.col("days_since_last_session").isNotNull()
    recency = F.when(days_known, F.rint(F.greatest(F.lit(0.0), left) * 10.0) / 10.0).otherwise(0.0)
    has_notes = reduce(or_, [stripped(F.coalesce(note, F.lit(""))) != "" for note in NOTE_COLUMNS])
    context = F.when(has_notes, params.CONTEXT_WITH_NOTES).otherwise(params.CONTEXT_WITHOUT_NOTES)
    scored = merged.withColumns({"recency_score": recency, "context_score": context})
    halves = F.col("recency_score") * 0.5 + F.col("context_score") * 0.5
    scored = scored.withColumn("hot_cold_score", py_round1(halves))
    *bounded, (coldest, _) = params.HEAT_LABELS
    first, *rest = bounded
    score = F.col("hot_cold_score")
    label = reduce(
        lambda case, bound: case.when(score >= bound[1], bound[0]),
        rest,
        F.when(score >= first[1], first[0]),
    ).otherwise(coldest)
    return (
        scored.withColumns({"hot_cold_label": label, "score_updated": date_literal(today)})
        .select(*ROSTER_COLUMNS)
        .orderBy("hot_cold_score", F.desc("ltv_usd"), "user_id")
    )


def heat_summary(scored: DataFrame) -> DataFrame:
    """Users per heat label, labels without users included, and the overall count."""
    names = [name for name, _ in params.HEAT_LABELS]
    counts = scored.agg(
        *[F.count_if(F.col("hot_cold_label") == name).alias(name) for name in names],
        F.count("*").alias("total"),
    )
    pairs = F.array(
        *[F.struct(F.lit(name).alias("label"), F.col(name).alias("users")) for name in names]
    )
    return counts.select(F.inline(pairs), "total")


def needs_attention(scored: DataFrame, n: int = params.NEEDS_ATTENTION) -> DataFrame:
    """The n coldest users nobody has contacted yet."""
    return (
        scored.filter(F.col("hot_cold_label").isin("Cold", "Inactive"))
        .filter(stripped(F.col("relationship_stage")) == params.NEW_STAGE)
        .orderBy("hot_cold_score", F.desc("ltv_usd"), "user_id")
        .limit(n)
        .select("user_id", "tier", "ltv_usd", "days_since_last_session", "hot_cold_score")
    )


def hot_list(scored: DataFrame) -> DataFrame:
    """All hot users, hottest first."""
    return (
        scored.filter(F.col("hot_cold_label") == "Hot")
        .select("user_id", "tier", "ltv_usd", "hot_cold_score")
        .orderBy(F.desc("hot_cold_score"), F.desc("ltv_usd"), "user_id")
    )
