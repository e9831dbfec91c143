"""Roster refresh: figures, merge with the stored roster, heat scores, publication, summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyroom import params
from tallyroom.operators import roster as ops
from tallyroom.plans.stages import fits_broadcast, kept, narrowed, sieve, staged
from tallyroom.sources.roster_store import (
    EmptyRosterError,
    RosterConflictError,
    current_roster,
    note_log,
    publish_roster,
    read_roster,
)


@dataclass(frozen=True)
class RosterRefresh:
    version: str
    roster: DataFrame
    heat_summary: DataFrame
    needs_attention: DataFrame
    hot_list: DataFrame
    conflicts: DataFrame | None = None

    def results(self) -> dict[str, DataFrame]:
        found = {
            "roster": self.roster,
            "heat_summary": self.heat_summary,
            "needs_attention": self.needs_attention,
            "hot_list": self.hot_list,
        }
        return found if self.conflicts is None else found | {"conflicts": self.conflicts}


def roster_inputs(
    user_crm: DataFrame,
    orders_created: DataFrame,
    vendor_pricing: DataFrame,
    internal_users: DataFrame,
    tiers: Sequence[tuple[float, str]] = params.TIERS,
    tie_break: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """The VIP users, staged, and the procurement costs of their orders.

    While the VIP users are few enough to broadcast, the order table is narrowed to them at the
    scan, and the pricing table to their orders, by the orders themselves or a filter of bounded size.
    Beyond that such a filter of the users cuts the order events at the scan; the rest are combined
    per order and user, cut to the VIP users by a shuffle, and only then meet the prices.
    """
    vips = staged(ops.vip_users(user_crm, internal_users, tiers))
    users = vips
    if fits_broadcast(vips):
        users = None
        orders_created = staged(kept(orders_created.select("order_id", "user_id"), vips))
        order_ids = orders_created.select("order_id").distinct()
        vendor_pricing = narrowed(vendor_pricing, staged(order_ids), "order_id")
    else:
        orders_created = sieve(vips)(orders_created.select("order_id", "user_id"))
    latest = ops.latest_vendor_pricing(vendor_pricing, tie_break)
    return vips, ops.procurement_cost_by_user(orders_created, latest, users)


def scored_roster(
    vips: DataFrame,
    costs: DataFrame,
    roster_prev: DataFrame,
    today: dt.date | str,
    tiers: Sequence[tuple[float, str]] = params.TIERS,
    sheet_order: Sequence[str] = ("sheet_row",),
) -> DataFrame:
    """The merged and scored roster of the VIP users."""
    fresh = ops.roster_rows(vips, costs, tiers)
    return ops.heat_scores(ops.merge_roster(fresh, roster_prev, sheet_order), today)


def refresh_roster(
    user_crm: DataFrame,
    orders_created: DataFrame,
    vendor_pricing: DataFrame,
    internal_users: DataFrame,
    store: str,
    today: dt.date | str,
    roster_prev: DataFrame | None = None,
    tiers: Sequence[tuple[float, str]] = params.TIERS,
    tie_break: Sequence[str] = (),
    sheet_order: Sequence[str] = ("sheet_row",),
    n_attention: int = params.NEEDS_ATTENTION,
    sheet_base: str | None = None,
    prefer: str = "sheet",
    attempts: int = 3,
    recall: bool = False,
) -> RosterRefresh:
    """Publish a refreshed roster in ``store`` and summarise what was stored.

    The previous roster is the published one unless another (such as an edited sheet) is given.
    ``sheet_base`` names the version that such a sheet was exported from: its edits are then merged
    with what has been stored since (``operators.roster.merge_sheet``), and ``conflicts`` lists the
    cells changed on both sides.

    With ``recall`` users who are back on the roster after some versions without them get the last
    notes they had (``operators.roster.last_notes``); otherwise they start at the "new" stage.

    If another refresh publishes in the meantime, the merge is done again on its roster, up to
    ``attempts`` times in all; the figures are staged and not computed again. A sheet without a base
    cannot be merged twice: it replaces what was read before it, and ``RosterConflictError`` is raised.
    The scored roster is computed once: the summaries read the published files.
    """
    spark = user_crm.sparkSession
    start = current_roster(spark, store)
    vips, costs = roster_inputs(
        user_crm, orders_created, vendor_pricing, internal_users, tiers, tie_break
    )
    if vips.isEmpty():
        raise EmptyRosterError("no user qualifies, the stored roster is kept")
    fresh = staged(ops.roster_rows(vips, costs, tiers))
    conflicts = None
    for attempt in range(attempts):
        if attempt:
            start = current_roster(spark, store)
        previous, order = roster_prev, sheet_order
        if roster_prev is None:
            previous, order = read_roster(spark, store, start.version), ("sheet_row",)
        elif sheet_base is not None:
            known = read_roster(spark, store, sheet_base), read_roster(spark, store, start.version)
            edited = staged(ops.merge_sheet(known[0], roster_prev, known[1], sheet_order, prefer))
            previous, order = edited, ("user_id",)
            conflicts = ops.sheet_conflicts(edited)
        if recall:
            previous = ops.with_returning(previous, ops.last_notes(note_log(spark, store)), order)
        scored = ops.heat_scores(ops.merge_roster(fresh, previous, order), today)
        try:
            version = publish_roster(scored, store, today, base=start.sequence)
            break
        except RosterConflictError:
            mergeable = roster_prev is None or sheet_base is not None
            if attempt + 1 == attempts or not mergeable:
                raise
    stored = read_roster(spark, store, version).drop("sheet_row")
    return RosterRefresh(
        version=version,
        roster=stored.orderBy("hot_cold_score", stored.ltv_usd.desc(), "user_id"),
        heat_summary=ops.heat_summary(stored),
        needs_attention=ops.needs_attention(stored, n_attention),
        hot_list=ops.hot_list(stored),
        conflicts=conflicts,
    )
