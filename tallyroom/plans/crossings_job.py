"""Tier crossings of the past 24 hours with the purchases behind them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyroom import params
from tallyroom.operators import crossings
from tallyroom.plans.stages import fits_broadcast, kept, sieve, staged, staged_together


@dataclass(frozen=True)
class CrossingsReport:
    tier_crossings: DataFrame
    entrant_last_purchases: DataFrame
    entrant_feed: DataFrame

    def results(self) -> dict[str, DataFrame]:
        return {
            "tier_crossings": self.tier_crossings,
            "entrant_last_purchases": self.entrant_last_purchases,
            "entrant_feed": self.entrant_feed,
        }


def crossing_users(
    user_crm: DataFrame,
    internal_users: DataFrame,
    as_of: dt.datetime | str,
    tiers: Sequence[tuple[float, str]],
    *tables: DataFrame,
) -> tuple[DataFrame, list[DataFrame]]:
    """The crossing users, staged, and the tables narrowed to them.

    They are few on a usual day, so the pricing and the purchase history are cut at the scan; when
    their counted number is too large for that, a filter of bounded size cuts most, and what is left
    is aggregated and joined by shuffle.
    """
    crossed = staged(crossings.newly_crossed(user_crm, internal_users, as_of, tiers))
    if fits_broadcast(crossed):
        return crossed, [kept(table, crossed) for table in tables]
    cut = sieve(crossed)
    return crossed, [cut(table) for table in tables]


def crossings_report(
    user_crm: DataFrame,
    vendor_pricing: DataFrame,
    internal_users: DataFrame,
    purchases: DataFrame,
    as_of: dt.datetime | str,
    tiers: Sequence[tuple[float, str]] = params.TIERS,
    n_purchases: int = params.ENTRANT_PURCHASES,
    partition_date: str | None = None,
) -> CrossingsReport:
    """Both results and their feed from one reading of "now"."""
    crossed, (vendor_pricing, purchases) = crossing_users(
        user_crm, internal_users, as_of, tiers, vendor_pricing, purchases
    )
    costs = crossings.vendor_cost_by_user(vendor_pricing)
    parts = staged_together(
        found=crossings.priced_rows(crossed, costs),
        latest=crossings.last_purchase_rows(
            crossed, purchases, as_of, n_purchases, partition_date
        ),
    )
    found, latest = parts["found"], parts["latest"]
    return CrossingsReport(
        tier_crossings=crossings.crossing_order(found),
        entrant_last_purchases=latest.orderBy("user_id", "rn"),
        entrant_feed=crossings.entrant_feed(found, latest),
    )
