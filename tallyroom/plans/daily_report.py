"""The daily report: twelve results over one UTC day."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom import params
from tallyroom.operators import boxes, daily
from tallyroom.operators.common import Excluded, on_day, payers_of_day, without_users
from tallyroom.operators.observations import observations
from tallyroom.plans.stages import fits_broadcast, kept, sieve, staged, staged_together


@dataclass(frozen=True)
class DailyReport:
    daily_active_users: DataFrame
    purchase_summary: DataFrame
    revenue_by_product: DataFrame
    top_boxes: DataFrame
    top_openers: DataFrame
    top_spenders: DataFrame
    payer_cohort: DataFrame
    top_box_openers: DataFrame
    cohort_kpis: DataFrame
    returning_payers: DataFrame
    box_mix: DataFrame
    observations: DataFrame

    def results(self) -> dict[str, DataFrame]:
        return {field.name: getattr(self, field.name) for field in fields(self)}


def _cohort(
    purchases: DataFrame,
    payers: DataFrame,
    few: bool,
    report_date: dt.date | str,
    excluded: Excluded,
    partition_date: str | None,
) -> DataFrame:
    """The cohort over the history of the payers, whom the exclusion has already passed."""
    history, excluded = (kept(purchases, payers), ()) if few else (sieve(payers)(purchases), excluded)
    return daily.cohort_rows(history, report_date, excluded, partition_date)


def narrowed_cohort(
    purchases: DataFrame,
    report_date: dt.date | str,
    excluded: Excluded = (),
    partition_date: str | None = None,
) -> DataFrame:
    """``daily.cohort_rows`` over the history of the day's payers, and few others when they are many."""
    payers = staged(payers_of_day(purchases, report_date, excluded, partition_date))
    few = fits_broadcast(payers)
    return _cohort(purchases, payers, few, report_date, excluded, partition_date)


def daily_report(
    logins: DataFrame,
    purchases: DataFrame,
    box_events: DataFrame,
    report_date: dt.date | str,
    excluded: Excluded = (),
    n_boxes: int = params.TOP_BOXES,
    n_openers: int = params.TOP_OPENERS,
    n_spenders: int = params.TOP_SPENDERS,
    n_observations: int = params.TOP_OBSERVATIONS,
    partition_date: str | None = None,
) -> DailyReport:
    """All results of one day, each computed once.

    Logins and box events are read once, purchases twice: the day and the history. The day's
    purchases, the box rollup and the payer cohort are staged, since several outputs
    read them; the history behind the cohort and the box events are narrowed to the day's payers
    when their counted number allows it, and by a filter of bounded size otherwise. The excluded users are
    gone once the day's purchases are staged, so what is derived from those need not look again.
    """
    first = staged_together(
        day=without_users(on_day(purchases, report_date, partition_date), excluded),
        active=daily.daily_active_users(logins, report_date, excluded, partition_date),
    )
    day, active = first["day"], first["active"]
    payers = day.select("user_id").distinct()
    few = fits_broadcast(payers)
    opened = on_day(kept(box_events, payers) if few else sieve(payers)(box_events), report_date, partition_date)
    second = staged_together(
        summary=daily.purchase_summary(day, report_date),
        products=daily.revenue_by_product(day, report_date),
        spenders=daily.top_spenders(day, report_date, n=n_spenders),
        cohort=_cohort(purchases, payers, few, report_date, excluded, partition_date),
        activity=boxes.payer_box_activity(opened, day, report_date),
    )
    cohort, activity = second["cohort"], second["activity"]
    third = staged_together(
        top=boxes.top_boxes_of(activity, n_boxes),
        openers=boxes.top_box_opener_rows(activity),
    )
    kpis = daily.cohort_kpis(active, second["summary"], cohort)
    returning = daily.returning_payers(cohort)
    mix = boxes.box_mix(third["top"], third["openers"])
    found = observations(
        second["products"], third["top"], second["spenders"], third["openers"], kpis, returning,
        mix, report_date, n_observations,
    )
    return DailyReport(
        daily_active_users=active,
        purchase_summary=second["summary"],
        revenue_by_product=second["products"].orderBy(F.desc("revenue_usd"), "product_slug"),
        top_boxes=third["top"].orderBy(
            F.desc("total_opens"), "box_display_name", "box_volatility"
        ),
        top_openers=boxes.top_openers_of(activity, n_openers),
        top_spenders=second["spenders"].orderBy(F.desc("total_spend_usd"), "user_id"),
        payer_cohort=daily.cohort_order(cohort),
        top_box_openers=boxes.opener_order(third["openers"]),
        cohort_kpis=kpis,
        returning_payers=returning,
        box_mix=mix,
        observations=found,
    )
