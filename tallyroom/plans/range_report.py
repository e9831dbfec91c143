"""All daily reports of a range of days in one job."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

from tallyroom import params
from tallyroom.operators import daily_range as ops
from tallyroom.operators.common import Excluded
from tallyroom.plans.stages import staged_together


@dataclass(frozen=True)
class RangeReport:
    """Each result has the columns of its namesake for one day beside ``report_date``."""

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


def range_report(
    logins: DataFrame,
    purchases: DataFrame,
    box_events: DataFrame,
    first_day: dt.date | str,
    last_day: dt.date | str,
    excluded: Excluded = (),
    n_boxes: int = params.TOP_BOXES,
    n_openers: int = params.TOP_OPENERS,
    n_spenders: int = params.TOP_SPENDERS,
    n_observations: int = params.TOP_OBSERVATIONS,
    partition_date: str | None = None,
) -> RangeReport:
    """The reports of every day from the first to the last.

    What several reports read is staged: the days' totals, the cohort, and the box rollup. Days are
    keys of the groups, so a backfill of a year is as many stages as one day.
    """
    span = (first_day, last_day, excluded)
    first = staged_together(
        active=ops.daily_active_users_range(logins, *span, partition_date),
        summary=ops.purchase_summary_range(purchases, *span, partition_date),
        products=ops.revenue_by_product_range(purchases, *span, partition_date),
        spenders=ops.top_spenders_range(purchases, *span, n_spenders, partition_date),
        cohort=ops.payer_cohort_range(purchases, *span, partition_date),
        activity=ops.payer_box_activity_range(box_events, purchases, *span, partition_date),
    )
    second = staged_together(
        top=ops.top_boxes_range(first["activity"], n_boxes),
        openers=ops.top_box_openers_range(first["activity"]),
        kpis=ops.cohort_kpis_range(first["active"], first["summary"], first["cohort"]),
    )
    returning = ops.returning_payers_range(first["cohort"])
    mix = ops.box_mix_range(second["top"], second["openers"], first_day, last_day)
    return RangeReport(
        daily_active_users=first["active"],
        purchase_summary=first["summary"],
        revenue_by_product=first["products"],
        top_boxes=second["top"],
        top_openers=ops.top_openers_range(first["activity"], n_openers),
        top_spenders=first["spenders"],
        payer_cohort=first["cohort"],
        top_box_openers=second["openers"],
        cohort_kpis=second["kpis"],
        returning_payers=returning,
        box_mix=mix,
        observations=ops.observations_range(
            first["products"], second["top"], first["spenders"], second["openers"], second["kpis"], returning, mix,
            n_observations,
        ),
    )
