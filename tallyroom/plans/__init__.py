"""The jobs, wired from the operators."""

from tallyroom.plans.crossings_job import CrossingsReport, crossings_report
from tallyroom.plans.daily_report import DailyReport, daily_report
from tallyroom.plans.range_report import RangeReport, range_report
from tallyroom.plans.roster_job import RosterRefresh, refresh_roster

__all__ = [
    "CrossingsReport",
    "DailyReport",
    "RangeReport",
    "RosterRefresh",
    "crossings_report",
    "daily_report",
    "range_report",
    "refresh_roster",
]
