"""One day of the payer cohort from the stored state, and the state of that day."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyroom.functions import day_of
from tallyroom.operators import payer_state as ops
from tallyroom.operators.common import Excluded
from tallyroom.operators.daily import cohort_order
from tallyroom.plans.stages import narrowed, staged
from tallyroom.sources.commits import commit, latest


class StateDayError(ValueError):
    """The stored state is not that of an earlier day."""


def read_state(spark: SparkSession, store: str) -> tuple[DataFrame, dt.date | None]:
    """The newest state and its day; empty before the first one."""
    found = latest(spark, f"{store}/commits")
    if found is None:
        return spark.createDataFrame([], ops.STATE), None
    number, entry = found
    return spark.read.schema(ops.STATE).parquet(f"{store}/states/{entry['state']}"), dt.date.fromordinal(number)


def _write_state(state: DataFrame, store: str, day: dt.date) -> None:
    """The day is the commit's number: of two runs of a day one is told that it comes second."""
    name = f"{day:%Y%m%d}-{uuid.uuid4().hex}"
    state.write.mode("error").parquet(f"{store}/states/{name}")
    commit(state.sparkSession, f"{store}/commits", day.toordinal(), {"state": name, "day": f"{day:%Y-%m-%d}"})


def start_state(
    purchases: DataFrame,
    store: str,
    through: dt.date | str,
    excluded: Excluded = (),
    partition_date: str | None = None,
) -> None:
    """Store the state of a day from the history: the one time that it is read whole."""
    _write_state(ops.payer_state(purchases, through, excluded, partition_date), store, day_of(through))


def advance_cohort(
    arrivals: DataFrame,
    store: str,
    report_date: dt.date | str,
    excluded: Excluded = (),
    partition_date: str | None = None,
) -> DataFrame:
    """The day's cohort, ordered, and the stored state moved to that day.

    ``arrivals`` are the rows that no earlier run was given, of the day and late ones. Only the state
    rows of the day's payers are kept at its scan while those are few enough to broadcast. The state
    moves last, so a run that failed can be repeated with the same rows.
    """
    day = day_of(report_date)
    state, through = read_state(arrivals.sparkSession, store)
    if through is not None and through >= day:
        raise StateDayError(f"the stored state is of {through}, too late for {day}")
    payers = staged(ops.payers_of_arrivals(arrivals, day, excluded, partition_date))
    cohort = staged(ops.cohort_from_state(narrowed(state, payers), payers, day))
    _write_state(ops.advanced_state(state, arrivals, day, excluded, partition_date), store, day)
    return cohort_order(cohort)
