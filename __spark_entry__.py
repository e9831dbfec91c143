"""Registered queries over the test tables, and the SQL that must give the same rows."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import cache, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracles import ORACLE_SQL
from tallyroom import params
from tallyroom.operators import boxes, crossings, daily, daily_range, distinct_users, roster
from tallyroom.plans import crossings_report, daily_report, range_report, refresh_roster
from tallyroom.plans.cohort_job import advance_cohort, start_state
from tallyroom.plans.crossings_job import crossing_users
from tallyroom.plans.daily_report import narrowed_cohort
from tallyroom.plans.roster_job import roster_inputs, scored_roster
from tallyroom.plans.stages import scratch_folder, staged
from tallyroom.sources import testdata as td
from tallyroom.sources.buckets import hot_keys, read_buckets, write_buckets
from tallyroom.sources.cells import changed_cells

try:
    import corpus_pipeline
    from tallyroom.llm import registry as llm
except ModuleNotFoundError as missing:  # the optional folder is not there; other errors surface
    if not (missing.name or "").startswith(("corpus_pipeline", "tallyroom.llm")):
        raise
    corpus_pipeline = llm = None

DAY = td.REPORT_DATE
Query = Callable[[SparkSession, str], DataFrame]


def _daily_active_users(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_active_users(td.logins(spark, sf), DAY, td.EXCLUDED)


def _purchase_summary(spark: SparkSession, sf: str) -> DataFrame:
    return daily.purchase_summary(td.purchases(spark, sf), DAY, td.EXCLUDED)


def _revenue_by_product(spark: SparkSession, sf: str) -> DataFrame:
    return daily.revenue_by_product(td.purchases(spark, sf), DAY, td.EXCLUDED)


def _top_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return boxes.top_boxes(td.box_events(spark, sf), td.purchases(spark, sf), DAY, td.EXCLUDED)


def _top_openers(spark: SparkSession, sf: str) -> DataFrame:
    return boxes.top_openers(td.box_events(spark, sf), td.purchases(spark, sf), DAY, td.EXCLUDED)


def _top_spenders(spark: SparkSession, sf: str) -> DataFrame:
    return daily.top_spenders(td.purchases(spark, sf), DAY, td.EXCLUDED)


def _cohort(spark: SparkSession, sf: str) -> DataFrame:
    return narrowed_cohort(td.purchases(spark, sf), DAY, td.EXCLUDED)


def _payer_cohort(spark: SparkSession, sf: str) -> DataFrame:
    return daily.cohort_order(_cohort(spark, sf))


def _box_activity(spark: SparkSession, sf: str) -> DataFrame:
    """The rollup of payers' opens, staged because its readers need it twice."""
    return staged(
        boxes.payer_box_activity(
            td.box_events(spark, sf), td.purchases(spark, sf), DAY, td.EXCLUDED
        )
    )


def _top_box_openers(spark: SparkSession, sf: str) -> DataFrame:
    return boxes.opener_order(boxes.top_box_opener_rows(_box_activity(spark, sf)))


def _cohort_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return daily.cohort_kpis(
        _daily_active_users(spark, sf), _purchase_summary(spark, sf), _cohort(spark, sf)
    )


def _returning_payers(spark: SparkSession, sf: str) -> DataFrame:
    return daily.returning_payers(_cohort(spark, sf))


def _box_mix(spark: SparkSession, sf: str) -> DataFrame:
    activity = _box_activity(spark, sf)
    return boxes.box_mix(boxes.top_boxes_of(activity), boxes.top_box_opener_rows(activity))


def _observations(spark: SparkSession, sf: str) -> DataFrame:
    return daily_report(
        td.logins(spark, sf), td.purchases(spark, sf), td.box_events(spark, sf), DAY, td.EXCLUDED
    ).observations


RANGE = (td.RANGE_START, td.RANGE_END, td.EXCLUDED)


def _payer_cohort_from_state(spark: SparkSession, sf: str) -> DataFrame:
    """The cohort of the report day from a stored state moved on by its last days, late rows included."""
    arrived = td.purchase_arrivals(spark, sf)
    store = f"{scratch_folder(spark)}/payers-{uuid.uuid4().hex}"
    start, *days = td.ARRIVAL_DAYS
    start_state(arrived.filter(F.col("arrival_date") <= F.lit(start).cast("date")), store, start, td.EXCLUDED)
    for day in days:
        cohort = advance_cohort(arrived.filter(F.col("arrival_date") == F.lit(day).cast("date")), store, day, td.EXCLUDED)
    return cohort


def _daily_active_users_range(spark: SparkSession, sf: str) -> DataFrame:
    return daily_range.daily_active_users_range(td.logins(spark, sf), *RANGE)


def _purchase_summary_range(spark: SparkSession, sf: str) -> DataFrame:
    return daily_range.purchase_summary_range(td.purchases(spark, sf), *RANGE)


def _revenue_by_product_range(spark: SparkSession, sf: str) -> DataFrame:
    return daily_range.revenue_by_product_range(td.purchases(spark, sf), *RANGE)


def _payer_cohort_range(spark: SparkSession, sf: str) -> DataFrame:
    return daily_range.payer_cohort_range(td.purchases(spark, sf), *RANGE)


def _cohort_kpis_range(spark: SparkSession, sf: str) -> DataFrame:
    return daily_range.cohort_kpis_range(
        _daily_active_users_range(spark, sf), _purchase_summary_range(spark, sf), _payer_cohort_range(spark, sf)
    )


def _box_activity_range(spark: SparkSession, sf: str) -> DataFrame:
    return daily_range.payer_box_activity_range(td.box_events(spark, sf), td.purchases(spark, sf), *RANGE)


def _top_boxes_range(spark: SparkSession, sf: str) -> DataFrame:
    return daily_range.top_boxes_range(_box_activity_range(spark, sf))


def _top_openers_range(spark: SparkSession, sf: str) -> DataFrame:
    return daily_range.top_openers_range(_box_activity_range(spark, sf))


def _top_spenders_range(spark: SparkSession, sf: str) -> DataFrame:
    return daily_range.top_spenders_range(td.purchases(spark, sf), *RANGE)


def _returning_payers_range(spark: SparkSession, sf: str) -> DataFrame:
    return daily_range.returning_payers_range(_payer_cohort_range(spark, sf))


def _of_range_report(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        tables = td.logins(spark, sf), td.purchases(spark, sf), td.box_events(spark, sf)
        return range_report(*tables, *RANGE).results()[name]

    return run


def _user_days(spark: SparkSession, sf: str, rows: DataFrame, *keys: str) -> DataFrame:
    """The day rows that the counts of longer spans are united from."""
    rows = rows.withColumn("day", F.to_date("event_timestamp"))
    numbers = staged(distinct_users.numbered_users(rows))
    return staged(distinct_users.user_bitmaps(rows, numbers, ["day", *keys]))


def _weekly_active_users(spark: SparkSession, sf: str) -> DataFrame:
    week = F.date_trunc("week", "day").cast("date").alias("week")
    return distinct_users.united_counts(_user_days(spark, sf, td.logins(spark, sf)), [week], "active_users")


def _monthly_payers(spark: SparkSession, sf: str) -> DataFrame:
    """Per product and month, and over all products (``all_products``), from rows per day and product."""
    days = _user_days(spark, sf, td.purchases(spark, sf), "product_slug")
    month = F.date_trunc("month", "day").cast("date").alias("month")
    by_product = distinct_users.united_counts(days, [month, "product_slug"], "payers")
    over_all = distinct_users.united_counts(days, [month], "payers")
    return by_product.withColumn("all_products", F.lit(False)).unionByName(
        over_all.withColumns({"product_slug": F.lit(None).cast("string"), "all_products": F.lit(True)})
    )


def _vendor_cost_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return crossings.vendor_cost_by_user(td.vendor_pricing(spark, sf))


def _tier_crossings(as_of: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        crossed, [pricing] = crossing_users(
            td.user_crm(spark, sf, as_of), td.internal_users(spark, sf), as_of, params.TIERS,
            td.vendor_pricing(spark, sf),
        )
        costs = crossings.vendor_cost_by_user(pricing)
        return crossings.crossing_order(crossings.priced_rows(crossed, costs))

    return run


def _entrant_last_purchases(as_of: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        crossed, [purchases] = crossing_users(
            td.user_crm(spark, sf, as_of), td.internal_users(spark, sf), as_of, params.TIERS,
            td.purchases(spark, sf),
        )
        return crossings.entrant_last_purchases(crossed, purchases, as_of)

    return run


def _entrant_feed(as_of: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        feed = crossings_report(
            td.user_crm(spark, sf, as_of),
            td.vendor_pricing(spark, sf),
            td.internal_users(spark, sf),
            td.purchases(spark, sf),
            as_of,
        ).entrant_feed
        # The comparison with SQL needs flat columns.
        line = F.transform(
            "purchases",
            lambda p: F.concat_ws(
                " | ", p.rn.cast("string"), p.local_time,
                F.format_string("%.2f", p.amount_usd), p.product_slug,
            ),
        )
        return feed.withColumn("purchase_text", F.array_join(line, "; ")).drop("purchases")

    return run


def _latest_vendor_pricing(spark: SparkSession, sf: str) -> DataFrame:
    return roster.latest_vendor_pricing(td.vendor_pricing(spark, sf), td.PRICING_TIE_BREAK)


def _procurement_cost_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return roster.procurement_cost_by_user(
        td.orders_created(spark, sf), _latest_vendor_pricing(spark, sf)
    )


def _roster_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return roster_inputs(
        td.user_crm(spark, sf, td.ROSTER_AS_OF),
        td.orders_created(spark, sf),
        td.vendor_pricing(spark, sf),
        td.internal_users(spark, sf),
        tie_break=td.PRICING_TIE_BREAK,
    )


def _vip_roster(spark: SparkSession, sf: str) -> DataFrame:
    return roster.roster_rows(*_roster_inputs(spark, sf))


def _merge_roster(spark: SparkSession, sf: str) -> DataFrame:
    return roster.merge_roster(_vip_roster(spark, sf), td.roster_prev(spark, sf))


def _sheet_merge(spark: SparkSession, sf: str) -> DataFrame:
    return roster.merge_sheet(
        td.roster_prev(spark, sf), td.roster_sheet(spark, sf), td.roster_now(spark, sf)
    )


def _merge_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return _sheet_merge(spark, sf).withColumn("conflicts", F.size("conflicts").cast("bigint")).withColumnRenamed(
        "conflicts", "n_conflicts"
    )


def _sheet_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return roster.sheet_conflicts(_sheet_merge(spark, sf))


def _last_notes(spark: SparkSession, sf: str) -> DataFrame:
    """The last notes of every user over three versions, from what each changed."""
    versions = [td.roster_prev(spark, sf), td.roster_now(spark, sf), td.roster_sheet(spark, sf)]
    logs = [
        changed_cells(version, before).withColumn("sequence", F.lit(number).cast("bigint"))
        for number, (version, before) in enumerate(zip(versions, [None, *versions], strict=False), 1)
    ]
    return roster.last_notes(logs[0].unionByName(logs[1]).unionByName(logs[2]))


def _procurement_cost_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The cost per user from order and pricing tables stored in buckets of the order id."""
    name, folder = f"t{uuid.uuid4().hex}", f"{scratch_folder(spark)}/buckets-{uuid.uuid4().hex}"
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    write_buckets(td.orders_created(spark, sf), f"{name}_orders", f"{folder}/orders", "order_id", buckets)
    write_buckets(td.vendor_pricing(spark, sf), f"{name}_pricing", f"{folder}/pricing", "order_id", buckets)
    orders, pricing = read_buckets(spark, f"{name}_orders"), read_buckets(spark, f"{name}_pricing")
    hot = hot_keys(orders, "order_id", buckets)
    return roster.stored_procurement_cost(orders, pricing, hot, td.PRICING_TIE_BREAK)


def _heat_scores(spark: SparkSession, sf: str) -> DataFrame:
    vips, costs = _roster_inputs(spark, sf)
    return scored_roster(vips, costs, td.roster_prev(spark, sf), td.ROSTER_AS_OF[:10])


def _heat_summary(spark: SparkSession, sf: str) -> DataFrame:
    return roster.heat_summary(_heat_scores(spark, sf))


def _needs_attention(spark: SparkSession, sf: str) -> DataFrame:
    return roster.needs_attention(_heat_scores(spark, sf))


def _hot_list(spark: SparkSession, sf: str) -> DataFrame:
    return roster.hot_list(_heat_scores(spark, sf))


def _write_roster_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Publishes the roster and reads the stored version back."""
    return refresh_roster(
        td.user_crm(spark, sf, td.ROSTER_AS_OF),
        td.orders_created(spark, sf),
        td.vendor_pricing(spark, sf),
        td.internal_users(spark, sf),
        f"{scratch_folder(spark)}/roster-{uuid.uuid4().hex}",
        td.ROSTER_AS_OF[:10],
        roster_prev=td.roster_prev(spark, sf),
        tie_break=td.PRICING_TIE_BREAK,
    ).roster


@cache
def _own_scratch() -> str:
    folder = tempfile.mkdtemp(prefix="tallyroom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _prepared(query: Query) -> Query:
    """On one machine a session without ``spark.checkpoint.dir`` gets a folder; a cluster must set it.

    Python workers find the package beside this file, wherever the session was started from.
    """

    @wraps(query)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        context = spark.sparkContext
        context.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.abspath(__file__)))
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if named is None and context.master.startswith("local["):
            context.setCheckpointDir(_own_scratch())
        return query(spark, sf)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """The scored loyalty roster at the smallest scale."""
    return _prepared(_heat_scores)(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """All queries; those of the optional folder only where it can be imported."""
    found = base_queries()
    if llm:
        found |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return {name: _prepared(query) for name, query in found.items()}


def base_queries() -> dict[str, Query]:
    return {
        "daily_active_users": _daily_active_users,
        "purchase_summary": _purchase_summary,
        "revenue_by_product": _revenue_by_product,
        "top_boxes": _top_boxes,
        "top_openers": _top_openers,
        "top_spenders": _top_spenders,
        "payer_cohort": _payer_cohort,
        "top_box_openers": _top_box_openers,
        "cohort_kpis": _cohort_kpis,
        "returning_payers": _returning_payers,
        "box_mix": _box_mix,
        "observations": _observations,
        "payer_cohort_from_state": _payer_cohort_from_state,
        "daily_active_users_range": _daily_active_users_range,
        "purchase_summary_range": _purchase_summary_range,
        "revenue_by_product_range": _revenue_by_product_range,
        "payer_cohort_range": _payer_cohort_range,
        "cohort_kpis_range": _cohort_kpis_range,
        "top_boxes_range": _top_boxes_range,
        "top_openers_range": _top_openers_range,
        "top_spenders_range": _top_spenders_range,
        "returning_payers_range": _returning_payers_range,
        "top_box_openers_range": _of_range_report("top_box_openers"),
        "box_mix_range": _of_range_report("box_mix"),
        "observations_range": _of_range_report("observations"),
        "weekly_active_users": _weekly_active_users,
        "monthly_payers": _monthly_payers,
        "vendor_cost_by_user": _vendor_cost_by_user,
        "tier_crossings": _tier_crossings(td.CROSSINGS_AS_OF),
        "tier_crossings_month_end": _tier_crossings(td.ROSTER_AS_OF),
        "entrant_last_purchases": _entrant_last_purchases(td.CROSSINGS_AS_OF),
        "entrant_last_purchases_month_end": _entrant_last_purchases(td.ROSTER_AS_OF),
        "entrant_feed": _entrant_feed(td.CROSSINGS_AS_OF),
        "latest_vendor_pricing": _latest_vendor_pricing,
        "procurement_cost_by_user": _procurement_cost_by_user,
        "vip_roster": _vip_roster,
        "merge_roster": _merge_roster,
        "last_notes": _last_notes,
        "procurement_cost_stored": _procurement_cost_stored,
        "merge_sheet": _merge_sheet,
        "sheet_conflicts": _sheet_conflicts,
        "heat_scores": _heat_scores,
        "write_roster_snapshot": _write_roster_snapshot,
        "heat_summary": _heat_summary,
        "needs_attention": _needs_attention,
        "hot_list": _hot_list,
    }


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLE_SQL)
    if llm:
        found |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
