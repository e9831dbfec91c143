"""Relations between results, and independence from partitioning and from the road taken."""

import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tallyroom.operators import boxes, crossings, daily, roster
from tallyroom.plans import crossings_report, daily_report, refresh_roster, stages
from tallyroom.sources import testdata as td
from tests.frames import one, tuples

SF = "/root/testdata/sf0.01"
QUERIES = {name: registry.queries()[name] for name in registry.base_queries()}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def report(spark):
    return daily_report(
        td.logins(spark, SF), td.purchases(spark, SF), td.box_events(spark, SF),
        td.REPORT_DATE, td.EXCLUDED,
    )


def test_job_gives_the_operators_results(spark, report):
    for name, df in report.results().items():
        assert rows(df) == rows(QUERIES[name](spark, SF)), name


def test_daily_results_agree_with_each_other(report):
    kpis = one(report.cohort_kpis)
    summary = one(report.purchase_summary)
    assert kpis["new_count"] + kpis["ret_count"] == summary["total_payers"]
    assert kpis["new_rev"] + kpis["ret_rev"] == pytest.approx(summary["total_revenue_usd"])
    by_product = one(
        report.revenue_by_product.selectExpr(
            "sum(CAST(revenue_usd AS DECIMAL(18,2))) AS revenue", "sum(transactions) AS n"
        )
    )
    assert float(by_product["revenue"]) == summary["total_revenue_usd"]
    assert by_product["n"] == summary["total_transactions"]
    top = one(report.top_boxes.limit(1))
    openers = one(report.top_box_openers.selectExpr("sum(opens) AS opens"))
    assert openers["opens"] >= top["total_opens"]


def test_results_do_not_depend_on_partitions(spark):
    scattered = {
        name: getattr(td, name)(spark, SF).repartition(13, F.rand(seed))
        for seed, name in enumerate(("purchases", "box_events"))
    }
    day = (td.REPORT_DATE, td.EXCLUDED)
    pairs = {
        "top_spenders": daily.top_spenders(scattered["purchases"], *day),
        "payer_cohort": daily.payer_cohort(scattered["purchases"], *day),
        "top_boxes": boxes.top_boxes(scattered["box_events"], scattered["purchases"], *day),
        "top_openers": boxes.top_openers(scattered["box_events"], scattered["purchases"], *day),
        "latest_vendor_pricing": roster.latest_vendor_pricing(
            td.vendor_pricing(spark, SF).repartition(13, F.rand(3)), td.PRICING_TIE_BREAK
        ),
    }
    for name, df in pairs.items():
        assert rows(df) == rows(QUERIES[name](spark, SF)), name


def test_crossings_meet_their_tier(spark):
    rule = dict((label, limit) for limit, label in crossings.params.TIERS)
    found = QUERIES["tier_crossings"](spark, SF).collect()
    assert found and all(row.ltv_usd >= rule[row.tier_crossed] for row in found)


@pytest.mark.parametrize("limits", [{}, {"MAX_BROADCAST_KEYS": 0}, {"MAX_BROADCAST_BYTES": 1}])
def test_jobs_give_the_same_on_either_road(spark, monkeypatch, tmp_path, limits):
    """Narrowed to a broadcast key set, or aggregated in full: the rows are the same."""
    real = stages.fits_broadcast
    if limits:
        bounds = {
            "max_keys": limits.get("MAX_BROADCAST_KEYS", stages.MAX_BROADCAST_KEYS),
            "max_bytes": limits.get("MAX_BROADCAST_BYTES", stages.MAX_BROADCAST_BYTES),
        }

        def bounded(keys, on="user_id"):
            return real(keys, on, **bounds)

        monkeypatch.setattr(stages, "fits_broadcast", bounded)
        for job in ("roster_job", "crossings_job", "daily_report"):
            monkeypatch.setattr(sys.modules[f"tallyroom.plans.{job}"], "fits_broadcast", bounded)
    as_of = td.CROSSINGS_AS_OF
    crossed = crossings_report(
        td.user_crm(spark, SF, as_of), td.vendor_pricing(spark, SF), td.internal_users(spark, SF),
        td.purchases(spark, SF), as_of,
    )
    for name in ("tier_crossings", "entrant_last_purchases"):
        assert rows(crossed.results()[name]) == rows(QUERIES[name](spark, SF)), name
    refreshed = refresh_roster(
        td.user_crm(spark, SF, td.ROSTER_AS_OF), td.orders_created(spark, SF),
        td.vendor_pricing(spark, SF), td.internal_users(spark, SF), str(tmp_path / "store"),
        td.ROSTER_AS_OF[:10], roster_prev=td.roster_prev(spark, SF),
        tie_break=td.PRICING_TIE_BREAK,
    )
    scored = QUERIES["heat_scores"](spark, SF)
    assert rows(refreshed.roster) == rows(scored)
    counts = dict(tuples(refreshed.heat_summary, "label", "users"))
    assert sum(counts.values()) == scored.count()
    day = daily_report(
        td.logins(spark, SF), td.purchases(spark, SF), td.box_events(spark, SF),
        td.REPORT_DATE, td.EXCLUDED,
    )
    assert rows(day.payer_cohort) == rows(QUERIES["payer_cohort"](spark, SF))


def test_key_sets_are_measured(spark):
    keys = spark.range(10).selectExpr("lpad(CAST(id AS STRING), 5, '0') AS user_id")
    assert stages.fits_broadcast(keys)
    assert stages.fits_broadcast(keys, max_keys=10, max_bytes=50)
    assert not stages.fits_broadcast(keys, max_keys=9)
    assert not stages.fits_broadcast(keys, max_bytes=49)
    assert stages.fits_broadcast(keys.limit(0), max_keys=0, max_bytes=0)


def test_staging_keeps_rows_types_and_the_job_group(spark):
    frames = {"a": spark.range(5), "b": spark.sql("SELECT CAST(1 AS DECIMAL(38,22)) AS x")}
    context = spark.sparkContext
    context.setJobGroup("staging", "two frames")
    try:
        done = stages.staged_together(**frames)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("staging")) >= 2
    for name, frame in frames.items():
        assert done[name].dtypes == frame.dtypes
        assert rows(done[name]) == rows(frame)


class _Session:
    """Stands in for a session that names no scratch folder."""

    def __init__(self, master, folder=None, context_folder=None):
        self.sparkContext = self
        self.conf = {"spark.checkpoint.dir": folder}
        self.master = master
        self.getCheckpointDir = lambda: context_folder


def test_scratch_folder():
    assert stages.scratch_folder(_Session("yarn", "/shared/scratch/")) == "/shared/scratch"
    assert stages.scratch_folder(_Session("yarn", None, "hdfs:/c/1")) == "hdfs:/c/1"
    for master in ("yarn", "local[2]", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            stages.scratch_folder(_Session(master))


def test_staged_folders_go_with_their_scope(spark):
    def staged_folders():
        path = spark._jvm.org.apache.hadoop.fs.Path(stages.scratch_folder(spark))
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        return {str(f.getPath()) for f in files if "tallyroom-stage-" in str(f.getPath())}

    before = staged_folders()
    with stages.stage_scope(spark):
        assert stages.staged(spark.range(3)).count() == 3
        assert len(staged_folders()) == len(before) + 1
    assert staged_folders() == before
    with pytest.raises(RuntimeError), stages.stage_scope(spark):
        stages.staged(spark.range(3))
        raise RuntimeError
    assert staged_folders() == before
