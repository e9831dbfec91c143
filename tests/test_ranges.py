"""Ranges of days, the kept payer state, and distinct users over longer spans, against the daily operators."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyroom.operators import boxes, daily, daily_range, distinct_users, payer_state
from tallyroom.plans import daily_report, range_report
from tallyroom.plans.cohort_job import StateDayError, advance_cohort, read_state, start_state
from tallyroom.sources.commits import CommitConflictError
from tests.frames import purchases, table, tuples

FIRST, LAST = dt.date(2024, 3, 1), dt.date(2024, 3, 30)
DAYS = [FIRST + dt.timedelta(days=i) for i in range(30)]
EXCLUDED = ["staff"]


def drawn_purchases(seed=7, n=500):
    """(user, time, amount, slug, coupon): a hot user, users without an id, amounts that are missing, empty days."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        day = dt.date(2024, 2, 20) + dt.timedelta(days=rng.randrange(42))
        if day in (DAYS[4], DAYS[29]):
            continue
        user = rng.choice(["hot", "hot", "staff", None, *[f"u{i}" for i in range(60)]])
        time = f"{day} {rng.choice(['00:00:00', '12:30:00', '23:59:59'])}"
        amount = rng.choice([None, "0.00", "-1.50", "19.99", "5.005"[:4], "100"])
        rows.append((user, time, amount, rng.choice([None, "a-pack", "b"]), rng.choice([None, "SAVE"])))
    return rows


@pytest.fixture(scope="module")
def bought(spark):
    return purchases(spark, *drawn_purchases())


@pytest.fixture(scope="module")
def seen(spark):
    rng = random.Random(3)
    names = ["hot", None, "staff", *"abcdef"]
    rows = [
        {"user_id": rng.choice(names), "event_timestamp": dt.datetime.combine(rng.choice(DAYS[1:20]), dt.time(10))}
        for _ in range(200)
    ]
    return table(spark, "logins", rows)


def per_day(df, *columns):
    """Rows of every day, in the order of the frame."""
    found = {}
    for row in df.collect():
        values = row.asDict()
        found.setdefault(values.pop("report_date"), []).append(tuple(values[c] for c in columns or values))
    return found


def test_every_day_of_the_range(spark, bought, seen):
    active = daily_range.daily_active_users_range(seen, FIRST, LAST, EXCLUDED)
    summary = daily_range.purchase_summary_range(bought, FIRST, LAST, EXCLUDED)
    products = daily_range.revenue_by_product_range(bought, FIRST, LAST, EXCLUDED)
    cohort = daily_range.payer_cohort_range(bought, FIRST, LAST, EXCLUDED)
    kpis = daily_range.cohort_kpis_range(active, summary, cohort)
    found = [per_day(df) for df in (active, summary, products, cohort, kpis)]
    assert list(found[0]) == list(found[1]) == list(found[4]) == DAYS
    for day in (DAYS[0], DAYS[1], DAYS[4], DAYS[13], DAYS[28], DAYS[29]):
        one = daily.daily_active_users(seen, day, EXCLUDED)
        total = daily.purchase_summary(bought, day, EXCLUDED)
        rows = daily.payer_cohort(bought, day, EXCLUDED)
        single = [one, total, daily.revenue_by_product(bought, day, EXCLUDED), rows, daily.cohort_kpis(one, total, rows)]
        assert [tuples(df) for df in single] == [ranged.get(day, []) for ranged in found], day


def test_a_range_of_one_day_and_none(spark, bought, seen):
    day = DAYS[13]
    assert per_day(daily_range.payer_cohort_range(bought, day, day, EXCLUDED)) == {
        day: tuples(daily.payer_cohort(bought, day, EXCLUDED))
    }
    nothing = bought.filter("false")
    assert daily_range.payer_cohort_range(nothing, FIRST, LAST).count() == 0
    assert tuples(daily_range.purchase_summary_range(nothing, day, day)) == [(day, 0, 0, None, None, 0)]
    with pytest.raises(ValueError, match="before it begins"):
        daily_range.daily_active_users_range(seen, LAST, FIRST)


def test_boxes_of_every_day(spark, bought):
    rng = random.Random(1)
    rows = table(
        spark,
        "box_events",
        [
            {
                "user_id": rng.choice(["hot", "staff", None, *[f"u{i}" for i in range(20)]]),
                "event_timestamp": dt.datetime.combine(rng.choice(DAYS), dt.time(9)),
                "box_display_name": rng.choice(["A", "B", "C"]),
                "box_volatility": rng.choice([10, 80]),
                "boxes_opened_count": rng.choice([0, 1, 5, None]),
                "total_coins_spent": None,
            }
            for _ in range(400)
        ],
    )
    activity = daily_range.payer_box_activity_range(rows, bought, FIRST, LAST, EXCLUDED)
    tops = per_day(daily_range.top_boxes_range(activity, 3))
    openers = per_day(daily_range.top_openers_range(activity, 2))
    for day in (DAYS[0], DAYS[4], DAYS[11], DAYS[20]):
        assert tops.get(day, []) == tuples(boxes.top_boxes(rows, bought, day, EXCLUDED, 3))
        assert openers.get(day, []) == tuples(boxes.top_openers(rows, bought, day, EXCLUDED, 2))


def test_the_report_of_a_range_is_that_of_its_days(spark, tmp_path):
    """Every result of the job for several days at once, days without any rows included."""
    rng = random.Random(5)
    bought = purchases(spark, *drawn_purchases(5, 250))
    names = ["hot", "staff", None, *[f"u{i}" for i in range(20)]]
    opened = table(
        spark,
        "box_events",
        [
            {
                "user_id": rng.choice(names),
                "event_timestamp": dt.datetime.combine(rng.choice(DAYS[:12]), dt.time(9)),
                "box_display_name": rng.choice(["A", "B", "C", ""]),
                "box_volatility": rng.choice([10, 80, None]),
                "boxes_opened_count": rng.choice([1, 5, 2]),
                "total_coins_spent": Decimal("12.50"),
            }
            for _ in range(300)
        ],
    )
    logged = table(
        spark, "logins", [{"user_id": rng.choice(names), "event_timestamp": dt.datetime.combine(rng.choice(DAYS[:9]), dt.time(1))} for _ in range(80)]
    )
    stored = []
    for name, df in (("l", logged), ("p", bought), ("b", opened)):
        df.write.parquet(str(tmp_path / name))
        stored.append(spark.read.parquet(str(tmp_path / name)))
    found = {name: per_day(df, *[c for c in df.columns if c != "report_date"]) for name, df in range_report(*stored, DAYS[2], DAYS[7], EXCLUDED).results().items()}
    for day in DAYS[2:8]:
        for name, df in daily_report(*stored, day, EXCLUDED).results().items():
            assert tuples(df) == found[name].get(day, []), (name, day)
    assert {day for days in found.values() for day in days} == set(DAYS[2:8])


def test_a_range_is_pruned_where_days_are_partitions(spark, tmp_path, bought):
    bought.withColumn("event_date", F.to_date("event_timestamp")).write.partitionBy("event_date").parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    ranged = daily_range.purchase_summary_range(stored, FIRST, LAST, EXCLUDED, partition_date="event_date")
    plan = ranged._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert tuples(ranged) == tuples(daily_range.purchase_summary_range(bought, FIRST, LAST, EXCLUDED))


# The kept state


def test_cohort_from_the_state_every_day_of_a_month(spark, tmp_path):
    """Rows arrive up to nine days late; each day's cohort is that of what is known by then."""
    rng = random.Random(11)
    rows = [(*row, rng.choice([0, 0, 0, 1, 4, 9])) for row in drawn_purchases(11, 300)]
    known = purchases(spark, *[row[:5] for row in rows])
    late = spark.createDataFrame([(i, row[5]) for i, row in enumerate(rows)], "event_id bigint, late int")
    arrived = known.join(F.broadcast(late), "event_id").withColumn(
        "arrival", F.date_add(F.to_date("event_timestamp"), F.col("late"))
    ).drop("late")
    arrived.write.parquet(str(tmp_path / "arrived"))
    arrived = spark.read.parquet(str(tmp_path / "arrived"))
    store = str(tmp_path / "store")
    before = FIRST - dt.timedelta(days=1)
    start_state(arrived.filter(F.col("arrival") <= F.lit(before)), store, before, EXCLUDED)
    for day in DAYS:
        cohort = advance_cohort(arrived.filter(F.col("arrival") == F.lit(day)), store, day, EXCLUDED)
        whole = daily.payer_cohort(arrived.filter(F.col("arrival") <= F.lit(day)), day, EXCLUDED)
        assert tuples(cohort) == tuples(whole), day
    state, through = read_state(spark, store)
    everything = payer_state.payer_state(arrived.filter(F.col("arrival") <= F.lit(LAST)), LAST, EXCLUDED)
    assert through == LAST and sorted(tuples(state)) == sorted(tuples(everything))


def test_the_state_moves_once_a_day(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    rows = purchases(spark, ("a", "2024-03-02 10:00:00", "5"), ("b", "2024-03-03 10:00:00", "7"))
    first = advance_cohort(rows, store, "2024-03-02")
    # Without a stored state everyone is new; rows of later days wait.
    assert tuples(first, "user_id", "payer_type") == [("a", "new")]
    with pytest.raises(StateDayError, match="too late"):
        advance_cohort(rows, store, "2024-03-02")
    # Two runs of one day that start from the same state: the second cannot store its own.
    from tallyroom.plans import cohort_job

    old = cohort_job.read_state(spark, store)
    advance_cohort(rows.filter("user_id = 'b'"), store, "2024-03-03")
    monkeypatch.setattr(cohort_job, "read_state", lambda *_: old)
    with pytest.raises(CommitConflictError):
        advance_cohort(rows.filter("user_id = 'b'"), store, "2024-03-03")
    monkeypatch.undo()
    state, through = read_state(spark, store)
    assert through == dt.date(2024, 3, 3) and {row.user_id: row.purchases for row in state.collect()} == {"a": 1, "b": 1}


def test_the_wide_road_gives_the_same_cohort(spark, tmp_path, monkeypatch, bought):
    from tallyroom.plans import cohort_job

    day = DAYS[13]
    history = bought.filter(F.col("event_timestamp") < F.lit(str(day)).cast("timestamp_ntz"))
    today = bought.filter(F.to_date("event_timestamp") == F.lit(day))
    found = []
    for road in ("narrow", "wide"):
        if road == "wide":
            monkeypatch.setattr(cohort_job, "narrowed", lambda rows, keys: rows)
        store = str(tmp_path / road)
        start_state(history, store, day - dt.timedelta(days=1), EXCLUDED)
        found.append(tuples(advance_cohort(today, store, day, EXCLUDED)))
    assert found[0] == found[1] == tuples(daily.payer_cohort(bought, day, EXCLUDED))


# Distinct users


def test_distinct_users_unite(spark, bought, tmp_path):
    rows = bought.withColumn("day", F.to_date("event_timestamp"))
    old = rows.filter(F.col("day") < F.lit(DAYS[10]))
    distinct_users.numbered_users(old).write.parquet(str(tmp_path / "n1"))
    known = spark.read.parquet(str(tmp_path / "n1"))
    distinct_users.numbered_users(rows, known).write.parquet(str(tmp_path / "n2"))
    numbers = known.unionByName(spark.read.parquet(str(tmp_path / "n2")))
    assert numbers.count() == numbers.select("number").distinct().count() == rows.select("user_id").dropna().distinct().count()
    sets = distinct_users.user_bitmaps(rows, numbers, ["day", "product_slug"])
    for keys in ([], ["day"], ["product_slug"], ["day", "product_slug"], [F.weekofyear("day").alias("week")]):
        found = distinct_users.united_counts(sets, keys, "users")
        wanted = rows.filter("user_id IS NOT NULL").groupBy(*keys).agg(F.count_distinct("user_id").alias("users"))
        assert sorted(tuples(found), key=repr) == sorted(tuples(wanted), key=repr)
    assert distinct_users.united_counts(sets.filter("false"), ["day"], "users").count() == 0


def test_blocks_of_users_are_filled(spark):
    """A day costs one row per block of 32,768 users, however its events are spread."""
    rows = spark.range(200_000).selectExpr("CAST(id % 100000 AS string) AS user_id", "'d' AS day")
    numbers = distinct_users.numbered_users(rows.repartition(2)).coalesce(2)
    numbers = spark.createDataFrame(numbers.collect(), distinct_users.NUMBERS)
    sets = distinct_users.user_bitmaps(rows, numbers, ["day"])
    assert sets.count() <= 100_000 // 32_768 + 1 + 8 and tuples(distinct_users.united_counts(sets, ["day"], "n")) == [("d", 100_000)]
