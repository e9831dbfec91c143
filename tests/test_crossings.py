"""Edge cases of the tier crossings on hand-made tables."""

import pytest

from tallyroom.functions import clock_text
from tallyroom.operators import crossings
from tests.frames import crm, one, pricing, purchases, ts, tuples, users

NOW = "2024-03-10 12:00:00"


def test_vendor_cost_needs_both_sides(spark):
    costs = crossings.vendor_cost_by_user(
        pricing(
            spark,
            (1, "a", "01:00", "10.10", "0.20"),
            (1, "a", "02:00", "10.10", "0.20"),
            (2, "a", "01:00", 99, None),
            (3, "b", "01:00", None, 5),
        )
    )
    assert sorted(tuples(costs)) == [("a", 20.6), ("b", None)]


@pytest.fixture(scope="module")
def found(spark):
    people = crm(
        spark,
        ("exact", 100, 1, "10:00"),
        ("was there", 150, 50, "10:00"),
        ("two tiers", "1000.00", "900.01", "10:00"),
        ("gold", "250.00", "0.01", "10:00"),
        ("on the hour", 120, 120, "2024-03-09 12:00:00"),
        ("too early", 120, 120, "2024-03-09 11:59:59"),
        ("now", 110, 110, "2024-03-10 12:00:00"),
        ("later", 125, 125, "2024-03-10 12:00:01"),
        ("staff", 120, 120, "10:00"),
        ("poor", "99.99", "99.99", "10:00"),
        (None, 130, 130, "10:00"),
    )
    prices = pricing(
        spark,
        (1, "exact", "01:00", 150, "0.10"),
        (2, "gold", "01:00", None, 1),
    )
    return crossings.tier_crossings(people, prices, users(spark, "staff", None), NOW)


def test_crossings(found):
    assert tuples(found) == [
        ("two tiers", 1000.0, 1000.0, True, "GOAT"),
        ("gold", 250.0, 250.0, False, "Gold"),
        (None, 130.0, 130.0, True, "VIP"),
        ("on the hour", 120.0, 120.0, True, "VIP"),
        ("now", 110.0, 110.0, True, "VIP"),
        ("exact", 100.0, -50.1, False, "VIP"),
    ]


def test_own_tiers_in_any_order(spark):
    people = crm(spark, ("a", 60, 30, "10:00"), ("b", 10, 10, "10:00"))
    tiers = [(5, "low"), (50, "high")]
    rows = crossings.tier_crossings(people, pricing(spark), users(spark), NOW, tiers)
    assert tuples(rows, "user_id", "tier_crossed") == [("a", "high"), ("b", "low")]


@pytest.fixture(scope="module")
def bought(spark):
    return purchases(
        spark,
        ("exact", "2024-03-01 21:07:00", 5, "old"),
        ("exact", "09:00", 6, "first of two"),
        ("exact", "09:00", 7, "second of two"),
        ("exact", "12:00", 8, "not yet"),
        ("gold", "2024-01-05 21:07:59", 9, ""),
        ("stranger", "09:00", 6, "x"),
        (None, "09:00", 6, "x"),
    )


def test_last_purchases(found, bought):
    assert tuples(crossings.entrant_last_purchases(found, bought, NOW)) == [
        ("exact", ts("09:00"), 7.0, "second of two", 1),
        ("exact", ts("09:00"), 6.0, "first of two", 2),
        ("gold", ts("2024-01-05 21:07:59"), 9.0, "", 1),
    ]


def test_feed_keeps_users_without_purchases(found, bought):
    feed = crossings.entrant_feed(found, crossings.entrant_last_purchases(found, bought, NOW))
    shown = {row.user_id: (row.purchase_count, row.purchases) for row in feed.collect()}
    assert list(shown) == ["two tiers", "gold", None, "on the hour", "now", "exact"]
    assert shown["two tiers"] == (0, None)
    assert [tuple(p) for p in shown["gold"][1]] == [(1, "Sat Jan 6, 12:07 AM", 9.0, "—")]
    assert [p.product_slug for p in shown["exact"][1]] == ["second of two", "first of two"]


def test_clock_ignores_the_session_zone(spark):
    times = {
        "2024-03-10 02:30:00": "Sun Mar 10, 2:30 AM",  # skipped by New York's clocks
        "2024-12-31 12:05:00": "Tue Dec 31, 12:05 PM",
        "2024-02-29 00:00:59": "Thu Feb 29, 12:00 AM",
    }
    events = purchases(spark, *[("a", time, 1) for time in times])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        shown = events.select(clock_text(events.event_timestamp, 0).alias("shown"))
        assert [row.shown for row in shown.collect()] == list(times.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_nobody_crossed(spark):
    none = crossings.tier_crossings(crm(spark), pricing(spark), users(spark), NOW)
    feed = crossings.entrant_feed(
        none, crossings.entrant_last_purchases(none, purchases(spark), NOW)
    )
    assert one(feed.selectExpr("count(*) AS n")) == {"n": 0}
