"""Edge cases of the daily operators on hand-made tables."""

import datetime as dt

import pytest

from tallyroom.operators import boxes, daily
from tallyroom.operators.common import without_users
from tests.frames import DAY, box_events, logins, one, purchases, tuples, users


def test_null_and_excluded_users_do_not_count(spark):
    seen = logins(spark, "a", "a", "b", None, "x")
    assert one(daily.daily_active_users(seen, DAY)) == {"daily_active_users": 3}
    assert one(daily.daily_active_users(seen, DAY, ["x"])) == {"daily_active_users": 2}
    listed = users(spark, "x", None)
    assert sorted(tuples(without_users(seen, listed), "user_id")) == [("a",), ("a",), ("b",)]
    assert one(daily.daily_active_users(seen, DAY, listed)) == {"daily_active_users": 2}


def test_day_is_utc_in_any_session_zone(spark):
    bought = purchases(
        spark,
        ("a", "2024-03-09 23:59:59", 1),
        ("b", "2024-03-10 00:00:00", 2),
        ("c", "2024-03-10 02:30:00", 4),
        ("d", "2024-03-10 23:59:59", 8),
        ("e", "2024-03-11 00:00:00", 16),
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(daily.purchase_summary(bought, DAY))["total_revenue_usd"] == 14.0
        prior = tuples(daily.payer_cohort(bought, "2024-03-11"), "user_id", "payer_type")
        assert prior == [("e", "new")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_summary_rounds_ties_up_and_counts_coupons(spark):
    bought = purchases(
        spark,
        ("a", "01:00", "1.00", "x", "SAVE"),
        ("a", "02:00", "1.01", "x"),
        (None, "03:00", "99.00", "x", "SAVE"),
    )
    assert one(daily.purchase_summary(bought, DAY)) == {
        "total_payers": 1,
        "total_transactions": 2,
        "total_revenue_usd": 2.01,
        "avg_transaction_usd": 1.01,  # 1.005
        "transactions_with_coupon": 1,
    }


def test_empty_day(spark):
    bought = purchases(spark, ("a", "2024-03-09 12:00:00", 5))
    summary = daily.purchase_summary(bought, DAY)
    assert one(summary) == {
        "total_payers": 0,
        "total_transactions": 0,
        "total_revenue_usd": None,
        "avg_transaction_usd": None,
        "transactions_with_coupon": 0,
    }
    cohort = daily.payer_cohort(bought, DAY)
    assert cohort.count() == 0
    kpis = one(daily.cohort_kpis(daily.daily_active_users(logins(spark), DAY), summary, cohort))
    assert kpis["pct_new"] == 0 and kpis["pct_ret"] == 100
    assert all(value == 0 for name, value in kpis.items() if name != "pct_ret")
    assert daily.top_spenders(bought, DAY).count() == 0
    assert daily.revenue_by_product(bought, DAY).count() == 0


def test_products_are_labelled_and_ordered(spark):
    bought = purchases(
        spark,
        ("a", "01:00", 3, "5k-coins-shop-item"),
        ("b", "01:00", 3, "big-o'neil-pack"),
        ("b", "01:00", 1, None),
        ("a", "02:00", 4, "étoile-shop-item"),
    )
    assert tuples(daily.revenue_by_product(bought, DAY)) == [
        ("étoile-shop-item", "Étoile", 1, 1, 4.0, 4.0),
        ("5k-coins-shop-item", "5K Coins", 1, 1, 3.0, 3.0),
        ("big-o'neil-pack", "Big O'Neil Pack", 1, 1, 3.0, 3.0),
        (None, None, 1, 1, 1.0, 1.0),
    ]


def test_spenders_list_products_in_time_order(spark):
    bought = purchases(
        spark,
        ("a", "23:00", 1, "late"),
        ("a", "01:30", 1, "early"),
        ("a", "01:30", 1, "same minute"),
        ("a", "02:00", 1, None),
        ("b", "01:00", 4, None),
        ("c", "01:00", 4, "c"),
        ("d", "01:00", 2, "d"),
    )
    assert tuples(daily.top_spenders(bought, DAY, ["d"], n=3)) == [
        ("a", 4, 4.0, "early, same minute, late"),
        ("b", 1, 4.0, None),
        ("c", 1, 4.0, "c"),
    ]
    assert [user for (user,) in tuples(daily.top_spenders(bought, DAY, n=2), "user_id")] == [
        "a",
        "b",
    ]


def test_cohort_history(spark):
    bought = purchases(
        spark,
        ("new", "01:00", 5),
        ("new", "02:00", "5.55"),
        ("back", "2024-02-29 23:59:59", 100),
        ("back", "2024-02-01 00:00:00", 1),
        ("back", "03:00", 10),
        ("back", "2024-03-11 00:00:00", 1000),
        ("gone", "2024-03-09 00:00:00", 7),
        ("staff", "03:00", 10),
        (None, "03:00", 10),
    )
    cohort = daily.payer_cohort(bought, DAY, ["staff"])
    assert tuples(cohort) == [
        ("new", "new", 2, 10.55, 10.55, None, None),
        ("back", "return", 3, 111.0, 10.0, dt.date(2024, 2, 29), 10),
    ]
    assert tuples(daily.returning_payers(cohort)) == [("back", 111.0, 3, 10)]
    kpis = one(
        daily.cohort_kpis(
            daily.daily_active_users(logins(spark, "new"), DAY),
            daily.purchase_summary(bought, DAY, ["staff"]),
            cohort,
        )
    )
    assert kpis == {
        "dau": 1, "total_payers": 2, "total_transactions": 3, "total_revenue_usd": 20.55,
        "avg_transaction_usd": 6.85, "transactions_with_coupon": 0, "new_count": 1,
        "ret_count": 1, "new_rev": 10.55, "ret_rev": 10.0, "pct_new": 50, "pct_ret": 50,
        "new_avg": 10.55, "ret_avg": 10.0, "new_rev_pct": 51, "ret_rev_pct": 49,
        "arppu": 20.55 / 2,
    }


@pytest.fixture(scope="module")
def opened(spark):
    bought = purchases(
        spark, ("a", "01:00", 1), ("b", "01:00", 1), ("x", "01:00", 1),
        ("late", "2024-03-11 01:00:00", 1),
    )
    events = box_events(
        spark,
        ("a", "Red", 10, 2, 10),
        ("a", "Red", 10, 1, 7),
        ("a", "Red", 10, 0, 99),
        ("b", "Red", 80, 4, 2),
        ("b", "Blue", 70, 3, "0.50"),
        ("x", "Blue", 70, 50, 50),
        ("late", "Blue", 70, 50, 50),
        ("nobody", "Blue", 70, 50, 50),
        (None, "Blue", 70, 50, 50),
    )
    return events, bought, DAY, ["x"]


def test_boxes_of_payers(opened):
    assert tuples(boxes.top_boxes(*opened)) == [
        ("Red", 80, 4, 1, 0.5),
        ("Blue", 70, 3, 1, 0.17),
        ("Red", 10, 3, 1, 6.0),  # mean of 5 and 7, the row without opens has no price
    ]
    assert tuples(boxes.top_boxes(*opened, n=1), "box_volatility") == [(80,)]
    assert tuples(boxes.top_openers(*opened)) == [("b", 7, 2, 3.0), ("a", 3, 1, 116.0)]


def test_top_box_counts_all_its_volatilities(opened):
    assert tuples(boxes.top_box_openers(*opened)) == [("Red", "b", 4, 2.0), ("Red", "a", 3, 116.0)]


def test_box_mix_looks_at_the_listed_rows(opened):
    top = boxes.top_boxes(*opened)
    assert one(boxes.box_mix(top, boxes.top_box_openers(*opened))) == {
        "total_opens_all": 10,
        "top_box_opens": 4,
        "top_box_pct": 40,
        "top_user_opens": 4,
        "top_user_pct": 100,
        "weighted_vol": (80 * 4 + 70 * 3 + 10 * 3) / 10,
        "high_vol_opens": 7,
        "high_vol_pct": 70,
    }


def test_user_over_two_volatilities_can_pass_a_hundred_percent(spark):
    bought = purchases(spark, ("a", "01:00", 1))
    events = box_events(spark, ("a", "Red", 10, 3, 1), ("a", "Red", 90, 2, 1))
    args = (events, bought, DAY)
    mix = one(boxes.box_mix(boxes.top_boxes(*args), boxes.top_box_openers(*args)))
    assert (mix["top_box_opens"], mix["top_user_opens"], mix["top_user_pct"]) == (3, 5, 167)


def test_no_boxes(spark):
    args = (box_events(spark), purchases(spark, ("a", "01:00", 1)), DAY)
    top, openers = boxes.top_boxes(*args), boxes.top_box_openers(*args)
    assert top.count() == 0 and openers.count() == 0
    assert set(one(boxes.box_mix(top, openers)).values()) == {0}
