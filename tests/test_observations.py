"""Every observation rule on, off and at its bounds."""

import pytest
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructType

from tallyroom.operators import boxes, daily
from tallyroom.operators.observations import observations, ranked_observations
from tests.frames import DAY, box_events, logins, purchases, tuples

# A day on which only the cohort rule speaks.
QUIET = {
    "date_text": DAY, "dau": 100, "total_payers": 5, "total_transactions": 4,
    "total_revenue_usd": 1000.0, "transactions_with_coupon": 1, "new_count": 2, "ret_count": 3,
    "pct_new": 40, "pct_ret": 60, "new_rev": 400.0, "ret_rev": 600.0, "new_avg": 200.0,
    "ret_avg": 200.0, "new_rev_pct": 40, "ret_rev_pct": 60, "bigger_spenders": "new users",
    "gap_user": None, "gap_days": None, "gap_ltv": None, "gap_purchases": None,
    "spender": "s", "spend": 100.0, "spend_pct": 10, "spend_transactions": 2,
    "has_openers": True, "box": "Red", "box_openers": 9, "top_user_pct": 10, "top_box_pct": 20,
    "top_user_opens": 1200, "top_box_opens": 12000, "total_opens_all": 60000,
    "coupon_pct": 25, "high_vol_pct": 40, "mean_vol": 33, "repeat_users": 0,
    "repeat_noun": "user", "repeat_lead": None, "repeat_transactions": None,
    "product": "5K Coins", "product_pct": 10, "product_revenue": 100.0,
    "product_transactions": 1, "conversion": 5.0,
}

COHORT = (6, 1, "Balanced cohort",
          "2 new payers ($200.00 avg) vs 3 returning ($200.00 avg) — new users spent more per "
          "head.")

CASES = {
    "quiet": ({}, []),
    "no payers": (
        {"total_payers": 0, "conversion": 0.0},
        [(10, 0, "No payers today", f"Zero purchase transactions were recorded for {DAY}.")]),
    "all new": (
        {"new_count": 5, "ret_count": 0, "pct_new": 100, "new_rev": 1234.5, "new_avg": 246.9},
        [(10, 1, "All new payers",
          "Every payer today was a first-time buyer. 5 new users generated $1,234.50 at $246.90 "
          "avg.")]),
    "all returning": (
        {"new_count": 0, "ret_count": 5, "pct_new": 0},
        [(10, 1, "All return payers",
          "No new buyers today. 5 returning users generated $600.00 at $200.00 avg.")]),
    "70 % new": (
        {"pct_new": 70},
        [(9, 1, "Heavy new payer skew",
          "2 of 5 payers (70%) were new, contributing $400.00 vs $600.00 from 3 returning "
          "users.")]),
    "69 % new": ({"pct_new": 69}, []),
    "30 % new": (
        {"pct_new": 30, "pct_ret": 70},
        [(9, 1, "Return payer dominated",
          "3 of 5 payers (70%) were returning, driving $600.00 (60% of revenue).")]),
    "31 % new": ({"pct_new": 31}, []),
    "gap 14": (
        {"gap_user": "u", "gap_days": 14, "gap_ltv": 1234.5, "gap_purchases": 7},
        [(9, 2, "Long re-engagement",
          "User u returned after 14 days away with $1,234.50 LTV across 7 lifetime purchases.")]),
    "gap 13": (
        {"gap_user": "u", "gap_days": 13, "gap_ltv": 2.0, "gap_purchases": 7},
        [(7, 2, "Re-engagement gap",
          "Top returning user came back after 13 days ($2.00 LTV).")]),
    "gap 4": ({"gap_user": "u", "gap_days": 4, "gap_ltv": 2.0, "gap_purchases": 7}, []),
    "spender 40 %": (
        {"spend_pct": 40},
        [(8, 3, "Spend concentration",
          "Top spender (user s) accounted for $100.00 (40% of total revenue) across 2 "
          "transactions.")]),
    "spender 39 %": (
        {"spend_pct": 39},
        [(6, 3, "Top spender drove 39% of revenue", "$100.00 from user s.")]),
    "spender 24 %": ({"spend_pct": 24}, []),
    "spender without revenue": ({"spend_pct": 40, "total_revenue_usd": 0.0}, []),
    "box user 80 %": (
        {"top_user_pct": 80, "top_box_pct": 90},
        [(8, 4, "Red monopolised", "One user opened 1,200 of 12,000 Red boxes (80%).")]),
    "box 50 %": (
        {"top_user_pct": 79, "top_box_pct": 50},
        [(7, 4, "Red dominates opens", "12,000 opens (50% of all 60,000) across 9 users.")]),
    "box 49 %": ({"top_box_pct": 49}, []),
    "box without openers": ({"top_user_pct": 80, "has_openers": False}, []),
    "coupons 40 %": (
        {"coupon_pct": 40},
        [(7, 5, "High coupon usage",
          "1 of 4 transactions (40%) used a coupon code, suggesting active discount-driven "
          "purchasing.")]),
    "coupons 0 % of 5": (
        {"coupon_pct": 0, "total_transactions": 5},
        [(5, 5, "No coupons today", "All 5 transactions were full price.")]),
    "coupons 0 % of 4": ({"coupon_pct": 0}, []),
    "risky 60 %": (
        {"high_vol_pct": 60},
        [(6, 6, "Risk appetite high",
          "60% of box opens were on high-volatility boxes (vol >= 70), weighted avg volatility "
          "33.")]),
    "careful 20 %": (
        {"high_vol_pct": 20},
        [(6, 6, "Conservative box preference",
          "Only 20% of opens on high-volatility boxes, weighted avg volatility 33.")]),
    "middle 59 %": ({"high_vol_pct": 59}, []),
    "middle 21 %": ({"high_vol_pct": 21}, []),
    "no opens": ({"high_vol_pct": 0, "total_opens_all": 0}, []),
    "one repeater": (
        {"repeat_users": 1, "repeat_lead": "r", "repeat_transactions": 3},
        [(7, 7, "Repeat buyers",
          "1 user made 3+ transactions today, led by user r with 3 purchases.")]),
    "two repeaters": (
        {"repeat_users": 2, "repeat_noun": "users", "repeat_lead": "r",
         "repeat_transactions": 4},
        [(7, 7, "Repeat buyers",
          "2 users made 3+ transactions today, led by user r with 4 purchases.")]),
    "product 60 %": (
        {"product_pct": 60},
        [(6, 8, "5K Coins drove 60% of revenue", "$100.00 from 1 transactions.")]),
    "product 59 %": ({"product_pct": 59}, []),
    "conversion 10": (
        {"conversion": 10.0},
        [(7, 9, "Strong conversion",
          "5 of 100 active users paid today (10.0% payer conversion rate).")]),
    "conversion 9.9": ({"conversion": 9.9}, []),
    "conversion 2": (
        {"conversion": 2.0},
        [(5, 9, "Low conversion", "Only 2.0% of 100 active users made a purchase today.")]),
    "conversion 2.1": ({"conversion": 2.1}, []),
    "nobody active": ({"dau": 0, "conversion": None}, []),
}


@pytest.fixture(scope="module")
def spoken(spark):
    kinds = {bool: BooleanType(), int: LongType(), float: DoubleType(), str: StringType()}
    nullable = {
        "gap_user": StringType(), "gap_days": LongType(), "gap_ltv": DoubleType(),
        "gap_purchases": LongType(), "repeat_lead": StringType(),
        "repeat_transactions": LongType(),
    }
    schema = StructType().add("case", StringType())
    for name, value in QUIET.items():
        schema = schema.add(name, nullable.get(name) or kinds[type(value)])
    figures = spark.createDataFrame(
        [(case, *{**QUIET, **changed}.values()) for case, (changed, _) in CASES.items()], schema
    )
    found = {}
    for row in ranked_observations(figures, 20, keep=["case"]).orderBy("case", "rank").collect():
        found.setdefault(row["case"], []).append(tuple(row)[1:])
    return found


@pytest.mark.parametrize("case", CASES)
def test_rule(spoken, case):
    changed, expected = CASES[case]
    rows = [row[1:] for row in spoken[case]]
    assert [rank for rank, *_ in spoken[case]] == list(range(1, len(rows) + 1))
    if not any(rule in (0, 1) for _, rule, *_ in expected):
        expected = sorted([*expected, COHORT], key=lambda row: (-row[0], row[1]))
    assert rows == expected


def test_order_and_limit(spark):
    """From raw tables: equal priorities keep the order of the rules, and three are shown."""
    bought = purchases(
        spark,
        *[("a", "01:00", 1, "starter-pack-shop-item", "SAVE")] * 3,
        ("b", "02:00", "97.25", None),
        ("b", "2024-02-01 10:00:00", 1),
    )
    events = box_events(spark, ("a", "Red", 90, 5, 5))
    args = (events, bought, DAY)
    summary = daily.purchase_summary(bought, DAY)
    cohort = daily.payer_cohort(bought, DAY)
    active = daily.daily_active_users(logins(spark, "a", "b", "c"), DAY)
    top, openers = boxes.top_boxes(*args), boxes.top_box_openers(*args)
    found = observations(
        daily.revenue_by_product(bought, DAY), top, daily.top_spenders(bought, DAY), openers,
        daily.cohort_kpis(active, summary, cohort), daily.returning_payers(cohort),
        boxes.box_mix(top, openers), DAY, n=20,
    )
    assert tuples(found, "rank", "priority", "rule", "label") == [
        (1, 9, 2, "Long re-engagement"),
        (2, 8, 3, "Spend concentration"),
        (3, 8, 4, "Red monopolised"),
        (4, 7, 5, "High coupon usage"),
        (5, 7, 7, "Repeat buyers"),
        (6, 7, 9, "Strong conversion"),
        (7, 6, 1, "Balanced cohort"),
        (8, 6, 6, "Risk appetite high"),
        (9, 6, 8, "No product drove 97% of revenue"),
    ]
    details = dict(tuples(found, "rule", "detail"))
    assert details[1] == (
        "1 new payers ($3.00 avg) vs 1 returning ($97.25 avg) — returners spent more per head."
    )
    assert details[9] == "2 of 3 active users paid today (66.7% payer conversion rate)."
