"""The day's ranked observations.

The reports are folded into one row of figures, each rule is a CASE over that row, and the
outcomes are ordered inside the row: nothing is shuffled after the folding.
"""

from __future__ import annotations

import datetime as dt
import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom import params
from tallyroom.functions import day_of, product_label, py_round1, whole_pct
from tallyroom.operators.common import folded, side_by_side


class Case(NamedTuple):
    """One outcome of a rule: a SQL condition on the figures, a priority and two wordings."""

    when: str
    priority: int
    label: str
    detail: str


# The rules by number, each with its cases in order; the first case that holds
# speaks. In the wordings {name} is a whole number, {name:money} has two digits and thousands
# marks, {name:count} thousands marks, {name:tenth} one digit, {name:text} is taken as it is.
NO_PAYERS = Case(
    "total_payers = 0", 10, "No payers today",
    "Zero purchase transactions were recorded for {date_text:text}.",
)
RULES: dict[int, tuple[Case, ...]] = {
    1: (
        Case("new_count = total_payers", 10, "All new payers",
             "Every payer today was a first-time buyer. {new_count} new users generated "
             "${new_rev:money} at ${new_avg:money} avg."),
        Case("ret_count = total_payers", 10, "All return payers",
             "No new buyers today. {ret_count} returning users generated ${ret_rev:money} at "
             "${ret_avg:money} avg."),
        Case("pct_new >= 70", 9, "Heavy new payer skew",
             "{new_count} of {total_payers} payers ({pct_new}%) were new, contributing "
             "${new_rev:money} vs ${ret_rev:money} from {ret_count} returning users."),
        Case("pct_new <= 30", 9, "Return payer dominated",
             "{ret_count} of {total_payers} payers ({pct_ret}%) were returning, driving "
             "${ret_rev:money} ({ret_rev_pct}% of revenue)."),
        Case("true", 6, "Balanced cohort",
             "{new_count} new payers (${new_avg:money} avg) vs {ret_count} returning "
             "(${ret_avg:money} avg) — {bigger_spenders:text} spent more per head."),
    ),
    2: (
        Case("gap_days >= 14", 9, "Long re-engagement",
             "User {gap_user:text} returned after {gap_days} days away with ${gap_ltv:money} "
             "LTV across {gap_purchases} lifetime purchases."),
        Case("gap_days >= 5", 7, "Re-engagement gap",
             "Top returning user came back after {gap_days} days (${gap_ltv:money} LTV)."),
    ),
    3: (
        Case("total_revenue_usd > 0 AND spend_pct >= 40", 8, "Spend concentration",
             "Top spender (user {spender:text}) accounted for ${spend:money} ({spend_pct}% of "
             "total revenue) across {spend_transactions} transactions."),
        Case("total_revenue_usd > 0 AND spend_pct >= 25", 6,
             "Top spender drove {spend_pct}% of revenue",
             "${spend:money} from user {spender:text}."),
    ),
    4: (
        Case("has_openers AND top_user_pct >= 80", 8, "{box:text} monopolised",
             "One user opened {top_user_opens:count} of {top_box_opens:count} {box:text} boxes "
             "({top_user_pct}%)."),
        Case("has_openers AND top_box_pct >= 50", 7, "{box:text} dominates opens",
             "{top_box_opens:count} opens ({top_box_pct}% of all {total_opens_all:count}) "
             "across {box_openers} users."),
    ),
    5: (
        Case("coupon_pct >= 40", 7, "High coupon usage",
             "{transactions_with_coupon} of {total_transactions} transactions ({coupon_pct}%) "
             "used a coupon code, suggesting active discount-driven purchasing."),
        Case("coupon_pct = 0 AND total_transactions >= 5", 5, "No coupons today",
             "All {total_transactions} transactions were full price."),
    ),
    6: (
        Case("total_opens_all > 0 AND high_vol_pct >= 60", 6, "Risk appetite high",
             "{high_vol_pct}% of box opens were on high-volatility boxes (vol >= 70), weighted "
             "avg volatility {mean_vol}."),
        Case("total_opens_all > 0 AND high_vol_pct <= 20", 6, "Conservative box preference",
             "Only {high_vol_pct}% of opens on high-volatility boxes, weighted avg volatility "
             "{mean_vol}."),
    ),
    7: (
        Case("repeat_users > 0", 7, "Repeat buyers",
             "{repeat_users} {repeat_noun:text} made 3+ transactions today, led by user "
             "{repeat_lead:text} with {repeat_transactions} purchases."),
    ),
    8: (
        Case("total_revenue_usd > 0 AND product_pct >= 60", 6,
             "{product:text} drove {product_pct}% of revenue",
             "${product_revenue:money} from {product_transactions} transactions."),
    ),
    9: (
        Case("conversion >= 10", 7, "Strong conversion",
             "{total_payers} of {dau} active users paid today ({conversion:tenth}% payer "
             "conversion rate)."),
        Case("conversion <= 2", 5, "Low conversion",
             "Only {conversion:tenth}% of {dau} active users made a purchase today."),
    ),
}

# Purchases without a slug have no product name to show.
NO_PRODUCT = "No product"

_STYLES = {
    "": "CAST({} AS STRING)",
    "text": "{}",
    "money": "format_number({}, 2)",
    "count": "format_number({}, 0)",
    "tenth": "format_string('%.1f', {})",
}


def _wording(template: str) -> str:
    """A text template as one SQL string expression over the figures."""
    parts = []
    for text, name, style, _ in string.Formatter().parse(template):
        if text:
            parts.append(f"'{text}'")
        if name is not None:
            parts.append(_STYLES[style or ""].format(name))
    return f"concat({', '.join(parts)})"


def _outcome(rule: int, cases: tuple[Case, ...], guard: str) -> str:
    """SQL for one rule: the struct of its first case that holds, else NULL."""
    branches = " ".join(
        f"WHEN {guard} AND {case.when} THEN struct({-case.priority}L AS order, {rule}L AS rule, "
        f"{_wording(case.label)} AS label, {_wording(case.detail)} AS detail)"
        for case in cases
    )
    return f"CASE {branches} END"


def _first(order: dict[str, bool], *columns: str) -> str:
    """SQL for the struct of the first row: names to sort by (True: largest first), then values.

    As an aggregate it keeps one row per task, and the sorting of its input becomes irrelevant.
    """
    keys = [
        f"coalesce(-CAST({name} AS DOUBLE), CAST('Infinity' AS DOUBLE))" if down else name
        for name, down in order.items()
    ]
    return f"min(struct({', '.join([*keys, *columns])}))"


def observation_figures(
    products: DataFrame,
    boxes: DataFrame,
    spenders: DataFrame,
    openers: DataFrame,
    kpis: DataFrame,
    returning: DataFrame,
    mix: DataFrame,
    report_date: dt.date | str | None = None,
) -> DataFrame:
    """Every figure the rules look at, in one row.

    Without ``report_date`` the frames have a column of that name, and every day has a row.
    """
    keys = () if report_date is not None else ("report_date",)
    by_revenue = _first(
        {"revenue_usd": True, "product_slug": False}, "revenue_usd AS rev", "transactions"
    )
    product = folded(products, keys).agg(F.expr(by_revenue).alias("top")).select(
        *keys,
        F.when(
            F.col("top").isNotNull(),
            F.coalesce(product_label(F.col("top.product_slug")), F.lit(NO_PRODUCT)),
        ).alias("product"),
        F.expr("top.rev AS product_revenue"),
        F.expr("top.transactions AS product_transactions"),
    )
    by_opens = _first(
        {"total_opens": True, "box_display_name": False, "box_volatility": False},
        "unique_openers",
    )
    box = folded(boxes, keys).agg(F.expr(by_opens).alias("top")).selectExpr(
        *keys, "top.box_display_name AS box", "top.unique_openers AS box_openers"
    )
    by_spend = _first(
        {"total_spend_usd": True, "user_id": False}, "transactions", "total_spend_usd AS spend"
    )
    spender = folded(spenders, keys).agg(
        F.expr(by_spend).alias("top"),
        F.expr(f"{by_spend} FILTER (WHERE transactions >= 3)").alias("again"),
        F.count_if(F.col("transactions") >= 3).alias("repeat_users"),
    ).selectExpr(
        *keys,
        "top.user_id AS spender",
        "top.spend",
        "top.transactions AS spend_transactions",
        "repeat_users",
        "again.user_id AS repeat_lead",
        "again.transactions AS repeat_transactions",
    )
    by_gap = _first(
        {"days_since_last_purchase": True, "lifetime_value_usd": True, "user_id": False},
        "days_since_last_purchase AS days",
        "lifetime_value_usd AS ltv",
        "lifetime_purchases AS purchases",
    )
    gap = folded(returning, keys).agg(
        F.expr(f"{by_gap} FILTER (WHERE days_since_last_purchase > 0)").alias("top")
    ).selectExpr(
        *keys,
        "top.user_id AS gap_user",
        "top.days AS gap_days",
        "top.ltv AS gap_ltv",
        "top.purchases AS gap_purchases",
    )
    opened = folded(openers, keys).agg((F.count("*") > 0).alias("has_openers"))
    row = side_by_side(kpis, mix, product, box, spender, gap, opened, keys=keys)
    revenue = F.col("total_revenue_usd")
    return row.select(
        "*",
        (F.col("report_date").cast("string") if keys else F.lit(day_of(report_date).isoformat())).alias("date_text"),
        F.expr("if(ret_avg > new_avg, 'returners', 'new users') AS bigger_spenders"),
        F.expr("if(repeat_users > 1, 'users', 'user') AS repeat_noun"),
        F.expr("CAST(rint(weighted_vol) AS BIGINT) AS mean_vol"),
        whole_pct(F.col("spend"), revenue).alias("spend_pct"),
        whole_pct(F.col("product_revenue"), revenue).alias("product_pct"),
        whole_pct(F.col("transactions_with_coupon"), F.col("total_transactions")).alias(
            "coupon_pct"
        ),
        py_round1(F.expr("total_payers / nullif(dau, 0) * 100")).alias("conversion"),
    )


def ranked_observations(
    figures: DataFrame, n: int = params.TOP_OBSERVATIONS, keep: Sequence[str] = ()
) -> DataFrame:
    """The n observations of highest priority for each row of figures.

    Equal priorities keep the order of the rules. ``keep`` names columns to carry along, such
    as the day a row belongs to.
    """
    outcomes = [
        _outcome(0, (NO_PAYERS,), "true"),
        *[_outcome(rule, cases, "total_payers > 0") for rule, cases in RULES.items()],
    ]
    held = f"filter(array({', '.join(outcomes)}), o -> o IS NOT NULL)"
    return figures.selectExpr(
        *keep, f"posexplode(slice(array_sort({held}), 1, {int(n)})) AS (pos, o)"
    ).selectExpr(
        *keep,
        "CAST(pos + 1 AS BIGINT) AS rank",
        "-o.order AS priority",
        "o.rule AS rule",
        "o.label AS label",
        "o.detail AS detail",
    )


def observations(
    products: DataFrame,
    boxes: DataFrame,
    spenders: DataFrame,
    openers: DataFrame,
    kpis: DataFrame,
    returning: DataFrame,
    mix: DataFrame,
    report_date: dt.date | str,
    n: int = params.TOP_OBSERVATIONS,
) -> DataFrame:
    """The day's n observations of highest priority."""
    figures = observation_figures(
        products, boxes, spenders, openers, kpis, returning, mix, report_date
    )
    return ranked_observations(figures, n)
