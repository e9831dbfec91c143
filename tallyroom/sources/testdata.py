"""Canonical tables derived from the generic test tables by plain SQL expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.functions import utc_literal

# Parameters of the test runs.
REPORT_DATE = "2024-01-04"
RANGE_START, RANGE_END = "2024-01-02", "2024-01-31"
ARRIVAL_DAYS = ("2024-01-01", "2024-01-02", "2024-01-03", REPORT_DATE)
CROSSINGS_AS_OF = "2024-01-05 00:00:00"
ROSTER_AS_OF = "2024-01-31 00:00:00"
EXCLUDED = tuple(str(user) for user in (3, 7, 11, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59))
PRICING_TIE_BREAK = ("l_linenumber", "l_partkey", "l_suppkey")

_K = "CAST(get_json_object(props, '$.k') AS INT)"
_EVENT = ("event_id", "CAST(user_id AS STRING) AS user_id", "ts AS event_timestamp")


# The columns of the test tables that are used; naming them saves a job per read that would
# open file footers to find the schema.
_COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").where("event_type = 'view'").selectExpr(*_EVENT)


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "events")
        .where("event_type = 'purchase'")
        .selectExpr("*", f"{_K} AS k")
        .selectExpr(
            *_EVENT,
            "CAST(value AS DECIMAL(18,2)) AS amount_usd",
            "CASE k % 6 WHEN 0 THEN '5k-coins-shop-item' WHEN 1 THEN 'starter-pack-shop-item' "
            "WHEN 2 THEN 'coin-pack-small-shop-item' WHEN 3 THEN 'coin-pack-large-shop-item' "
            "WHEN 4 THEN 'season-bundle' END AS product_slug",
            "CASE WHEN k % 3 = 0 THEN concat('SAVE', k) END AS coupon_code",
        )
    )


def purchase_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with the day they arrive on: every seventh two days late, all by the report day."""
    late = "date_add(to_date(event_timestamp), if(event_id % 7 = 0, 2, 0))"
    day = f"DATE '{REPORT_DATE}'"
    arrival = f"if(to_date(event_timestamp) <= {day}, least({late}, {day}), to_date(event_timestamp)) AS arrival_date"
    return purchases(spark, sf_dir).selectExpr("*", arrival)


def box_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "events")
        .where("event_type IN ('click', 'error')")
        .selectExpr("*", f"{_K} AS k")
        .selectExpr(
            *_EVENT,
            "concat('Box ', k % 12) AS box_display_name",
            "k % 12 * 8 + if(k >= 96, 5, 0) AS box_volatility",
            "event_id % 6 AS boxes_opened_count",
            "CAST(value AS DECIMAL(18,2)) AS total_coins_spent",
        )
    )


def orders_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "CAST(o_custkey AS STRING) AS user_id",
        "o_orderdate AS event_timestamp",
    )


def vendor_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = _table(spark, sf_dir, "orders").where("o_custkey % 10 <> 0")
    lines = _table(spark, sf_dir, "lineitem")
    return lines.join(priced, F.expr("l_orderkey = o_orderkey")).selectExpr(
        "l_orderkey AS order_id",
        "CAST(o_custkey AS STRING) AS user_id",
        "l_shipdate AS event_timestamp",
        *PRICING_TIE_BREAK,
        "CAST(l_quantity AS DECIMAL(18,2)) AS vendor_price",
        "CASE WHEN l_returnflag <> 'R' THEN CAST(l_tax * 10 AS DECIMAL(18,2)) END AS vendor_fee",
    )


def internal_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = _table(spark, sf_dir, "events").where("user_id % 13 = 0")
    return staff.selectExpr("CAST(user_id AS STRING) AS user_id").distinct()


def user_crm(spark: SparkSession, sf_dir: str, as_of: dt.datetime | str) -> DataFrame:
    """One row per user with a purchase before ``as_of``, in one pass over the events."""
    bought = "event_type = 'purchase'"
    seen = f"event_type = 'signup' AND {_K} < 10"
    per_user = (
        _table(spark, sf_dir, "events")
        .where("event_type IN ('purchase', 'signup')")
        .where(F.col("ts") < utc_literal(as_of))
        .withColumn("amount", F.expr("CAST(value AS DECIMAL(18,2))"))
        .groupBy("user_id")
        .agg(
            F.expr(f"CAST(sum(amount) FILTER (WHERE {bought}) AS DECIMAL(18,2)) AS ltv"),
            F.expr(f"max(struct(ts, event_id, amount)) FILTER (WHERE {bought}) AS last"),
            F.expr(f"count_if({bought}) AS n"),
            F.expr(f"max(ts) FILTER (WHERE {seen}) AS session"),
        )
        .where("n > 0")
        .withColumn("today", F.to_date(utc_literal(as_of)))
    )
    customers = _table(spark, sf_dir, "customer").join(
        _table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"), "left"
    )
    return per_user.join(customers, F.expr("user_id = c_custkey"), "left").selectExpr(
        "CAST(user_id AS STRING) AS user_id",
        "ltv AS lifetime_purchases_usd",
        "last.amount AS last_purchase_amount_usd",
        "last.ts AS last_purchase_at",
        "n AS total_purchases",
        "date_diff(today, to_date(last.ts)) AS days_since_last_purchase",
        "date_diff(today, to_date(session)) AS days_since_last_session",
        "if(n >= 10, 'loyal', 'active') AS lifecycle_state",
        "n_name AS country",
        "c_mktsegment AS favorite_box_category",
    )


def _kept_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS sheet_row",
        "CAST(c_custkey AS STRING) AS user_id",
        "'Customer' AS first_name",
        "substring_index(c_name, '#', -1) AS last_name",
        "concat('u', c_custkey, '@example.com') AS email",
        "'email' AS preferred_channel",
        "CASE c_custkey % 4 WHEN 0 THEN 'new' WHEN 1 THEN 'engaged' WHEN 3 THEN ' new ' END "
        "AS relationship_stage",
        "CAST(NULL AS STRING) AS last_contacted_at",
        "CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment END AS conversation_note_1",
        "CASE WHEN c_custkey % 5 = 1 THEN '   ' END AS conversation_note_2",
        "CAST(NULL AS STRING) AS conversation_note_3",
        "CAST(NULL AS STRING) AS manager_notes",
    )


def roster_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_rows(spark, sf_dir).where("sheet_row % 3 <> 0")


def roster_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``roster_prev`` as a manager has edited it: cells changed and cleared, rows deleted and added."""
    k = F.col("sheet_row")
    edited = {
        "manager_notes": F.when(k % 11 == 0, F.concat(F.lit("sheet "), k)),
        "relationship_stage": F.when(k % 8 == 1, "won").otherwise(F.col("relationship_stage")),
        "conversation_note_1": F.when(k % 10 == 0, "").otherwise(F.col("conversation_note_1")),
        "preferred_channel": F.when(k % 13 == 0, "phone").otherwise("email"),
    }
    rows = _kept_rows(spark, sf_dir).where("sheet_row % 3 <> 0 AND sheet_row % 7 <> 6 OR sheet_row % 12 = 0")
    return rows.withColumns(edited)


def roster_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``roster_prev`` as another manager has changed it in the meantime."""
    k = F.col("sheet_row")
    edited = {
        "manager_notes": F.when(k % 22 == 0, F.concat(F.lit("other "), k)).when(
            k % 55 == 0, F.concat(F.lit("sheet "), k)
        ),
        "relationship_stage": F.when(k % 16 == 1, "lost").otherwise(F.col("relationship_stage")),
        "preferred_channel": F.when(k % 26 == 0, "phone").when(k % 17 == 0, "0").otherwise("email"),
    }
    rows = _kept_rows(spark, sf_dir).where("sheet_row % 3 <> 0 AND sheet_row % 9 <> 8 OR sheet_row % 6 = 3")
    return rows.withColumns(edited)
