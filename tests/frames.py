"""Small hand-made canonical tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tallyroom.sources.schemas import SCHEMAS

DAY = "2024-03-10"  # the day clocks change in New York


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text if len(text) > 5 else f"{DAY} {text}")


def money(value):
    return None if value is None else Decimal(str(value))


def table(spark, name: str, rows, **extra):
    """A canonical table from dicts; columns left out are NULL."""
    schema = SCHEMAS[name]
    for column, kind in extra.items():
        schema = type(schema)([*schema.fields]).add(column, kind)
    return spark.createDataFrame(
        [tuple(row.get(field) for field in schema.names) for row in rows], schema
    )


def purchases(spark, *rows):
    """(user, time, amount, slug, coupon)"""
    return table(
        spark,
        "purchases",
        [
            {
                "event_id": number,
                "user_id": row[0],
                "event_timestamp": ts(row[1]),
                "amount_usd": money(row[2]),
                "product_slug": row[3] if len(row) > 3 else None,
                "coupon_code": row[4] if len(row) > 4 else None,
            }
            for number, row in enumerate(rows)
        ],
    )


def box_events(spark, *rows):
    """(user, box, volatility, opened, coins)"""
    return table(
        spark,
        "box_events",
        [
            {
                "user_id": row[0],
                "event_timestamp": ts("12:00"),
                "box_display_name": row[1],
                "box_volatility": row[2],
                "boxes_opened_count": row[3],
                "total_coins_spent": money(row[4]),
            }
            for row in rows
        ],
    )


def logins(spark, *users):
    return table(
        spark, "logins", [{"user_id": user, "event_timestamp": ts("08:00")} for user in users]
    )


def crm(spark, *rows):
    """(user, ltv, last amount, last purchase at, purchases, session days)"""
    return table(
        spark,
        "user_crm",
        [
            {
                "user_id": row[0],
                "lifetime_purchases_usd": money(row[1]),
                "last_purchase_amount_usd": money(row[2]),
                "last_purchase_at": ts(row[3]),
                "total_purchases": row[4] if len(row) > 4 else 1,
                "days_since_last_session": row[5] if len(row) > 5 else None,
            }
            for row in rows
        ],
    )


def pricing(spark, *rows):
    """(order, user, time, price, fee)"""
    return table(
        spark,
        "vendor_pricing",
        [
            {
                "order_id": row[0],
                "user_id": row[1],
                "event_timestamp": ts(row[2]),
                "vendor_price": money(row[3]),
                "vendor_fee": money(row[4]),
            }
            for row in rows
        ],
    )


def users(spark, *names):
    return table(spark, "internal_users", [{"user_id": name} for name in names])


def tuples(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]


def one(df) -> dict:
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()
