"""Schemas of the canonical tables.

Event times are zone-less UTC. ``event_id`` is only a tie-break between events of one user at
one instant. A table may carry further columns, such as an ``event_date`` partition column.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# The column groups of the stored roster and their order.
AUTO_COLUMNS = (
    "user_id", "tier", "ltv_usd", "net_spend_usd", "last_purchase_date",
    "days_since_last_purchase", "days_since_last_session", "lifecycle_state",
    "total_purchases", "avg_transaction_usd", "country", "favorite_box_category",
)
IDENTITY_COLUMNS = ("first_name", "last_name", "email")
NOTE_COLUMNS = ("conversation_note_1", "conversation_note_2", "conversation_note_3")
MANAGER_COLUMNS = (
    "preferred_channel", "relationship_stage", "last_contacted_at", *NOTE_COLUMNS, "manager_notes",
)
SCORE_COLUMNS = (
    "recency_score", "context_score", "hot_cold_score", "hot_cold_label", "score_updated",
)
ROSTER_COLUMNS = (
    "user_id", *IDENTITY_COLUMNS, *AUTO_COLUMNS[1:], *MANAGER_COLUMNS, *SCORE_COLUMNS,
)

_MONEY = DecimalType(18, 2)
_TEXT = StringType()
_INSTANT = TimestampNTZType()

# Columns of the stored roster that are not text.
ROSTER_TYPES: dict[str, DataType] = {
    "ltv_usd": DoubleType(),
    "net_spend_usd": DoubleType(),
    "last_purchase_date": DateType(),
    "days_since_last_purchase": IntegerType(),
    "days_since_last_session": IntegerType(),
    "total_purchases": LongType(),
    "avg_transaction_usd": DoubleType(),
    "recency_score": DoubleType(),
    "context_score": IntegerType(),
    "hot_cold_score": DoubleType(),
    "score_updated": DateType(),
}


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


SCHEMAS: dict[str, StructType] = {
    "logins": _schema(user_id=_TEXT, event_timestamp=_INSTANT),
    "purchases": _schema(
        event_id=LongType(),
        user_id=_TEXT,
        event_timestamp=_INSTANT,
        amount_usd=_MONEY,
        product_slug=_TEXT,
        coupon_code=_TEXT,
    ),
    "box_events": _schema(
        user_id=_TEXT,
        event_timestamp=_INSTANT,
        box_display_name=_TEXT,
        box_volatility=IntegerType(),
        boxes_opened_count=LongType(),
        total_coins_spent=_MONEY,
    ),
    "user_crm": _schema(
        user_id=_TEXT,
        lifetime_purchases_usd=_MONEY,
        last_purchase_amount_usd=_MONEY,
        last_purchase_at=_INSTANT,
        total_purchases=LongType(),
        days_since_last_purchase=IntegerType(),
        days_since_last_session=IntegerType(),
        lifecycle_state=_TEXT,
        country=_TEXT,
        favorite_box_category=_TEXT,
    ),
    "internal_users": _schema(user_id=_TEXT),
    "vendor_pricing": _schema(
        order_id=LongType(),
        user_id=_TEXT,
        event_timestamp=_INSTANT,
        vendor_price=_MONEY,
        vendor_fee=_MONEY,
    ),
    "orders_created": _schema(order_id=LongType(), user_id=_TEXT),
    "roster_prev": _schema(**{name: ROSTER_TYPES.get(name, _TEXT) for name in ROSTER_COLUMNS}),
}
