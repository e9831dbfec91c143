"""Defaults of the reports. Every operator takes them as keyword arguments."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple


class Tier(NamedTuple):
    threshold: int
    label: str


# Spend tiers, row limits and score cut points of the reports.
TIERS: tuple[Tier, ...] = (Tier(1000, "GOAT"), Tier(250, "Gold"), Tier(100, "VIP"))
TOP_BOXES = 10
TOP_OPENERS = 5
TOP_SPENDERS = 5
TOP_OBSERVATIONS = 3
ENTRANT_PURCHASES = 2
NEEDS_ATTENTION = 5
CROSSING_WINDOW_HOURS = 24
DISPLAY_OFFSET_HOURS = 3
HEAT_LABELS: tuple[tuple[str, int], ...] = (
    ("Hot", 70), ("Warm", 40), ("Cold", 15), ("Inactive", 0),
)
RECENCY_DAYS = 30
CONTEXT_WITH_NOTES = 70
CONTEXT_WITHOUT_NOTES = 50
NEW_STAGE = "new"
HIGH_VOLATILITY = 70


def ordered_tiers(tiers: Sequence[tuple[float, str]]) -> list[Tier]:
    """Tiers from the highest threshold down."""
    if not tiers:
        raise ValueError("at least one tier is needed")
    return sorted((Tier(*tier) for tier in tiers), key=lambda tier: -tier.threshold)
