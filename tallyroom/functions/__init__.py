"""Column expressions shared by the operators; all of them stay inside the JVM."""

from tallyroom.functions.rounding import cents, mean2, py_round1, round2, whole_pct
from tallyroom.functions.text import clock_text, product_label, stripped
from tallyroom.functions.time import date_literal, day_of, utc_literal, utc_wall, within

__all__ = [
    "cents",
    "clock_text",
    "date_literal",
    "day_of",
    "mean2",
    "product_label",
    "py_round1",
    "round2",
    "stripped",
    "utc_literal",
    "utc_wall",
    "whole_pct",
    "within",
]
