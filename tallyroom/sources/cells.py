"""The hand-kept cells of a roster or sheet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.sources.schemas import IDENTITY_COLUMNS, MANAGER_COLUMNS

KEPT_COLUMNS = (*IDENTITY_COLUMNS, *MANAGER_COLUMNS)
# A cell of a sheet that reads as the number 0.
ZERO = r"^\s*[+-]?(0+\.?0*|\.0+)\s*$"


def cell(name: str) -> Column:
    """A kept cell as the roster holds it: blank for nothing, and for nothing but a zero."""
    value = F.coalesce(name, F.lit(""))
    return F.when(value.rlike(ZERO), "").otherwise(value).alias(name)


def row_order(rows: DataFrame) -> list[str]:
    return ["sheet_row"] if "sheet_row" in rows.columns else ["user_id"]


def last_rows(rows: DataFrame, order: Sequence[str], side: str) -> DataFrame:
    """The kept cells of each user's last row as one struct."""
    cells = F.struct(*map(cell, KEPT_COLUMNS))
    return (
        rows.filter(F.col("user_id") != "")
        .select("user_id", cells.alias("cells"), F.struct(*order).alias("place"))
        .groupBy("user_id")
        .agg(F.max_by("cells", "place").alias(side))
    )


NOTE_LOG = "user_id string, field string, value string"


def changed_cells(roster: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """``user_id, field, value`` for the kept cells that are not blank and differ from ``before``."""
    now = last_rows(roster, row_order(roster), "now")
    if before is not None:
        now = now.join(last_rows(before, row_order(before), "was"), "user_id", "left")
        was = [F.coalesce(f"was.{name}", F.lit("")) for name in KEPT_COLUMNS]
    else:
        was = [F.lit("")] * len(KEPT_COLUMNS)
    cells = [
        F.when(
            (F.col(f"now.{name}") != "") & (F.col(f"now.{name}") != old),
            F.struct(F.lit(name).alias("field"), F.col(f"now.{name}").alias("value")),
        )
        for name, old in zip(KEPT_COLUMNS, was, strict=True)
    ]
    return now.select("user_id", F.inline(F.array_compact(F.array(*cells))))
