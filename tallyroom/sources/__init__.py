"""Canonical input tables and the stored loyalty roster."""

from tallyroom.sources.roster_store import (
    EmptyRosterError,
    MixedSheetError,
    RosterConflictError,
    current_roster,
    note_log,
    publish_roster,
    read_roster,
    read_sheet_csv,
    sheet_base,
    write_sheet_csv,
)
from tallyroom.sources.schemas import SCHEMAS
from tallyroom.sources.tables import conform, read_table, read_tables

__all__ = [
    "EmptyRosterError",
    "MixedSheetError",
    "RosterConflictError",
    "SCHEMAS",
    "conform",
    "current_roster",
    "note_log",
    "publish_roster",
    "read_roster",
    "read_sheet_csv",
    "read_table",
    "read_tables",
    "sheet_base",
    "write_sheet_csv",
]
