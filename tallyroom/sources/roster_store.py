"""The stored roster: versioned snapshots, and exchange with a hand-edited sheet as CSV.

A snapshot is written under a fresh version directory, checked there and only then announced by a
numbered commit (``sources.commits``). Readers follow the highest number, so clocks of different
hosts do not matter, a failed, lost or empty write never touches the roster in use, and older
versions with their notes stay readable.

Of two writers that read the same roster one gets the next number. The other is told so, with the
number it wanted, and can merge again with the roster that is there now: no refresh hides another.
Stores whose versions were announced as rows of ``published`` are read and continued.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyroom.functions import day_of
from tallyroom.sources.cells import NOTE_LOG, changed_cells
from tallyroom.sources.commits import CommitConflictError, commit, latest
from tallyroom.sources.schemas import ROSTER_COLUMNS, ROSTER_TYPES, SCHEMAS

_POINTER = "version string, snapshot_date date, users bigint, sequence bigint, published_at timestamp"
VERSION_COLUMN = "roster_version"


class EmptyRosterError(ValueError):
    """The refreshed roster has no rows; the stored one stays in use."""


class RosterConflictError(RuntimeError):
    """Another roster was published since the one that this refresh started from."""


class Current(NamedTuple):
    """The version in use and its number; no version and 0 before the first publication."""

    version: str | None
    sequence: int


def publish_roster(
    roster: DataFrame, path: str, snapshot_date: dt.date | str, base: int | None = None
) -> str:
    """Write a scored roster as the new current version and return its name.

    ``base`` is the number of the roster it was made from; if a newer one has been published since,
    ``RosterConflictError`` is raised and nothing is announced. Without ``base`` the roster takes the
    next free number. The plan is evaluated once: the emptiness guard counts the files just written.
    """
    spark = roster.sparkSession
    version = f"{day_of(snapshot_date):%Y%m%d}-{uuid.uuid4().hex}"
    target = f"{path}/versions/{version}"
    roster.select(*ROSTER_COLUMNS).write.mode("error").parquet(target)
    users = spark.read.schema(SCHEMAS["roster_prev"]).parquet(target).count()
    if users == 0:
        raise EmptyRosterError("the roster has no rows, the stored one is kept")
    entry = {
        "version": version,
        "snapshot_date": f"{day_of(snapshot_date):%Y-%m-%d}",
        "users": users,
        "published_at": dt.datetime.now(dt.UTC).isoformat(),
    }
    before = current_roster(spark, path).version
    was = None if before is None else read_roster(spark, path, before)
    stored = spark.read.schema(SCHEMAS["roster_prev"]).parquet(target)
    changed_cells(stored, was).write.mode("error").parquet(f"{path}/notes/version={version}")
    while True:
        number = (current_roster(spark, path).sequence if base is None else base) + 1
        try:
            commit(spark, f"{path}/commits", number, entry)
        except CommitConflictError:
            if base is None:
                continue
            for name in (target, f"{path}/notes/version={version}"):
                folder = spark._jvm.org.apache.hadoop.fs.Path(name)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            raise RosterConflictError(
                f"roster {number} was published by another refresh, this one started from {base}"
            ) from None
        return version


def current_roster(spark: SparkSession, path: str) -> Current:
    """The roster in use."""
    found = latest(spark, f"{path}/commits")
    if found is not None:
        return Current(found[1]["version"], found[0])
    try:
        published = spark.read.schema(_POINTER).parquet(f"{path}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return Current(None, 0)
    place = F.struct(F.coalesce("sequence", F.lit(0)).alias("sequence"), "published_at", "version")
    newest = published.agg(F.max(place).alias("p")).select("p.version", "p.sequence").first()
    return Current(newest["version"], newest["sequence"] or 0)


def note_log(spark: SparkSession, path: str) -> DataFrame:
    """``user_id, field, value, sequence``: every kept cell that a published version has changed."""
    log = StructType.fromDDL(f"{NOTE_LOG}, version string")
    if latest(spark, f"{path}/commits") is None:
        return spark.createDataFrame([], log).select("user_id", "field", "value", F.lit(0).cast("bigint").alias("sequence"))
    number = F.regexp_extract("_metadata.file_name", r"(\d+)", 1).cast("bigint").alias("sequence")
    published = spark.read.schema("version string").json(f"{path}/commits").select("version", number)
    cells = spark.read.schema(log).parquet(f"{path}/notes")
    return cells.join(published, "version").select("user_id", "field", "value", "sequence")


def read_roster(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The current roster, or a given version; empty when nothing has been published yet."""
    version = version or current_roster(spark, path).version
    if version is None:
        empty = spark.createDataFrame([], SCHEMAS["roster_prev"])
        return empty.withColumn("sheet_row", F.lit(0).cast("bigint"))
    rows = spark.read.schema(SCHEMAS["roster_prev"]).parquet(f"{path}/versions/{version}")
    return rows.withColumn("sheet_row", F.monotonically_increasing_id())


def read_sheet_csv(spark: SparkSession, path: str) -> DataFrame:
    """A hand-edited sheet saved as CSV with a header row; blank text reads as ``''``.

    ``sheet_file``, ``sheet_block`` and ``sheet_row`` order the rows as they stand in the files;
    ``roster_version`` is the version that a row was exported from, blank where the sheet has none.
    """
    sheet = spark.read.csv(path, header=True, multiLine=True, escape='"')
    absent = [name for name in ROSTER_COLUMNS if name not in sheet.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return sheet.select(
        *[
            F.col(name).try_cast(ROSTER_TYPES[name]).alias(name)
            if name in ROSTER_TYPES
            else F.coalesce(name, F.lit("")).alias(name)
            for name in ROSTER_COLUMNS
        ],
        (F.coalesce(VERSION_COLUMN, F.lit("")) if VERSION_COLUMN in sheet.columns else F.lit("")).alias(VERSION_COLUMN),
        F.col("_metadata.file_path").alias("sheet_file"),
        F.col("_metadata.file_block_start").alias("sheet_block"),
        F.monotonically_increasing_id().alias("sheet_row"),
    )


SHEET_ORDER = ("sheet_file", "sheet_block", "sheet_row")


class MixedSheetError(ValueError):
    """The rows of a sheet were exported from more than one version."""


def sheet_base(sheet: DataFrame) -> str | None:
    """The version that a sheet was exported from; none where it does not say."""
    known = sheet.filter(F.col(VERSION_COLUMN) != "").select(VERSION_COLUMN).distinct().limit(2).collect()
    if len(known) > 1:
        raise MixedSheetError("the rows of the sheet come from more than one version of the roster")
    return known[0][0] if known else None


def write_sheet_csv(roster: DataFrame, path: str, version: str | None = None) -> None:
    """The roster as CSV text with a header row, for hand editing; NULL becomes blank.

    With ``version`` every row names the version it comes from, so that a later import can tell the
    cells that were edited from those that have changed in the store since.
    """
    named = [] if version is None else [F.lit(version).alias(VERSION_COLUMN)]
    roster.select(*ROSTER_COLUMNS, *named).write.mode("error").csv(
        path,
        header=True,
        escape='"',
        nullValue="",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
