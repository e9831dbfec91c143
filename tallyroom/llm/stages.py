"""Tables between the steps of an operator or a pipeline, and keys of their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.llm.text import table
from tallyroom.plans.stages import stage_scope, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def run_stages(spark: SparkSession, sf_dir: str, stages: list[tuple[str, Stage]]) -> DataFrame:
    """Every stage's rows are written and read again as the documents of the next.

    What a stage staged on its way goes once its rows are written, and so do the rows of the stage
    before it.
    """
    docs, last = table(spark, sf_dir, "documents"), None
    for _, stage in stages:
        with stage_scope(spark) as scope:
            docs = staged(stage(spark, docs, sf_dir))
            written = scope.released()
            if last is not None:
                scope.add(last)
            last = written
    return docs


def keyed_rows(docs: DataFrame, stored: bool = False) -> DataFrame:
    """Every row as ``row`` beside ``rid``, a key of its own, which may be joined with again.

    ``stored`` says that ``docs`` are the rows of a file table as they lie there; a row is then named
    by its file and its place in it. All others are written once, with a number each.
    """
    row = F.struct("*").alias("row")
    if stored and "_metadata" not in docs.columns:
        place = F.struct(
            F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")
        )
        try:
            return docs.select(place.alias("rid"), row)
        except AnalysisException as error:  # rows that do not come from files
            if error.getCondition() not in ("UNRESOLVED_COLUMN.WITH_SUGGESTION", "UNRESOLVED_COLUMN.WITHOUT_SUGGESTION"):
                raise
    return staged(docs.select(F.monotonically_increasing_id().alias("rid"), row))
