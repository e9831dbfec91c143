"""Reading the canonical tables.

Nothing here filters or caps rows; day filters belong to the operators and reach the scan from
there. Lay event tables out by a UTC ``event_date`` partition column where they are large: the
operators then add the matching partition filter by themselves.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType, TimestampType

from tallyroom.sources.schemas import SCHEMAS


TIE_BREAKS = {"event_id"}
AS_STORED = {"order_id"}


def _typed(name: str, source: DataType, target: DataType) -> Column:
    column = F.col(name)
    if source == target:
        return column
    if isinstance(source, TimestampType) and target.simpleString() == "timestamp_ntz":
        # Stays an instant, which day filters can push to the scan; operators convert it behind them.
        return column
    return column.cast(target).alias(name)


def _column(field: StructField, have: dict[str, DataType]) -> Column:
    if field.name in AS_STORED:
        return F.col(field.name)
    if field.name not in have:
        return F.lit(None).cast(field.dataType).alias(field.name)
    return _typed(field.name, have[field.name], field.dataType)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Bring the schema's columns to its types and keep further columns.

    An absent tie-break column becomes NULL, any other absent column is an error. Order ids keep
    the type they are stored in.
    """
    have = {field.name: field.dataType for field in df.schema}
    absent = [name for name in schema.names if name not in have and name not in TIE_BREAKS]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    typed = [_column(field, have) for field in schema]
    return df.select(*typed, *[name for name in have if name not in schema.names])


def read_table(
    spark: SparkSession,
    location: str,
    name: str,
    fmt: str = "parquet",
    stored_as: str | None = None,
) -> DataFrame:
    """One canonical table from ``<location>/<name>``, or from the catalog when ``fmt`` is "table".

    ``stored_as`` names the folder or table where it differs from the canonical name.
    """
    stored = stored_as or name
    if fmt == "table":
        raw = spark.table(f"{location}.{stored}")
    else:
        raw = spark.read.format(fmt).load(f"{location.rstrip('/')}/{stored}")
    return conform(raw, SCHEMAS[name])


def read_tables(
    spark: SparkSession, location: str, names: Iterable[str], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    return {name: read_table(spark, location, name, fmt) for name in names}
