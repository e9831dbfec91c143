"""Places of rows in a sorted table that no task sees as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.plans.stages import staged


def running(rows: DataFrame, groups: list[str], order: list, sums: dict[str, Column]) -> DataFrame:
    """The rows with, for each name of ``sums``, its sum over the earlier rows of the group, and over the group.

    The sums are named as given and ``all_`` of it. ``order`` holds names of columns, ascending.

    The rows are laid out by ranges of (groups, order), so a group with a third of them stands in
    many partitions. Each (partition, group) is summed up by itself, behind what the earlier
    partitions hold of the group; rows that tie in everything are told apart by a number of their
    own, so they spread too. The groups must not be null. One row of sums for each partition and
    group is all that is looked at across partitions.
    """
    own = {f"own_{name}": value for name, value in sums.items()}
    rows = rows.withColumns({"tie": F.monotonically_increasing_id(), **own})
    laid = staged(rows.repartitionByRange(*groups, *order, "tie").withColumn("part", F.spark_partition_id()))

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    held = laid.groupBy("part", *groups).agg(*[F.sum(name).alias(name) for name in own])
    parts, group = Window.partitionBy(*groups).orderBy("part"), Window.partitionBy(*groups)
    bases = held.select(
        "part",
        *groups,
        *[before(f"own_{name}", parts).alias(f"base_{name}") for name in sums],
        *[F.sum(f"own_{name}").over(group).alias(f"all_{name}") for name in sums],
    )
    inside = Window.partitionBy("part", *groups).orderBy(*order, "tie")
    return (
        laid.withColumns({f"in_{name}": before(f"own_{name}", inside) for name in sums})
        .join(bases, ["part", *groups])
        .withColumns({name: F.col(f"base_{name}") + F.col(f"in_{name}") for name in sums})
        .drop("part", "tie", *[f"{kind}_{name}" for kind in ("own", "in", "base") for name in sums])
    )


def placed(rows: DataFrame, groups: list[str], order: list, weight: Column | None = None) -> DataFrame:
    """The rows with ``pos``, what stands before them in their group, and ``n``, what the group holds.

    Rows are counted, so that ``pos`` is a row's place from 0; with ``weight`` its values are summed.
    """
    one = F.lit(1).cast("bigint") if weight is None else weight
    return running(rows, groups, order, {"pos": one}).withColumnRenamed("all_pos", "n")
