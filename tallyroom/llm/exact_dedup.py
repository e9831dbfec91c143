"""Exact dedup by content sort.

Sampled splitters range-partition the normalised texts, every partition is sorted externally, and
neighbours are compared in full. A splitter holds the first characters of a text and its 64-bit
hash, so what the sampling sends to the driver does not depend on the length of the texts, and
texts with one long common beginning still spread.

A text with more copies than an average partition has rows is hot. Its copies are dealt over
several ranges by a salt from their ids; what belongs to the whole group (the id that stays, the
number of copies) then comes from an aggregation that combines the copies inside every task before
the shuffle. There are fewer hot texts than partitions, which bounds the list of their hashes on
the driver and the table broadcast to their copies.

Defined results: a null text is empty, and empty texts are equal to each other. A null id never
wins against an id. Of rows that repeat both id and text one stays. An empty table gives an empty
result. Extra columns, whatever their names, are carried along and not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.text import ascii_lower, filled, shuffle_partitions, table

SPLITTER_CHARS = 32


def _keyed(docs: DataFrame, text: Column) -> DataFrame:
    norm = ascii_lower(filled(text))
    return docs.withColumns({"norm": norm}).withColumn("h", F.xxhash64("norm"))


def _with_salt(rows: DataFrame, hot: dict[int, int]) -> DataFrame:
    salts = rows.sparkSession.createDataFrame(list(hot.items()), "h bigint, salts bigint")
    salt = F.pmod(F.xxhash64("id"), F.coalesce("salts", F.lit(1).cast("bigint")))
    return rows.join(F.broadcast(salts), "h", "left").withColumn("salt", salt).drop("salts")


def duplicate_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min"
) -> DataFrame:
    """Every row as ``row`` beside ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``keep`` is ``min`` or ``max``: which id of a group of equal texts stays.
    """
    if keep not in ("min", "max"):
        raise ValueError(f"keep must be min or max, not {keep}")
    spark = docs.sparkSession
    rows = _keyed(
        docs.select(F.col(id_col).alias("id"), F.struct("*").alias("row")), F.col(f"row.{text_col}")
    )

    average = -(-docs.count() // shuffle_partitions(spark))
    counted = rows.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > max(average, 1))
    hot = {r["h"]: -(-r["n"] // max(average, 1)) for r in counted.collect()}

    # The sort reads the texts from the row: only the row and the short keys are shuffled.
    keys = ["head", "h", "salt"] if hot else ["head", "h"]
    dealt = (
        (_with_salt(rows, hot) if hot else rows)
        .withColumn("head", F.substring("norm", 1, SPLITTER_CHARS))
        .drop("norm")
        .repartitionByRange(*keys)
        .withColumn("norm", ascii_lower(filled(F.col(f"row.{text_col}"))))
    )
    order = F.col("id").asc_nulls_last() if keep == "min" else F.col("id").desc_nulls_last()
    run = Window.partitionBy(*keys, "norm")
    compared = dealt.select(
        "h",
        "row",
        "id",
        F.sha2("norm", 256).alias("text_sha256"),
        F.row_number().over(run.orderBy(order)).alias("place"),
        F.first("id").over(run.orderBy(order)).alias("keep_id"),
        F.count("*").over(run).alias("group_size"),
    )
    if hot:
        cold = F.col("n").isNull()
        best = F.min("id") if keep == "min" else F.max("id")
        groups = (
            rows.filter(F.col("h").isin(*hot))
            .groupBy("h", "norm")
            .agg(best.alias("best"), F.count("*").alias("n"))
            .select("h", F.sha2("norm", 256).alias("text_sha256"), "best", "n")
        )
        compared = (
            compared.join(F.broadcast(groups), ["h", "text_sha256"], "left")
            .withColumn("place", F.when(cold | F.col("keep_id").eqNullSafe(F.col("best")), F.col("place")))
            .withColumn("keep_id", F.when(cold, F.col("keep_id")).otherwise(F.col("best")))
            .withColumn("group_size", F.coalesce("n", "group_size"))
        )
    return compared.select(
        "row", "keep_id", "group_size", F.coalesce(F.col("place") == 1, F.lit(False)).alias("kept"), "text_sha256"
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows that stay, with their columns as they came."""
    return duplicate_rows(docs, id_col, text_col, keep).filter("kept").select("row.*")


def op10_exact_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = duplicate_rows(docs, keep="max")
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP10_SQL = """
WITH normal AS (
    SELECT doc_id,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
    FROM documents
), grouped AS (
    SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM normal JOIN grouped USING (norm)
"""
