"""Tables stored in buckets of a key, so that joins and groups by it need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_buckets(rows: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Store rows as the table ``name`` at ``path``, in ``buckets`` by ``key``, sorted by it inside.

    One task writes a bucket, so a bucket is one file. Tables that are to be joined need the same
    number of buckets; choose it for files of some hundred megabytes.
    """
    laid = rows.repartition(buckets, key)
    laid.write.mode("error").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def read_buckets(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def hot_keys(rows: DataFrame, key: str, buckets: int) -> list:
    """Keys with more rows than an average bucket, of a table stored in buckets of the key.

    There are fewer than buckets. Counting them needs no shuffle, since a bucket holds all rows of a key.
    """
    counted = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    most = max(rows.count() // buckets, 1)
    return [row[key] for row in counted.filter(F.col("n") > most).collect()]
